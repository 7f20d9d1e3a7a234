"""Registered queries: every product of the package over the given tables.

``queries()`` maps a name to ``(spark, sf_dir) -> DataFrame``; ``oracle_sql()``
gives the SQL of the same meaning for DuckDB.
"""

from __future__ import annotations

import sys
from collections.abc import Callable
from datetime import date, timedelta
from functools import wraps
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import oracles
from listenlake.functions.times import epoch_millis, utc_date, utc_hour
from listenlake.operators.lookup import attach_key
from listenlake.operators.ordering import dense_keys
from listenlake.operators.runs import state_runs
from listenlake.operators.scd2 import append_members
from listenlake.operators.scratch import materialise, on_clear, scratch_path
from listenlake.plans import calendars, checks, dimensions, facts, marts, sketches, users
from listenlake.plans.warehouse import Warehouse
from listenlake.schemas import TOPIC_SCHEMAS, lake_schema, require_columns
from listenlake.sources import messages, playlog
from listenlake.sources.tables import between_dates, read_version
from listenlake.streaming import compact, ingest, refresh

FIRST_LOAD = date(2024, 1, 16)
NEXT_LOAD = date(2024, 2, 1)

# Per application and folder: the visits derived from its tables, and the warehouse built on them.
_visits_of: dict[tuple[str, str], DataFrame] = {}
_warehouses: dict[tuple[str, str], Warehouse] = {}
_facts: dict[tuple[str, str, bool], DataFrame] = {}
_followed: dict[tuple[str, str], Warehouse] = {}
# What they point to goes with the scratch folder.
for _cache in (_visits_of, _warehouses, _facts, _followed):
    on_clear(_cache.clear)


def _visits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All visits of ``sf_dir``, derived from its tables and stored when first used."""
    at = (spark.sparkContext.applicationId, sf_dir)
    if at not in _visits_of:
        _visits_of[at] = materialise(playlog.numbered_visits(spark, sf_dir), "visits")
    return _visits_of[at]


def _warehouse(spark: SparkSession, sf_dir: str) -> Warehouse:
    """The stored tables of ``sf_dir``: visits at once, each dimension when first used."""
    at = (spark.sparkContext.applicationId, sf_dir)
    if at not in _warehouses:
        # A projection of the stored visits: cheaper to read off them than to store once more.
        plays = ingest.enrich(playlog.topic_events(_visits(spark, sf_dir), "listen_events"))
        _warehouses[at] = Warehouse(spark, scratch_path(spark, "warehouse"), plays, FIRST_LOAD)
    return _warehouses[at]


def _plays(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _warehouse(spark, sf_dir).plays


def _stored_fact(spark: SparkSession, sf_dir: str, by_hour: bool) -> DataFrame:
    """The facts of all dates, loaded when first used."""
    at = (spark.sparkContext.applicationId, sf_dir, by_hour)
    if at not in _facts:
        store = _warehouse(spark, sf_dir)
        dates = store.plays.agg(F.min("event_date").alias("first"), F.max("event_date").alias("last")).first()
        _facts[at] = store.load_facts(dates["first"], dates["last"], by_hour)
    return _facts[at]


def _without_zone(frame: DataFrame) -> DataFrame:
    """TIMESTAMP columns as TIMESTAMP_NTZ in UTC, the form the oracle has."""
    zoned = [name for name, kind in frame.dtypes if kind == "timestamp"]
    return frame.withColumns({c: F.col(c).cast("timestamp_ntz") for c in zoned})


# --- ingest ---------------------------------------------------------------------------


def _topic(spark: SparkSession, sf_dir: str, topic: str) -> DataFrame:
    return playlog.topic_events(_visits(spark, sf_dir), topic)


def _parse(topic: str) -> Callable[[SparkSession, str], DataFrame]:
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        sent = messages.as_messages(_topic(spark, sf_dir, topic).drop("event_id"), topic)
        # Stored before the split, as the lake does: a filter on the fresh parse would parse twice.
        return ingest.good_rows(materialise(ingest.parse_topic(sent, topic, TOPIC_SCHEMAS[topic]), topic))

    return query


def ingest_quarantine(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Messages by outcome when one in ten is no JSON and one in ten has no text."""
    topic = "listen_events"
    rows = _topic(spark, sf_dir, topic)
    sent = messages.as_messages(rows, topic).withColumn("id", F.get_json_object(F.col("value").cast("string"), "$.event_id"))
    broken = sent.withColumn(
        "value",
        F.when(F.col("id") % 10 == 0, F.lit("not json").cast("binary")).when(F.col("id") % 10 != 1, F.col("value")),
    )
    parsed = ingest.parse_topic(broken, topic, TOPIC_SCHEMAS[topic])
    return parsed.groupBy("quality", F.coalesce("bad_reason", F.lit("none")).alias("reason")).agg(
        F.count("*").alias("message_rows"), F.sum("ts").alias("sum_ts")
    )


def ingest_bad_times(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lake rows by outcome when four in ten messages have an impossible time and one an unreadable place."""
    topic = "listen_events"
    kind = F.get_json_object("text", "$.event_id") % 10
    spoilt = (
        F.when(kind == 0, F.regexp_replace("text", r'"ts":\d+', '"ts":9223372036854775807'))
        .when(kind == 1, F.regexp_replace("text", r'"ts":(\d+)', '"ts":$1000'))
        .when(kind == 2, F.regexp_replace("text", r'"ts":', '"ts":-'))
        .when(kind == 3, F.regexp_replace("text", r'"ts":\d+', '"ts":"yesterday"'))
        .when(kind == 4, F.regexp_replace("text", r'"sessionId":\d+', '"sessionId":"unknown"'))
        .otherwise(F.col("text"))
    )
    sent = messages.as_messages(_topic(spark, sf_dir, topic), topic).withColumn("text", F.col("value").cast("string"))
    sent_to, output, state = (scratch_path(spark, label) for label in ("messages", "lake", "checkpoints"))
    sent.withColumn("value", spoilt.cast("binary")).drop("text").write.parquet(f"{sent_to}/{topic}")
    stream = messages.stream_messages(spark, f"{sent_to}/{topic}")
    ingest.wait_for([ingest.ingest_topic(stream, topic, output, state, None)])
    lake = spark.read.schema(lake_schema(TOPIC_SCHEMAS[topic])).parquet(f"{output}/{topic}")
    return lake.groupBy("quality", F.coalesce("bad_reason", F.lit("none")).alias("reason")).agg(
        F.count("*").alias("message_rows"), F.count("raw_value").alias("kept_texts"), F.sum("ts").alias("sum_ts")
    )


def _streamed(spark: SparkSession, sf_dir: str, topics: list[str], start) -> str:
    """Send the topics through a message folder and a caught-up stream; returns the output folder."""
    sent_to, output, state = (scratch_path(spark, label) for label in ("messages", "lake", "checkpoints"))
    for topic in topics:
        rows = _topic(spark, sf_dir, topic).drop("event_id")
        messages.as_messages(rows, topic).write.parquet(f"{sent_to}/{topic}")
    queries = ingest.run_topics(
        topics,
        lambda topic: messages.stream_messages(spark, f"{sent_to}/{topic}"),
        lambda frame, topic: start(frame, topic, output, state, None),
    )
    ingest.wait_for(queries)
    return output


def ingest_stream_append(spark: SparkSession, sf_dir: str) -> DataFrame:
    lake = _streamed(spark, sf_dir, ["listen_events"], ingest.ingest_topic)
    return ingest.read_lake(spark, f"{lake}/listen_events", "listen_events")


def ingest_stream_topics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All four topics side by side: rows, users and times that arrived in each lake table."""
    lake = _streamed(spark, sf_dir, list(TOPIC_SCHEMAS), ingest.ingest_topic)
    arrived = None
    for topic in TOPIC_SCHEMAS:
        rows = ingest.read_lake(spark, f"{lake}/{topic}", topic)
        part = rows.groupBy("event_date").agg(
            F.count("*").alias("event_rows"), F.sum("ts").alias("sum_ts"), F.sum("userId").alias("sum_user_id")
        )
        part = part.select(F.lit(topic).alias("topic"), *part.columns)
        arrived = part if arrived is None else arrived.unionByName(part)
    return arrived


def ingest_deduplicated(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What arrives when every message is sent again in a second batch, and one in three twice in the first."""
    topic = "listen_events"
    sent_to, output, state = (scratch_path(spark, label) for label in ("messages", "lake", "checkpoints"))
    rows = _topic(spark, sf_dir, topic)
    once = messages.as_messages(rows.drop("event_id"), topic)
    again = messages.as_messages(rows.filter("event_id % 3 = 0").drop("event_id"), topic)
    for batch in (once.unionByName(again), once):
        batch.write.mode("append").parquet(sent_to)
        stream = messages.stream_messages(spark, sent_to)
        ingest.wait_for([ingest.ingest_topic(stream, topic, output, state, None, repeats_within="400 days")])
    lake = ingest.read_lake(spark, f"{output}/{topic}", topic)
    return lake.groupBy("event_date").agg(
        F.count("*").alias("event_rows"), F.sum("ts").alias("sum_ts"), F.sum("userId").alias("sum_user_id")
    )


def lake_compacted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows by date and by the form they are read in, when all dates but the last are compacted."""
    topic = "listen_events"
    lake = f"{_streamed(spark, sf_dir, [topic], ingest.ingest_topic)}/{topic}"
    dates = ingest.read_lake(spark, lake, topic).agg(F.min("event_date").alias("first"), F.max("event_date").alias("last")).first()
    compact.compact_dates(spark, lake, topic, dates["first"], dates["last"] - timedelta(days=1))
    rows = compact.read_lake_rows(spark, lake, topic)
    large = F.contains(F.input_file_name(), F.lit(compact.compacted_path(topic))).alias("compacted")
    return rows.groupBy("event_date", large).agg(
        F.count("*").alias("event_rows"), F.sum("ts").alias("sum_ts")
    )


def check_required_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of each topic that lack a value in a column that later steps need; a missing column raises."""
    needed = ["ts", "sessionId", "userId", "level"]
    found = None
    for topic in TOPIC_SCHEMAS:
        rows = require_columns(_topic(spark, sf_dir, topic), needed)
        counts = rows.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in needed])
        part = counts.unpivot([], needed, "column_name", "null_rows").select(F.lit(topic).alias("topic"), "column_name", "null_rows")
        found = part if found is None else found.unionByName(part)
    return found


def archive_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    archive = _streamed(spark, sf_dir, ["page_view_events"], ingest.archive_topic)
    return ingest.read_archive(spark, f"{archive}/page_view_events", "page_view_events")


def ingest_event_date(spark: SparkSession, sf_dir: str) -> DataFrame:
    ts = epoch_millis("ts")
    events = playlog.table(spark, sf_dir, "events")
    return events.select("event_id", utc_date(ts).alias("event_date"), utc_hour(ts).alias("event_hour"))


def ingest_masked_registration(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = ingest.enrich(_visits(spark, sf_dir))
    return rows.select("event_id", "userId", "registration", "registration_date")


# --- dimensions -----------------------------------------------------------------------


def dim_song(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dimensions.song_dimension(_plays(spark, sf_dir))


def dim_artist(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dimensions.artist_dimension(_plays(spark, sf_dir), FIRST_LOAD)


def dim_city(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dimensions.city_dimension(_plays(spark, sf_dir))


def dim_device(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dimensions.device_dimension(_plays(spark, sf_dir))


def dim_date(spark: SparkSession, sf_dir: str) -> DataFrame:
    return calendars.day_calendar(calendars.range_of_plays(_plays(spark, sf_dir)))


def dim_date_hour(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _without_zone(calendars.hour_calendar(calendars.range_of_plays(_plays(spark, sf_dir))))


def _printable_end(history: DataFrame) -> DataFrame:
    """The open end lies in year 9999, beyond what nanosecond clients hold: shown as text."""
    text = F.date_format("rowExpirationDate", "yyyy-MM-dd HH:mm:ss")
    return _without_zone(history.withColumn("rowExpirationDate", text))


def dim_user_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _printable_end(users.user_history(_plays(spark, sf_dir)))


def dim_user(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _printable_end(users.user_dimension(_warehouse(spark, sf_dir).table("dim_user_history")))


def dim_song_from_none(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Songs appended to a table that was never written: reading it gives no rows of its schema."""
    never = read_version(spark, scratch_path(spark, "never"), "song_name string, song_duration double, song_id bigint")
    return append_members(never, dimensions.song_members(_plays(spark, sf_dir)), dimensions.SONG_KEY, "song_id")


def dim_session(spark: SparkSession, sf_dir: str) -> DataFrame:
    sessions = dimensions.session_dimension(_plays(spark, sf_dir), FIRST_LOAD)
    return _without_zone(dimensions.with_start_month(sessions))


def _early(plays: DataFrame) -> DataFrame:
    return plays.filter(F.col("event_date") < F.lit(FIRST_LOAD))


def scd2_session_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sessions known so far (cut short for even users), then a load that lacks user 7."""
    plays = _plays(spark, sf_dir)
    early = _early(plays)
    ends = materialise(early.groupBy("sessionId").agg(F.max("ts").alias("last_ts")), "ends")
    known = early.join(ends, "sessionId").filter("userId % 2 = 1 OR ts < last_ts")
    existing = materialise(dimensions.session_dimension(known, FIRST_LOAD), "sessions")
    return _without_zone(
        dimensions.session_dimension(plays.filter("userId <> 7"), NEXT_LOAD, existing).select(*existing.columns)
    )


def dim_artist_increment(spark: SparkSession, sf_dir: str) -> DataFrame:
    plays = _plays(spark, sf_dir)
    existing = dimensions.artist_dimension(_early(plays), FIRST_LOAD)
    return dimensions.artist_dimension(plays, NEXT_LOAD, existing)


# --- facts and checks -----------------------------------------------------------------


def fact_plays_day(spark: SparkSession, sf_dir: str) -> DataFrame:
    store = _warehouse(spark, sf_dir)
    return facts.fact_by_day(store.plays, store.star(by_hour=False))


def fact_plays_hour(spark: SparkSession, sf_dir: str) -> DataFrame:
    store = _warehouse(spark, sf_dir)
    return facts.fact_by_hour(store.plays, store.star(by_hour=True))


def fact_plays_device(spark: SparkSession, sf_dir: str) -> DataFrame:
    store = _warehouse(spark, sf_dir)
    return facts.fact_by_hour(store.plays, store.star(by_hour=True, with_device=True))


def fact_plays_of_a_day(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The facts of one date, from the months of the dimensions that it needs."""
    store = _warehouse(spark, sf_dir)
    store.star(by_hour=True)
    star = store.star_of_dates(FIRST_LOAD, FIRST_LOAD, by_hour=True)
    return facts.fact_by_hour(between_dates(store.plays, FIRST_LOAD, FIRST_LOAD), star)


def _followed_warehouse(spark: SparkSession, sf_dir: str) -> Warehouse:
    """A warehouse that followed the stream of plays in three batches, started anew for each."""
    at = (spark.sparkContext.applicationId, sf_dir)
    if at not in _followed:
        topic = "listen_events"
        sent_to, root, state = (scratch_path(spark, label) for label in ("messages", "followed", "checkpoints"))
        rows = ingest.enrich(_topic(spark, sf_dir, topic))
        later = NEXT_LOAD - timedelta(days=8)
        part = F.when(F.col("event_date") < F.lit(FIRST_LOAD), 0).when(F.col("event_date") < F.lit(later), 1).otherwise(2)
        stream_rows = spark.readStream.schema(ingest.enriched_schema(topic))
        for number in range(3):
            rows.drop("event_id").filter(part == number).write.mode("append").parquet(sent_to)
            ingest.wait_for([refresh.refresh_stream(stream_rows.parquet(sent_to), root, state, interval=None)])
        plays = read_version(spark, f"{root}/{refresh.PLAYS}")
        _followed[at] = Warehouse(spark, root, plays, NEXT_LOAD)
    return _followed[at]


def stream_refresh_facts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Facts that followed the stream, with what their keys stand for in the dimensions that did."""
    store = _followed_warehouse(spark, sf_dir)
    rows = store.facts(by_hour=True)
    for name, key, foreign in (("dim_song", "song_id", "song_id"), ("dim_artist", "artist_id", "artist_id"),
                               ("dim_city", "city_id", "city_id"), ("dim_session", "session_id", "session_id_fk")):
        members = store.table(name).withColumnRenamed(key, f"_{key}")
        shown = {"dim_song": ["song_name", "song_duration"], "dim_artist": ["artist_name"],
                 "dim_city": ["city_name", "zip_code"], "dim_session": ["sessionId"]}[name]
        rows = rows.join(members.select(f"_{key}", *shown), F.col(foreign) == F.col(f"_{key}"), "left")
    return rows.select(
        "ts", "datetime_id", "user_id_fk", "level", "duration", "song_name", "song_duration", "artist_name", "city_name",
        "zip_code", "sessionId",
    )


def stream_refresh_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows and keys of the dimensions that followed the stream: those of one load of everything."""
    return _key_uniqueness(_followed_warehouse(spark, sf_dir))


def stream_refresh_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The users' history that followed the stream."""
    return _printable_end(_followed_warehouse(spark, sf_dir).table("dim_user_history"))


def check_fact_sums(spark: SparkSession, sf_dir: str) -> DataFrame:
    return checks.sums_preserved(_plays(spark, sf_dir), _stored_fact(spark, sf_dir, by_hour=True))


def fact_undated_plays(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Facts loaded by date range when one play in fifty has no time: none is lost."""
    store = _warehouse(spark, sf_dir)
    lost = F.col("event_id") % 50 != 0
    plays = store.plays.withColumns({c: F.when(lost, F.col(c)) for c in ("ts", "event_date")})
    other = Warehouse(spark, scratch_path(spark, "undated"), materialise(plays, "plays"), FIRST_LOAD)
    dates = other.plays.agg(F.min("event_date").alias("first"), F.max("event_date").alias("last")).first()
    loaded = other.load_facts(dates["first"], dates["last"], by_hour=True)
    return loaded.groupBy(F.col("datetime_id").isNull().alias("undated")).agg(
        F.count("*").alias("fact_rows"), F.sum(F.col("duration").cast(checks.EXACT)).cast("double").alias("total_duration")
    )


def _late_loads(spark: SparkSession, plays: DataFrame, tables: list[str]) -> Warehouse:
    """A warehouse that got the dates from ``FIRST_LOAD`` on first, and those before it late."""
    dates = plays.agg(F.min("event_date").alias("first"), F.max("event_date").alias("last")).first()
    root = scratch_path(spark, "late-loads")
    for first, last in ((FIRST_LOAD, dates["last"]), (dates["first"], FIRST_LOAD - timedelta(days=1))):
        store = Warehouse(spark, root, plays, NEXT_LOAD, first, last)
        for name in tables:
            store.refresh(name)
    return store


def warehouse_late_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The users' history of two loads, the earlier dates last: that of one load."""
    store = _late_loads(spark, _plays(spark, sf_dir), ["dim_date", "dim_user_history"])
    return _printable_end(store.table("dim_user_history"))


def warehouse_late_sessions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bounds of sessions that last through both loads (one a user), the earlier dates last."""
    plays = _plays(spark, sf_dir).withColumn("sessionId", F.col("userId").cast("int"))
    sessions = _late_loads(spark, plays, ["dim_session"]).table("dim_session")
    return _without_zone(sessions.filter("is_active").select("sessionId", "StartTime", "EndTime"))


def check_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    return checks.distinct_profile(_plays(spark, sf_dir))


def check_hours_per_date(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Dates that lack hours, when every seventh hour and every tenth day is taken out of the hour calendar."""
    store = _warehouse(spark, sf_dir)
    hours = store.table("dim_date_hour").filter("DateSK % 7 <> 0 AND Day % 10 <> 0")
    return checks.incomplete_dates(store.table("dim_date"), hours)


def check_date_range(spark: SparkSession, sf_dir: str) -> DataFrame:
    return checks.date_span(_warehouse(spark, sf_dir).table("dim_date_hour"))


def check_unique_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _key_uniqueness(_warehouse(spark, sf_dir))


def _key_uniqueness(store: Warehouse) -> DataFrame:
    return checks.key_uniqueness(
        {
            "dim_song": (store.table("dim_song"), dimensions.SONG_KEY),
            "dim_artist": (store.table("dim_artist").filter("is_active"), dimensions.ARTIST_KEY),
            "dim_city": (store.table("dim_city"), dimensions.CITY_KEY),
            "dim_device": (store.table("dim_device"), ["userAgent"]),
            "dim_date": (store.table("dim_date"), ["DateSK"]),
            "dim_date_hour": (store.table("dim_date_hour"), ["DateSK"]),
            "dim_user": (store.table("dim_user"), ["userId"]),
            "dim_session": (store.table("dim_session").filter("is_active"), ["sessionId"]),
        }
    )


def duration_by_user(spark: SparkSession, sf_dir: str) -> DataFrame:
    return checks.duration_by_user(_plays(spark, sf_dir))


def duration_by_city(spark: SparkSession, sf_dir: str) -> DataFrame:
    return checks.duration_by_city(_plays(spark, sf_dir))


# --- marts ----------------------------------------------------------------------------


def mart_top_songs(spark: SparkSession, sf_dir: str) -> DataFrame:
    store = _warehouse(spark, sf_dir)
    return marts.top_songs(_stored_fact(spark, sf_dir, by_hour=True), store.table("dim_song"), 20)


def mart_active_users_hour(spark: SparkSession, sf_dir: str) -> DataFrame:
    return marts.active_users(_stored_fact(spark, sf_dir, by_hour=True), "user_id_fk")


def mart_active_users_day(spark: SparkSession, sf_dir: str) -> DataFrame:
    return marts.active_users(_stored_fact(spark, sf_dir, by_hour=False), "userKey")


def mart_active_over_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Exact users and songs of the seven days up to each date, and whether the merged sketches come near them."""
    store = _warehouse(spark, sf_dir)
    dates = store.plays.agg(F.min("event_date").alias("first"), F.max("event_date").alias("last")).first()
    estimated = sketches.over_days(store.load_sketches(dates["first"], dates["last"]), 7)
    ends = F.explode(F.sequence("event_date", F.date_add("event_date", 6)))
    song = F.when(F.col("song").isNotNull() | F.col("duration").isNotNull(), F.struct("song", "duration"))
    exact = (
        store.plays.select("userId", song.alias("song"), ends.alias("last_date"))
        .filter(F.col("last_date") <= F.lit(dates["last"]))
        .groupBy("last_date")
        .agg(F.count("*").alias("plays"), F.countDistinct("userId").alias("users"), F.countDistinct("song").alias("songs"))
    )
    both = exact.join(estimated.select("last_date", *[F.col(c).alias(f"_{c}") for c in ("plays", "users", "songs")]), "last_date")
    near = [
        (F.abs(F.col(f"_{c}") - F.col(c)) <= F.ceil(F.col(c) * sketches.ERROR_BOUND)).alias(f"{c}_near") for c in ("users", "songs")
    ]
    return both.filter("plays = _plays").select("last_date", "plays", "users", "songs", *near)


def mart_demographics(spark: SparkSession, sf_dir: str) -> DataFrame:
    return marts.demographics(_warehouse(spark, sf_dir).table("dim_user"))


# --- the same operators on the commerce tables ----------------------------------------


def star_lineitem(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order lines with keys of their part kind, supplier place and ship date."""
    lines = playlog.table(spark, sf_dir, "lineitem").withColumn("ship_date", F.col("l_shipdate").cast("date"))
    parts = playlog.table(spark, sf_dir, "part")
    kind = ["p_brand", "p_type", "p_size"]
    kinds = dense_keys(parts.select(*kind).distinct(), kind, "part_kind_id")
    suppliers = playlog.table(spark, sf_dir, "supplier").join(
        playlog.table(spark, sf_dir, "nation"), F.col("s_nationkey") == F.col("n_nationkey")
    )
    places = dense_keys(suppliers.select("n_name").distinct(), ["n_name"], "place_id")
    days = calendars.day_calendar(
        lines.agg(F.min("ship_date").alias("first"), F.max("ship_date").alias("last"))
    )
    # Keys go to parts and suppliers first, so that lines are joined once per dimension.
    part_kinds = attach_key(parts, kinds, {c: c for c in kind}, "part_kind_id")
    supplier_places = attach_key(suppliers, places, {"n_name": "n_name"}, "place_id")
    rows = attach_key(lines, days, {"ship_date": "Date"}, "DateSK")
    rows = attach_key(rows, supplier_places, {"l_suppkey": "s_suppkey"}, "place_id")
    rows = attach_key(rows, part_kinds, {"l_partkey": "p_partkey"}, "part_kind_id")
    return rows.select(
        "l_orderkey", "l_linenumber", "part_kind_id", "place_id", "DateSK", "l_quantity", "l_extendedprice"
    )


def runs_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stretches of orders with the same status, per customer."""
    orders = playlog.table(spark, sf_dir, "orders").withColumn("one", F.lit(1))
    return state_runs(
        orders,
        keys=["o_custkey"],
        order=["o_orderdate", "o_orderkey"],
        state=["o_orderstatus"],
        measures={"orders": ("sum", "one"), "largest": ("max", "o_totalprice")},
    )


def runs_hot_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stretches of events by the same user, per event type: a few keys hold all events."""
    return state_runs(
        playlog.table(spark, sf_dir, "events").withColumn("one", F.lit(1)),
        keys=["event_type"],
        order=["ts", "event_id"],
        state=["user_id"],
        measures={"events": ("sum", "one"), "largest": ("max", "value")},
    )


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "ingest_parse_listen": _parse("listen_events"),
    "ingest_parse_auth": _parse("auth_events"),
    "ingest_parse_page_view": _parse("page_view_events"),
    "ingest_parse_status_change": _parse("status_change_events"),
    **{
        query.__name__: query
        for query in (
            ingest_quarantine,
            ingest_bad_times,
            ingest_stream_append,
            ingest_stream_topics,
            archive_csv,
            ingest_deduplicated,
            lake_compacted,
            check_required_columns,
            ingest_event_date,
            ingest_masked_registration,
            dim_song,
            dim_artist,
            dim_city,
            dim_device,
            dim_date,
            dim_date_hour,
            dim_user_history,
            dim_user,
            dim_song_from_none,
            dim_session,
            scd2_session_merge,
            dim_artist_increment,
            fact_plays_day,
            fact_plays_hour,
            fact_plays_device,
            fact_plays_of_a_day,
            stream_refresh_facts,
            stream_refresh_keys,
            stream_refresh_history,
            fact_undated_plays,
            warehouse_late_history,
            warehouse_late_sessions,
            check_fact_sums,
            check_profile,
            check_hours_per_date,
            check_date_range,
            check_unique_keys,
            duration_by_user,
            duration_by_city,
            mart_top_songs,
            mart_active_users_hour,
            mart_active_users_day,
            mart_active_over_days,
            mart_demographics,
            star_lineitem,
            runs_orders,
            runs_hot_key,
        )
    },
}


# The corpus operators are a package of their own, which the rest works without.
try:
    from listenlake.llm import queries as llm
except ImportError as error:
    if not (error.name or "").startswith("listenlake.llm"):
        raise
    LLM_QUERIES, LLM_SQL = {}, {}
else:
    LLM_QUERIES, LLM_SQL = llm.QUERIES, llm.oracle_sql()


def _in_utc(query: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    """The query in a session whose printed times are UTC, like those of the oracle."""

    @wraps(query)
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
        return query(spark, sf_dir)

    return run


def entry(spark: SparkSession) -> DataFrame:
    """Most played songs of the star built from the sf0.001 tables."""
    return queries()["mart_top_songs"](spark, "/root/testdata/sf0.001")


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {name: _in_utc(query) for name, query in {**QUERIES, **LLM_QUERIES}.items()}


def oracle_sql() -> dict[str, str]:
    return {**oracles.oracle_sql(), **LLM_SQL}
