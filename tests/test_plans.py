import random
from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from conftest import settings
from listenlake.operators import ordering, runs
from listenlake.plans import calendars, checks, dimensions, facts, marts, users
from listenlake.plans.main import main
from listenlake.plans.warehouse import Warehouse
from listenlake.schemas import LISTEN_EVENTS
from listenlake.sources.tables import read_version, replace_partitions, versions
from listenlake.streaming.ingest import enrich

HOUR = 3_600_000
START = 1_704_067_200_000  # 2024-01-01 00:00 UTC
OPEN = datetime(9999, 12, 31)


def play(ts, user=1, session=1, item=0, level="free", song="s", artist="a", duration=1.5, city="c", zip="9",
         name="N", agent="Firefox", registration=0):
    return (
        artist, song, duration, ts, session, "Logged In", level, item, city, zip, "st", agent, 10.0, 20.0,
        user, "L", name, "F", registration,
    )


def plays_of(spark, *rows):
    return enrich(spark.createDataFrame(list(rows), LISTEN_EVENTS))


def rows(frame):
    return sorted((tuple(r) for r in frame.collect()), key=str)


@pytest.fixture
def plays(spark):
    return plays_of(
        spark,
        play(START, level="free"),
        play(START + HOUR, level="free", item=1, song="s2"),
        play(START + 2 * HOUR, level="paid", item=2, song=None, artist=None),
        play(START + 25 * HOUR, level="free", session=2, duration=None),
        play(START + 3 * HOUR, user=2, session=3, level="paid", city=None, agent=None),
        play(START + 3 * HOUR, user=None, session=4, zip=None, agent="curl"),
    )


def test_dimensions_leave_out_what_has_no_key(plays):
    assert rows(dimensions.song_dimension(plays)) == [("s", 1.5, 1), ("s2", 1.5, 2)]
    day = date(2024, 5, 1)
    assert rows(dimensions.artist_dimension(plays, day)) == [("a", 20.0, 10.0, day, None, True, 1)]
    assert rows(dimensions.city_dimension(plays)) == sorted(
        [(None, "st", "9", 20.0, 10.0, 1), ("c", "st", None, 20.0, 10.0, 2), ("c", "st", "9", 20.0, 10.0, 3)], key=str
    )
    assert rows(dimensions.device_dimension(plays)) == [
        (1, None, "Unknown", "Unknown", "Unknown"),
        (2, "Firefox", "Unknown", "Unknown", "Firefox"),
        (3, "curl", "Unknown", "Unknown", "Unknown"),
    ]


def test_scans_read_and_filter_only_what_is_needed(spark, plays, tmp_path):
    plays.write.parquet(str(tmp_path / "plays"))
    stored = spark.read.schema(plays.schema).parquet(str(tmp_path / "plays"))
    plan = dimensions.song_members(stored)._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<song:string,duration:double>" in plan
    assert "PushedFilters: [IsNotNull(song), IsNotNull(duration)]" in plan
    plan = dimensions.session_bounds(stored)._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<ts:bigint,sessionId:int>" in plan
    assert plan.count("Exchange") == 1 and "partial_min" in plan


def test_sessions_run_from_first_to_last_play(plays):
    day = date(2024, 5, 1)
    got = dimensions.with_start_month(dimensions.session_dimension(plays, day)).filter("sessionId = 1")
    assert rows(got) == [
        (1, datetime(2024, 1, 1), datetime(2024, 1, 1, 2), day, None, True, 1, 2024, 1),
    ]
    with pytest.raises(ValueError, match="sessionId"):
        dimensions.session_bounds(plays.drop("sessionId"))


def test_a_late_play_makes_one_new_session_version(spark, plays):
    first = dimensions.session_dimension(plays, date(2024, 1, 3))
    late = plays.unionByName(plays_of(spark, play(START - HOUR, session=1)))
    second = dimensions.session_dimension(late, date(2024, 1, 4), first)
    versions = second.filter("sessionId = 1").orderBy("session_id").collect()
    assert [(v["StartTime"].hour, v["end_date"], v["is_active"], v["session_id"]) for v in versions] == [
        (0, date(2024, 1, 4), False, 1),
        (23, None, True, 5),
    ]
    assert second.count() == first.count() + 1


def test_user_history_and_current_row(plays):
    history = users.user_history(plays)
    got = history.filter("userId = 1").orderBy("rowActivationDate").select(
        "level", "rowActivationDate", "rowExpirationDate", "currentRow"
    )
    first, second, third = datetime(2024, 1, 1), datetime(2024, 1, 1, 2), datetime(2024, 1, 2, 1)
    assert [tuple(r) for r in got.collect()] == [
        ("free", first, second, 0),
        ("paid", second, third, 0),
        ("free", third, OPEN, 1),
    ]
    current = users.user_dimension(history)
    assert rows(current.select("userKey", "userId", "level")) == [(1, 1, "free"), (2, 2, "paid")]


def test_equal_times_are_ordered_by_session_and_item(spark):
    tied = plays_of(
        spark,
        play(START, level="paid", session=2, item=0),
        play(START, level="free", session=1, item=5),
        play(START + 1, level="paid", session=2, item=1),
        play(START, level="free", session=1, item=4),
    )
    history = users.user_history(tied).select("level", "currentRow")
    assert rows(history) == [("free", 0), ("paid", 1)]


def test_a_user_under_two_names_gets_one_current_row(spark):
    renamed = plays_of(spark, play(START, name="Old"), play(START + HOUR, name="New", level="paid"))
    history = users.user_history(renamed)
    assert history.filter("currentRow = 1").count() == 2
    assert [r["firstName"] for r in users.user_dimension(history).collect()] == ["New"]


@pytest.mark.parametrize("large", [0, 4, 1000])
def test_users_with_few_and_with_many_plays_get_the_same_history(spark, many_chunks, large):
    random.seed(8)
    lake = plays_of(
        spark,
        *[
            play(START + random.randint(0, 60) * HOUR, user=random.choice([1, 1, 1, 1, 2, 3, 4, None]), item=i,
                 level=random.choice(["free", "paid", None]), session=random.randint(1, 9), name=random.choice(["N", "M", None]))
            for i in range(60)
        ],
    )
    whole = users.user_history(lake, large=1000)
    assert rows(users.user_history(lake, large=large)) == rows(whole)
    border = date(2024, 1, 2)
    before = users.user_history(lake.filter(F.col("event_date") < border), large=large)
    after = lake.filter(F.col("event_date") >= border)
    assert rows(users.user_history(after, before, border, large)) == rows(whole)


def test_a_history_of_few_plays_a_user_stores_no_play(plays, monkeypatch):
    kept = []

    def stored(frame, label):
        kept.append((label, frame.count()))
        return frame

    for module in (ordering, runs):
        monkeypatch.setattr(module, "materialise", stored)
    history = users.user_history(plays)
    plan = history._jdf.queryExecution().executedPlan().toString()
    assert kept == [("large", 0)]
    assert plan.count("Exchange") == 1  # by user


def test_calendars(spark):
    days = calendars.day_calendar(calendars.date_range(spark, date(2021, 1, 1), date(2021, 12, 31)))
    assert days.count() == 365
    assert len(days.columns) == 23
    first = days.filter("DateSK = 20210101").first()
    assert (first["Week"], first["WeekNameLong"], first["DayOfWeek"], first["QuarterNameLong"]) == (
        53, "week53", 6, "1st quarter",
    )


@pytest.mark.parametrize("zone", ["UTC", "America/New_York"])
def test_every_date_has_24_hours_in_any_zone(spark, zone):
    with settings(spark, {"spark.sql.session.timeZone": zone}):
        hours = calendars.hour_calendar(calendars.date_range(spark, date(2021, 1, 1), date(2021, 12, 31)))
        assert hours.count() == hours.select("DateSK").distinct().count() == 8760
        assert len(hours.columns) == 24
        days = calendars.day_calendar(calendars.date_range(spark, date(2021, 1, 1), date(2021, 12, 31)))
        assert checks.incomplete_dates(days, hours).isEmpty()
        some = hours.filter("DateSK <> 2021030405 AND NOT (Month = 7 AND Day = 1)")
        assert rows(checks.incomplete_dates(days, some)) == [(date(2021, 3, 4), 23), (date(2021, 7, 1), 0)]
        assert rows(checks.date_span(hours)) == [(date(2021, 1, 1), date(2021, 12, 31))]


def test_calendar_of_the_plays(plays):
    assert rows(calendars.range_of_plays(plays)) == [(date(2024, 1, 1), date(2024, 1, 2))]
    assert calendars.day_calendar(calendars.range_of_plays(plays.limit(0))).count() == 0


def star_of(plays, by_hour, device=None):
    day = date(2024, 5, 1)
    bounds = calendars.range_of_plays(plays.filter(f"ts < {START + 24 * HOUR}"))  # lacks the second day
    return facts.Star(
        song=dimensions.song_dimension(plays),
        artist=dimensions.artist_dimension(plays, day),
        city=dimensions.city_dimension(plays),
        calendar=calendars.hour_calendar(bounds) if by_hour else calendars.day_calendar(bounds),
        user=users.user_dimension(users.user_history(plays)),
        session=dimensions.session_dimension(plays, day),
        device=device,
    )


def test_fact_keeps_every_play_once(plays):
    star = star_of(plays, by_hour=False)
    fact = facts.fact_by_day(plays, star)
    assert fact.columns == [
        "userKey", "song_id", "artist_id", "city_id", "datetime_id", "session_id_fk", "level", "ts", "plays_count",
    ]
    assert fact.count() == 6
    by_ts = {(r["ts"] - START) // HOUR: r for r in fact.filter("userKey = 1").collect()}
    assert tuple(by_ts[0])[:6] == (1, 1, 1, 3, 20240101, 1)
    assert (by_ts[2]["song_id"], by_ts[2]["artist_id"]) == (None, None)  # no song, no artist
    assert (by_ts[25]["song_id"], by_ts[25]["datetime_id"]) == (None, None)  # no duration; outside the calendar
    unknown = fact.filter("userKey IS NULL").first()
    assert (unknown["city_id"], unknown["plays_count"]) == (None, 1)  # a NULL zip finds no city


def test_fact_by_hour_keeps_sums(plays):
    star = star_of(plays, by_hour=True, device=dimensions.device_dimension(plays))
    fact = facts.fact_by_hour(plays, star)
    assert rows(fact.filter("user_id_fk = 2").select("datetime_id", "device_id", "duration")) == [(2024010103, 1, 1.5)]
    assert rows(checks.sums_preserved(plays, fact)) == [(6, 6, 7.5, 7.5, True)]
    assert rows(checks.sums_preserved(plays, fact.limit(5)))[0][-1] is False


def test_only_active_versions_are_looked_up(plays):
    star = star_of(plays, by_hour=False)
    closed = star.artist.withColumns({"is_active": F.lit(False), "artist_id": F.col("artist_id") + 100})
    both = facts.Star(**{**star.__dict__, "artist": star.artist.unionByName(closed)})
    assert rows(facts.fact_by_day(plays, both)) == rows(facts.fact_by_day(plays, star))


def test_fact_with_shuffled_joins_is_the_same(spark, plays):
    star = star_of(plays, by_hour=True)
    expected = rows(facts.fact_by_hour(plays, star))
    with settings(spark, {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1"}):
        shuffled = facts.fact_by_hour(plays, star)
        assert rows(shuffled) == expected
        assert "SortMergeJoin" in shuffled._jdf.queryExecution().executedPlan().toString()


def test_profile_counts_a_row_of_nulls(plays):
    assert dict(rows(checks.distinct_profile(plays))) == {
        "users": 3, "cities": 3, "artist_places": 2, "artists": 2, "songs": 4, "sessions": 4, "timestamps": 5, "devices": 3,
    }
    estimate = checks.approximate_profile(plays).first().asDict()
    assert estimate["sessions"] == 4


def test_durations(plays):
    assert dict(rows(checks.duration_by_user(plays))) == {1: 4.5, 2: 1.5, None: 1.5}
    assert sum(r["total_duration"] for r in checks.duration_by_city(plays).collect()) == 7.5


def test_durations_are_not_rounded_before_the_sum(spark):
    plays = spark.createDataFrame([(1, 277.89016), (1, 256.92689), (1, 0.004)], "userId long, duration double")
    assert rows(checks.duration_by_user(plays)) == [(1, 534.82105)]


def test_key_uniqueness(spark):
    frame = spark.createDataFrame([(1, "a"), (1, "b"), (None, "c")], "k int, v string")
    got = checks.key_uniqueness({"by_k": (frame, ["k"]), "by_v": (frame, ["v"]), "empty": (frame.limit(0), ["k"])})
    assert rows(got) == [("by_k", 3, 2, 1, False), ("by_v", 3, 3, 0, True), ("empty", 0, 0, 0, True)]
    assert checks.require_unique(frame, ["v"]) is frame
    with pytest.raises(ValueError, match="not unique in k"):
        checks.require_unique(frame, ["k"])


def test_marts(plays):
    star = star_of(plays, by_hour=False)
    fact = facts.fact_by_day(plays, star)
    top = marts.top_songs(fact, star.song, 1)
    assert rows(top) == [(1, 1, "s", 1.5, 3)]
    assert rows(marts.active_users(fact, "userKey")) == [(20240101, 2, 5), (None, 1, 1)]
    assert rows(marts.demographics(star.user)) == [("F", "free", 1), ("F", "paid", 1)]


def test_warehouse_grows_with_stable_keys(spark, plays, tmp_path):
    root = str(tmp_path / "w")
    store = Warehouse(spark, root, plays, date(2024, 1, 3))
    before = {name: rows(store.table(name)) for name in ("dim_song", "dim_city", "dim_device", "dim_user")}
    assert rows(store.table("dim_song")) == before["dim_song"]  # read, not built again
    assert versions(spark, f"{root}/dim_song") == [1]
    store.table("dim_session"), store.table("dim_artist")

    more = plays.unionByName(
        plays_of(
            spark,
            play(START + 30 * HOUR, session=2),
            play(START, user=0, session=9, artist="z", song="a", city=None, agent=None, level="paid"),
        )
    )
    grown = Warehouse(spark, root, more, date(2024, 1, 4))  # as another application would
    grown.refresh_all()
    assert rows(grown.table("dim_song").filter("song_id <= 2")) == before["dim_song"]
    assert rows(grown.table("dim_song").filter("song_id > 2")) == [("a", 1.5, 3)]
    assert rows(grown.table("dim_device")) == before["dim_device"]
    assert rows(grown.table("dim_city")) == before["dim_city"]  # a NULL city is known, too
    assert rows(grown.table("dim_user").select("userKey", "userId")) == [(1, 1), (2, 2), (3, 0)]
    assert rows(grown.table("dim_session").filter("sessionId IN (2, 9)").select("sessionId", "is_active", "session_id")) == [
        (2, False, 4), (2, True, 6), (9, True, 5),
    ]
    assert grown.table("dim_artist").count() == 2
    everything = {name: rows(grown.table(name)) for name in before}
    grown.refresh_all()
    assert {name: rows(grown.table(name)) for name in before} == everything


@pytest.mark.parametrize("loads", [[1, 2, 3], [3, 1, 2, 2], [2, 3, 1, 3]])
def test_loads_by_date_equal_one_load(spark, tmp_path, loads):
    day = 24 * HOUR
    made = plays_of(
        spark,
        play(START, level="free", session=1),
        play(START + day - 1, level="paid", session=1, song="s2"),
        play(START + day, level="paid", session=1),
        play(START + day + HOUR, level="free", session=2, city="d"),
        play(START + 2 * day, level="free", session=2),
        play(START + 2 * day, level="paid", session=3, song="s3"),
        play(START, user=2, session=4),
        play(START + 2 * day + HOUR, user=3, session=5, name=None),
        play(START + day + HOUR, user=3, session=5, name=None, level="paid"),
    )
    made.write.partitionBy("event_date").parquet(str(tmp_path / "lake"))
    lake = spark.read.schema(made.schema).parquet(str(tmp_path / "lake"))
    for n in loads:
        store = Warehouse(spark, str(tmp_path / "w"), lake, date(2024, 2, 1), date(2024, 1, n), date(2024, 1, n))
        store.refresh_all()
        store.load_facts(date(2024, 1, n), date(2024, 1, n), by_hour=True)
    whole = users.user_history(lake)
    assert rows(store.table("dim_user_history").select(*whole.columns)) == rows(whole)
    assert rows(store.table("dim_user").drop("userKey")) == rows(users.user_dimension(whole).drop("userKey"))
    bounds = store.table("dim_session").filter("is_active").select("sessionId", "StartTime", "EndTime")
    assert rows(bounds) == rows(dimensions.session_bounds(lake))
    assert rows(store.table("dim_date")) == rows(calendars.day_calendar(calendars.range_of_plays(lake)))
    assert store.table("dim_date_hour").count() == 72
    assert rows(store.table("dim_song").drop("song_id")) == rows(dimensions.song_members(lake))
    assert rows(store.table("dim_city").drop("city_id")) == rows(dimensions.city_members(lake))
    facts_read = store.facts(by_hour=True)
    assert facts_read.count() == 9 and facts_read.filter("song_id IS NULL OR city_id IS NULL").isEmpty()
    plan = dimensions.session_bounds(store.loaded)._jdf.queryExecution().executedPlan().toString()
    assert "event_date" in plan.split("PartitionFilters: ")[1][:60]


def test_facts_of_a_date_range_are_replaced(spark, plays, tmp_path):
    store = Warehouse(spark, str(tmp_path / "w"), plays, date(2024, 1, 3))
    first, second = date(2024, 1, 1), date(2024, 1, 2)
    assert store.load_facts(first, first, by_hour=True).count() == 5
    assert store.load_facts(second, second, by_hour=True).count() == 6
    both = rows(store.load_facts(first, second, by_hour=True))
    assert len(both) == 6
    assert rows(store.load_facts(first, second, by_hour=True)) == both
    assert store.load_facts(first, second, by_hour=False).count() == 6


def test_plays_without_a_date_and_emptied_dates(spark, plays, tmp_path):
    root = str(tmp_path / "w")
    undated = plays.withColumn("event_date", F.when(F.col("event_date") == date(2024, 1, 2), F.col("event_date")))
    first, second = date(2024, 1, 1), date(2024, 1, 2)
    assert Warehouse(spark, root, plays, second).load_facts(first, second, by_hour=True).count() == 6
    fewer = Warehouse(spark, root, plays.filter(F.col("event_date") == first), second)
    left = fewer.load_facts(first, second, by_hour=True)
    assert left.count() == 5 and left.filter(F.col("event_date") == second).isEmpty()
    store = Warehouse(spark, str(tmp_path / "u"), undated.withColumn("ts", F.when(F.col("event_date").isNotNull(), F.col("ts"))), second)
    loaded = store.load_facts(second, second, by_hour=True)
    assert loaded.count() == 6 and loaded.filter("datetime_id IS NULL").count() == 5
    assert store.load_facts(second, second, by_hour=True).count() == 6


def test_batch_job_from_lake_to_facts(spark, plays, tmp_path):
    lake = plays.withColumns(
        {"bad_reason": F.lit(None).cast("string"), "raw_value": F.lit(None).cast("string"), "quality": F.lit("good")}
    )
    replace_partitions(lake, str(tmp_path / "lake" / "listen_events"), ["quality", "event_date"])
    command = ["--lake", str(tmp_path / "lake"), "--warehouse", str(tmp_path / "w"), "--first", "2024-01-01"]
    main([*command, "--last", "2024-01-01"])
    main([*command, "--last", "2024-01-02", "--grain", "both"])
    main([*command, "--last", "2024-01-02", "--grain", "both"])
    facts_read = read_version(spark, str(tmp_path / "w" / "fact_by_hour"))
    assert rows(facts_read.groupBy("event_date").count()) == [(date(2024, 1, 1), 5), (date(2024, 1, 2), 1)]
    assert read_version(spark, str(tmp_path / "w" / "fact_by_day")).count() == 6
