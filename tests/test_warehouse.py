"""What loads of the warehouse write, read and refuse."""

from datetime import date, timedelta

import pytest
from pyspark.sql import functions as F

from conftest import settings
from listenlake.plans import facts, warehouse
from listenlake.plans.sketches import ERROR_BOUND, daily_sketches, merged, over_days
from listenlake.plans.warehouse import DIMENSIONS, LAYOUTS, Warehouse
from listenlake.sources import tables
from listenlake.sources.tables import (
    NONE,
    dates_predicate,
    drop_old_versions,
    drop_torn_versions,
    fold_dates,
    fold_versions,
    layers,
    read_version,
    version_of,
    versions,
    write_version,
)
from listenlake.streaming import refresh
from test_plans import HOUR, START, play, plays_of, rows

DAY = 24 * HOUR
JAN, FEB = date(2024, 1, 1), date(2024, 2, 1)


def months(spark):
    """Plays of January and February; session 2 lasts into February, 3 is of February alone."""
    return plays_of(
        spark,
        play(START, session=1),
        play(START + 30 * DAY, session=2, user=2, song="b"),
        play(START + 31 * DAY, session=2, user=2, level="paid"),
        play(START + 33 * DAY, session=3, user=3, song="c", city="d"),
        play(START + 40 * DAY, session=4, user=1, level="paid"),
    )


# --- layered versions -----------------------------------------------------------------


def numbers(spark, *pairs):
    return spark.createDataFrame([(i, date.fromisoformat(d)) for i, d in pairs], "id bigint, event_date date")


def test_versions_lie_over_each_other(spark, tmp_path):
    path, by = str(tmp_path / "t"), ["event_date"]
    schema = "id bigint, event_date date"
    write_version(numbers(spark, (1, "2024-01-01"), (2, "2024-01-02")), path, by)
    write_version(numbers(spark, (3, "2024-01-02")), path, by, NONE)
    write_version(numbers(spark, (4, "2024-01-02")), path, by, dates_predicate(date(2024, 1, 2), date(2024, 1, 5)), "x")
    assert sorted(r.id for r in read_version(spark, path, schema).collect()) == [1, 4]
    assert sorted(r.id for r in read_version(spark, path, schema, 2).collect()) == [1, 2, 3]
    assert (version_of(spark, path, "x"), version_of(spark, path, "y")) == (3, None)
    plan = read_version(spark, path, schema).filter("event_date = DATE'2024-01-01'")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(event_date" in plan
    assert drop_old_versions(spark, path, keep=1) == []  # all three are needed
    assert fold_versions(spark, path, read_version(spark, path, schema).schema, by, most=2)
    assert list(layers(spark, path)) == [4] and sorted(r.id for r in read_version(spark, path, schema).collect()) == [1, 4]
    assert drop_old_versions(spark, path, keep=1) == [1, 2, 3]


def test_torn_versions_are_swept(spark, tmp_path):
    path = str(tmp_path / "t")
    write_version(spark.range(3), path)
    spark.range(9).write.parquet(f"{path}/v=2")
    assert drop_torn_versions(spark, path) == [2]
    assert read_version(spark, path, "id bigint").count() == 3

    def refuse():
        raise ValueError("refused")

    with pytest.raises(ValueError, match="refused"):
        write_version(spark.range(5), path, before_commit=refuse)
    assert versions(spark, path) == [1] and read_version(spark, path, "id bigint").count() == 3


def test_small_versions_of_closed_dates_are_brought_together(spark, tmp_path):
    path, schema = str(tmp_path / "t"), numbers(spark, (1, "2024-01-01")).schema
    for n in range(6):
        frame = numbers(spark, (n, f"2024-01-0{1 + n // 2}"))
        write_version(frame, path, ["event_date"], NONE, note=tables.dates_note(frame))
    assert fold_dates(spark, path, schema, date(2024, 1, 3), most=6) is None
    assert fold_dates(spark, path, schema, date(2024, 1, 3), most=3) == 7
    assert list(layers(spark, path)) == [5, 6, 7]
    assert sorted(r.id for r in read_version(spark, path, schema).collect()) == list(range(6))
    assert drop_old_versions(spark, path, keep=1) == [1, 2, 3, 4]
    assert sorted(r.id for r in read_version(spark, path, schema).collect()) == list(range(6))


# --- dimensions -----------------------------------------------------------------------


def test_a_load_writes_only_what_it_adds(spark, tmp_path):
    root, plays = str(tmp_path / "w"), months(spark)
    Warehouse(spark, root, plays.filter(F.col("event_date") < FEB), FEB).refresh_all()
    before = {name: versions(spark, f"{root}/{name}") for name in DIMENSIONS}
    store = Warehouse(spark, root, plays, date(2024, 3, 1), FEB, date(2024, 2, 29))
    store.refresh_all()
    added = spark.read.parquet(f"{root}/dim_song/v=2")
    assert rows(added.select("song_name", "song_id")) == [("c", 3)]
    assert versions(spark, f"{root}/dim_device") == before["dim_device"] == [1]  # nothing new
    written = {p.relative_to(tmp_path / "w" / "dim_session" / "v=2").parent.as_posix() for p in (tmp_path / "w" / "dim_session" / "v=2").rglob("*.parquet")}
    # Session 2 grew: its month is rewritten, its old version closed; 3 and 4 are new.
    assert written == {"is_active=true/year=2024/month=1", "is_active=false/year=2024/month=1", "is_active=true/year=2024/month=2"}
    sessions = store.table("dim_session")
    assert rows(sessions.select("sessionId", "is_active")) == [(1, True), (2, False), (2, True), (3, True), (4, True)]
    assert sessions.columns[-2:] == ["year", "month"]
    store.refresh_all()
    assert rows(store.table("dim_session")) == rows(sessions)


def fact_plan(spark, store, first, last):
    with settings(spark, {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.maxMetadataStringLength": "4000"}):
        frame = facts.fact_by_hour(warehouse.of_dates(store.plays, first, last), store.star_of_dates(first, last, True))
        return frame, frame._jdf.queryExecution().executedPlan().toString().splitlines()


def above(lines, at):
    """The operators above line ``at`` of a plan, up to the next join."""
    depth = lambda line: len(line) - len(line.lstrip(" :+-*()0123456789"))
    inner = depth(lines[at])
    for line in reversed(lines[:at]):
        if depth(line) < inner:
            inner = depth(line)
            yield line
            if "Join" in line:
                return


def test_user_and_session_lookups_do_not_move_the_dimensions(spark, tmp_path):
    store = Warehouse(spark, str(tmp_path / "w"), months(spark), FEB)
    store.refresh_all()
    frame, lines = fact_plan(spark, store, JAN, date(2024, 3, 1))
    bucketed = [i for i, line in enumerate(lines) if "Bucketed: true" in line]
    assert len(bucketed) == 2
    for at in bucketed:
        assert not any("Exchange" in line for line in above(lines, at))
    moved = [line for line in lines if "Exchange hashpartitioning(userId" in line or "Exchange hashpartitioning(sessionId" in line]
    assert len(moved) == 2  # the plays, once a key
    with settings(spark, {"spark.sql.autoBroadcastJoinThreshold": "-1"}):
        shuffled = rows(frame)
    assert shuffled == rows(facts.fact_by_hour(store.plays, store.star(by_hour=True)))


def test_bucketed_tables_of_other_sizes_are_still_read(spark, tmp_path):
    """Versions dealt into different numbers of buckets are read as plain files."""
    path, frame = str(tmp_path / "t"), spark.range(100).withColumn("x", F.col("id") * 2)
    write_version(frame, path, buckets=("id", 4))
    write_version(frame.withColumn("id", F.col("id") + 100), path, replaces=NONE, buckets=("id", 8))
    got = read_version(spark, path, frame.schema)
    assert got.count() == 200 and got.agg(F.sum("x")).first()[0] == 2 * 9900


def test_a_one_day_load_reads_the_sessions_of_its_months(spark, tmp_path):
    store = Warehouse(spark, str(tmp_path / "w"), months(spark), FEB)
    store.refresh_all()
    read = lambda first, last: {
        (r.year, r.month) for r in store.star_of_dates(first, last, True).session.select("year", "month").collect()
    }
    assert read(JAN, JAN) == {(2024, 1)}
    assert read(date(2024, 2, 1), date(2024, 2, 1)) == {(2024, 1), (2024, 2)}  # session 2 began in January
    assert read(date(2024, 2, 9), date(2024, 2, 9)) == {(2024, 2)}
    _, lines = fact_plan(spark, store, date(2024, 2, 9), date(2024, 2, 9))
    scan = next(line for line in lines if "StartTime" not in line and "is_active" in line and "year" in line and "FileScan" in line)
    filters = scan.split("PartitionFilters: ")[1].split("PushedFilters")[0]
    assert "is_active" in filters and "year" in filters and "month" in filters and "= 2" in filters
    for day in range(41):
        at = JAN + timedelta(days=day)
        wanted = warehouse.of_dates(store.plays, at, at)
        pruned = facts.fact_by_hour(wanted, store.star_of_dates(at, at, True))
        if day in (0, 30, 31, 33, 40):
            assert rows(pruned) == rows(facts.fact_by_hour(wanted, store.star(by_hour=True)))


# --- facts ----------------------------------------------------------------------------


def test_a_crash_before_the_commit_leaves_the_facts(spark, tmp_path, monkeypatch):
    store = Warehouse(spark, str(tmp_path / "w"), months(spark), FEB)
    before = rows(store.load_facts(JAN, date(2024, 3, 1), by_hour=True))
    fewer = Warehouse(spark, str(tmp_path / "w"), store.plays.filter("userId = 1"), FEB)

    def crash(*args):
        raise RuntimeError("crash")

    with monkeypatch.context() as patched:
        patched.setattr(tables, "commit_version", crash)
        with pytest.raises(RuntimeError, match="crash"):
            fewer.load_facts(JAN, date(2024, 3, 1), by_hour=True)
    assert rows(store.facts(by_hour=True)) == before
    assert fewer.load_facts(JAN, date(2024, 3, 1), by_hour=True).count() == 2


@pytest.mark.parametrize("name", ["dim_user", "dim_session", "dim_song"])
def test_a_planted_duplicate_raises(spark, tmp_path, monkeypatch, name):
    store = Warehouse(spark, str(tmp_path / "w"), months(spark), FEB)
    store.refresh_all()
    twice = store.table(name)
    bucket = LAYOUTS[name].bucket_by
    note = {"schema": twice.schema.jsonValue()}
    write_version(twice, f"{tmp_path}/w/{name}", LAYOUTS[name].partition_by, NONE, None, note, (bucket, 8) if bucket else None)
    with pytest.raises(ValueError, match=f"rows of {name} are not unique"):
        store.load_facts(JAN, date(2024, 3, 1), by_hour=True)
    # Were the keys not looked at, the sums taken while the facts are written would tell.
    monkeypatch.setattr(warehouse, "require_unique", lambda *args: None)
    with pytest.raises(ValueError, match="facts differ from plays"):
        store.load_facts(JAN, date(2024, 3, 1), by_hour=True)
    with pytest.raises(ValueError, match="facts differ from plays"):
        store.load_facts(JAN, date(2024, 3, 1), by_hour=False)
    assert versions(spark, f"{tmp_path}/w/fact_by_hour") == []


def test_equal_observations_need_no_second_pass(spark, tmp_path, monkeypatch):
    seen = []
    monkeypatch.setattr(warehouse, "require_equal", lambda *args: seen.append(args))
    store = Warehouse(spark, str(tmp_path / "w"), months(spark), FEB)
    store.load_facts(JAN, date(2024, 3, 1), by_hour=True)
    store.load_facts(date(2023, 1, 1), date(2023, 1, 2), by_hour=True)  # no plays
    (before, after, *_), (none, nothing, *_) = seen
    assert before == after and before["n"] == 5 and float(before["sum_duration"]) == 7.5
    assert dict(none).get("n", 0) == dict(nothing).get("n", 0) == 0


# --- streams of plays -----------------------------------------------------------------


def batches(spark):
    plays = months(spark)
    late = plays_of(spark, play(START + 2 * DAY, session=1, song="late"), play(START + 3 * DAY, session=9, user=9))
    return [
        plays.filter(F.col("event_date") < date(2024, 1, 20)),
        plays.filter(F.col("event_date").between(date(2024, 1, 20), date(2024, 2, 1))),
        plays.filter(F.col("event_date") > date(2024, 2, 1)).unionByName(late),
    ]


def everything(spark, root):
    store = Warehouse(spark, root, read_version(spark, f"{root}/plays"), FEB)
    found = {name: rows(store.table(name)) for name in DIMENSIONS}
    counted = merged(store.sketches(), "event_date")
    return {**found, "facts": rows(store.facts(True)), "plays": rows(store.plays), "sketches": rows(counted)}


@pytest.fixture(scope="module")
def undisturbed(spark, tmp_path_factory):
    root = str(tmp_path_factory.mktemp("undisturbed"))
    for number, batch in enumerate(batches(spark)):
        refresh.apply_batch(batch, f"plays-{number}", root)
    return everything(spark, root)


@pytest.mark.parametrize("commits", [1, 11, 18])
def test_a_batch_that_comes_again_changes_nothing_twice(spark, tmp_path, monkeypatch, undisturbed, commits):
    """The driver dies between a write and its commit, whichever it is; the batch comes again."""
    root = str(tmp_path / "w")
    commit, left = tables.commit_version, [commits]

    def dying(*args):
        left[0] -= 1
        if left[0] == 0:
            raise RuntimeError("killed")
        commit(*args)

    monkeypatch.setattr(tables, "commit_version", dying)
    killed = 0
    for number, batch in enumerate(batches(spark)):
        try:
            refresh.apply_batch(batch, f"plays-{number}", root)
        except RuntimeError:
            killed += 1
            refresh.apply_batch(batch, f"plays-{number}", root)
    assert killed == 1
    refresh.apply_batch(batches(spark)[1], "plays-1", root)  # and an old one once more
    assert everything(spark, root) == undisturbed


def test_what_followed_the_stream_is_what_one_load_gives(spark, undisturbed, tmp_path):
    whole = None
    for batch in batches(spark):
        whole = batch if whole is None else whole.unionByName(batch)
    store = Warehouse(spark, str(tmp_path / "w"), whole, FEB)
    store.refresh_all()
    assert undisturbed["dim_user_history"] == rows(store.table("dim_user_history"))
    assert undisturbed["dim_date_hour"] == rows(store.table("dim_date_hour"))
    without = lambda found, *places: sorted(tuple(v for i, v in enumerate(r) if i not in places) for r in found)
    assert without(undisturbed["dim_song"], 2) == without(rows(store.table("dim_song")), 2)
    assert len(undisturbed["facts"]) == len(undisturbed["plays"]) == whole.count()
    assert undisturbed["sketches"] == rows(merged(daily_sketches(whole), "event_date"))


def test_a_killed_stream_goes_on_where_it_was(spark, tmp_path, monkeypatch):
    inbox, root, state = (str(tmp_path / name) for name in ("in", "w", "state"))
    schema = batches(spark)[0].schema
    start = lambda: refresh.refresh_stream(spark.readStream.schema(schema).parquet(inbox), root, state, interval=None)
    commit, left = tables.commit_version, [8]

    def dying(*args):
        left[0] -= 1
        if left[0] == 0:
            raise RuntimeError("killed")
        commit(*args)

    monkeypatch.setattr(tables, "commit_version", dying)
    failures = 0
    for batch in batches(spark)[:2]:
        batch.write.mode("append").parquet(inbox)
        try:
            start().awaitTermination()
        except Exception as error:
            assert "killed" in str(error)
            failures += 1
            start().awaitTermination()
    assert failures == 1
    expected = batches(spark)[0].unionByName(batches(spark)[1])
    found = everything(spark, root)
    assert found["plays"] == rows(expected.select(*read_version(spark, f"{root}/plays").columns))
    assert len(found["facts"]) == expected.count()


# --- sketches -------------------------------------------------------------------------


def test_estimates_stay_within_the_bound(spark):
    """A hundred thousand users over thirty days, a tenth of them on each day."""
    made = spark.range(300_000).select(
        F.date_add(F.lit(JAN), (F.col("id") % 30).cast("int")).alias("event_date"),
        (F.xxhash64("id") % 100_000).alias("userId"),
        (F.col("id") % 7_000).alias("sessionId"),
        F.concat(F.lit("s"), F.col("id") % 50).alias("song"),
        F.lit(1.5).alias("duration"),
        F.lit(None).cast("string").alias("artist"),
    )
    sketches = daily_sketches(made)
    for first, last in ((1, 1), (1, 7), (3, 30)):
        days = F.dayofmonth("event_date").between(first, last)
        exact = made.filter(days).agg(F.countDistinct("userId"), F.countDistinct("sessionId"), F.countDistinct("song")).first()
        found = merged(sketches.filter(days)).first()
        for true, estimate in zip(exact, (found.users, found.sessions, found.songs), strict=True):
            assert abs(estimate - true) <= true * ERROR_BOUND
        assert found.artists == 0
    weeks = over_days(sketches, 7)
    assert weeks.count() == 30 and weeks.agg(F.max("plays")).first()[0] == 70_000
