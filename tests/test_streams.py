"""Watched streams, repeated messages and compacted lake tables."""

import logging
import time
from datetime import date

import pytest
from pyspark.sql import functions as F

from listenlake.sources import tables
from listenlake.sources.messages import stream_messages
from listenlake.streaming import compact, ingest
from listenlake.streaming.supervise import StreamWatch, supervise
from test_ingest import TOPIC, catch_up, drop, event

DAY = 86_400_000


def ticking(spark, tmp_path, name):
    rows = spark.readStream.format("rate").option("rowsPerSecond", 50).load()
    return ingest.append_stream(rows, str(tmp_path / name), str(tmp_path / f"state-{name}"), "500 milliseconds")


def test_a_failure_stops_the_others_at_once_and_progress_is_logged(spark, tmp_path, caplog):
    endless = ticking(spark, tmp_path, "a")
    watch = StreamWatch()
    failed_at = []
    broken = spark.readStream.format("rate").option("rowsPerSecond", 50).load()
    broken = broken.filter(F.when(F.col("value") > 120, F.raise_error(F.lit("planted"))).otherwise(True).cast("boolean"))
    failing = ingest.append_stream(broken, str(tmp_path / "b"), str(tmp_path / "state-b"), "500 milliseconds")
    with caplog.at_level(logging.INFO, "listenlake.streams"), pytest.raises(Exception, match="planted"):
        try:
            supervise(spark, [endless, failing], watch)
        finally:
            failed_at.append(time.monotonic())
    assert not endless.isActive and not failing.isActive
    assert watch.totals[endless.id].rows > 0 and watch.totals[endless.id].batches > 0
    assert any("rows" in r.message and "batch" in r.message for r in caplog.records)


def test_queries_that_end_are_waited_for_and_foreign_failures_ignored(spark, tmp_path):
    foreign = spark.readStream.format("rate").load().filter(F.raise_error(F.lit("foreign")).cast("boolean"))
    foreign = ingest.append_stream(foreign, str(tmp_path / "f"), str(tmp_path / "state-f"), "100 milliseconds")
    drop(spark, str(tmp_path / "in"), event(1), event(2))
    mine = ingest.ingest_topic(stream_messages(spark, str(tmp_path / "in")), TOPIC, str(tmp_path / "lake"), str(tmp_path / "s"), None)
    supervise(spark, [mine])
    assert not mine.isActive and mine.exception() is None
    foreign.stop()
    supervise(spark, [])


def test_repeated_messages_arrive_once_and_late_ones_are_counted(spark, tmp_path):
    inbox = str(tmp_path / "in")
    watch = StreamWatch()

    def run():
        source = stream_messages(spark, inbox, files_per_batch=1)
        query = ingest.ingest_topic(source, TOPIC, str(tmp_path / "lake"), str(tmp_path / "state"), None, repeats_within="2 days")
        supervise(spark, [query], watch)
        return query

    start = 1_704_067_200_000
    drop(spark, inbox, event(1, ts=start), event(1, ts=start), event(2, ts=start + DAY), "broken", "broken")
    run()
    time.sleep(1)
    # The same again after a restart, one that differs, and one without a time twice.
    drop(spark, inbox, event(1, ts=start), event(2, ts=start + DAY), event(3, ts=start + 9 * DAY), event(4, ts=None), event(4, ts=None))
    query = run()
    time.sleep(1)
    drop(spark, inbox, event(5, ts=start + 3 * DAY), event(6, ts=start + 8 * DAY))  # the first is two days late and more
    run()
    lake = f"{tmp_path}/lake/{TOPIC}"
    assert sorted(r.userId for r in ingest.read_lake(spark, lake, TOPIC).collect()) == [1, 2, 3, 4, 4, 6]
    assert ingest.read_quarantine(spark, lake, TOPIC).count() == 2
    deadline = time.monotonic() + 20
    while watch.totals[query.id].late_rows < 1 and time.monotonic() < deadline:
        time.sleep(0.2)
    assert watch.totals[query.id].late_rows == 1


def test_masks_depend_on_the_seed_and_replace_the_registration(spark):
    rows = spark.createDataFrame([(1, 0, 5), (2, 0, None)], "userId bigint, ts bigint, registration bigint")
    one, other = (ingest.enrich(rows, seed).orderBy("userId").collect() for seed in ("a", "b"))
    assert [r.registration_date for r in one] != [r.registration_date for r in other]
    for found in (one, other):
        assert found[1].registration is None
        assert found[0].registration == (found[0].registration_date - date(1970, 1, 1)).days * DAY


def lake_of(spark, tmp_path):
    start = 1_704_067_200_000
    for n in range(3):
        drop(spark, str(tmp_path / "in"), *[event(10 * n + i, ts=start + (i % 3) * DAY) for i in range(6)], "broken")
        time.sleep(1)
    return catch_up(spark, tmp_path)


def files_of(spark, lake, day):
    rows = compact.read_lake_rows(spark, lake, TOPIC).filter(F.col("event_date") == day)
    return {r[0] for r in rows.select(F.input_file_name()).distinct().collect()}


def test_compacted_dates_have_the_same_rows_in_fewer_files(spark, tmp_path, monkeypatch):
    lake = lake_of(spark, tmp_path)
    first, second, third = (date(2024, 1, n) for n in (1, 2, 3))
    before = sorted(map(str, ingest.read_lake(spark, lake, TOPIC).collect()))
    assert len(files_of(spark, lake, first)) == 3

    def crash(*args):
        raise RuntimeError("crash")

    with monkeypatch.context() as patched:  # written, not committed
        patched.setattr(tables, "commit_version", crash)
        with pytest.raises(RuntimeError, match="crash"):
            compact.compact_dates(spark, lake, TOPIC, first, second)
    assert sorted(map(str, ingest.read_lake(spark, lake, TOPIC).collect())) == before
    assert len(files_of(spark, lake, first)) == 3

    compact.compact_dates(spark, lake, TOPIC, first, second)
    assert sorted(map(str, ingest.read_lake(spark, lake, TOPIC).collect())) == before
    assert [len(files_of(spark, lake, day)) for day in (first, second, third)] == [1, 1, 3]
    assert ingest.read_quarantine(spark, lake, TOPIC).count() == 3

    # Rows that come late for a compacted date are read beside it, and go in with the next compaction.
    drop(spark, str(tmp_path / "in"), event(99, ts=1_704_067_200_000))
    catch_up(spark, tmp_path)
    assert len(ingest.read_lake(spark, lake, TOPIC).collect()) == len(before) + 1
    assert len(files_of(spark, lake, first)) == 2
    compact.compact_dates(spark, lake, TOPIC, first, first)
    assert len(files_of(spark, lake, first)) == 1 and len(files_of(spark, lake, second)) == 1
    assert len(ingest.read_lake(spark, lake, TOPIC).collect()) == len(before) + 1
    plan = ingest.read_lake(spark, lake, TOPIC).filter(F.col("event_date") == second)._jdf.queryExecution().executedPlan().toString()
    pruned = [part.split("PushedFilters")[0] for part in plan.split("PartitionFilters: ")[1:]]
    assert len(pruned) == 2 and all("isnotnull(event_date" in part for part in pruned)
    assert compact.compact_dates(spark, lake, TOPIC, date(2025, 1, 1), date(2025, 1, 2)) is None
