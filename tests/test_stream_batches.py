"""A micro-batch is read once: its dates are seen while it is stored."""

from __future__ import annotations

from datetime import date

from listenlake.sources.tables import NONE, dates_found, read_note, write_version
from listenlake.streaming.refresh import PLAYS, apply_batch


def test_a_note_can_tell_what_the_written_rows_tell(spark, tmp_path):
    path = f"{tmp_path}/t"
    number = write_version(spark.range(3), path, replaces=NONE, token="x", note=lambda: {"dates": ["a", "b"]})
    assert read_note(spark, path, number) == {"dates": ["a", "b"], "replaces": NONE, "token": "x"}


def test_dates_of_rows_without_any_or_with_undated_ones_are_not_noted():
    first, last = date(2024, 1, 1), date(2024, 1, 3)
    assert dates_found({"first": first, "last": last, "undated": 0}) == {"dates": ["2024-01-01", "2024-01-03"]}
    assert dates_found({"first": first, "last": last, "undated": 1}) == {}
    assert dates_found({"first": None, "last": None, "undated": 0}) == {}


def test_a_batch_is_stored_without_being_kept_in_memory(spark, tmp_path, monkeypatch):
    batch = spark.createDataFrame([(1, None), (2, None)], "ts long, event_date date")

    def persist(self, *level):
        raise AssertionError("batches are not kept in memory")

    monkeypatch.setattr(type(batch), "persist", persist)
    for token, rows in (("some", batch), ("none", batch.limit(0))):
        apply_batch(rows, token, f"{tmp_path}/w")
    assert [read_note(spark, f"{tmp_path}/w/{PLAYS}", n).get("token") for n in (1, 2)] == ["some", "none"]
    assert spark.read.parquet(f"{tmp_path}/w/{PLAYS}/v=1").count() == 2
