"""Plays derived from small commerce tables of the tests' own."""

from datetime import datetime, timedelta
from functools import partial

import pytest
from pyspark.sql import Window as W
from pyspark.sql import functions as F

import __spark_entry__ as entry
from listenlake.operators import ordering
from listenlake.sources import playlog

START = datetime(2024, 1, 30, 22)


def user_of(i):
    return [1, 1, 1, 1, 2, 9, None][i % 7]


def copies_of(i):
    return (2 if i % 4 == 1 else 1) * (2 if user_of(i) == 2 else 1)


@pytest.fixture
def commerce(spark, tmp_path):
    """Three users (one hot, one unknown, one NULL) and a customer, a part and an event that come twice."""

    events = [
        (i, None if i % 11 == 0 else START + timedelta(minutes=7 * (i % 29)), user_of(i), "error" if i % 5 == 0 else "view",
         i / 2, f'{{"k": {i % 4}}}')
        for i in range(60)
    ]
    tables = {
        "events": ([*events, events[3]], "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string"),
        "part": ([(0, "a", "b0"), (1, "b", "b1"), (1, "b", "b1")], "p_partkey bigint, p_name string, p_brand string"),
        "customer": ([(1, "C1", 0), (2, "C2", 0), (2, "C2", 0)], "c_custkey bigint, c_name string, c_nationkey int"),
        "nation": ([(0, "N", 0)], "n_nationkey int, n_name string, n_regionkey int"),
        "region": ([(0, "R")], "r_regionkey int, r_name string"),
    }
    for name, (data, schema) in tables.items():
        spark.createDataFrame(data, schema).write.parquet(f"{tmp_path}/{name}.parquet")
    return str(tmp_path)


@pytest.mark.parametrize("large", [0, 6, 1000])
def test_items_are_numbered_over_all_rows_of_a_user_and_day(spark, commerce, monkeypatch, large):
    monkeypatch.setattr(playlog, "number_within", partial(ordering.number_within, large=large))
    visits = playlog.numbered_visits(spark, commerce)
    alike = W.partitionBy("userId", "day").orderBy("ts", "event_id")
    wrong = visits.withColumn("n", F.row_number().over(alike) - 1)
    numbers = [sorted(tuple(map(str, r)) for r in wrong.select("userId", "day", c).collect()) for c in ("itemInSession", "n")]
    assert numbers[0] == numbers[1]
    by_time = wrong.groupBy("userId", "day", "ts", "event_id").agg(
        F.array_sort(F.collect_list("itemInSession")).alias("got"), F.array_sort(F.collect_list("n")).alias("wanted")
    )
    assert by_time.filter("got <> cast(wanted AS array<bigint>)").isEmpty()
    assert visits.count() == sum(copies_of(i) for i in [*range(60), 3])


def test_visits_are_stored_once_and_plays_not_again(spark, commerce, monkeypatch):
    kept = []
    store = ordering.materialise

    def stored(frame, label):
        kept.append(label)
        return store(frame, label)

    for module in (ordering, entry):
        monkeypatch.setattr(module, "materialise", stored)
    plays = entry._warehouse(spark, commerce).plays
    assert kept == ["large", "visits"]  # the list of large groups has no row
    assert sorted(plays.inputFiles()) == sorted(entry._visits(spark, commerce).inputFiles())
    assert entry.check_fact_sums(spark, commerce).first()["play_rows"] == plays.count()
