import random
from datetime import date

import pytest
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from conftest import settings
from listenlake.operators.lookup import attach_key
from listenlake.operators.ordering import dense_keys, highest_key, in_order, number_within
from listenlake.operators.runs import gathered_state_runs, state_runs
from listenlake.operators.scd2 import append_members, as_first_version, merge_versions


def rows(frame):
    return sorted((tuple(r) for r in frame.collect()), key=str)


# --- dense keys -----------------------------------------------------------------------


def test_dense_keys_equal_row_number_over_the_whole_table(spark, many_chunks):
    random.seed(1)
    names = {(random.choice(["", "a", "b", "B", "é", None]), random.randint(0, 200) / 4) for _ in range(900)}
    frame = spark.createDataFrame(list(names), "name string, length double").repartition(5)
    expected = frame.withColumn("id", F.row_number().over(W.orderBy("name", "length")))
    got = dense_keys(frame, ["name", "length"], "id", start=0)
    assert rows(got) == rows(expected)
    assert rows(dense_keys(frame, ["name", "length"], "id", start=40)) == rows(
        expected.withColumn("id", F.col("id") + 40)
    )


def test_dense_keys_of_nothing_and_of_one_row(spark):
    empty = spark.createDataFrame([], "name string")
    assert dense_keys(empty, ["name"], "id").count() == 0
    assert highest_key(dense_keys(empty, ["name"], "id"), "id") == 0
    assert rows(dense_keys(spark.createDataFrame([("x",)], "name string"), ["name"], "id", start=7)) == [("x", 8)]


def test_ordering_gathers_nothing_in_one_task(spark):
    plan = in_order(spark.range(1000).withColumnRenamed("id", "k"), ["k"])._jdf.queryExecution().executedPlan().toString()
    assert "rangepartitioning" in plan
    assert "SinglePartition" not in plan


def test_number_within_a_hot_group(spark, many_chunks):
    random.seed(2)
    data = [(random.choice(["hot", "hot", "a", "b", None]), random.randint(0, 400), i) for i in range(1500)]
    frame = spark.createDataFrame(data, "g string, t int, id int")
    expected = frame.withColumn("n", F.row_number().over(W.partitionBy("g").orderBy("t", "id")) - 1)
    assert rows(number_within(frame, ["g"], ["t", "id"], "n")) == rows(expected)


@pytest.mark.parametrize("large", [0, 100, 2000])
def test_number_within_groups_of_both_kinds(spark, many_chunks, large):
    random.seed(3)
    data = [(random.choice([*["hot"] * 9, "a", "b", None]), random.randint(0, 400), i) for i in range(900)]
    frame = spark.createDataFrame(data, "g string, t int, id int")
    expected = frame.withColumn("n", (F.row_number().over(W.partitionBy("g").orderBy("t", "id")) - 1).cast("bigint"))
    got = number_within(frame, ["g"], ["t", "id"], "n", large=large)
    assert got.schema.simpleString() == expected.schema.simpleString()
    assert rows(got) == rows(expected)


def test_number_within_moves_no_row_that_a_join_has_dealt(spark):
    data = spark.createDataFrame([(i % 7, i % 3, i) for i in range(100)], "g int, h int, id int")
    names = spark.createDataFrame([(i, f"n{i}") for i in range(7)], "k int, name string")
    with settings(spark, {"spark.sql.autoBroadcastJoinThreshold": "-1"}):
        joined = data.join(names, data.g == names.k, "left")
        plan = number_within(joined, ["g", "h"], ["id"], "n")._jdf.queryExecution().executedPlan().toString()
    assert plan.split("== Initial Plan ==")[-1].count("Exchange") == 2  # those of the join


# --- runs -----------------------------------------------------------------------------


def windowed_runs(frame, keys, order, state):
    """The textbook form: lag, running sum, group, lead over one window per key."""
    w = W.partitionBy(*keys).orderBy(*order)
    changed = (~F.struct(*state).eqNullSafe(F.lag(F.struct(*state)).over(w))).cast("int")
    return (
        frame.withColumn("c", changed)
        .withColumn("run", F.sum("c").over(w.rowsBetween(W.unboundedPreceding, 0)))
        .groupBy(*keys, "run", *state)
        .agg(F.min(order[0]).alias("run_start"), F.sum("v").alias("total"), F.min("v").alias("least"))
        .withColumn("next_start", F.lead("run_start").over(W.partitionBy(*keys).orderBy("run")))
        .select(*keys, *state, "run_start", "next_start", "total", "least")
    )


@pytest.mark.parametrize("flip, hot_share", [
    (0.0, 0.34), (0.0, 1.0), (0.02, 0.34), (0.02, 1.0), (0.5, 0.34), (0.5, 1.0), (1.0, 0.34), (0.1, 0.34),
])
def test_runs_of_a_hot_key_cross_chunk_borders(spark, many_chunks, flip, hot_share):
    random.seed(int(1000 * (flip + hot_share)))
    data, level = [], "free"
    for t in range(1200):
        if random.random() < flip:
            level = {"free": "paid", "paid": None, None: "free"}[level]
        user = 5 if random.random() < hot_share else random.randint(0, 40)
        data.append((user, "n" if user % 2 else None, t // 2, t, level, random.randint(0, 9)))
    random.shuffle(data)
    frame = spark.createDataFrame(data, "u int, name string, t int, id int, level string, v int")
    got = state_runs(
        frame, ["u", "name"], ["t", "id"], ["level"], {"total": ("sum", "v"), "least": ("min", "v")}
    )
    assert rows(got) == rows(windowed_runs(frame, ["u", "name"], ["t", "id"], ["level"]))


def test_gathered_runs_are_the_same_runs(spark):
    random.seed(6)
    data = [
        (random.choice([1, 2, None]), random.choice(["n", None]), random.choice([None, *range(99)]), i,
         random.choice(["free", "paid", None]), random.randint(0, 9))
        for i in range(600)
    ]
    frame = spark.createDataFrame(data, "u int, name string, t int, id int, level string, v int")
    how = (["u", "name"], ["t", "id"], ["level"], {"total": ("sum", "v"), "least": ("min", "v")})
    assert rows(gathered_state_runs(frame, *how)) == rows(state_runs(frame, *how))


def test_runs_of_nothing(spark):
    frame = spark.createDataFrame([], "u int, t int, level string")
    assert state_runs(frame, ["u"], ["t"], ["level"]).count() == 0
    assert gathered_state_runs(frame, ["u"], ["t"], ["level"]).count() == 0


# --- lookup ---------------------------------------------------------------------------


@pytest.mark.parametrize("broadcast", ["10485760", "-1"])
def test_lookup_keeps_every_row_also_with_a_hot_key(spark, broadcast):
    data = [(i, "hit" if i % 3 == 0 else (None if i % 3 == 1 else f"k{i % 50}")) for i in range(3000)]
    facts = spark.createDataFrame(data, "id int, song string")
    songs = spark.createDataFrame([("hit", 1), ("k2", 2), (None, 3)], "song string, song_id int")
    skew = {
        "spark.sql.autoBroadcastJoinThreshold": broadcast,
        "spark.sql.adaptive.autoBroadcastJoinThreshold": broadcast,
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1KB",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "2KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.1",
    }
    with settings(spark, skew):
        joined = attach_key(facts.repartition(8), songs, {"song": "song"}, "song_id", "fk")
        got = joined.collect()
        plan = joined._jdf.queryExecution().executedPlan().toString()
    assert ("skew=true" in plan) == (broadcast == "-1")
    assert len(got) == 3000
    expected = {"hit": 1, "k2": 2}
    assert all(row["fk"] == expected.get(row["song"]) for row in got)
    assert got[0].asDict().keys() == {"id", "song", "fk"}


# --- growing dimensions ---------------------------------------------------------------

DAY1, DAY2, DAY3 = date(2024, 1, 1), date(2024, 1, 2), date(2024, 1, 3)


def sessions(spark, data):
    return spark.createDataFrame(data, "sid int, a int, b int")


def merged(spark, existing, data, day):
    return merge_versions(existing, sessions(spark, data), ["sid"], ["a", "b"], "key", ["a", "sid"], day)


def test_merge_versions(spark):
    first = dense_keys(
        as_first_version(sessions(spark, [(1, 10, 11), (2, 20, None), (3, 30, 31), (None, 5, 5)]), DAY1),
        ["a", "sid"],
        "key",
    )
    load = [(1, 10, 11), (2, 20, 22), (4, 1, 2), (None, 5, 5)]
    second = merged(spark, first, load, DAY2)
    assert rows(second.select(*first.columns)) == sorted(
        [
            (None, 5, 5, DAY1, None, True, 1),  # unchanged, NULL key
            (1, 10, 11, DAY1, None, True, 2),  # unchanged
            (2, 20, None, DAY1, DAY2, False, 3),  # closed: NULL became 22
            (3, 30, 31, DAY1, None, True, 4),  # absent from the load
            (4, 1, 2, DAY2, None, True, 5),  # new
            (2, 20, 22, DAY2, None, True, 6),  # its new version
        ],
        key=str,
    )
    assert rows(merged(spark, second, load, DAY3)) == rows(second)  # again: nothing changes
    third = merged(spark, second, [(2, 20, 23)], DAY3)
    history = sorted((r["start_date"], r["end_date"] or date.max, r["is_active"]) for r in third.collect() if r["sid"] == 2)
    assert history == [(DAY1, DAY2, False), (DAY2, DAY3, False), (DAY3, date.max, True)]
    keys = [r["key"] for r in third.select("key").collect()]
    assert sorted(keys) == list(range(1, 8))


def test_merge_into_an_empty_dimension(spark):
    empty = spark.createDataFrame(
        [], "sid int, a int, b int, start_date date, end_date date, is_active boolean, key bigint"
    )
    got = merged(spark, empty, [(2, 2, 2), (1, 2, 2)], DAY1)
    assert rows(got) == [(1, 2, 2, DAY1, None, True, 1), (2, 2, 2, DAY1, None, True, 2)]


def test_append_members_continues_after_the_highest_key(spark):
    existing = spark.createDataFrame([("a", 1), ("c", 9)], "name string, id bigint")  # ids with a gap
    load = spark.createDataFrame([("c",), ("d",), ("b",)], "name string")
    grown = append_members(existing, load, ["name"], "id")
    assert rows(grown) == [("a", 1), ("b", 10), ("c", 9), ("d", 11)]
    assert rows(append_members(grown, load, ["name"], "id")) == rows(grown)


def test_merge_versions_rejects_repeated_members_and_earlier_dates(spark):
    first = dense_keys(as_first_version(sessions(spark, [(1, 10, 11)]), DAY2), ["a", "sid"], "key")
    with pytest.raises(ValueError, match="not unique in sid"):
        merged(spark, first, [(1, 10, 12), (1, 10, 13)], DAY3)
    with pytest.raises(ValueError, match="start after"):
        merged(spark, first, [(1, 10, 12)], DAY1)
    assert rows(merged(spark, first, [(1, 10, 11)], DAY1)) == rows(first)  # nothing to close
