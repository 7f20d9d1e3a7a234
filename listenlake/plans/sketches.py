"""Distinct counts over any range of dates from one sketch a date, without reading the plays again."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# 2^12 registers a sketch: the standard error of a count is 1.04 / sqrt(2^12) = 1.6 %. Estimates
# are relied on within three of them; counts up to a few hundred are all but exact.
REGISTERS_LOG = 12
ERROR_BOUND = 3 * 1.04 / (1 << (REGISTERS_LOG // 2))

# What is counted: a set of columns each; rows in which all are NULL do not count.
SKETCHED = {
    "users": ["userId"],
    "sessions": ["sessionId"],
    "songs": ["song", "duration"],
    "artists": ["artist"],
}


def _identity(columns: list[str]):
    return F.when(F.coalesce(*[F.col(c).cast("string") for c in columns]).isNotNull(), F.xxhash64(*columns))


def daily_sketches(plays: DataFrame) -> DataFrame:
    """One row per date: number of plays and a sketch of each entry of ``SKETCHED``. Plays without a date are left out."""
    sketches = [F.hll_sketch_agg(_identity(c), F.lit(REGISTERS_LOG)).alias(name) for name, c in SKETCHED.items()]
    dated = plays.filter(F.col("event_date").isNotNull())
    return dated.groupBy("event_date").agg(F.count("*").alias("plays"), *sketches)


def merged(sketches: DataFrame, *by: str) -> DataFrame:
    """Plays and estimated distinct counts of the rows of each group: sketches merge without loss."""
    counts = [F.hll_sketch_estimate(F.hll_union_agg(name)).alias(name) for name in SKETCHED]
    return sketches.groupBy(*by).agg(F.sum("plays").alias("plays"), *counts)


def over_days(sketches: DataFrame, days: int) -> DataFrame:
    """The same for the ``days`` dates that end on each date, by ``last_date``, up to the last date known."""
    last = sketches.agg(F.max("event_date").alias("newest"))
    ends = F.explode(F.sequence("event_date", F.date_add("event_date", days - 1)))
    ending = sketches.select("*", ends.alias("last_date")).join(F.broadcast(last), F.col("last_date") <= F.col("newest"))
    return merged(ending, "last_date")
