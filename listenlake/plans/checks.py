"""Data checks: sums kept by the joins, distinct counts, calendars, key uniqueness."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from listenlake.functions.times import utc_second

# Sums of doubles depend on the order of the rows; sums of decimals do not. Nine decimals
# hold what a duration in seconds is given with; nothing is rounded before the sum.
EXACT = "decimal(38,9)"


def _exact_total(column: str):
    return F.sum(F.col(column).cast(EXACT)).cast("double")


def duration_by_user(plays: DataFrame) -> DataFrame:
    return plays.groupBy("userId").agg(_exact_total("duration").alias("total_duration"))


def duration_by_city(plays: DataFrame) -> DataFrame:
    places = plays.select(
        F.col("city").alias("city_name"),
        "state",
        F.col("zip").alias("zip_code"),
        F.col("lat").alias("latitude"),
        F.col("lon").alias("longitude"),
        "duration",
    )
    return places.groupBy("city_name", "state", "zip_code", "latitude", "longitude").agg(
        _exact_total("duration").alias("total_duration")
    )


def sums_preserved(plays: DataFrame, facts: DataFrame) -> DataFrame:
    """One row: row count and total duration of plays and facts, and whether they agree."""

    def side(frame: DataFrame, is_fact: bool) -> DataFrame:
        return frame.agg(F.count("*").alias("n"), F.sum(F.col("duration").cast(EXACT)).alias("total")).withColumn(
            "is_fact", F.lit(is_fact)
        )

    def of(column: str, is_fact: bool):
        return F.max(F.when(F.col("is_fact") == is_fact, F.col(column)))

    return (
        side(plays, False)
        .unionByName(side(facts, True))
        .agg(
            of("n", False).alias("play_rows"),
            of("n", True).alias("fact_rows"),
            of("total", False).cast("double").alias("play_duration"),
            of("total", True).cast("double").alias("fact_duration"),
            (of("n", False).eqNullSafe(of("n", True)) & of("total", False).eqNullSafe(of("total", True))).alias(
                "preserved"
            ),
        )
    )


# What the profile counts: each entry is a set of columns, a row of NULLs counts too.
PROFILE = {
    "users": ["userId"],
    "cities": ["city", "state", "zip", "lat", "lon"],
    "artist_places": ["artist", "lat", "lon"],
    "artists": ["artist"],
    "songs": ["song", "duration"],
    "sessions": ["sessionId"],
    "timestamps": ["second"],
    "devices": ["userAgent"],
}


def distinct_profile(plays: DataFrame) -> DataFrame:
    """(measure, distinct_rows) for every entry of ``PROFILE``.

    One pruned scan and one partial aggregation per entry; a single aggregation
    with eight distinct counts would multiply every row by eight first.
    """
    rows = plays.withColumn("second", utc_second(F.col("ts")))
    counted = [
        rows.select(*columns)
        .distinct()
        .agg(F.count("*").alias("distinct_rows"))
        .select(F.lit(measure).alias("measure"), "distinct_rows")
        for measure, columns in PROFILE.items()
    ]
    return reduce(DataFrame.unionByName, counted)


def approximate_profile(plays: DataFrame, relative_error: float = 0.01) -> DataFrame:
    """The profile in one pass with sketches, for when an estimate is enough."""
    rows = plays.withColumn("second", utc_second(F.col("ts")))
    return rows.agg(
        *[
            F.approx_count_distinct(F.struct(*columns), relative_error).alias(measure)
            for measure, columns in PROFILE.items()
        ]
    )


def incomplete_dates(days: DataFrame, hours: DataFrame) -> DataFrame:
    """Dates of the day calendar with fewer than 24 hours in the hour calendar; 0 where it has none."""
    counted = hours.groupBy(F.col("date").cast("date").alias("Date")).agg(F.count("Hour").alias("hour_count"))
    return (
        days.select("Date")
        .join(counted, "Date", "left")
        .select("Date", F.coalesce("hour_count", F.lit(0)).alias("hour_count"))
        .filter("hour_count < 24")
    )


def date_span(calendar: DataFrame) -> DataFrame:
    return calendar.agg(
        F.min("Date").cast("date").alias("first_date"), F.max("Date").cast("date").alias("last_date")
    )


def key_uniqueness(tables: Mapping[str, tuple[DataFrame, list[str]]]) -> DataFrame:
    """Per table: rows, distinct keys, rows with a NULL key part, and whether the key is unique.

    ``tables`` maps a name to (frame, key columns).
    """

    def count(name: str, frame: DataFrame, key: list[str]) -> DataFrame:
        has_null = reduce(lambda a, b: a | b, [F.col(c).isNull() for c in key])
        return (
            frame.groupBy(*key)
            .agg(F.count("*").alias("n"))
            .agg(
                F.coalesce(F.sum("n"), F.lit(0)).alias("row_count"),
                F.count("*").alias("distinct_keys"),
                F.coalesce(F.sum(F.when(has_null, F.col("n")).otherwise(0)), F.lit(0)).alias("null_keys"),
            )
            .select(
                F.lit(name).alias("table_name"),
                "row_count",
                "distinct_keys",
                "null_keys",
                (F.col("row_count") == F.col("distinct_keys")).alias("is_unique"),
            )
        )

    return reduce(DataFrame.unionByName, [count(name, *table) for name, table in tables.items()])


def require_unique(frame: DataFrame, key: list[str], name: str = "") -> DataFrame:
    """Return ``frame``, or raise when two rows share a key (one aggregation, no rows collected)."""
    twice = frame.groupBy(*key).agg(F.count("*").alias("n")).filter("n > 1")
    if not twice.isEmpty():
        raise ValueError(f"rows{f' of {name}' if name else ''} are not unique in {', '.join(key)}")
    return frame


def totals(measures: Sequence[str]) -> list[Column]:
    """Row count and exact sums of some columns: what two frames must agree in to hold the same facts."""
    return [F.count(F.lit(1)).alias("n"), *[F.sum(F.col(m).cast(EXACT)).alias(f"sum_{m}") for m in measures]]


def require_equal(
    seen: Mapping[str, object], made: Mapping[str, object], plays: DataFrame, facts: DataFrame, measures: Sequence[str]
) -> None:
    """Raise unless the totals of ``plays`` and ``facts`` agree.

    ``seen`` and ``made`` are those that a write observed on its way. A task that was tried again
    may count twice there, so if they differ, both frames are counted anew before the verdict.
    """
    if dict(seen) == dict(made):
        return
    before, after = (frame.agg(*totals(measures)).first().asDict() for frame in (plays, facts))
    if before != after:
        raise ValueError(f"facts differ from plays: {after} instead of {before}")
