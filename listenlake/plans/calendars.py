"""Day and hour calendars."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from listenlake.functions.calendar_parts import calendar_parts
from listenlake.functions.times import EARLIEST_MS, LATEST_MS, utc_date


def date_range(spark: SparkSession, first: date, last: date) -> DataFrame:
    """The range ``first..last`` as the one-row frame the calendars take."""
    return spark.range(1).select(F.lit(first).alias("first"), F.lit(last).alias("last"))


def range_of_plays(plays: DataFrame) -> DataFrame:
    """From the date of the first play to the date of the last one, between 2000 and 2100.

    A play at another time is no reason for a calendar of millions of days.
    """
    return plays.filter(F.col("ts").between(EARLIEST_MS, LATEST_MS)).agg(F.min("ts").alias("first"), F.max("ts").alias("last")).select(
        utc_date(F.col("first")).alias("first"), utc_date(F.col("last")).alias("last")
    )


def with_stored(bounds: DataFrame, calendar: DataFrame | None) -> DataFrame:
    """``bounds`` stretched to the dates of a stored calendar, of days or hours."""
    if calendar is None:
        return bounds
    day = F.to_date(F.substring(F.col("DateSK").cast("string"), 1, 8), "yyyyMMdd")
    known = calendar.agg(F.min(day).alias("first"), F.max(day).alias("last"))
    return bounds.unionByName(known).agg(F.min("first").alias("first"), F.max("last").alias("last"))


def day_calendar(bounds: DataFrame) -> DataFrame:
    """One row per date of ``bounds``, both ends included."""
    days = bounds.select(F.explode(F.sequence("first", "last")).alias("Date"))
    return days.select("Date", *calendar_parts(F.col("Date"), with_hour=False))


def hour_calendar(bounds: DataFrame) -> DataFrame:
    """One row per hour, from the first hour of ``first`` to the last of ``last``.

    Counted without a time zone, so that every date has 24 hours wherever the
    session runs; ``date`` itself is a TIMESTAMP.
    """
    an_hour = F.make_dt_interval(hours=F.lit(1))
    start = F.col("first").cast("timestamp_ntz")
    stop = F.date_add("last", 1).cast("timestamp_ntz") - an_hour
    hours = bounds.select(F.explode(F.sequence(start, stop, an_hour)).alias("moment"))
    return hours.select(
        F.col("moment").cast("timestamp").alias("date"), *calendar_parts(F.col("moment"), with_hour=True)
    )
