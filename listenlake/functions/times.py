"""Epoch-millisecond columns to UTC dates, hours and times.

Dates and hours are integer arithmetic on the epoch, so that they do not
depend on the session time zone.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

DAY_MS = 86_400_000
HOUR_MS = 3_600_000

# Start of 2000 and of 2100: what a message's time must lie between to be believed.
EARLIEST_MS = 946_684_800_000
LATEST_MS = 4_102_444_800_000
# Start of year 1 and end of year 9999: what dates and times can hold.
_FIRST_MS = -62_135_596_800_000
_LAST_MS = 253_402_300_799_999


def _whole(ms: Column, unit: int) -> Column:
    """Number of whole ``unit``s since the epoch, floored (also before 1970)."""
    return ((ms - F.pmod(ms, F.lit(unit))) / unit).cast("bigint")


def _within_years(ms: Column, value: Column) -> Column:
    """``value`` for times of the years 1 to 9999, NULL beyond."""
    return F.when(ms.between(_FIRST_MS, _LAST_MS), value)


def utc_date(ms: Column) -> Column:
    """UTC date; NULL outside the years 1 to 9999."""
    return _within_years(ms, F.date_from_unix_date(_whole(ms, DAY_MS).cast("int")))


def utc_hour(ms: Column) -> Column:
    return _within_years(ms, F.pmod(_whole(ms, HOUR_MS), F.lit(24)).cast("int"))


def utc_second(ms: Column) -> Column:
    """TIMESTAMP cut to whole seconds; NULL outside the years 1 to 9999."""
    return _within_years(ms, F.timestamp_seconds(_whole(ms, 1000)))


def epoch_millis(timestamp_ntz: str) -> Column:
    """Epoch milliseconds (floored) of a TIMESTAMP_NTZ column that holds UTC."""
    return F.timestamp_diff("MILLISECOND", F.lit("1970-01-01").cast("timestamp_ntz"), F.col(timestamp_ntz))


def date_key(date: Column) -> Column:
    """``yyyyMMdd`` as INT."""
    return F.year(date) * 10000 + F.month(date) * 100 + F.day(date)


def hour_key(date: Column, hour: Column) -> Column:
    """``yyyyMMddHH`` as BIGINT."""
    return date_key(date).cast("bigint") * 100 + hour
