"""Named calendar expressions of a date or of a timestamp without time zone.

The names and the printed formats are fixed values of the calendar tables.
Week numbers are ISO weeks; ``DayOfWeek`` counts from Sunday = 1.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from listenlake.functions.times import date_key, hour_key


def calendar_parts(moment: Column, with_hour: bool) -> list[Column]:
    """The derived columns, ``DateSK`` first, ready for a single ``select``."""
    day = moment.cast("date")
    week = F.lpad(F.weekofyear(day).cast("string"), 2, "0")
    key = hour_key(day, F.hour(moment)) if with_hour else date_key(day)
    hour = {"Hour": F.hour(moment)} if with_hour else {}
    parts = {
        "DateSK": key,
        "Year": F.year(day),
        "Quarter": F.quarter(day),
        "Month": F.month(day),
        "Day": F.day(day),
        **hour,
        "Week": F.weekofyear(day),
        "QuarterNameLong": F.date_format(day, "QQQQ"),
        "QuarterNameShort": F.date_format(day, "QQQ"),
        "QuarterNumberString": F.date_format(day, "QQ"),
        "MonthNameLong": F.date_format(day, "MMMM"),
        "MonthNameShort": F.date_format(day, "MMM"),
        "MonthNumberString": F.date_format(day, "MM"),
        "DayNumberString": F.date_format(day, "dd"),
        "WeekNameLong": F.concat(F.lit("week"), week),
        "WeekNameShort": F.concat(F.lit("w"), week),
        "WeekNumberString": week,
        "DayOfWeek": F.dayofweek(day),
        "YearMonthString": F.date_format(day, "yyyy/MM"),
        "DayOfWeekNameLong": F.date_format(day, "EEEE"),
        "DayOfWeekNameShort": F.date_format(day, "EEE"),
        "DayOfMonth": F.dayofmonth(day),
        "DayOfYear": F.dayofyear(day),
    }
    return [expression.alias(name) for name, expression in parts.items()]
