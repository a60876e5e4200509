"""Date arithmetic on whole 24-hour periods."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def whole_days(start: Column, end: Column) -> Column:
    """Floored count of 24-hour periods from ``start`` to ``end`` (23 h -> 0, -1 h -> -1).

    Works on the interval between the two, so no session time zone or
    daylight-saving shift can enter.
    """
    gap = end - start
    truncated = F.extract(F.lit("DAY"), gap).cast("int")
    return (truncated - (gap < F.make_dt_interval(truncated)).cast("int")).cast("bigint")


def plus_days(when: Column, days: int) -> Column:
    return when + F.make_dt_interval(F.lit(days))


def month_of(when: Column) -> Column:
    """First day of the month, as a date."""
    return F.trunc(when.cast("date"), "MONTH")


def months_between_starts(first: Column, later: Column) -> Column:
    """Whole months between two month starts."""
    return ((F.year(later) - F.year(first)) * 12 + F.month(later) - F.month(first)).cast("int")
