"""Date and time expressions with pandas-compatible semantics."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def ts(value: str) -> Column:
    """A timestamp_ntz literal."""
    return F.lit(value).cast("timestamp_ntz")


def elapsed_days(start: Column, end: Column) -> Column:
    """Whole days elapsed from ``start`` to ``end``.

    Equals ``(end - start).days`` of pandas: elapsed 24-hour periods, floored.
    ``timestamp_diff`` truncates toward zero, so negative gaps are floored by
    hand.
    """
    d = F.timestamp_diff("DAY", start, end)
    back = F.timestamp_add("DAY", d, start) > end
    return (d - F.when(back, 1).otherwise(0)).cast("bigint")


def months_active(first: Column, last: Column) -> Column:
    """Calendar months touched from ``first`` to ``last`` inclusive."""
    return ((F.year(last) - F.year(first)) * 12 + F.month(last) - F.month(first) + 1).cast("bigint")


def month_start(t: Column) -> Column:
    """Month bucket (``to_period('M')``) as the first day of the month."""
    return F.trunc(t.cast("date"), "month")


def age_exact(birthdate: Column, as_of: str) -> Column:
    """round((as_of - birthdate).days / 365), half to even."""
    return F.bround(F.datediff(F.lit(as_of).cast("date"), birthdate) / 365.0).cast("bigint")


def age_years(birthdate: Column, as_of: str) -> Column:
    """year(as_of) - year(birthdate)."""
    return (F.year(F.lit(as_of).cast("date")) - F.year(birthdate)).cast("bigint")
