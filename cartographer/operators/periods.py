"""Sliding-window grids over a closed time range, without range joins.

The grid is anchored at the first purchase: window k covers
[start + k*step, start + k*step + length). With d the elapsed microseconds of a
row since the start, the row belongs to windows
k in [floor((d - length) / step) + 1, floor(d / step)], clipped to [0, n).
``explode(sequence(lo, hi))`` therefore emits at most ceil(length / step)
copies per row, and only inside the map stage: the aggregate that follows
combines them map-side before any shuffle.
"""

from __future__ import annotations

from math import gcd

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

DAY_US = 86_400_000_000


def _us_between(start: Column, end: Column) -> Column:
    """Microseconds from ``start`` to ``end`` (timestamp_ntz: no time zone involved)."""
    return F.timestamp_diff("MICROSECOND", start, end)


class Grid:
    """n windows of ``offset``..``offset+length`` days after each start,
    starts every ``step`` days while start + ``horizon`` days <= end."""

    def __init__(self, data: DataFrame, horizon_days: int, step_days: int,
                 ts_col: str = "purchase_datetime"):
        s = data.agg(F.struct(F.min(ts_col).alias("start"), F.max(ts_col).alias("end"))).scalar()
        self.start = s["start"]
        self.end = s["end"]
        self.step_us = step_days * DAY_US
        span = _us_between(self.start, self.end) - F.lit(horizon_days * DAY_US)
        # number of starts s with start + k*step + horizon <= end
        self.n = F.when(span >= 0, F.floor(span / F.lit(self.step_us)) + 1).otherwise(F.lit(0))
        self.step_days = step_days
        self.ts_col = ts_col

    def elapsed(self) -> Column:
        return _us_between(self.start, F.col(self.ts_col))

    def cell(self, *days: int) -> Column:
        """Start (microseconds since the grid's start) of the row's cell: cells are as long as the
        greatest common divisor of the step and ``days``, so no window of such lengths cuts one."""
        size = F.lit(gcd(self.step_days, *days) * DAY_US)
        return F.floor(self.elapsed() / size) * size

    def windows(self, offset_days: int, length_days: int, elapsed: Column | None = None) -> Column:
        """Array of window indices whose [offset, offset+length) day range holds the row,
        or the cell that begins at ``elapsed``."""
        d = (self.elapsed() if elapsed is None else elapsed) - F.lit(offset_days * DAY_US)
        lo = F.greatest(F.floor((d - F.lit(length_days * DAY_US)) / F.lit(self.step_us)) + 1, F.lit(0))
        hi = F.least(F.floor(d / F.lit(self.step_us)), self.n - 1)
        return F.when(hi >= lo, F.sequence(lo, hi)).otherwise(F.array().cast("array<bigint>"))

    def start_of(self, k: Column, plus_days: int = 0) -> Column:
        return F.timestamp_add("DAY", k * self.step_days + plus_days, self.start)
