"""Statistical expressions: binning, scaling, exact money sums.

Global statistics are scalar subqueries (``DataFrame.scalar()``): Spark runs
the aggregate once, with partial aggregation on every executor, and inlines
the result as a literal in the consuming stage. No Cartesian product, no
driver round trip.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..config import MONEY_TYPE


def scalar(df: DataFrame, **aggs: Column) -> Column:
    """One-row aggregate of ``df`` as a struct-valued scalar subquery."""
    return df.agg(F.struct(*[c.alias(k) for k, c in aggs.items()]).alias("s")).scalar()


def minmax(x: Column, lo: Column, hi: Column) -> Column:
    """(x - min) / (max - min); null when max == min (NaN in pandas)."""
    return F.try_divide(x - lo, F.nullif(hi - lo, F.lit(0)))


def cut_right_closed(x: Column, edges: Sequence[float], labels: Sequence[str]) -> Column:
    """pd.cut with right-closed bins (-inf, e0], (e0, e1], ..., (e_n, inf); null and NaN stay null."""
    expr = F.when(x.isNull() | F.isnan(x.cast("double")), F.lit(None).cast("string"))
    for e, lab in zip(edges, labels, strict=False):
        expr = expr.when(x <= e, lab)
    return expr.otherwise(labels[len(edges)])


def money_sum(c: Column) -> Column:
    """Exact sum of a money column, as double.

    Summed as ``config.MONEY_TYPE`` (six decimals), so the result depends on
    neither partitioning nor summation order and prices finer than cents count.
    """
    return F.sum(c.cast(MONEY_TYPE)).cast("double")


def money_avg(c: Column) -> Column:
    """Exact money sum divided by the count of non-null values."""
    return F.try_divide(money_sum(c), F.count(c).cast("double"))
