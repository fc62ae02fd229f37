"""Exact quantiles and prefix sums that no single task or group bounds.

Values are first reduced to one row per distinct value (a partial aggregate).
The distinct values are range-partitioned on (group, value) and written to the
checkpoint folder, so that partition numbers are fixed; partition totals give
each partition its offset, and a window inside a partition completes the
prefix sum. A group of any size, and any distribution of values, spreads over
as many partitions as its distinct values fill.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..session import cut_lineage


def prefix_sums(df: DataFrame, order: str, cols: Sequence[str], keys: Sequence[str] = ()) -> DataFrame:
    """Adds ``<c>_before`` (sum of ``c`` over the group's rows with a smaller
    ``order``) and ``<c>_total`` (over the whole group).

    ``df`` has one row per (``keys``, ``order``).
    """
    n = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    keys = list(keys)
    placed = cut_lineage(df.repartitionByRange(n, *keys, order).withColumn("_part", F.spark_partition_id()))
    totals = placed.groupBy(*keys, "_part").agg(*[F.sum(c).alias(f"_sum_{c}") for c in cols])
    group = Window.partitionBy(*keys)   # one row per partition
    ahead = group.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    totals = totals.select(*[F.col(k).alias(f"_key_{k}") for k in keys], F.col("_part").alias("_at"),
                           *[F.coalesce(F.sum(f"_sum_{c}").over(ahead), F.lit(0)).alias(f"_ahead_{c}") for c in cols],
                           *[F.sum(f"_sum_{c}").over(group).alias(f"{c}_total") for c in cols])
    on = F.col("_part") == F.col("_at")
    for k in keys:
        on = on & F.col(k).eqNullSafe(F.col(f"_key_{k}"))
    inside = Window.partitionBy(*keys, "_part").orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    return placed.join(totals, on).select(
        *df.columns,
        *[(F.col(f"_ahead_{c}") + F.coalesce(F.sum(c).over(inside), F.lit(0))).alias(f"{c}_before") for c in cols],
        *[f"{c}_total" for c in cols])


def value_places(df: DataFrame, cols: Sequence[str] | dict[str, Column], keys: Sequence[str] = (),
                 weight: str | None = None) -> DataFrame:
    """(keys..., column_name, value, n, n_before, n_total): one row per distinct non-null value, its rows and
    those below it. ``weight`` names a column with the number of rows that a row stands for."""
    named = cols if isinstance(cols, dict) else {c: F.col(c) for c in cols}
    values = F.array(*[F.struct(F.lit(name).alias("column_name"), x.cast("double").alias("value"))
                       for name, x in named.items()])
    n = (F.col(weight) if weight else F.lit(1)).cast("bigint").alias("_rows")
    counts = (df.select(*keys, n, F.inline(values)).where(F.col("value").isNotNull())
              .groupBy(*keys, "column_name", "value").agg(F.sum("_rows").alias("n")))
    return prefix_sums(counts, "value", ["n"], [*keys, "column_name"])


def quantile_table(df: DataFrame, cols: Sequence[str] | dict[str, Column], qs: Sequence[float],
                   keys: Sequence[str] = (), weight: str | None = None) -> DataFrame:
    """(keys..., column_name, n, q): linearly interpolated quantiles of the
    non-null values, as pandas ``quantile``; ``q`` is an array in the order of
    ``qs``. ``weight`` names a column with the number of rows that a row stands for."""
    return placed_quantiles(value_places(df, cols, keys, weight), qs, keys)


def placed_quantiles(placed: DataFrame, qs: Sequence[float], keys: Sequence[str] = ()) -> DataFrame:
    """``quantile_table`` from the rows of ``value_places``."""
    def at(rank: Column) -> Column:
        return F.max(F.when((F.col("n_before") <= rank) & (rank < F.col("n_before") + F.col("n")), F.col("value")))

    out = []
    for q in qs:
        place = (F.col("n_total") - 1) * F.lit(float(q))
        out.append(F.struct(at(F.floor(place)).alias("lo"), at(F.ceil(place)).alias("hi"),
                            F.max(place - F.floor(place)).alias("part")))
    picked = placed.groupBy(*keys, "column_name").agg(F.max("n_total").alias("n"), F.array(*out).alias("_q"))
    return picked.select(*keys, "column_name", "n",
                         F.transform("_q", lambda x: x["lo"] + (x["hi"] - x["lo"]) * x["part"]).alias("q"))


def quantile_row(df: DataFrame, cols: Sequence[str] | dict[str, Column], qs: Sequence[float]) -> DataFrame:
    """One row, one struct column: an array of quantiles per column (nulls for a column without values)."""
    t = quantile_table(df, cols, qs)
    return t.agg(F.struct(*[F.array(*[F.max(F.when(F.col("column_name") == c, F.col("q")[i])) for i in range(len(qs))]).alias(c)
                            for c in cols]).alias("s"))


def quantile(df: DataFrame, col: str, q: float) -> Column:
    """One quantile of one column, as a scalar subquery."""
    return quantile_row(df, {"x": F.col(col)}, [q]).scalar()["x"][0]
