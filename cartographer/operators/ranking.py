"""Windows, ranking, binning and top-k."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions.dates import elapsed_days
from ..functions.stats import minmax, scalar
from .quantiles import prefix_sums, quantile_row


def previous_in_group(df: DataFrame, key: str, order: Sequence[str], value: str,
                      out: str = "previous", partitions: int | None = None) -> DataFrame:
    """``lag(value)`` over (``key`` ordered by ``order``) without gathering a
    key in one task.

    Rows are range-partitioned on (key, order...), so a key holding a large
    share of the rows spans many partitions. The lag is taken inside each
    (partition, key) slice; the first row of a slice takes the last value of
    the same key in the nearest earlier partition, found on a boundary table
    with one row per slice (at most #partitions rows per key).
    """
    spark = df.sparkSession
    n = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    r = df.repartitionByRange(n, key, *order).withColumn("_pid", F.spark_partition_id())
    w = Window.partitionBy("_pid", key).orderBy(*order)
    whole = w.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    r = r.select("*", F.lag(value).over(w).alias("_lag"), F.row_number().over(w).alias("_rn"),
                 F.last(value).over(whole).alias("_last"))
    slices = r.where(F.col("_rn") == 1).select("_pid", key, "_last")
    carry = slices.select("_pid", key, F.lag("_last").over(Window.partitionBy(key).orderBy("_pid"))
                          .alias("_carry"))
    j = r.join(carry, ["_pid", key])
    return j.select(*df.columns, F.when(F.col("_rn") == 1, F.col("_carry")).otherwise(F.col("_lag"))
                    .alias(out))


def purchase_gaps(df: DataFrame) -> DataFrame:
    """Days since the customer's previous purchase; a customer's first row gets
    the days from that customer's last purchase to the end of the data.

    The previous purchase comes from ``previous_in_group`` (skew-safe lag over
    time, order, product); the customer's last purchase is a partial aggregate
    joined back; the end of the data is a scalar subquery.
    """
    end = df.agg(F.max("purchase_datetime")).scalar()
    base = df.select("customer_id", "order_id", "product_id", "purchase_datetime")
    prev = previous_in_group(base, "customer_id", ["purchase_datetime", "order_id", "product_id"],
                             "purchase_datetime", "_prev")
    last = df.groupBy("customer_id").agg(F.max("purchase_datetime").alias("_last_buy"))
    return prev.join(last, "customer_id").select(
        "customer_id", "order_id", "product_id", "purchase_datetime",
        F.coalesce(elapsed_days(F.col("_prev"), F.col("purchase_datetime")),
                   elapsed_days(F.col("_last_buy"), end)).alias("purchase_diff"))


def cumulative_share(df: DataFrame, col: str) -> DataFrame:
    """(value, cumulative_share): share of rows with ``col`` <= value.

    Rows are first reduced to distinct values (partial aggregate); the prefix
    sum runs over range partitions of them.
    """
    d = df.where(F.col(col).isNotNull()).groupBy(col).agg(F.count(F.lit(1)).alias("n"))
    return prefix_sums(d, col, ["n"]).select(
        col, ((F.col("n_before") + F.col("n")) / F.col("n_total")).alias("cumulative_share"))


def top_k(df: DataFrame, k: int, order: Sequence) -> DataFrame:
    """Global top-k (planned as TakeOrderedAndProject: per-partition top-k, merged)."""
    return df.orderBy(*order).limit(k)


def minmax_scale(df: DataFrame, cols: Sequence[str], suffix: str = "_scaled") -> DataFrame:
    s = scalar(df, **{f"{c}__lo": F.min(c) for c in cols}, **{f"{c}__hi": F.max(c) for c in cols})
    return df.select("*", *[minmax(F.col(c), s[f"{c}__lo"], s[f"{c}__hi"]).alias(c + suffix)
                            for c in cols])


def row_mean(cols: Sequence[str]):
    """Mean of the non-null values of ``cols`` (null if all are null)."""
    total = sum((F.coalesce(F.col(c), F.lit(0.0)) for c in cols[1:]), F.coalesce(F.col(cols[0]), F.lit(0.0)))
    n = sum((F.when(F.col(c).isNotNull(), 1).otherwise(0) for c in cols[1:]),
            F.when(F.col(cols[0]).isNotNull(), 1).otherwise(0))
    return F.try_divide(total, F.nullif(n, F.lit(0)))


def qcut_labels(df: DataFrame, col: str, labels: Sequence[str]) -> DataFrame:
    """pd.qcut(q=len(labels)): interpolated quantile edges, right-closed bins,
    lowest edge included. Repeated edges merge bins instead of raising."""
    q = len(labels)
    edges = quantile_row(df, [col], [i / q for i in range(1, q)]).scalar()[col]
    x = F.col(col)
    expr = F.when(x.isNull(), F.lit(None).cast("string"))
    for i in range(q - 1):
        expr = expr.when(x <= edges[i], labels[i])
    return df.withColumn(f"{col}_label", expr.otherwise(labels[-1]))
