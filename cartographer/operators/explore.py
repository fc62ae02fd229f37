"""Exploratory aggregates: breakdowns, pivots, profiles, box plots, histograms.

Each is a single aggregate (partial on the map side, final after one shuffle
on the grouping keys). Null grouping keys are dropped, as pandas ``groupby``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


from ..functions.dates import elapsed_days, month_start, ts
from ..functions.stats import money_avg, money_sum, scalar
from .quantiles import placed_quantiles, value_places


def _nn(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    cond = None
    for k in keys:
        c = F.col(k).isNotNull()
        cond = c if cond is None else cond & c
    return df.where(cond) if cond is not None else df


def value_counts(df: DataFrame, col: str) -> DataFrame:
    return _nn(df, [col]).groupBy(col).agg(F.count(F.lit(1)).alias("count"))


def top_counts(df: DataFrame, col: str, n: int) -> DataFrame:
    """``value_counts().nlargest(n)`` with ties broken by value."""
    return value_counts(df, col).orderBy(F.col("count").desc(), F.col(col)).limit(n)


def rows_per_customer(df: DataFrame) -> DataFrame:
    return df.groupBy("customer_id").agg(F.count(F.lit(1)).alias("order_count"))


def spend_per_customer(df: DataFrame) -> DataFrame:
    return df.groupBy("customer_id").agg(money_sum(F.col("gross_price")).alias("total_spend"))


def recency_to(df: DataFrame, as_of: str) -> DataFrame:
    g = df.groupBy("customer_id").agg(F.max("purchase_datetime").alias("last_order_date"))
    return g.withColumn("recency", elapsed_days(F.col("last_order_date"), ts(as_of)))


def demographics_summary(df_with_age: DataFrame) -> DataFrame:
    return _nn(df_with_age, ["gender"]).groupBy("gender").agg(
        money_avg(F.col("gross_price")).alias("avg_gross_price"),
        money_sum(F.col("gross_price")).alias("total_gross_price"),
        F.count("gross_price").alias("order_count"),
        F.avg("age").alias("avg_age"),
        F.min("age").alias("min_age"),
        F.max("age").alias("max_age"))


def price_by(df: DataFrame, key: str) -> DataFrame:
    """Total and mean gross price per key; an all-null group sums to 0."""
    return _nn(df, [key]).groupBy(key).agg(
        F.coalesce(money_sum(F.col("gross_price")), F.lit(0.0)).alias("total_gross_price"),
        money_avg(F.col("gross_price")).alias("avg_gross_price"))


def count_pivot(df: DataFrame, row: str, col: str, values: Sequence[str]) -> DataFrame:
    """row x col count table for an explicit list of column values, fill 0."""
    p = _nn(df, [row, col]).groupBy(row).pivot(col, list(values)).count()
    return p.select(row, *[F.coalesce(F.col(v), F.lit(0)).cast("bigint").alias(v) for v in values])


def row_share(pivot: DataFrame, row: str, values: Sequence[str]) -> DataFrame:
    total = sum((F.col(v) for v in values[1:]), F.col(values[0]))
    return pivot.select(row, *[(F.col(v) / total).alias(v) for v in values])


def class_gender_profile(df_with_age: DataFrame) -> DataFrame:
    return _nn(df_with_age, ["product_class", "gender"]).groupBy("product_class", "gender").agg(
        money_sum(F.col("gross_price")).alias("total_gross_price"),
        money_avg(F.col("gross_price")).alias("avg_gross_price"),
        money_sum(F.col("price_reduction")).alias("total_price_reduction"),
        money_avg(F.col("price_reduction")).alias("avg_price_reduction"),
        F.count("order_id").alias("total_orders"),
        F.avg("age").alias("avg_age"))


def correlation_matrix(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Long-form Pearson matrix, pairwise-complete, from one aggregate."""
    aggs = []
    for a in cols:
        for b in cols:
            aggs.append(F.struct(F.lit(a).alias("var1"), F.lit(b).alias("var2"),
                                 F.corr(F.col(a).cast("double"), F.col(b).cast("double"))
                                 .alias("corr")))
    return df.agg(F.array(*aggs).alias("m")).select(F.inline("m"))


def monthly_sales(df: DataFrame, class_col: str = "product_class") -> DataFrame:
    return (_nn(df.withColumn("month", month_start(F.col("purchase_datetime"))), [class_col])
            .groupBy("month", class_col).agg(money_sum(F.col("gross_price")).alias("total_sales")))


def monthly_sales_pivot(df: DataFrame, classes: Sequence[str],
                        class_col: str = "product_class") -> DataFrame:
    m = df.withColumn("month", month_start(F.col("purchase_datetime")))
    p = _nn(m, [class_col]).groupBy("month").pivot(class_col, list(classes)).agg(money_sum(F.col("gross_price")))
    return p.select("month", *[F.coalesce(F.col(v), F.lit(0.0)).alias(f"class_{v}") for v in classes])


def customer_behaviour(df: DataFrame) -> DataFrame:
    return df.groupBy("customer_id").agg(
        F.count_distinct("order_id").alias("purchase_frequency"),
        money_avg(F.col("gross_price")).alias("avg_order_value"),
        F.mode("product_class", deterministic=True).alias("favorite_category"))


def loyalty_impact(df: DataFrame, status_col: str) -> DataFrame:
    return _nn(df, [status_col]).groupBy("customer_id", status_col).agg(
        F.count_distinct("order_id").alias("order_count"),
        money_sum(F.col("gross_price")).alias("total_spend"))


def boxplot_stats(df: DataFrame, keys: Sequence[str], value: str, weight: str | None = None) -> DataFrame:
    """Per group: quartiles, whiskers (most extreme values within 1.5 IQR), outliers.

    ``weight`` is a column that says how many rows a row stands for.

    Rows are reduced to distinct values once; quartiles, whiskers and outliers all
    come from these, joined to one row per group.
    """
    base = (_nn(df, list(keys)).where(F.col(value).isNotNull())
            .select(*keys, F.col(value), (F.col(weight) if weight else F.lit(1)).alias("_w")))
    placed = value_places(base, [value], keys, "_w")
    q = placed_quantiles(placed, [0.25, 0.5, 0.75], keys)
    q = q.select(*keys, F.col("n").alias("_n"), F.col("q")[0].alias("q1"), F.col("q")[1].alias("median"), F.col("q")[2].alias("q3"))
    iqr = F.col("q3") - F.col("q1")
    lo = F.col("q1") - 1.5 * iqr
    hi = F.col("q3") + 1.5 * iqr
    v = F.col("value")
    return placed.join(q, list(keys)).groupBy(*keys, F.col("_n").alias("n"), "q1", "median", "q3").agg(
        F.min(F.when(v >= lo, v)).alias("whisker_low"),
        F.max(F.when(v <= hi, v)).alias("whisker_high"),
        F.sum(F.when((v < lo) | (v > hi), F.col("n")).otherwise(0)).cast("bigint").alias("outliers"))


def equal_width_hist(df: DataFrame, x: Column, bins: int) -> DataFrame:
    """(bin, count) over ``bins`` equal-width bins of [min, max]; max in the last."""
    d = df.select(x.cast("double").alias("_x")).where(F.col("_x").isNotNull())
    s = scalar(d, lo=F.min("_x"), hi=F.max("_x"))
    b = F.when(s["hi"] > s["lo"],
               F.least(F.floor((F.col("_x") - s["lo"]) / (s["hi"] - s["lo"]) * bins) + 1, F.lit(bins))
               ).otherwise(F.lit(1)).cast("bigint")
    return d.select(b.alias("bin")).groupBy("bin").agg(F.count(F.lit(1)).alias("count"))


def density_2d(df: DataFrame, x: Column, y: Column, bins: int) -> DataFrame:
    """(x_bin, y_bin, count): equal-width 2-D bin counts replacing a scatter plot."""
    d = df.select(x.cast("double").alias("_x"), y.cast("double").alias("_y")) \
        .where(F.col("_x").isNotNull() & F.col("_y").isNotNull())
    s = scalar(d, xl=F.min("_x"), xh=F.max("_x"), yl=F.min("_y"), yh=F.max("_y"))

    def b(c, lo, hi):
        return F.when(hi > lo, F.least(F.floor((F.col(c) - lo) / (hi - lo) * bins) + 1, F.lit(bins))
                      ).otherwise(F.lit(1)).cast("bigint")

    binned = d.select(b("_x", s["xl"], s["xh"]).alias("x_bin"), b("_y", s["yl"], s["yh"]).alias("y_bin"))
    return binned.groupBy("x_bin", "y_bin").agg(F.count(F.lit(1)).alias("count"))


def density_by(df: DataFrame, key: str, y: Column, bins: int, weight: str | None = None) -> DataFrame:
    """(key, y_bin, count): equal-width bin counts of a value for each level of a key."""
    d = df.select(F.col(key), y.cast("double").alias("_y"), (F.col(weight) if weight else F.lit(1)).alias("_w")).where(
        F.col(key).isNotNull() & F.col("_y").isNotNull())
    s = scalar(d, lo=F.min("_y"), hi=F.max("_y"))
    b = F.when(s["hi"] > s["lo"], F.least(F.floor((F.col("_y") - s["lo"]) / (s["hi"] - s["lo"]) * bins) + 1, F.lit(bins))
               ).otherwise(F.lit(1)).cast("bigint")
    return d.select(key, b.alias("y_bin"), "_w").groupBy(key, "y_bin").agg(F.sum("_w").cast("bigint").alias("count"))
