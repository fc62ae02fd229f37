"""Profiling and data-quality operators (one pass each, long-form output)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pyspark.sql.types import NumericType
from pyspark.sql.window import Window

from ..session import cut_lineage
from .quantiles import quantile_table

#: Repeated digests (two longs each) that are broadcast at most.
BROADCAST_DIGESTS = 1_000_000


def _stack(df: DataFrame, names: Sequence[str], value_type: str = "bigint") -> str:
    parts = ", ".join(f"'{n}', CAST(`{n}` AS {value_type})" for n in names)
    return f"stack({len(names)}, {parts}) AS (column_name, value)"


def null_counts(df: DataFrame) -> DataFrame:
    """(column_name, null_count) for every column, from one aggregate pass."""
    one = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in df.columns])
    return one.selectExpr(_stack(one, one.columns)).withColumnRenamed("value", "null_count")


def row_count(df: DataFrame) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("row_count"))


def _with_digest(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Adds a 128-bit digest of ``cols``; equal rows have equal digests, nulls included."""
    return df.withColumns({"_d1": F.xxhash64(F.lit(1), *cols), "_d2": F.xxhash64(F.lit(2), *cols)})


def _split_repeated(df: DataFrame, cols: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """Rows whose digest of ``cols`` occurs again, and the others.

    Only digests are counted over all rows. Up to ``BROADCAST_DIGESTS`` repeated ones are
    broadcast, so whole rows stay where they are; more are joined by a shuffle.
    """
    d = _with_digest(df, cols)
    repeated = cut_lineage(d.groupBy("_d1", "_d2").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > 1).select("_d1", "_d2"))
    if repeated.count() <= BROADCAST_DIGESTS:
        repeated = F.broadcast(repeated)
    return (d.join(repeated, ["_d1", "_d2"], "left_semi").drop("_d1", "_d2"),
            d.join(repeated, ["_d1", "_d2"], "left_anti").drop("_d1", "_d2"))


def duplicate_row_count(df: DataFrame) -> DataFrame:
    """Rows that repeat an earlier identical row (all columns); whole rows are compared among those of one digest."""
    g = _split_repeated(df, df.columns)[0].groupBy(*df.columns).count()
    return g.agg(F.coalesce(F.sum(F.col("count") - 1), F.lit(0)).cast("bigint")
                 .alias("duplicate_rows"))


def describe_numeric(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """count, mean, sample std, min, interpolated quartiles, max per column in
    long form: one aggregate pass, joined to the quartiles (a row per column)."""
    if cols is None:
        cols = [f.name for f in df.schema.fields if isinstance(f.dataType, NumericType)]
    aggs = []
    for c in cols:
        x = F.col(c).cast("double")
        aggs.append(F.struct(F.lit(c).alias("column_name"), F.count(x).alias("count"), F.avg(x).alias("mean"),
                             F.stddev_samp(x).alias("std"), F.min(x).alias("min"), F.max(x).alias("max")))
    stats = df.agg(F.array(*aggs).alias("a")).select(F.inline("a"))
    q = quantile_table(df, list(cols), [0.25, 0.5, 0.75]).select("column_name", "q")
    return stats.join(q, "column_name", "left").select(
        "column_name", "count", "mean", "std", "min", F.col("q")[0].alias("q25"), F.col("q")[1].alias("q50"),
        F.col("q")[2].alias("q75"), "max")


def distinct_preview(df: DataFrame, n: int = 5) -> DataFrame:
    """(column_name, rank, value): the ``n`` smallest distinct values per column, null last.

    One scan emits (column, value) pairs; distinct values come from an
    aggregate, and the per-column ``row_number <= n`` is planned as a window
    group limit that keeps only the top ``n`` per map partition before the
    shuffle.
    """
    pairs = F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(c).cast("string").alias("value"))
                      for c in df.columns])
    d = df.select(F.inline(pairs)).distinct()
    w = F.row_number().over(Window.partitionBy("column_name").orderBy(F.col("value").asc_nulls_last()))
    return d.select("column_name", w.cast("bigint").alias("rank"), "value").where(F.col("rank") <= n)


def duplicates(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """All members of duplicate groups (``keep=False``) on ``cols`` or all columns.

    Rows of a repeated digest are kept first; among them duplicate keys come from a
    partial aggregate and rows from a null-safe semi join, so a hot key is never
    gathered by a window.
    """
    cols = list(cols or df.columns)
    some = _split_repeated(df, cols)[0]
    keys = some.groupBy(*cols).count().where(F.col("count") > 1).drop("count")
    cond = [some[c].eqNullSafe(keys[c]) for c in cols]
    return some.join(keys, cond, "left_semi")


def dedup_exact(df: DataFrame) -> DataFrame:
    """One row of each; rows whose digest is their own are passed on as they are."""
    repeated, alone = _split_repeated(df, df.columns)
    return alone.unionAll(repeated.dropDuplicates())


def distinct_count(df: DataFrame, col: str, approx: bool = False) -> DataFrame:
    f = F.approx_count_distinct if approx else F.count_distinct
    return df.agg(f(F.col(col)).cast("bigint").alias(f"distinct_{col}"))


def class_distribution(df: DataFrame, col: str) -> DataFrame:
    """value_counts(normalize=True): share of each non-null class."""
    base = df.where(F.col(col).isNotNull())
    total = base.agg(F.count(F.lit(1))).scalar()
    return base.groupBy(col).count().select(
        col, F.col("count").cast("bigint").alias("count"), (F.col("count") / total).alias("share"))


def require_columns(df: DataFrame, cols: Sequence[str]) -> None:
    """Raise before any job runs when required columns are missing."""
    missing = [c for c in cols if c not in df.columns]
    if missing:
        raise ValueError(f"missing required columns: {missing}")


def check_binary_label(df: DataFrame, col: str) -> bool:
    """True when ``col`` holds both 0 and 1; raise on values outside {0, 1}."""
    r = df.agg(F.min(col).alias("lo"), F.max(col).alias("hi"),
               F.count_distinct(col).alias("n")).first()
    if r["n"] and (r["lo"] < 0 or r["hi"] > 1):
        raise ValueError(f"label {col} has values outside {{0, 1}}")
    return bool(r["n"] == 2)


def column_types(df: DataFrame) -> DataFrame:
    """(column_name, data_type) of a DataFrame's schema (metadata, no scan)."""
    spark = df.sparkSession
    return spark.createDataFrame([(f.name, f.dataType.simpleString()) for f in df.schema.fields],
                                 "column_name string, data_type string")
