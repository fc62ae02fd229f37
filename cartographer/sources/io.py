"""Typed CSV scans, Parquet/CSV sinks, samples and run selection."""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import (BooleanType, DateType, DoubleType, IntegerType, StringType,
                               StructField, StructType, TimestampNTZType)

from .. import config as C
from ..functions.sampling import hash_bucket, in_fraction, key_hash
from ..session import ensure_checkpoint_dir
from . import split_csv

#: Tables of a folder that are opened at the same time.
FOLDER_THREADS = 4


def _s(*fields) -> StructType:
    return StructType([StructField(n, t, True) for n, t in fields])


SCHEMAS = {
    "customers": _s(("customer_id", StringType()), ("address_id", StringType()),
                    ("birthdate", DateType()), ("gender", StringType()), ("job_type", StringType()),
                    ("email_provider", StringType()), ("flag_phone_provided", DoubleType()),
                    ("flag_privacy", BooleanType())),
    "products": _s(("product_id", StringType()), ("product_class", StringType())),
    "orders": _s(("order_id", StringType()), ("customer_id", StringType()), ("store_id", StringType()),
                 ("product_id", StringType()), ("direction", IntegerType()),
                 ("gross_price", DoubleType()), ("price_reduction", DoubleType()),
                 ("purchase_datetime", TimestampNTZType())),
    "addresses": _s(("address_id", StringType()), ("postal_code", StringType()),
                    ("district", StringType()), ("region", StringType())),
    "customer_accounts": _s(("customer_id", StringType()), ("account_id", StringType()),
                            ("favorite_store", StringType()), ("loyalty_type", StringType()),
                            (C.LOYALTY_STATUS_COL, IntegerType()), ("activation_date", DateType())),
    "customer_reviews": _s(("review_id", StringType()), ("customer_id", StringType()),
                           ("review_text", StringType())),
    "labelled_reviews": _s(("labelled_reviews_index", StringType()), ("review_text", StringType()),
                           ("sentiment_label", StringType())),
}


def read_csv(spark: SparkSession, path: str, table: str | None = None,
             schema: StructType | None = None, split_bytes: int = split_csv.SPLIT_BYTES) -> DataFrame:
    """Typed CSV scan (header, quoted multi-line fields); unknown tables are inferred.

    Files are shared by several tasks, ``split_bytes`` each; a folder with compressed files,
    which can't be split, goes through Spark's own scan, one task per file.
    """
    schema = schema or (SCHEMAS.get(table) if table else None)
    if not split_csv.any_compressed(spark, path):
        return split_csv.scan(spark, path, schema, split_bytes)
    r = spark.read.option("header", True).options(**split_csv.OPTIONS)
    return (r.schema(schema) if schema is not None else r.option("inferSchema", True)).csv(path)


def folder_tables(spark: SparkSession, folder: str) -> dict[str, str]:
    """Name and path of each table in a folder: a CSV file, or a folder of them. Names starting with _ or . are no tables."""
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(folder)
    found = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).listStatus(p)
    paths = sorted(st.getPath().toString() for st in found)
    names = {x.rstrip("/").rsplit("/", 1)[-1]: x for x in paths}
    return {n.split(".")[0]: x for n, x in names.items() if n[0] not in "_."}


def read_folder(spark: SparkSession, folder: str, split_bytes: int = split_csv.SPLIT_BYTES) -> dict[str, DataFrame]:
    """Every table of a folder, typed where its name is known, else inferred."""
    tables = folder_tables(spark, folder)
    ensure_checkpoint_dir(spark)
    # the tables' small jobs (sizes, quotes) are independent: a few driver threads let them share the cluster
    with ThreadPoolExecutor(max_workers=FOLDER_THREADS) as pool:
        found = pool.map(lambda name: read_csv(spark, tables[name], name, split_bytes=split_bytes), tables)
        return dict(zip(tables, found, strict=True))


def write(df: DataFrame, path: str, fmt: str = "parquet", mode: str = "overwrite",
          partition_by: list[str] | None = None) -> None:
    w = df.write.mode(mode)
    if partition_by:
        w = w.partitionBy(*partition_by)
    if fmt == "csv":
        w = w.option("header", True)
    w.format(fmt).save(path)


def write_run(df: DataFrame, path: str, run_ts: str, fmt: str = "parquet") -> None:
    """Append one run under ``run_ts=...`` instead of a timestamped file name."""
    write(df.withColumn("run_ts", F.lit(run_ts)), path, fmt, "append", ["run_ts"])


def latest_run(df: DataFrame, run_col: str = "run_ts") -> DataFrame:
    """Rows of the newest run; partition pruning applies on a partitioned layout."""
    newest = df.agg(F.max(run_col)).scalar()
    return df.where(F.col(run_col) == newest)


def sample_fraction(df: DataFrame, frac: float, *keys: str, seed: int = C.SEED) -> DataFrame:
    """Deterministic fraction by key hash (same rows for any partitioning)."""
    return df.where(in_fraction(frac, *[F.col(k) for k in keys], seed=seed))


def sample_n(df: DataFrame, n: int, *keys: str, seed: int = C.SEED) -> DataFrame:
    """min(n, rows) rows, chosen by smallest key hash (a top-k, not a scan)."""
    return (df.withColumn("_h", key_hash(*[F.col(k) for k in keys], seed=seed))
            .orderBy("_h", *keys).limit(n).drop("_h"))


def head(df: DataFrame, n: int, *keys: str) -> DataFrame:
    return df.orderBy(*keys).limit(n)


def split(df: DataFrame, test_fraction: float, *keys: str, seed: int = C.SEED) -> DataFrame:
    """Adds ``is_test`` by key hash: disjoint, complete, partition-independent."""
    return df.withColumn("is_test", hash_bucket(*[F.col(k) for k in keys], seed=seed)
                         < F.lit(int(round(test_fraction * 10000))))


def table_overview(spark: SparkSession, tables: dict[str, DataFrame], n: int = 3) -> dict[str, DataFrame]:
    """Per table: its columns and types, and a preview of ``n`` rows (a limit, no full scan)."""
    from ..operators.quality import column_types
    return {name: column_types(df).withColumn("table", F.lit(name)) for name, df in tables.items()} | {
        f"{name}__head": df.limit(n) for name, df in tables.items()}
