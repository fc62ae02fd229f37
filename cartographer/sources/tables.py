"""Reader for the driver's Parquet tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem",
          "events", "documents", "embeddings", "pages", "benchmark", "labels",
          "conversations")


_READERS: dict[tuple[str, int, str], DataFrame] = {}


def read_parquet(spark: SparkSession, path: str) -> DataFrame:
    """Parquet scan, resolved once per session: schema discovery and file
    listing run a small job each time, so the scan plan is reused."""
    key = (spark.sparkContext.applicationId, id(spark._jsparkSession), path)
    df = _READERS.get(key)
    if df is None:
        df = _READERS[key] = spark.read.parquet(path)
    return df


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    if name not in TABLES:
        raise ValueError(f"unknown table {name!r}")
    return read_parquet(spark, f"{sf_dir.rstrip('/')}/{name}.parquet")


class Tables:
    """Lazy accessor: ``Tables(spark, dir).lineitem`` is a Parquet scan."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir

    def __getattr__(self, name: str) -> DataFrame:
        if name in TABLES:
            return read_table(self.spark, self.sf_dir, name)
        raise AttributeError(name)
