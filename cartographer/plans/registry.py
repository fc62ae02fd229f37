"""Query registry.

``@query(key, sql=..., doubles=...)`` registers a Spark plan builder
``fn(ctx) -> DataFrame`` and, when the answer is exact, its DuckDB oracle.
Columns listed in ``doubles`` carry unavoidable float noise (quantile
interpolation, standard deviations, correlations) and are rounded to 6
decimals on both sides; money sums are exact (decimal) on both sides.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, FloatType

from ..operators import joins
from ..sources import fixtures
from ..sources.fixtures import Retail
from ..sources.prepared import prepared
from .fixture_sql import with_ctes

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}
ROUND_DIGITS = 6


class Ctx:
    """Lazily built shared inputs of one scale factor (plans, not data)."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir
        self.r = Retail(spark, sf_dir)

    @cached_property
    def customers(self) -> DataFrame:
        return self.r.customers()

    @cached_property
    def products(self) -> DataFrame:
        return self.r.products()

    @cached_property
    def orders(self) -> DataFrame:
        return self.r.orders()

    @cached_property
    def addresses(self) -> DataFrame:
        return self.r.addresses()

    @cached_property
    def accounts(self) -> DataFrame:
        return self.r.accounts()

    @cached_property
    def reviews(self) -> DataFrame:
        return self.r.reviews()

    @cached_property
    def labelled(self) -> DataFrame:
        return self.r.labelled()

    @cached_property
    def scores(self) -> DataFrame:
        return self.r.scores()

    @cached_property
    def lines(self) -> DataFrame:
        """Order side of the merged table (one row per order and product):
        a column-pruned read of the prepared merged table."""
        return self.merged.select(*joins.ORDER_COLS, "product_class")

    @cached_property
    def merged(self) -> DataFrame:
        """The merged table, prepared once per input fingerprint."""
        inputs = [f"{self.sf_dir.rstrip('/')}/{t}.parquet"
                  for t in ("lineitem", "orders", "part", "customer", "nation", "region")]
        return prepared(self.spark, "merged_data", inputs, self.build_merged,
                        sort_within=["customer_id", "purchase_datetime"], code=[joins, fixtures],
                        bucket_by="customer_id", sizes=lambda: self.orders.select("customer_id"),
                        build_parts=self.build_merged)

    def build_merged(self, partitions: int | None = None) -> DataFrame:
        return joins.merged_data(self.r.orders(by_order_id=True), self.products, self.customers,
                                 self.addresses, self.accounts, partitions)


def round_doubles(df: DataFrame, names: Sequence[str], digits: int = ROUND_DIGITS) -> DataFrame:
    """Round the listed columns (float noise of sums, quantiles, std, corr).

    Columns computed exactly on both sides (money sums via decimal, ratios of
    counts, pass-through values) are left untouched so they stay bit-equal.
    """
    names = set(names)
    cols = []
    for f in df.schema.fields:
        if f.name in names and isinstance(f.dataType, (DoubleType, FloatType)):
            cols.append(F.round(F.col(f.name), digits).alias(f.name))
        else:
            cols.append(F.col(f.name))
    return df.select(*cols)


def oracle_round(sql: str, doubles: Sequence[str]) -> str:
    if not doubles:
        return sql
    rep = ", ".join(f"round({c}, {ROUND_DIGITS}) AS {c}" for c in doubles)
    return f"SELECT * REPLACE ({rep}) FROM (\n{sql}\n) q"


def query(key: str, sql: str | None = None, doubles: Sequence[str] = (),
          extra_ctes: dict[str, str] | None = None, recursive: bool = False):
    if key in QUERIES:
        raise ValueError(f"duplicate query key {key}")

    def deco(fn: Callable[[Ctx], DataFrame]):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return round_doubles(fn(Ctx(spark, sf_dir)), doubles)

        run.__name__ = f"q_{key}"
        run.__doc__ = fn.__doc__
        QUERIES[key] = run
        if sql is not None:
            ORACLE[key] = oracle_round(with_ctes(sql, extra_ctes, recursive), doubles)
        return fn

    return deco


def load_all() -> None:
    """Import every plan module so its queries register."""
    from . import (basket, churn, cleaning, exploration, features, metrics,  # noqa: F401
                   models, profiling, propensity, sentiment, sources)
