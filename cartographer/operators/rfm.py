"""Recency / frequency / monetary scores."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import config as C
from ..functions.stats import money_sum
from ..functions.dates import elapsed_days, months_active, ts


def rfm(data: DataFrame) -> DataFrame:
    """Per customer: recency = days from the customer's last purchase to the
    last purchase in the data; monetary = sum of gross price; frequency =
    order rows / calendar months active.

    One partial+final aggregate on customer_id; the global maximum is a scalar
    subquery, so no second pass joins back to the rows.
    """
    end = data.agg(F.max("purchase_datetime")).scalar()
    g = data.groupBy("customer_id").agg(
        F.min("purchase_datetime").alias("first_purchase"),
        F.max("purchase_datetime").alias("last_purchase"),
        F.count("order_id").alias("order_count"),
        money_sum(F.col("gross_price")).alias("monetary"),
    )
    return g.select(
        "customer_id",
        elapsed_days(F.col("last_purchase"), end).alias("recency"),
        F.col("monetary"),
        (F.col("order_count") / months_active(F.col("first_purchase"), F.col("last_purchase")))
        .alias("frequency"),
    )


def rfm_fixed_date(data: DataFrame, as_of: str = C.LEGACY_AS_OF) -> DataFrame:
    """Legacy RFM: recency to a fixed reference date, frequency = row count."""
    return data.groupBy("customer_id").agg(
        elapsed_days(F.max("purchase_datetime"), ts(as_of)).alias("recency"),
        F.count("order_id").alias("frequency"),
        money_sum(F.col("gross_price")).alias("monetary"),
    )


def churn_threshold(rfm_df: DataFrame, days: int = C.CHURN_RECENCY_DAYS) -> DataFrame:
    """Legacy churn flag: recency above ``days``."""
    return rfm_df.withColumn("churn", F.col("recency") > F.lit(days))
