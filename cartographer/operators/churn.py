"""Sliding-window churn labels, window features, high-value targeting."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import config as C
from ..functions.dates import elapsed_days, month_start
from ..config import MONEY_TYPE
from ..functions.stats import minmax, money_sum
from ..session import cut_lineage
from .periods import Grid
from .quantiles import quantile
from .ranking import qcut_labels, row_mean


def _tagged(cells: DataFrame, g: Grid, observation_days: int, control_days: int) -> DataFrame:
    """Cells exploded to (k, ctl): their observation windows (ctl = 0) and the
    windows whose control period holds them (ctl = 1). The window arrays are
    projected first (they use the grid's scalar subqueries), then tagged."""
    tag = lambda flag: (lambda k: F.struct(k.alias("k"), F.lit(flag).alias("ctl")))
    cell = F.col("_cell")
    w = cells.select("*", g.windows(0, observation_days, cell).alias("_o"),
                     g.windows(observation_days, control_days, cell).alias("_c"))
    return w.select(*cells.columns, F.inline(F.concat(F.transform("_o", tag(0)), F.transform("_c", tag(1)))))


def churn_labels(data: DataFrame, observation_days: int = C.CHURN_OBSERVATION_DAYS,
                 control_days: int = C.CHURN_CONTROL_DAYS,
                 step_days: int = C.CHURN_STEP_DAYS) -> DataFrame:
    """(customer_id, churned, window_start, window_end, control_end) for every
    customer seen in an observation window; churned = 1 when the customer
    has no purchase in the control period that follows.

    Rows shrink to one per (customer, grid cell) before cells are tagged with
    their observation and control windows; one aggregate per (customer,
    window) then gives both flags.
    """
    g = Grid(data, observation_days + control_days, step_days)
    cells = data.select("customer_id", g.cell(observation_days, control_days).alias("_cell")).distinct()
    flags = _tagged(cells, g, observation_days, control_days).groupBy("customer_id", "k").agg(
        F.max(1 - F.col("ctl")).alias("_seen"), F.max("ctl").alias("_kept"))
    return flags.where(F.col("_seen") == 1).select(
        "customer_id",
        (1 - F.col("_kept")).cast("int").alias("churned"),
        g.start_of(F.col("k")).alias("window_start"),
        g.start_of(F.col("k"), observation_days).alias("window_end"),
        g.start_of(F.col("k"), observation_days + control_days).alias("control_end"))


def churn_features(data: DataFrame, observation_days: int = C.CHURN_OBSERVATION_DAYS,
                   control_days: int = C.CHURN_CONTROL_DAYS,
                   step_days: int = C.CHURN_STEP_DAYS) -> DataFrame:
    """Per (customer, observation window): frequency, mean and max spend,
    recency (days from the last purchase to the window end), mean of the
    calendar-month spend totals, and the churn label of the window.

    Rows are first aggregated per (customer, grid cell, month): windows are
    unions of cells, so only these partial results are copied into windows. A
    (customer, window, month) and a (customer, window) aggregate follow.
    """
    g = Grid(data, observation_days + control_days, step_days)
    cells = (data.select("customer_id", "gross_price", "purchase_datetime",
                         month_start(F.col("purchase_datetime")).alias("month"),
                         g.cell(observation_days, control_days).alias("_cell"))
             .groupBy("customer_id", "_cell", "month").agg(
                 F.count("purchase_datetime").alias("n"), F.sum(F.col("gross_price").cast(MONEY_TYPE)).alias("spend"),
                 F.count("gross_price").alias("n_price"), F.max("gross_price").alias("max_spend"),
                 F.max("purchase_datetime").alias("last")))
    obs = F.col("ctl") == 0
    monthly = _tagged(cells, g, observation_days, control_days).groupBy("customer_id", "k", "month").agg(
        F.coalesce(F.sum(F.when(obs, F.col("n"))), F.lit(0)).alias("n"),
        F.sum(F.when(obs, F.col("spend"))).alias("spend"),
        F.sum(F.when(obs, F.col("n_price"))).alias("n_price"),
        F.max(F.when(obs, F.col("max_spend"))).alias("max_spend"),
        F.max(F.when(obs, F.col("last"))).alias("last"),
        F.max("ctl").alias("kept"))
    feats = monthly.groupBy("customer_id", "k").agg(
        F.sum("n").alias("frequency"),
        F.try_divide(F.sum("spend").cast("double"), F.sum("n_price").cast("double")).alias("avg_spend"),
        F.max("max_spend").alias("max_spend"),
        F.max("last").alias("last"),
        F.try_divide(F.sum("spend").cast("double"), F.count(F.when(F.col("n") > 0, 1)).cast("double"))
        .alias("total_monthly_spend"),
        F.max("kept").alias("kept"))
    window_end = g.start_of(F.col("k"), observation_days)
    return feats.where(F.col("frequency") > 0).select(
        "customer_id",
        F.col("frequency").cast("bigint").alias("frequency"),
        "avg_spend", "max_spend",
        elapsed_days(F.col("last"), window_end).alias("recency"),
        "total_monthly_spend",
        g.start_of(F.col("k")).alias("window_start"),
        window_end.alias("window_end"),
        (1 - F.col("kept")).cast("int").alias("churned"),
        g.start_of(F.col("k"), observation_days + control_days).alias("control_end"))


def features_current(data: DataFrame) -> DataFrame:
    """Per customer over all rows: frequency, total / mean / max spend, and
    recency to the last purchase of the data."""
    end = data.agg(F.max("purchase_datetime")).scalar()
    g = data.groupBy("customer_id").agg(
        F.count("purchase_datetime").alias("frequency"),
        money_sum(F.col("gross_price")).alias("total_monthly_spend"),
        F.count("gross_price").alias("_n"),
        F.max("gross_price").alias("max_spend"),
        F.max("purchase_datetime").alias("_last"))
    return g.select("customer_id", "frequency", "total_monthly_spend",
                    F.try_divide(F.col("total_monthly_spend"), F.col("_n").cast("double")).alias("avg_spend"),
                    "max_spend", elapsed_days(F.col("_last"), end).alias("recency"))


def features_of_all(data: DataFrame, days: int) -> DataFrame:
    """``features_current`` of the last ``days`` days for every customer of ``data``.

    Customers without a purchase in them have zero counts and spends; recency
    always looks back to the customer's last purchase.
    """
    ever = features_current(data).select("customer_id", "recency")
    recent = features_current(last_window(data, days)).drop("recency")
    return ever.join(recent, "customer_id", "left").fillna(
        {"frequency": 0, "total_monthly_spend": 0.0, "avg_spend": 0.0, "max_spend": 0.0})


def last_window(data: DataFrame, days: int = C.CHURN_RECENCY_DAYS) -> DataFrame:
    """Rows in the last ``days`` days before the final purchase."""
    end = data.agg(F.max("purchase_datetime")).scalar()
    return data.where(F.col("purchase_datetime") >= F.timestamp_add("DAY", F.lit(-days), end))


def high_value_at_risk(features: DataFrame, prob_col: str = "churn_probability_rf",
                       threshold: float = C.HIGH_VALUE_SCORE_THRESHOLD,
                       spend_col: str = "total_monthly_spend",
                       quantile_level: float = C.HIGH_VALUE_SPEND_QUANTILE,
                       labels: Sequence[str] = C.RISK_LABELS) -> DataFrame:
    """Customers with spend >= the spend quantile and churn probability above
    ``threshold``; recency, spend and frequency are min-max scaled within
    that group, averaged, and cut into quantile bins Low / Medium / High."""
    # per-customer tables: checkpointed so the statistics below read a flat scan
    # instead of nesting one scalar subquery inside the next
    features = cut_lineage(features)
    cut = quantile(features, spend_col, quantile_level)
    hv = cut_lineage(features.where((F.col(spend_col) >= cut) & (F.col(prob_col) > threshold)))
    cols = ["recency", spend_col, "frequency"]
    s = hv.agg(F.struct(*[F.min(c).alias(f"lo{i}") for i, c in enumerate(cols)],
                        *[F.max(c).alias(f"hi{i}") for i, c in enumerate(cols)]).alias("s")).scalar()
    scaled = hv.select("*", *[minmax(F.col(c).cast("double"), s[f"lo{i}"], s[f"hi{i}"]).alias(f"_s{i}")
                              for i, c in enumerate(cols)])
    scaled = cut_lineage(scaled.withColumn("RFM_avg", row_mean([f"_s{i}" for i in range(len(cols))])))
    return (qcut_labels(scaled.drop(*[f"_s{i}" for i in range(len(cols))]), "RFM_avg", labels)
            .withColumnRenamed("RFM_avg_label", "RFM_cluster"))


def high_value_legacy(rfm_df: DataFrame, prob_col: str = "churn_probability",
                      threshold: float = C.HIGH_VALUE_SCORE_THRESHOLD) -> DataFrame:
    """Monetary strictly above its 75th percentile and probability above threshold."""
    cut = quantile(rfm_df, "monetary", C.HIGH_VALUE_SPEND_QUANTILE)
    return rfm_df.where((F.col("monetary") > cut) & (F.col(prob_col) > threshold))


def campaign_funnel(targets: DataFrame, prob_col: str = "churn_probability_rf",
                    cluster_col: str = "RFM_cluster", top: str = "High",
                    min_prob: float = C.CAMPAIGN_SCORE_THRESHOLD) -> DataFrame:
    """Counts and percentages of the retention-campaign filter steps."""
    not_top = (F.col(cluster_col) != top) | F.col(cluster_col).isNull()
    low = F.col(prob_col) < min_prob
    a = targets.agg(F.count(F.lit(1)).alias("total_rows"),
                    F.count_if(not_top).alias("not_high"),
                    F.count_if(low).alias("low_probability"),
                    F.count_if(not_top | low).alias("either"))
    pct = lambda c: F.try_divide(F.col(c) * 100.0, F.col("total_rows").cast("double"))
    return a.select("total_rows", "not_high", "low_probability", "either",
                    (F.col("total_rows") - F.col("either")).alias("remaining"),
                    pct("not_high").alias("pct_not_high"), pct("low_probability").alias("pct_low_probability"),
                    pct("either").alias("pct_either"),
                    F.try_divide((F.col("total_rows") - F.col("either")) * 100.0,
                                 F.col("total_rows").cast("double")).alias("pct_remaining"))
