"""Propensity targets over sliding periods, offer value and next best offer,
category ranking from propensity scores."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from .. import config as C
from ..functions.stats import money_avg
from .periods import Grid

OBS, PRED, STEP = C.PROPENSITY_OBSERVATION_DAYS, C.PROPENSITY_PREDICTION_DAYS, C.PROPENSITY_STEP_DAYS


def period_grid(data: DataFrame, obs: int = OBS, pred: int = PRED, step: int = STEP) -> Grid:
    return Grid(data, obs + pred, step)


def periods(data: DataFrame, obs: int = OBS, pred: int = PRED, step: int = STEP) -> DataFrame:
    """(period_idx, period_start, period_end, prediction_end) of every period."""
    g = period_grid(data, obs, pred, step)
    k = F.col("period_idx")
    return (data.sparkSession.range(1)
            .select(F.explode(F.sequence(F.lit(0).cast("bigint"), (g.n - 1).cast("bigint"))).alias("period_idx"))
            .where(k >= 0)
            .select("period_idx", g.start_of(k).alias("period_start"), g.start_of(k, obs).alias("period_end"),
                    g.start_of(k, obs + pred).alias("prediction_end")))


def _observed(data: DataFrame, g: Grid, keep: Sequence[str], obs: int) -> DataFrame:
    return data.select(*keep, F.explode(g.windows(0, obs)).alias("_k"))


def _buying_windows(data: DataFrame, g: Grid, keys: Sequence[str], obs: int, pred: int) -> DataFrame:
    """Distinct (keys..., _k): prediction windows in which the rows of ``data`` fall.

    Rows shrink to one per (keys, grid cell) before cells are copied into windows.
    """
    cells = data.select(*keys, g.cell(obs, pred).alias("_cell")).distinct()
    return cells.select(*keys, F.explode(g.windows(obs, pred, F.col("_cell"))).alias("_k")).distinct()


def target_variable(data: DataFrame, product: str | None = None, category: str | None = None,
                    keep: Sequence[str] = ("customer_id", "order_id", "product_id"),
                    obs: int = OBS, pred: int = PRED, step: int = STEP) -> DataFrame:
    """Observation rows of every period with target = 1 when the customer buys
    the product (or a product of the category) in the prediction window."""
    if product is None and category is None:
        raise ValueError("a target needs a product or a category to look for")
    g = period_grid(data, obs, pred, step)
    hit = (F.col("product_id") == product) if product is not None else (F.col("product_class") == category)
    buyers = _buying_windows(data.where(hit), g, ["customer_id"], obs, pred).withColumn("_t", F.lit(1))
    rows = _observed(data, g, keep, obs)
    return rows.join(buyers, ["customer_id", "_k"], "left").select(
        *keep, g.start_of(F.col("_k")).alias("period_start"), g.start_of(F.col("_k"), obs).alias("period_end"),
        F.coalesce(F.col("_t"), F.lit(0)).cast("int").alias("target"))


def multi_category_target(data: DataFrame, keep: Sequence[str] = ("customer_id", "order_id", "product_id"),
                          obs: int = OBS, pred: int = PRED, step: int = STEP) -> DataFrame:
    """Observation rows of every period with the sorted set of classes the
    customer buys in the prediction window (empty when none).

    Rows meet a customer's windows by the customer alone, before they are copied into
    their own windows: data that lies by customer is not moved.
    """
    g = period_grid(data, obs, pred, step)
    bought = (_buying_windows(data.where(F.col("product_class").isNotNull()), g, ["customer_id", "product_class"], obs, pred)
              .groupBy("customer_id", "_k").agg(F.array_sort(F.collect_set("product_class")).alias("_cats"))
              .groupBy("customer_id").agg(F.map_from_entries(F.collect_list(F.struct("_k", "_cats"))).alias("_by_window")))
    rows = data.select(*dict.fromkeys(["customer_id", *keep]), g.windows(0, obs).alias("_windows")).join(bought, "customer_id", "left")
    found = F.transform("_windows", lambda k: F.struct(k.alias("k"), F.try_element_at("_by_window", k).alias("cats")))
    return rows.select(*keep, F.explode(found).alias("_w")).select(
        *keep, g.start_of(F.col("_w.k")).alias("period_start"), g.start_of(F.col("_w.k"), obs).alias("period_end"),
        F.coalesce(F.col("_w.cats"), F.array().cast("array<string>")).alias("target_categories"))


def npv_cost(data: DataFrame, targets: dict[str, Column]) -> DataFrame:
    """(target, npv, cost) per named filter: npv = mean price * margin,
    cost = e-mail cost + mean reduction + fulfilment cost."""
    out = None
    for name, cond in targets.items():
        d = data.where(cond)
        r = d.agg(F.lit(name).alias("target"),
                  (money_avg(F.col("gross_price")) * C.PROFIT_MARGIN).alias("npv"),
                  (F.lit(C.EMAIL_COST) + money_avg(F.col("price_reduction")) + F.lit(C.FULFILLMENT_COST))
                  .alias("cost"))
        out = r if out is None else out.unionByName(r)
    return out


def vpo(p: Column, npv: Column, cost: Column) -> Column:
    """p * npv - cost; a probability outside [0, 1] gives null (NaN in pandas)."""
    return F.when(p.between(0, 1), p * npv - cost)


def _offers(scores: DataFrame, offers: dict[str, str], values: DataFrame) -> DataFrame:
    arr = F.array(*[F.struct(F.lit(o).alias("offer"), F.col(c).cast("double").alias("probability"))
                    for o, c in offers.items()])
    long = scores.select("customer_id", F.inline(arr))
    return long.join(F.broadcast(values), long.offer == values.target)


def offer_values(scores: DataFrame, offers: dict[str, str], values: DataFrame, counters: Observation | None = None) -> DataFrame:
    """Long (customer_id, offer, probability, vpo): one row per customer and
    offer; ``offers`` maps offer name -> probability column, ``values`` holds
    (target, npv, cost) per offer (one row per offer, broadcast).

    With ``counters`` the job that uses the result also counts what is worth a warning:
    rows, probabilities outside [0, 1] (their value is null), negative npv and negative cost.
    """
    j = _offers(scores, offers, values)
    if counters is not None:
        count = lambda c: F.coalesce(F.sum(c.cast("bigint")), F.lit(0).cast("bigint"))
        p = F.col("probability")
        j = j.observe(counters, F.count(F.lit(1)).alias("rows"), count((p < 0) | (p > 1)).alias("invalid_probabilities"),
                      count(F.col("npv") < 0).alias("negative_npv"), count(F.col("cost") < 0).alias("negative_cost"))
    return j.select("customer_id", "offer", "probability",
                    vpo(F.col("probability"), F.col("npv"), F.col("cost")).alias("vpo"))


def next_best_offer(values: DataFrame, offer_order: Sequence[str]) -> DataFrame:
    """Per customer the offer with the largest VPO (null counts as -inf, ties
    go to the earlier offer); customers whose offers are all invalid drop out.

    ``row_number() = 1`` runs with a partial window group limit, so each map
    task forwards one row per customer before the shuffle.
    """
    from pyspark.sql.window import Window
    rank = F.create_map(*[x for i, o in enumerate(offer_order) for x in (F.lit(o), F.lit(i))])
    v = F.coalesce(F.col("vpo"), F.lit(float("-inf")))
    w = Window.partitionBy("customer_id").orderBy(v.desc(), rank[F.col("offer")])
    best = values.withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") == 1)
    return best.where(v != float("-inf")).select("customer_id", "offer", "probability", "vpo")


def primary_secondary(df: DataFrame, prefix: str = "propensity_",
                      share: float = C.PRIMARY_CATEGORY_SHARE) -> DataFrame:
    """Primary = best category (ties: lowest name); secondary = the others with
    a score >= ``share`` x the best, in descending score order."""
    cols = [c for c in df.columns if c.startswith(prefix)]
    arr = F.array(*[F.struct(F.col(c).cast("double").alias("p"), F.lit(c[len(prefix):].split("_")[0]).alias("name"))
                    for c in cols])
    ranked = F.array_sort(arr, lambda a, b: F.when(a["p"] > b["p"], -1).when(a["p"] < b["p"], 1)
                          .when(a["name"] < b["name"], -1).when(a["name"] > b["name"], 1).otherwise(0))
    d = df.select("customer_id", ranked.alias("_r"))
    best = F.col("_r")[0]
    rest = F.filter(F.slice(F.col("_r"), 2, max(len(cols) - 1, 1)), lambda x: x["p"] >= share * best["p"])
    return d.select("customer_id", best["name"].alias("primary_category"),
                    F.array_join(F.transform(rest, lambda x: x["name"]), ",").alias("secondary_categories"))


def period_training_set(data: DataFrame, cond: Column, obs: int = OBS, pred: int = PRED,
                        step: int = STEP) -> DataFrame:
    """One row per (customer, period): observation-window features and
    target = 1 when a purchase matching ``cond`` falls in the prediction window."""
    from .churn import churn_features
    g = period_grid(data, obs, pred, step)
    feats = churn_features(data, obs, pred, step).drop("churned", "control_end")
    hits = (_buying_windows(data.where(cond), g, ["customer_id"], obs, pred)
            .select("customer_id", g.start_of(F.col("_k")).alias("window_start"), F.lit(1).alias("_t")))
    return feats.join(hits, ["customer_id", "window_start"], "left").withColumn(
        "target", F.coalesce(F.col("_t"), F.lit(0)).cast("int")).drop("_t")


def multi_period_training_set(data: DataFrame, obs: int = OBS, pred: int = PRED,
                              step: int = STEP) -> DataFrame:
    """One row per (customer, period): observation features and
    ``target_categories``, the sorted classes bought in the prediction window."""
    from .churn import churn_features
    g = period_grid(data, obs, pred, step)
    feats = churn_features(data, obs, pred, step).drop("churned", "control_end")
    bought = (_buying_windows(data.where(F.col("product_class").isNotNull()), g, ["customer_id", "product_class"], obs, pred)
              .groupBy("customer_id", "_k").agg(F.array_sort(F.collect_set("product_class")).alias("_cats"))
              .select("customer_id", g.start_of(F.col("_k")).alias("window_start"), "_cats"))
    return feats.join(bought, ["customer_id", "window_start"], "left").withColumn(
        "target_categories", F.coalesce(F.col("_cats"), F.array().cast("array<string>"))).drop("_cats")
