"""Propensity, offer and category-ranking queries (L*, E27, I20)."""

from __future__ import annotations

from pyspark.sql import Observation
from pyspark.sql import functions as F

from .. import config as C
from ..operators import features as FE
from ..operators import propensity as P
from ..operators import quality as Q
from .exploration import CLASSES, product_classes
from .registry import Ctx, query

OBS, PRED, STEP = P.OBS, P.PRED, P.STEP
CAT, PROD = C.PROPENSITY_CATEGORY, C.PROPENSITY_PRODUCT
OFFERS = {f"category_{CAT}": "propensity_1", f"product_{PROD}": "propensity_2"}


def _d(k: str, plus: int) -> str:
    return f"s + to_days(CAST({k} * {STEP} + {plus} AS INTEGER))"


PERIOD_CTES = {
    "x_pb": "SELECT min(purchase_datetime) AS s, max(purchase_datetime) AS e FROM f_merged",
    "x_pk": f"""SELECT unnest(generate_series(0, CAST(floor(datediff('second', s, e) / {STEP * 86400}) AS BIGINT))) AS k
  FROM x_pb""",
    "x_pw": f"""SELECT k, {_d('k', 0)} AS ps, {_d('k', OBS)} AS pe, {_d('k', OBS + PRED)} AS pz
  FROM x_pk, x_pb WHERE {_d('k', OBS + PRED)} <= e""",
    "x_obsrows": """SELECT m.customer_id, m.order_id, m.product_id, w.k, w.ps, w.pe FROM f_merged m
  JOIN x_pw w ON m.purchase_datetime >= w.ps AND m.purchase_datetime < w.pe""",
    "x_predrows": """SELECT m.customer_id, m.product_id, m.product_class, w.k FROM f_merged m
  JOIN x_pw w ON m.purchase_datetime >= w.pe AND m.purchase_datetime < w.pz""",
    "x_multi": """SELECT o.customer_id, o.order_id, o.product_id, o.ps AS period_start, o.pe AS period_end,
  coalesce(t.cats, []) AS cats FROM x_obsrows o LEFT JOIN (
    SELECT customer_id, k, list_sort(list(DISTINCT product_class)) AS cats FROM x_predrows
    WHERE product_class IS NOT NULL GROUP BY 1, 2) t ON o.customer_id = t.customer_id AND o.k = t.k""",
}
VALUE_CTES = {
    "x_npv": f"""
SELECT 'category_{CAT}' AS target,
  CAST(sum(CAST(gross_price AS DECIMAL(28,6))) AS DOUBLE) / count(gross_price) * {C.PROFIT_MARGIN} AS npv,
  {C.EMAIL_COST} + CAST(sum(CAST(price_reduction AS DECIMAL(28,6))) AS DOUBLE) / count(price_reduction)
    + {C.FULFILLMENT_COST} AS cost FROM f_merged WHERE product_class = '{CAT}'
UNION ALL
SELECT 'product_{PROD}',
  CAST(sum(CAST(gross_price AS DECIMAL(28,6))) AS DOUBLE) / count(gross_price) * {C.PROFIT_MARGIN},
  {C.EMAIL_COST} + CAST(sum(CAST(price_reduction AS DECIMAL(28,6))) AS DOUBLE) / count(price_reduction)
    + {C.FULFILLMENT_COST} FROM f_merged WHERE product_id = '{PROD}'""",
    "x_vpo": " UNION ALL ".join(
        f"""SELECT s.customer_id, '{o}' AS offer, CAST(s.{col} AS DOUBLE) AS probability,
  CASE WHEN s.{col} BETWEEN 0 AND 1 THEN s.{col} * v.npv - v.cost END AS vpo
  FROM f_scores s JOIN x_npv v ON v.target = '{o}'""" for o, col in OFFERS.items()),
}


def _target_sql(cond: str) -> str:
    return f"""
SELECT o.customer_id, o.order_id, o.product_id, o.ps AS period_start, o.pe AS period_end,
  CASE WHEN t.k IS NULL THEN 0 ELSE 1 END AS target
FROM x_obsrows o LEFT JOIN (SELECT DISTINCT customer_id, k FROM x_predrows WHERE {cond}) t
  ON o.customer_id = t.customer_id AND o.k = t.k"""


def _npv(c: Ctx):
    return P.npv_cost(c.lines, {f"category_{CAT}": F.col("product_class") == CAT,
                                f"product_{PROD}": F.col("product_id") == PROD})


def _values(c: Ctx):
    return P.offer_values(c.scores, OFFERS, _npv(c))


@query("propensity_periods", extra_ctes=PERIOD_CTES, sql="""
SELECT k AS period_idx, ps AS period_start, pe AS period_end, pz AS prediction_end FROM x_pw""")
def propensity_periods(c: Ctx):
    return P.periods(c.lines)


@query("propensity_target_category", extra_ctes=PERIOD_CTES, sql=_target_sql(f"product_class = '{CAT}'"))
def propensity_target_category(c: Ctx):
    return P.target_variable(c.lines, category=CAT)


@query("propensity_target_product", extra_ctes=PERIOD_CTES, sql=_target_sql(f"product_id = '{PROD}'"))
def propensity_target_product(c: Ctx):
    return P.target_variable(c.lines, product=PROD)


@query("multi_category_target", extra_ctes=PERIOD_CTES, sql="""
SELECT customer_id, order_id, product_id, period_start, period_end, array_to_string(cats, ',') AS target_categories
FROM x_multi""")
def multi_category_target(c: Ctx):
    t = P.multi_category_target(c.lines)
    return t.withColumn("target_categories", F.array_join("target_categories", ","))


@query("target_category_share", extra_ctes=PERIOD_CTES, sql="""
SELECT category, count(*) AS count, count(*) / (SELECT count(*) FROM x_multi) AS share
FROM (SELECT unnest(cats) AS category FROM x_multi) u GROUP BY 1""")
def target_category_share(c: Ctx):
    t = P.multi_category_target(c.lines)
    total = t.agg(F.count(F.lit(1))).scalar()
    return (t.select(F.explode("target_categories").alias("category")).groupBy("category")
            .agg(F.count(F.lit(1)).alias("count")).withColumn("share", F.col("count") / total))


@query("multilabel_matrix", extra_ctes=PERIOD_CTES, sql="""
SELECT customer_id, order_id, product_id, period_start, """ + ", ".join(
    f"CAST(list_contains(cats, '{v}') AS INTEGER) AS cat_{v}" for v in CLASSES) + " FROM x_multi")
def multilabel_matrix(c: Ctx):
    t = P.multi_category_target(c.lines)
    m = FE.multilabel_matrix(t, "target_categories", product_classes(c))
    return m.drop("target_categories", "period_end")


@query("npv_cost", extra_ctes=VALUE_CTES, sql="SELECT * FROM x_npv")
def npv_cost(c: Ctx):
    return _npv(c)


@query("vpo", extra_ctes=VALUE_CTES, sql="SELECT * FROM x_vpo")
def vpo(c: Ctx):
    return _values(c)


@query("vpo_counters", extra_ctes=VALUE_CTES, sql=" UNION ALL ".join(["SELECT " + ", ".join([
    "count(*) AS rows", "count(*) FILTER (p < 0 OR p > 1) AS invalid_probabilities", "count(*) FILTER (npv < 0) AS negative_npv",
    "count(*) FILTER (cost < 0) AS negative_cost"]) + " FROM (" + " UNION ALL ".join(
        f"SELECT s.{col} * 1.25 - 0.125 AS p, v.npv, v.npv - v.cost * 60 AS cost FROM f_scores s JOIN x_npv v ON v.target = '{o}'"
        for o, col in OFFERS.items()) + ") t"]))
def vpo_counters(c: Ctx):
    """Warning counts of an offer valuation, gathered by the job that values the offers.

    Scores are stretched beyond [0, 1] and costs lowered below 0 for some offers, as uncalibrated inputs would be.
    """
    stretched = c.scores.withColumns({col: F.col(col) * 1.25 - 0.125 for col in OFFERS.values()})
    values = _npv(c).withColumn("cost", F.col("npv") - F.col("cost") * 60)
    counters = Observation()
    P.offer_values(stretched, OFFERS, values, counters).write.format("noop").mode("overwrite").save()
    return c.spark.createDataFrame([counters.get], "rows bigint, invalid_probabilities bigint, negative_npv bigint, negative_cost bigint")


NEXT_SQL = f"""
SELECT customer_id, offer, probability, vpo FROM (
  SELECT *, row_number() OVER (PARTITION BY customer_id ORDER BY coalesce(vpo, '-inf'::DOUBLE) DESC,
    CASE offer {" ".join(f"WHEN '{o}' THEN {i}" for i, o in enumerate(OFFERS))} END) AS rn FROM x_vpo) t
WHERE rn = 1 AND coalesce(vpo, '-inf'::DOUBLE) <> '-inf'::DOUBLE"""


@query("next_best_offer", extra_ctes=VALUE_CTES, sql=NEXT_SQL)
def next_best_offer(c: Ctx):
    return P.next_best_offer(_values(c), list(OFFERS))


@query("primary_secondary", extra_ctes={
    "x_l": """SELECT customer_id, '1' AS cat, propensity_1 AS p FROM f_scores
  UNION ALL SELECT customer_id, '2', propensity_2 FROM f_scores
  UNION ALL SELECT customer_id, '3', propensity_3 FROM f_scores""",
    "x_r": """SELECT *, row_number() OVER (PARTITION BY customer_id ORDER BY p DESC, cat) AS rn,
  max(p) OVER (PARTITION BY customer_id) AS best FROM x_l"""}, sql=f"""
SELECT customer_id, max(cat) FILTER (WHERE rn = 1) AS primary_category,
  coalesce(string_agg(cat, ',' ORDER BY rn) FILTER (WHERE rn > 1 AND p >= {C.PRIMARY_CATEGORY_SHARE} * best), '')
    AS secondary_categories FROM x_r GROUP BY customer_id""")
def primary_secondary(c: Ctx):
    return P.primary_secondary(c.scores.select("customer_id", "propensity_1", "propensity_2", "propensity_3"))


def _stats_sql(src: str, cols: list[str]) -> str:
    return " UNION ALL ".join(
        f"SELECT '{x}' AS column_name, count({x}) AS count, avg({x}) AS mean, stddev_samp({x}) AS std, min({x}) AS min, "
        f"quantile_cont({x}, 0.25) AS q25, quantile_cont({x}, 0.5) AS q50, quantile_cont({x}, 0.75) AS q75, max({x}) AS max FROM {src}"
        for x in cols)


STAT_DOUBLES = ["mean", "std", "q25", "q50", "q75"]


@query("offer_statistics", extra_ctes=dict(VALUE_CTES, x_best=NEXT_SQL), doubles=STAT_DOUBLES, sql=_stats_sql("x_best", ["probability", "vpo"]))
def offer_statistics(c: Ctx):
    """Statistics of the best offers' probabilities and values."""
    return Q.describe_numeric(P.next_best_offer(_values(c), list(OFFERS)), ["probability", "vpo"])


@query("propensity_statistics", doubles=STAT_DOUBLES, sql=_stats_sql("f_scores", ["propensity_1", "propensity_2", "propensity_3"]))
def propensity_statistics(c: Ctx):
    return Q.describe_numeric(c.scores, ["propensity_1", "propensity_2", "propensity_3"])
