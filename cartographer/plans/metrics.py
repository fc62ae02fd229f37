"""Metric queries over a deterministic score table (I12-I17)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import metrics as M
from .registry import Ctx, query

THRESHOLD = 0.5
MODELS = ["score", "propensity_2", "propensity_3"]

SC_CTES = {
    "x_sc": """SELECT CAST(score AS DOUBLE) AS score, count(*) FILTER (WHERE label = 1) AS pos,
  count(*) FILTER (WHERE label <> 1) AS neg FROM f_scores WHERE score IS NOT NULL AND label IS NOT NULL GROUP BY 1""",
    "x_cum": """SELECT *, coalesce(sum(neg) OVER w, 0) AS neg_before, coalesce(sum(pos) OVER w, 0) AS pos_before
  FROM x_sc WINDOW w AS (ORDER BY score ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)""",
    "x_tot": "SELECT sum(pos) AS p, sum(neg) AS n FROM x_sc",
}
CM_CTES = {
    "x_cm": f"""SELECT CAST(label AS VARCHAR) AS label, CAST(CASE WHEN score > {THRESHOLD} THEN 1 ELSE 0 END AS VARCHAR)
  AS prediction, count(*) AS count FROM f_scores GROUP BY 1, 2""",
    "x_cls": "SELECT label AS c FROM x_cm UNION SELECT prediction FROM x_cm",
    "x_per": """SELECT c AS class, coalesce(sum(count) FILTER (WHERE label = c AND prediction = c), 0) AS tp,
  coalesce(sum(count) FILTER (WHERE label = c), 0) AS support,
  coalesce(sum(count) FILTER (WHERE prediction = c), 0) AS predicted FROM x_cls, x_cm GROUP BY c""",
    "x_m": """SELECT class, tp, support, CASE WHEN predicted > 0 THEN tp / predicted ELSE 0.0 END AS precision,
  CASE WHEN support > 0 THEN tp / support ELSE 0.0 END AS recall FROM x_per""",
    "x_f": """SELECT *, CASE WHEN precision + recall > 0 THEN 2 * precision * recall / (precision + recall)
  ELSE 0.0 END AS f1_score FROM x_m""",
}


def _pred(c: Ctx):
    return c.scores.withColumn("prediction", (F.col("score") > THRESHOLD).cast("int"))


@query("classification_report", extra_ctes=CM_CTES, doubles=["precision", "recall", "f1_score"], sql="""
SELECT class, precision, recall, f1_score, CAST(support AS BIGINT) AS support FROM x_f
UNION ALL SELECT 'accuracy', NULL, NULL, sum(tp) / sum(support), CAST(sum(support) AS BIGINT) FROM x_f
UNION ALL SELECT 'macro avg', avg(precision), avg(recall), avg(f1_score), CAST(sum(support) AS BIGINT) FROM x_f
UNION ALL SELECT 'weighted avg', sum(precision * support) / sum(support), sum(recall * support) / sum(support),
  sum(f1_score * support) / sum(support), CAST(sum(support) AS BIGINT) FROM x_f""")
def classification_report(c: Ctx):
    return M.classification_report(_pred(c), "label", "prediction")


@query("confusion_matrix", extra_ctes=CM_CTES, sql="""
SELECT a.c AS label, b.c AS prediction, CAST(coalesce(x_cm.count, 0) AS BIGINT) AS count
FROM x_cls a, x_cls b LEFT JOIN x_cm ON x_cm.label = a.c AND x_cm.prediction = b.c""")
def confusion_matrix(c: Ctx):
    return M.confusion_matrix(_pred(c), "label", "prediction")


@query("roc_auc", extra_ctes=SC_CTES, sql="""
SELECT sum(pos * (neg_before + 0.5 * neg)) / CAST(sum(pos) * sum(neg) AS DOUBLE) AS roc_auc FROM x_cum""")
def roc_auc(c: Ctx):
    return M.roc_auc(c.scores, "label", "score")


@query("roc_curve", extra_ctes=SC_CTES, sql="""
SELECT score AS threshold, CAST(n - neg_before AS DOUBLE) / n AS fpr, CAST(p - pos_before AS DOUBLE) / p AS tpr,
  CAST(p - pos_before AS DOUBLE) / ((p - pos_before) + (n - neg_before)) AS precision,
  CAST(p - pos_before AS DOUBLE) / p AS recall FROM x_cum, x_tot""")
def roc_curve(c: Ctx):
    return M.roc_curve(c.scores, "label", "score")


@query("pr_curve", extra_ctes=SC_CTES, sql="""
SELECT score AS threshold, CAST(p - pos_before AS DOUBLE) / ((p - pos_before) + (n - neg_before)) AS precision,
  CAST(p - pos_before AS DOUBLE) / p AS recall FROM x_cum, x_tot""")
def pr_curve(c: Ctx):
    return M.roc_curve(c.scores, "label", "score").select("threshold", "precision", "recall")


def _model_sql(m: str) -> str:
    return f"""
SELECT '{m}' AS model, ok / n AS accuracy, CASE WHEN pp > 0 THEN tp / pp ELSE 0.0 END AS precision,
  CASE WHEN p > 0 THEN tp / p ELSE 0.0 END AS recall, auc.roc_auc
FROM (SELECT count(*) FILTER (WHERE label = CAST({m} > {THRESHOLD} AS INT)) AS ok, count(*) AS n,
  count(*) FILTER (WHERE {m} > {THRESHOLD} AND label = 1) AS tp, count(*) FILTER (WHERE {m} > {THRESHOLD}) AS pp,
  count(*) FILTER (WHERE label = 1) AS p FROM f_scores) a,
(SELECT sum(pos * (neg_before + 0.5 * neg)) / CAST(sum(pos) * sum(neg) AS DOUBLE) AS roc_auc FROM (
  SELECT *, coalesce(sum(neg) OVER (ORDER BY s ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS neg_before
  FROM (SELECT CAST({m} AS DOUBLE) AS s, count(*) FILTER (WHERE label = 1) AS pos,
    count(*) FILTER (WHERE label <> 1) AS neg FROM f_scores WHERE {m} IS NOT NULL GROUP BY 1) x) y) auc"""


@query("model_comparison", doubles=["accuracy", "precision", "recall", "f1", "roc_auc"], sql=f"""
SELECT model, accuracy, precision, recall,
  CASE WHEN precision + recall > 0 THEN 2 * precision * recall / (precision + recall) ELSE 0.0 END AS f1, roc_auc
FROM ({" UNION ALL ".join(_model_sql(m) for m in MODELS)}) t""")
def model_comparison(c: Ctx):
    out = None
    for m in MODELS:
        r = M.binary_metrics(c.scores, "label", m, THRESHOLD).select(F.lit(m).alias("model"), "*")
        out = r if out is None else out.unionByName(r)
    return out
