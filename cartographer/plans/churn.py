"""RFM and churn queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from .. import config as C
from ..operators import churn as CH
from ..operators import explore as X
from ..operators import joins, quality
from ..operators import rfm as R
from .exploration import hist_sql
from .registry import Ctx, query


@query("rfm", sql="""
SELECT customer_id,
  datesub('day', max(purchase_datetime), (SELECT max(purchase_datetime) FROM f_merged)) AS recency,
  CAST(sum(CAST(gross_price AS DECIMAL(28,6))) AS DOUBLE) AS monetary,
  count(order_id) / ((year(max(purchase_datetime)) - year(min(purchase_datetime))) * 12
    + month(max(purchase_datetime)) - month(min(purchase_datetime)) + 1) AS frequency
FROM f_merged GROUP BY customer_id""")
def rfm(c: Ctx):
    """Flagship: RFM per customer over the merged order lines."""
    return R.rfm(c.lines)


OBS, CTL, STEP = C.CHURN_OBSERVATION_DAYS, C.CHURN_CONTROL_DAYS, C.CHURN_STEP_DAYS
MSUM = "CAST(sum(CAST(gross_price AS DECIMAL(28,6))) AS DOUBLE)"

WINDOW_CTES = {
    "x_bounds": "SELECT min(purchase_datetime) AS s, max(purchase_datetime) AS e FROM f_merged",
    "x_k": f"""SELECT unnest(generate_series(0, CAST(floor(datediff('second', s, e) / {STEP * 86400}) AS BIGINT))) AS k
  FROM x_bounds""",
    "x_win": f"""SELECT k, s + to_days(CAST(k * {STEP} AS INTEGER)) AS ws,
  s + to_days(CAST(k * {STEP} + {OBS} AS INTEGER)) AS we, s + to_days(CAST(k * {STEP} + {OBS + CTL} AS INTEGER)) AS ce
  FROM x_k, x_bounds WHERE s + to_days(CAST(k * {STEP} + {OBS + CTL} AS INTEGER)) <= e""",
    "x_obs": """SELECT DISTINCT m.customer_id, w.k FROM f_merged m JOIN x_win w
  ON m.purchase_datetime >= w.ws AND m.purchase_datetime < w.we""",
    "x_ctl": """SELECT DISTINCT m.customer_id, w.k FROM f_merged m JOIN x_win w
  ON m.purchase_datetime >= w.we AND m.purchase_datetime < w.ce""",
}
FEATURE_CTES = dict(WINDOW_CTES, x_feat=f"""
SELECT f.customer_id, f.frequency, f.avg_spend, f.max_spend, f.recency, f.total_monthly_spend,
  f.ws AS window_start, f.we AS window_end, CASE WHEN c.k IS NULL THEN 1 ELSE 0 END AS churned,
  f.ce AS control_end
FROM (SELECT m.customer_id, w.k, w.ws, w.we, w.ce, count(m.purchase_datetime) AS frequency,
    {MSUM} / count(m.gross_price) AS avg_spend, max(m.gross_price) AS max_spend,
    datesub('day', max(m.purchase_datetime), w.we) AS recency,
    {MSUM} / count(DISTINCT date_trunc('month', m.purchase_datetime)) AS total_monthly_spend
  FROM f_merged m JOIN x_win w ON m.purchase_datetime >= w.ws AND m.purchase_datetime < w.we
  GROUP BY m.customer_id, w.k, w.ws, w.we, w.ce) f
LEFT JOIN x_ctl c ON f.customer_id = c.customer_id AND f.k = c.k""")
LAST_CTES = {
    "x_last": f"""SELECT * FROM f_merged WHERE purchase_datetime >=
  (SELECT max(purchase_datetime) FROM f_merged) - INTERVAL {C.CHURN_RECENCY_DAYS} DAY""",
    "x_cur": f"""SELECT customer_id, count(purchase_datetime) AS frequency, {MSUM} AS total_monthly_spend,
  {MSUM} / count(gross_price) AS avg_spend, max(gross_price) AS max_spend,
  datesub('day', max(purchase_datetime), (SELECT max(purchase_datetime) FROM x_last)) AS recency
  FROM x_last GROUP BY customer_id""",
}
HV_CTES = dict(LAST_CTES, **{
    "x_f": "SELECT x_cur.*, s.score AS churn_probability_rf FROM x_cur JOIN f_scores s ON x_cur.customer_id = s.customer_id",
    "x_hv": f"""SELECT * FROM x_f WHERE total_monthly_spend >= (SELECT quantile_cont(total_monthly_spend, {C.HIGH_VALUE_SPEND_QUANTILE}) FROM x_f)
  AND churn_probability_rf > {C.HIGH_VALUE_SCORE_THRESHOLD}""",
    "x_sc": """SELECT x_hv.*,
  (recency - min(recency) OVER ()) / nullif(max(recency) OVER () - min(recency) OVER (), 0) AS s0,
  (total_monthly_spend - min(total_monthly_spend) OVER ()) / nullif(max(total_monthly_spend) OVER () - min(total_monthly_spend) OVER (), 0) AS s1,
  (frequency - min(frequency) OVER ()) / nullif(max(frequency) OVER () - min(frequency) OVER (), 0) AS s2
  FROM x_hv""",
    "x_avg": """SELECT * EXCLUDE (s0, s1, s2),
  (coalesce(s0, 0.0) + coalesce(s1, 0.0) + coalesce(s2, 0.0)) / nullif(CAST(s0 IS NOT NULL AS INT) + CAST(s1 IS NOT NULL AS INT)
    + CAST(s2 IS NOT NULL AS INT), 0) AS RFM_avg FROM x_sc""",
    "x_risk": """SELECT x_avg.*, CASE WHEN RFM_avg IS NULL THEN NULL WHEN RFM_avg <= q.e[1] THEN 'Low'
  WHEN RFM_avg <= q.e[2] THEN 'Medium' ELSE 'High' END AS RFM_cluster
  FROM x_avg, (SELECT quantile_cont(RFM_avg, [1/3, 2/3]) AS e FROM x_avg) q""",
})


def high_value(c: Ctx):
    cur = CH.features_current(CH.last_window(c.lines))
    f = cur.join(c.scores.select("customer_id", F.col("score").alias("churn_probability_rf")), "customer_id")
    return CH.high_value_at_risk(f)


@query("rfm_fixed_date", sql=f"""
SELECT customer_id, datesub('day', max(purchase_datetime), TIMESTAMP '{C.LEGACY_AS_OF} 00:00:00') AS recency,
  count(order_id) AS frequency, {MSUM} AS monetary FROM f_merged GROUP BY customer_id""")
def rfm_fixed_date(c: Ctx):
    return R.rfm_fixed_date(c.lines, C.LEGACY_AS_OF)


@query("churn_threshold", sql=f"""
SELECT customer_id, datesub('day', max(purchase_datetime), TIMESTAMP '{C.LEGACY_AS_OF} 00:00:00') AS recency,
  count(order_id) AS frequency, {MSUM} AS monetary,
  datesub('day', max(purchase_datetime), TIMESTAMP '{C.LEGACY_AS_OF} 00:00:00') > {C.CHURN_RECENCY_DAYS} AS churn
FROM f_merged GROUP BY customer_id""")
def churn_threshold(c: Ctx):
    return R.churn_threshold(R.rfm_fixed_date(c.lines, C.LEGACY_AS_OF))


@query("churn_labels", extra_ctes=WINDOW_CTES, sql="""
SELECT o.customer_id, CASE WHEN c.k IS NULL THEN 1 ELSE 0 END AS churned, w.ws AS window_start,
  w.we AS window_end, w.ce AS control_end
FROM x_obs o JOIN x_win w ON o.k = w.k LEFT JOIN x_ctl c ON o.customer_id = c.customer_id AND o.k = c.k""")
def churn_labels(c: Ctx):
    return CH.churn_labels(c.lines)


@query("churn_features", extra_ctes=FEATURE_CTES, sql="SELECT * FROM x_feat")
def churn_features(c: Ctx):
    return CH.churn_features(c.lines)


TRAINING_CTES = dict(FEATURE_CTES, x_cust="""
SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY customer_id ORDER BY address_id NULLS FIRST,
  birthdate NULLS FIRST, gender NULLS FIRST, job_type NULLS FIRST, email_provider NULLS FIRST,
  flag_phone_provided NULLS FIRST, flag_privacy NULLS FIRST, postal_code NULLS FIRST, district NULLS FIRST,
  region NULLS FIRST, account_id NULLS FIRST, favorite_store NULLS FIRST, loyalty_type NULLS FIRST,
  loyatlty_status NULLS FIRST, activation_date NULLS FIRST) AS rn FROM f_customer_data) t WHERE rn = 1""")


@query("churn_training_set", extra_ctes=TRAINING_CTES, sql="""
SELECT f.*, c.* EXCLUDE (customer_id) FROM x_feat f LEFT JOIN x_cust c ON f.customer_id = c.customer_id""")
def churn_training_set(c: Ctx):
    """Window features with one row of customer attributes per customer."""
    cust = joins.keep_first(joins.customer_data(c.customers, c.addresses, c.accounts), ["customer_id"])
    return CH.churn_features(c.lines).join(cust, "customer_id", "left")


@query("churn_features_current", extra_ctes=LAST_CTES, sql="SELECT * FROM x_cur")
def churn_features_current(c: Ctx):
    return CH.features_current(CH.last_window(c.lines))


@query("last_window", extra_ctes=LAST_CTES, sql="SELECT * FROM x_last")
def last_window(c: Ctx):
    return CH.last_window(c.merged)


@query("high_value_at_risk", extra_ctes=HV_CTES, sql="SELECT * FROM x_risk")
def high_value_at_risk(c: Ctx):
    return high_value(c)


@query("campaign_target", extra_ctes=HV_CTES, sql="SELECT * FROM x_risk WHERE RFM_cluster = 'High'")
def campaign_target(c: Ctx):
    return high_value(c).where(F.col("RFM_cluster") == "High")


@query("campaign_funnel", extra_ctes=HV_CTES, sql=f"""
SELECT total_rows, not_high, low_probability, either, total_rows - either AS remaining,
  not_high * 100.0 / total_rows AS pct_not_high, low_probability * 100.0 / total_rows AS pct_low_probability,
  either * 100.0 / total_rows AS pct_either, (total_rows - either) * 100.0 / total_rows AS pct_remaining
FROM (SELECT count(*) AS total_rows,
  count(*) FILTER (WHERE RFM_cluster IS DISTINCT FROM 'High') AS not_high,
  count(*) FILTER (WHERE churn_probability_rf < {C.CAMPAIGN_SCORE_THRESHOLD}) AS low_probability,
  count(*) FILTER (WHERE RFM_cluster IS DISTINCT FROM 'High' OR churn_probability_rf < {C.CAMPAIGN_SCORE_THRESHOLD}) AS either
  FROM x_risk) t""")
def campaign_funnel(c: Ctx):
    return CH.campaign_funnel(high_value(c))


@query("high_value_legacy", sql=f"""
SELECT * FROM (SELECT r.*, s.score AS churn_probability FROM (
  SELECT customer_id, datesub('day', max(purchase_datetime), TIMESTAMP '{C.LEGACY_AS_OF} 00:00:00') AS recency,
    count(order_id) AS frequency, {MSUM} AS monetary FROM f_merged GROUP BY customer_id) r
  JOIN f_scores s ON r.customer_id = s.customer_id) t
WHERE monetary > (SELECT quantile_cont(monetary, {C.HIGH_VALUE_SPEND_QUANTILE}) FROM (
  SELECT {MSUM} AS monetary FROM f_merged GROUP BY customer_id) m) AND churn_probability > {C.HIGH_VALUE_SCORE_THRESHOLD}""")
def high_value_legacy(c: Ctx):
    r = R.rfm_fixed_date(c.lines, C.LEGACY_AS_OF).join(
        c.scores.select("customer_id", F.col("score").alias("churn_probability")), "customer_id")
    return CH.high_value_legacy(r)


@query("score_over_70", sql=f"SELECT * FROM f_scores WHERE score > {C.HIGH_VALUE_SCORE_THRESHOLD}")
def score_over_70(c: Ctx):
    return c.scores.where(F.col("score") > C.HIGH_VALUE_SCORE_THRESHOLD)


@query("churn_share", extra_ctes=WINDOW_CTES, sql="""
SELECT churned, count(*) AS count, count(*) / sum(count(*)) OVER () AS share FROM (
  SELECT CASE WHEN c.k IS NULL THEN 1 ELSE 0 END AS churned
  FROM x_obs o LEFT JOIN x_ctl c ON o.customer_id = c.customer_id AND o.k = c.k) t GROUP BY churned""")
def churn_share(c: Ctx):
    return quality.class_distribution(CH.churn_labels(c.lines), "churned")


@query("churn_score_histogram", sql=hist_sql("f_scores", "score"))
def churn_score_histogram(c: Ctx):
    return X.equal_width_hist(c.scores, F.col("score"), C.HISTOGRAM_BINS)
