"""Exploratory aggregates (E*) and window / ranking queries (F*)."""

from __future__ import annotations

from pyspark.sql import functions as F

from .. import config as C
from ..operators import clean as K
from ..operators import explore as X
from ..operators import joins
from ..operators import quality as Q
from ..operators import ranking as RK
from ..operators import rfm as R
from ..functions.stats import money_sum
from .registry import Ctx, query

AS_OF = C.AS_OF
#: Product classes of the test data, for oracles that list one column per class.
CLASSES = [str(i) for i in range(1, 26)]
YEARS_SQL = f"CAST(year(DATE '{AS_OF}') - year(birthdate) AS BIGINT)"
AGE_SQL = f"CAST(round_even(datediff('day', birthdate, DATE '{AS_OF}') / 365.0, 0) AS BIGINT)"
HISTORY_CUSTOMER = "23"
BINS = C.HISTOGRAM_BINS


def merged_years(c: Ctx):
    """The merged table with calendar age; orders of customers without birthdate stay (age null)."""
    return K.with_age(c.merged, AS_OF, exact=False, keep_unknown=True)


def known_customers(c: Ctx):
    """Customers with a birthdate; missing gender and job type are Unknown."""
    return K.with_age(c.customers, AS_OF).fillna({"gender": C.UNKNOWN_LABEL, "job_type": C.UNKNOWN_LABEL})


YEARS_CTE = {"x_age": f"SELECT *, {YEARS_SQL} AS age FROM f_merged"}
MERGED_AGE_CTE = {"x_age": f"SELECT *, {AGE_SQL} AS age FROM f_merged WHERE birthdate IS NOT NULL"}


def hist_sql(src: str, expr: str, bins: int = BINS) -> str:
    return f"""
SELECT CAST(CASE WHEN s.hi > s.lo THEN least(floor((x - s.lo) / (s.hi - s.lo) * {bins}) + 1, {bins})
  ELSE 1 END AS BIGINT) AS bin, count(*) AS count
FROM (SELECT CAST({expr} AS DOUBLE) AS x FROM {src}) d,
  (SELECT min(CAST({expr} AS DOUBLE)) AS lo, max(CAST({expr} AS DOUBLE)) AS hi FROM {src}) s
WHERE x IS NOT NULL GROUP BY 1"""


def box_sql(src: str, keys: list[str], value: str) -> tuple[str, dict]:
    k = ", ".join(keys)
    nn = " AND ".join(f"{x} IS NOT NULL" for x in keys + [value])
    ctes = {
        "bx_base": f"SELECT {k}, CAST({value} AS DOUBLE) AS v FROM {src} WHERE {nn}",
        "bx_q": f"""SELECT {k}, count(*) AS n, quantile_cont(v, 0.25) AS q1, quantile_cont(v, 0.5) AS median,
  quantile_cont(v, 0.75) AS q3 FROM bx_base GROUP BY {k}""",
    }
    body = f"""
SELECT {", ".join("q." + x for x in keys)}, q.n, q.q1, q.median, q.q3,
  min(b.v) FILTER (WHERE b.v >= q.q1 - 1.5 * (q.q3 - q.q1)) AS whisker_low,
  max(b.v) FILTER (WHERE b.v <= q.q3 + 1.5 * (q.q3 - q.q1)) AS whisker_high,
  count(*) FILTER (WHERE b.v < q.q1 - 1.5 * (q.q3 - q.q1) OR b.v > q.q3 + 1.5 * (q.q3 - q.q1)) AS outliers
FROM bx_base b JOIN bx_q q ON {" AND ".join(f"b.{x} = q.{x}" for x in keys)}
GROUP BY {", ".join("q." + x for x in keys)}, q.n, q.q1, q.median, q.q3"""
    return body, ctes


BOX_DOUBLES = ["q1", "median", "q3"]


@query("age_distribution", sql=f"""
SELECT {AGE_SQL} AS age, count(*) AS count FROM f_customers WHERE birthdate IS NOT NULL GROUP BY 1""")
def age_distribution(c: Ctx):
    return X.value_counts(K.with_age(c.customers, AS_OF), "age")


@query("age_summary", doubles=["mean", "std", "q25", "q50", "q75"], sql=f"""
SELECT 'age' AS column_name, count(*) AS count, avg(a) AS mean, stddev_samp(a) AS std, CAST(min(a) AS DOUBLE) AS min,
  quantile_cont(a, 0.25) AS q25, quantile_cont(a, 0.5) AS q50, quantile_cont(a, 0.75) AS q75, CAST(max(a) AS DOUBLE) AS max
FROM (SELECT {AGE_SQL} AS a FROM f_customers WHERE birthdate IS NOT NULL) t""")
def age_summary(c: Ctx):
    return Q.describe_numeric(K.with_age(c.customers, AS_OF), ["age"])


@query("gender_counts", sql="""
SELECT coalesce(gender, 'Unknown') AS gender, count(*) AS count FROM f_customers WHERE birthdate IS NOT NULL GROUP BY 1""")
def gender_counts(c: Ctx):
    return X.value_counts(known_customers(c), "gender")


@query("top_job_types", sql="""
SELECT coalesce(job_type, 'Unknown') AS job_type, count(*) AS count FROM f_customers WHERE birthdate IS NOT NULL GROUP BY 1
ORDER BY count DESC, job_type LIMIT 10""")
def top_job_types(c: Ctx):
    return X.top_counts(known_customers(c), "job_type", 10)


@query("order_frequency", sql="SELECT customer_id, count(*) AS order_count FROM f_merged GROUP BY 1")
def order_frequency(c: Ctx):
    return X.rows_per_customer(c.lines)


@query("total_spend", sql="SELECT customer_id, CAST(sum(CAST(gross_price AS DECIMAL(28,6))) AS DOUBLE) AS total_spend FROM f_merged GROUP BY 1")
def total_spend(c: Ctx):
    return X.spend_per_customer(c.lines)


@query("recency", sql=f"""
SELECT customer_id, max(purchase_datetime) AS last_order_date,
  datesub('day', max(purchase_datetime), TIMESTAMP '{AS_OF} 00:00:00') AS recency FROM f_merged GROUP BY 1""")
def recency(c: Ctx):
    return X.recency_to(c.lines, AS_OF)


@query("category_popularity", sql="""
SELECT product_class, count(*) AS count FROM f_merged WHERE product_class IS NOT NULL GROUP BY 1""")
def category_popularity(c: Ctx):
    return X.value_counts(c.merged, "product_class")


@query("sentiment_distribution", sql="""
SELECT sentiment_label, count(*) AS count FROM f_labelled WHERE sentiment_label IS NOT NULL GROUP BY 1""")
def sentiment_distribution(c: Ctx):
    return X.value_counts(c.labelled, "sentiment_label")


@query("demographics_summary", extra_ctes=YEARS_CTE,
       sql="""
SELECT gender, (CAST(sum(CAST(gross_price AS DECIMAL(28,6))) AS DOUBLE) / count(gross_price)) AS avg_gross_price, CAST(sum(CAST(gross_price AS DECIMAL(28,6))) AS DOUBLE) AS total_gross_price,
  count(gross_price) AS order_count, avg(age) AS avg_age, min(age) AS min_age, max(age) AS max_age
FROM x_age WHERE gender IS NOT NULL GROUP BY gender""")
def demographics_summary(c: Ctx):
    return X.demographics_summary(merged_years(c))


def _price_by(key: str, name: str):
    @query(f"price_by_{name}",
           sql=f"""
SELECT {key}, coalesce(CAST(sum(CAST(gross_price AS DECIMAL(28,6))) AS DOUBLE), 0.0) AS total_gross_price, (CAST(sum(CAST(gross_price AS DECIMAL(28,6))) AS DOUBLE) / count(gross_price)) AS avg_gross_price
FROM f_merged WHERE {key} IS NOT NULL GROUP BY 1""")
    def q(c: Ctx):
        return X.price_by(c.merged, key)
    return q


for _k, _n in (("gender", "gender"), ("loyalty_type", "loyalty"), ("product_class", "class"),
               ("region", "region")):
    _price_by(_k, _n)


@query("store_gender_counts", sql="""
SELECT favorite_store, count(*) FILTER (WHERE gender = 'F') AS "F", count(*) FILTER (WHERE gender = 'M') AS "M"
FROM f_merged WHERE favorite_store IS NOT NULL AND gender IS NOT NULL GROUP BY 1""")
def store_gender_counts(c: Ctx):
    return X.count_pivot(c.merged, "favorite_store", "gender", ["F", "M"])


@query("store_gender_share", sql="""
SELECT favorite_store, f / (f + m) AS "F", m / (f + m) AS "M" FROM (
  SELECT favorite_store, count(*) FILTER (WHERE gender = 'F') AS f, count(*) FILTER (WHERE gender = 'M') AS m
  FROM f_merged WHERE favorite_store IS NOT NULL AND gender IS NOT NULL GROUP BY 1) t""")
def store_gender_share(c: Ctx):
    p = X.count_pivot(c.merged, "favorite_store", "gender", ["F", "M"])
    return X.row_share(p, "favorite_store", ["F", "M"])


@query("class_gender_profile", extra_ctes=YEARS_CTE,
       sql="""
SELECT product_class, gender, CAST(sum(CAST(gross_price AS DECIMAL(28,6))) AS DOUBLE) AS total_gross_price, (CAST(sum(CAST(gross_price AS DECIMAL(28,6))) AS DOUBLE) / count(gross_price)) AS avg_gross_price,
  CAST(sum(CAST(price_reduction AS DECIMAL(28,6))) AS DOUBLE) AS total_price_reduction, (CAST(sum(CAST(price_reduction AS DECIMAL(28,6))) AS DOUBLE) / count(price_reduction)) AS avg_price_reduction,
  count(order_id) AS total_orders, avg(age) AS avg_age
FROM x_age WHERE product_class IS NOT NULL AND gender IS NOT NULL GROUP BY 1, 2""")
def class_gender_profile(c: Ctx):
    return X.class_gender_profile(merged_years(c))


CORR_COLS = ["gross_price", "flag_phone_provided", "age"]


@query("correlation_matrix", extra_ctes=YEARS_CTE, doubles=["corr"], sql=" UNION ALL ".join(
    f"SELECT '{a}' AS var1, '{b}' AS var2, corr(CAST({a} AS DOUBLE), CAST({b} AS DOUBLE)) AS corr FROM x_age"
    for a in CORR_COLS for b in CORR_COLS))
def correlation_matrix(c: Ctx):
    return X.correlation_matrix(merged_years(c), CORR_COLS)


@query("monthly_sales", sql="""
SELECT CAST(date_trunc('month', purchase_datetime) AS DATE) AS month, product_class,
  CAST(sum(CAST(gross_price AS DECIMAL(28,6))) AS DOUBLE) AS total_sales FROM f_merged WHERE product_class IS NOT NULL GROUP BY 1, 2""")
def monthly_sales(c: Ctx):
    return X.monthly_sales(c.merged)


def product_classes(c: Ctx) -> list[str]:
    """Pivot levels: the distinct classes of the product dimension (bounded)."""
    rows = c.products.select("product_class").where(F.col("product_class").isNotNull()).distinct().collect()
    return sorted(r[0] for r in rows)


@query("monthly_sales_pivot", sql="SELECT CAST(date_trunc('month', purchase_datetime) AS DATE) AS month, " + ", ".join(
    f"coalesce(CAST(sum(CAST(gross_price AS DECIMAL(28,6))) FILTER (WHERE product_class = '{v}') AS DOUBLE), 0.0) AS class_{v}"
    for v in CLASSES) + " FROM f_merged WHERE product_class IS NOT NULL GROUP BY 1")
def monthly_sales_pivot(c: Ctx):
    return X.monthly_sales_pivot(c.merged, product_classes(c))


SENTIMENT_CTE = {"x_cs": """SELECT r.customer_id, s.sentiment_score, count(*) AS n
  FROM f_reviews r JOIN f_sentiment s ON r.review_text = s.review_text WHERE s.sentiment_score IS NOT NULL GROUP BY 1, 2"""}


def customer_sentiment(c: Ctx):
    """(customer_id, sentiment_score, n): scored reviews of each customer, counted at review grain."""
    s = joins.review_sentiment_join(c.reviews, c.labelled).where(F.col("sentiment_score").isNotNull())
    return s.groupBy("customer_id", "sentiment_score").agg(F.count(F.lit(1)).alias("n"))


@query("sentiment_vs_sales", doubles=["avg_sentiment"], extra_ctes=SENTIMENT_CTE, sql="""
SELECT m.product_id, sum(x.total) / sum(x.n) AS avg_sentiment, CAST(sum(CAST(m.gross_price AS DECIMAL(28,6))) AS DOUBLE) AS total_sales
FROM f_merged m LEFT JOIN (SELECT customer_id, sum(sentiment_score * n) AS total, sum(n) AS n FROM x_cs GROUP BY 1) x
  ON m.customer_id = x.customer_id GROUP BY 1""")
def sentiment_vs_sales(c: Ctx):
    """Per product: mean sentiment over its order lines' reviews (each review weighs alike) and sales."""
    cs = customer_sentiment(c).groupBy("customer_id").agg(
        F.sum(F.col("sentiment_score") * F.col("n")).alias("_total"), F.sum("n").alias("_n"))
    return c.lines.join(cs, "customer_id", "left").groupBy("product_id").agg(
        F.try_divide(F.sum("_total").cast("double"), F.sum("_n").cast("double")).alias("avg_sentiment"), money_sum(F.col("gross_price")).alias("total_sales"))


@query("customer_behaviour", sql="""
SELECT a.customer_id, a.purchase_frequency, a.avg_order_value, m.product_class AS favorite_category FROM
  (SELECT customer_id, count(DISTINCT order_id) AS purchase_frequency, (CAST(sum(CAST(gross_price AS DECIMAL(28,6))) AS DOUBLE) / count(gross_price)) AS avg_order_value
   FROM f_merged GROUP BY 1) a
  LEFT JOIN (SELECT customer_id, product_class, row_number() OVER (PARTITION BY customer_id
      ORDER BY count(*) DESC, product_class) AS rn
    FROM f_merged WHERE product_class IS NOT NULL GROUP BY 1, 2) m ON a.customer_id = m.customer_id AND m.rn = 1""")
def customer_behaviour(c: Ctx):
    return X.customer_behaviour(c.lines)


@query("loyalty_impact", sql="""
SELECT customer_id, loyatlty_status, count(DISTINCT order_id) AS order_count, CAST(sum(CAST(gross_price AS DECIMAL(28,6))) AS DOUBLE) AS total_spend
FROM f_merged WHERE loyatlty_status IS NOT NULL GROUP BY 1, 2""")
def loyalty_impact(c: Ctx):
    return X.loyalty_impact(c.merged, C.LOYALTY_STATUS_COL)


def _box(key: str, src_sql: str, keys: list[str], value: str, extra: dict | None, build):
    body, ctes = box_sql(src_sql, keys, value)
    ctes = {**(extra or {}), **ctes}
    query(key, sql=body, extra_ctes=ctes, doubles=BOX_DOUBLES)(build)


_box("boxplot_by_loyalty", "f_merged", ["loyalty_type"], "gross_price", None,
     lambda c: X.boxplot_stats(c.merged, ["loyalty_type"], "gross_price"))
_box("boxplot_by_class_gender", "f_merged", ["product_class", "gender"], "gross_price", None,
     lambda c: X.boxplot_stats(c.merged, ["product_class", "gender"], "gross_price"))
_box("boxplot_loyalty_behaviour", "x_li", ["loyatlty_status"], "order_count",
     {"x_li": """SELECT customer_id, loyatlty_status, count(DISTINCT order_id) AS order_count
  FROM f_merged WHERE loyatlty_status IS NOT NULL GROUP BY 1, 2"""},
     lambda c: X.boxplot_stats(X.loyalty_impact(c.merged, C.LOYALTY_STATUS_COL),
                               [C.LOYALTY_STATUS_COL], "order_count"))
_box("boxplot_loyalty_spend", "x_ls", ["loyatlty_status"], "total_spend",
     {"x_ls": """SELECT customer_id, loyatlty_status, CAST(sum(CAST(gross_price AS DECIMAL(28,6))) AS DOUBLE) AS total_spend
  FROM f_merged WHERE loyatlty_status IS NOT NULL GROUP BY 1, 2"""},
     lambda c: X.boxplot_stats(X.loyalty_impact(c.merged, C.LOYALTY_STATUS_COL),
                               [C.LOYALTY_STATUS_COL], "total_spend"))


def sentiment_prices(c: Ctx):
    """(gross_price, sentiment_score, n): order lines of the customer table against the customers' scored reviews.

    The rows of the customer-360 join, with a weight instead of the fan-out:
    addresses repeat a customer as often as they do there.
    """
    homes = c.addresses.groupBy("address_id").agg(F.count(F.lit(1)).alias("_homes"))
    base = (c.customers.select("customer_id", "address_id").join(homes, "address_id", "left")
            .select("customer_id", F.coalesce("_homes", F.lit(1)).alias("_homes")))
    prices = c.orders.select("customer_id", "gross_price").join(base, "customer_id")
    return prices.join(customer_sentiment(c), "customer_id").select(
        "gross_price", "sentiment_score", (F.col("n") * F.col("_homes")).alias("n"))


SENTIMENT_PRICE_SQL = """SELECT o.gross_price, s.sentiment_score FROM f_customers c
  LEFT JOIN f_orders o ON c.customer_id = o.customer_id
  LEFT JOIN f_addresses a ON c.address_id = a.address_id
  LEFT JOIN f_reviews r ON c.customer_id = r.customer_id
  LEFT JOIN f_sentiment s ON r.review_text = s.review_text"""
_box("boxplot_by_sentiment", "x_360", ["sentiment_score"], "gross_price", {"x_360": SENTIMENT_PRICE_SQL},
     lambda c: X.boxplot_stats(sentiment_prices(c), ["sentiment_score"], "gross_price", weight="n"))


def _price_bins(name: str, key: str, src: str, extra: dict, build, weight: str | None = None):
    query(f"price_density_{name}", extra_ctes=extra, sql=f"""
SELECT {key}, CAST(CASE WHEN s.yh > s.yl THEN least(floor((gross_price - s.yl) / (s.yh - s.yl) * 20) + 1, 20) ELSE 1 END AS BIGINT) AS y_bin,
  count(*) AS count
FROM (SELECT * FROM {src} WHERE {key} IS NOT NULL AND gross_price IS NOT NULL) d,
  (SELECT min(gross_price) AS yl, max(gross_price) AS yh FROM {src} WHERE {key} IS NOT NULL AND gross_price IS NOT NULL) s
GROUP BY 1, 2""")(lambda c: X.density_by(build(c), key, F.col("gross_price"), 20, weight))


_price_bins("sentiment", "sentiment_score", "x_360", {"x_360": SENTIMENT_PRICE_SQL}, sentiment_prices, "n")
_price_bins("class", "product_class", "f_merged", {}, lambda c: c.merged)
_price_bins("loyalty", "loyalty_type", "f_merged", {}, lambda c: c.merged)


@query("price_density_2d", extra_ctes=MERGED_AGE_CTE, sql="""
SELECT CAST(CASE WHEN s.xh > s.xl THEN least(floor((x - s.xl) / (s.xh - s.xl) * 20) + 1, 20) ELSE 1 END AS BIGINT) AS x_bin,
  CAST(CASE WHEN s.yh > s.yl THEN least(floor((y - s.yl) / (s.yh - s.yl) * 20) + 1, 20) ELSE 1 END AS BIGINT) AS y_bin,
  count(*) AS count
FROM (SELECT CAST(age AS DOUBLE) AS x, gross_price AS y FROM x_age WHERE gross_price IS NOT NULL) d,
  (SELECT min(CAST(age AS DOUBLE)) AS xl, max(CAST(age AS DOUBLE)) AS xh, min(gross_price) AS yl,
   max(gross_price) AS yh FROM x_age WHERE gross_price IS NOT NULL) s GROUP BY 1, 2""")
def price_density_2d(c: Ctx):
    return X.density_2d(K.with_age(c.merged, AS_OF), F.col("age"), F.col("gross_price"), 20)


@query("purchase_histogram", sql=hist_sql("f_merged", "epoch_us(purchase_datetime)"))
def purchase_histogram(c: Ctx):
    epoch = F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")
    return X.equal_width_hist(c.lines, F.timestamp_diff("MICROSECOND", epoch, F.col("purchase_datetime")), BINS)


@query("customer_history", sql=f"""
SELECT * FROM f_merged WHERE customer_id = '{HISTORY_CUSTOMER}'""")
def customer_history(c: Ctx):
    """One customer's purchase history, ordered by time."""
    return c.merged.where(F.col("customer_id") == HISTORY_CUSTOMER).orderBy("purchase_datetime", "order_id",
                                                                           "product_id")


GAPS_CTE = {"x_gaps": """
SELECT customer_id, order_id, product_id, purchase_datetime,
  coalesce(datesub('day', lag(purchase_datetime) OVER w, purchase_datetime),
           datesub('day', max(purchase_datetime) OVER (PARTITION BY customer_id),
                   (SELECT max(purchase_datetime) FROM f_merged))) AS purchase_diff
FROM f_merged WINDOW w AS (PARTITION BY customer_id ORDER BY purchase_datetime, order_id, product_id)"""}


@query("purchase_gaps", extra_ctes=GAPS_CTE, sql="SELECT * FROM x_gaps")
def purchase_gaps(c: Ctx):
    return RK.purchase_gaps(c.lines)


@query("large_gaps", extra_ctes=GAPS_CTE, sql=f"SELECT * FROM x_gaps WHERE purchase_diff > {C.LARGE_GAP_DAYS}")
def large_gaps(c: Ctx):
    return RK.purchase_gaps(c.lines).where(F.col("purchase_diff") > C.LARGE_GAP_DAYS)


@query("gap_histogram", extra_ctes=GAPS_CTE, sql=hist_sql("x_gaps", "purchase_diff"))
def gap_histogram(c: Ctx):
    # the gaps feed two passes (range scalars, then binning): materialise them once
    from ..session import cut_lineage
    return X.equal_width_hist(cut_lineage(RK.purchase_gaps(c.lines)), F.col("purchase_diff"), BINS)


@query("cumulative_score", sql="""
SELECT score, sum(n) OVER (ORDER BY score) / sum(n) OVER () AS cumulative_share
FROM (SELECT score, count(*) AS n FROM f_scores WHERE score IS NOT NULL GROUP BY 1) d""")
def cumulative_score(c: Ctx):
    return RK.cumulative_share(c.scores, "score")


@query("top_churn_risk", sql="""
SELECT customer_id, score FROM f_scores ORDER BY score DESC, customer_id LIMIT 10""")
def top_churn_risk(c: Ctx):
    return RK.top_k(c.scores.select("customer_id", "score"), 10, [F.col("score").desc(), "customer_id"])


RFM_CTE = {"x_rfm": """
SELECT customer_id,
  datesub('day', max(purchase_datetime), (SELECT max(purchase_datetime) FROM f_merged)) AS recency,
  CAST(sum(CAST(gross_price AS DECIMAL(28,6))) AS DOUBLE) AS monetary,
  count(order_id) / ((year(max(purchase_datetime)) - year(min(purchase_datetime))) * 12
    + month(max(purchase_datetime)) - month(min(purchase_datetime)) + 1) AS frequency
FROM f_merged GROUP BY customer_id"""}


@query("minmax_scale", extra_ctes=RFM_CTE,
       sql="""
SELECT x_rfm.*, (recency - s.rl) / nullif(s.rh - s.rl, 0) AS recency_scaled,
  (monetary - s.ml) / nullif(s.mh - s.ml, 0) AS monetary_scaled,
  (frequency - s.fl) / nullif(s.fh - s.fl, 0) AS frequency_scaled
FROM x_rfm, (SELECT min(recency) rl, max(recency) rh, min(monetary) ml, max(monetary) mh,
  min(frequency) fl, max(frequency) fh FROM x_rfm) s""")
def minmax_scale(c: Ctx):
    return RK.minmax_scale(R.rfm(c.lines), ["recency", "monetary", "frequency"])
