"""Feature-engineering queries (I1-I5, I20 and one-hot decoding)."""

from __future__ import annotations

from pyspark.sql import functions as F

from .. import config as C
from ..operators import features as FE
from ..operators import joins
from .registry import Ctx, query

KEYS = ["order_id", "product_id"]
NUM = FE.NUMERIC
CAT = FE.CATEGORICAL + ["email_provider"]

TOP_CTE = {"x_top": """SELECT email_provider FROM f_merged WHERE email_provider IS NOT NULL
  GROUP BY 1 ORDER BY count(*) DESC, email_provider LIMIT 3""",
           "x_em": """SELECT * REPLACE (CASE WHEN email_provider IN (SELECT email_provider FROM x_top)
  THEN email_provider ELSE 'others' END AS email_provider) FROM f_merged"""}
NUM_CTES = dict(TOP_CTE, **{
    "x_med": """SELECT quantile_cont(price_reduction, 0.5) AS m1, quantile_cont(flag_phone_provided, 0.5) AS m2,
  quantile_cont(CAST(loyatlty_status AS DOUBLE), 0.5) AS m3 FROM f_merged""",
    "x_imp": """SELECT order_id, product_id, coalesce(price_reduction, m1) AS a, coalesce(flag_phone_provided, m2) AS b,
  coalesce(CAST(loyatlty_status AS DOUBLE), m3) AS c FROM f_merged, x_med""",
    "x_st": """SELECT avg(a) AS ma, coalesce(nullif(stddev_pop(a), 0), 1.0) AS sa, avg(b) AS mb,
  coalesce(nullif(stddev_pop(b), 0), 1.0) AS sb, avg(c) AS mc, coalesce(nullif(stddev_pop(c), 0), 1.0) AS sc FROM x_imp""",
    "x_num": """SELECT order_id, product_id, (a - ma) / sa AS num__price_reduction, (b - mb) / sb AS num__flag_phone_provided,
  (c - mc) / sc AS num__loyatlty_status FROM x_imp, x_st""",
    "x_mode": """SELECT gender FROM f_merged WHERE gender IS NOT NULL GROUP BY 1 ORDER BY count(*) DESC, gender LIMIT 1""",
    "x_bin": """SELECT order_id, product_id, CASE WHEN coalesce(gender, (SELECT gender FROM x_mode)) = 'M'
  THEN 1.0 ELSE 0.0 END AS bin__gender_M FROM f_merged""",
    "x_oh": " UNION ALL ".join(
        f"SELECT order_id, product_id, 'cat__{c}_' || coalesce(CAST({c} AS VARCHAR), 'missing') AS feature FROM x_em"
        for c in CAT),
})
#: The same numbers without the full merge: the kept line of each (order, product), five columns, scalar statistics.
FIVE_CTES = {
    "y_line": """SELECT order_id, product_id, any_value(customer_id) AS customer_id,
  min({'a': store_id, 'b': direction, 'c': gross_price, 'd': price_reduction}).d AS price_reduction FROM f_orders GROUP BY 1, 2""",
    "y_five": """SELECT order_id, product_id, price_reduction AS a, flag_phone_provided AS b, CAST(loyatlty_status AS DOUBLE) AS c
  FROM y_line LEFT JOIN f_customers USING (customer_id) LEFT JOIN f_accounts USING (customer_id)""",
    "y_fill": "SELECT order_id, product_id, " + ", ".join(
        f"coalesce({x}, (SELECT quantile_cont({x}, 0.5) FROM y_five)) AS {x}" for x in "abc") + " FROM y_five",
}
SCALED_SQL = "SELECT order_id, product_id, " + ", ".join(
    f"({x} - (SELECT avg({x}) FROM y_fill)) / (SELECT coalesce(nullif(stddev_pop({x}), 0), 1.0) FROM y_fill) AS num__{name}"
    for x, name in zip("abc", NUM, strict=True)) + " FROM y_fill"
NUM_FEATURES = ["num__price_reduction", "num__flag_phone_provided", "num__loyatlty_status"]


def _merged_email(c: Ctx):
    top = FE.top_values(c.merged, "email_provider", 3)
    return c.merged.withColumn("email_provider", FE.group_rare(F.col("email_provider"), top))


@query("email_top3", extra_ctes=TOP_CTE, sql="SELECT order_id, product_id, email_provider FROM x_em")
def email_top3(c: Ctx):
    return _merged_email(c).select(*KEYS, "email_provider")


@query("impute_scale", extra_ctes=FIVE_CTES, doubles=NUM_FEATURES, sql=SCALED_SQL)
def impute_scale(c: Ctx):
    p = FE.fit_preprocessor(c.merged, NUM, [], [], email_col=None)
    return p.transform(c.merged, KEYS)


@query("one_hot", extra_ctes=NUM_CTES, sql="SELECT * FROM x_oh")
def one_hot(c: Ctx):
    return FE.one_hot_long(_merged_email(c), KEYS, CAT)


@query("binary_encode", extra_ctes=NUM_CTES, sql="SELECT * FROM x_bin")
def binary_encode(c: Ctx):
    p = FE.fit_preprocessor(c.merged, [], [], ["gender"], email_col=None)
    return p.transform(c.merged, KEYS)


@query("feature_matrix", extra_ctes=NUM_CTES, doubles=["value"], sql="""
SELECT order_id, product_id, feature, value FROM (
  SELECT order_id, product_id, 'num__price_reduction' AS feature, num__price_reduction AS value FROM x_num
  UNION ALL SELECT order_id, product_id, 'num__flag_phone_provided', num__flag_phone_provided FROM x_num
  UNION ALL SELECT order_id, product_id, 'num__loyatlty_status', num__loyatlty_status FROM x_num
  UNION ALL SELECT order_id, product_id, feature, 1.0 FROM x_oh
  UNION ALL SELECT order_id, product_id, 'bin__gender_M', bin__gender_M FROM x_bin) t
WHERE value <> 0""")
def feature_matrix(c: Ctx):
    """Fitted column transformer output in sparse long form (non-zero cells)."""
    p = FE.fit_preprocessor(c.merged)
    return p.cells(c.merged, KEYS)


ATTR = ["job_type", "region", "loyalty_type", "email_provider"]


@query("decode_one_hot", extra_ctes={
    "x_cd": """SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY customer_id ORDER BY address_id NULLS FIRST,
  birthdate NULLS FIRST, gender NULLS FIRST, job_type NULLS FIRST, email_provider NULLS FIRST,
  flag_phone_provided NULLS FIRST, flag_privacy NULLS FIRST, postal_code NULLS FIRST, district NULLS FIRST,
  region NULLS FIRST, account_id NULLS FIRST, favorite_store NULLS FIRST, loyalty_type NULLS FIRST,
  loyatlty_status NULLS FIRST, activation_date NULLS FIRST) AS rn FROM f_customer_data) t WHERE rn = 1""",
    "x_ct": """SELECT email_provider FROM x_cd WHERE email_provider IS NOT NULL GROUP BY 1
  ORDER BY count(*) DESC, email_provider LIMIT 3"""}, sql="""
SELECT customer_id, coalesce(job_type, 'missing') AS cat__job_type_decoded, coalesce(region, 'missing') AS cat__region_decoded,
  coalesce(loyalty_type, 'missing') AS cat__loyalty_type_decoded,
  CASE WHEN email_provider IN (SELECT email_provider FROM x_ct) THEN email_provider ELSE 'others' END
    AS cat__email_provider_decoded
FROM x_cd""")
def decode_one_hot(c: Ctx):
    """Customer attributes one-hot encoded, then decoded back by arg-max."""
    cust = joins.keep_first(joins.customer_data(c.customers, c.addresses, c.accounts), ["customer_id"])
    p = FE.fit_preprocessor(cust, [], [x for x in ATTR if x != "email_provider"], [])
    return FE.decode_one_hot(p.transform(cust, ["customer_id"]), C.ONE_HOT_PREFIXES)
