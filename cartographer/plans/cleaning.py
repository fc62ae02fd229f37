"""Cleaning and typing queries (C*)."""

from __future__ import annotations

from pyspark.sql import functions as F

from .. import config as C
from ..operators import clean as K
from ..operators import joins
from .registry import Ctx, query

ORDER_DOUBLES = ["gross_price", "price_reduction"]


@query("clean_customers", sql=f"""
SELECT customer_id, address_id, birthdate, gender, coalesce(job_type, '{C.DEFAULT_JOB_TYPE}') AS job_type,
  coalesce(email_provider, '{C.DEFAULT_EMAIL_PROVIDER}') AS email_provider,
  coalesce(coalesce(flag_phone_provided, 0.0) = 1.0, false) AS flag_phone_provided, flag_privacy
FROM f_customers""")
def clean_customers(c: Ctx):
    return K.clean_customers(c.customers)


@query("fill_by_type", sql=f"""
SELECT coalesce(customer_id, 'Unknown') AS customer_id, coalesce(address_id, 'Unknown') AS address_id,
  birthdate, coalesce(gender, 'Unknown') AS gender, coalesce(job_type, 'Unknown') AS job_type,
  coalesce(email_provider, 'Unknown') AS email_provider,
  coalesce(flag_phone_provided, (SELECT quantile_cont(flag_phone_provided, 0.5) FROM (SELECT DISTINCT * FROM f_customers) m))
    AS flag_phone_provided, flag_privacy
FROM (SELECT DISTINCT * FROM f_customers) d""")
def fill_by_type(c: Ctx):
    return K.fill_by_type(c.customers)


@query("parse_dates", sql="""
SELECT customer_id, TRY_CAST(CAST(birthdate AS VARCHAR) AS TIMESTAMP) AS birth_ts,
  TRY_CAST(email_provider AS TIMESTAMP) AS email_ts FROM f_customers""")
def parse_dates(c: Ctx):
    return c.customers.select(
        "customer_id",
        K.parse_timestamp(F.col("birthdate").cast("string")).alias("birth_ts"),
        K.parse_timestamp(F.col("email_provider")).alias("email_ts"))


@query("parse_numeric", sql="""
SELECT address_id, TRY_CAST(postal_code AS DOUBLE) AS postal_number,
  TRY_CAST(district AS DOUBLE) AS district_number FROM f_addresses""")
def parse_numeric(c: Ctx):
    a = c.addresses
    return a.select("address_id", K.parse_double(F.col("postal_code")).alias("postal_number"),
                    K.parse_double(F.col("district")).alias("district_number"))


@query("outlier_to_median", doubles=["gross_price"], sql=f"""
SELECT order_id, customer_id, store_id, product_id, direction,
  CASE WHEN abs(gross_price - s.mu) / nullif(s.sd, 0) > {C.OUTLIER_Z} THEN s.med ELSE gross_price END AS gross_price,
  price_reduction, purchase_datetime
FROM f_orders, (SELECT avg(gross_price) AS mu, stddev_pop(gross_price) AS sd,
  quantile_cont(gross_price, 0.5) AS med FROM f_orders) s""")
def outlier_to_median(c: Ctx):
    return K.outlier_to_median(c.orders, ["gross_price"])


@query("clean_reviews", sql="""
SELECT review_id, customer_id,
  replace(replace(replace(replace(review_text, '<', ''), '>', ''), 'href', ''), 'br', '') AS review_text
FROM f_reviews""")
def clean_reviews(c: Ctx):
    return K.clean_reviews(c.reviews)


@query("normalize_text", sql=r"""
SELECT review_id, customer_id,
  regexp_replace(lower(coalesce(review_text, '')), '[^\p{L}\p{M}\p{N}_\s]', '', 'g') AS review_text
FROM f_reviews""")
def normalize_text(c: Ctx):
    return K.normalize_text(c.reviews)


@query("sentiment_score_map", sql="SELECT * FROM f_sentiment")
def sentiment_score_map(c: Ctx):
    return joins.sentiment_scores(c.labelled)


@query("dedup_order_product", sql="""
SELECT order_id, customer_id, store_id, product_id, direction, gross_price, price_reduction,
  purchase_datetime, product_class FROM (
  SELECT *, row_number() OVER (PARTITION BY order_id, product_id ORDER BY customer_id NULLS FIRST,
    store_id NULLS FIRST, direction NULLS FIRST, gross_price NULLS FIRST, price_reduction NULLS FIRST,
    purchase_datetime NULLS FIRST, product_class NULLS FIRST) AS rn FROM f_order_data) x WHERE rn = 1""")
def dedup_order_product(c: Ctx):
    return joins.order_lines(c.orders, c.products)


@query("customer_age", sql=f"""
SELECT *, CAST(round_even(datediff('day', birthdate, DATE '{C.AS_OF}') / 365.0, 0) AS BIGINT) AS age
FROM f_customers WHERE birthdate IS NOT NULL""")
def customer_age(c: Ctx):
    return K.with_age(c.customers, C.AS_OF, exact=True)


@query("customer_age_years", sql=f"""
SELECT *, CAST(year(DATE '{C.AS_OF}') - year(birthdate) AS BIGINT) AS age
FROM f_customers WHERE birthdate IS NOT NULL""")
def customer_age_years(c: Ctx):
    return K.with_age(c.customers, C.AS_OF, exact=False)
