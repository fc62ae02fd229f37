"""Profiling and quality queries (B*)."""

from __future__ import annotations

from ..operators import quality as Q
from .registry import Ctx, query

CUSTOMER_COLS = ["customer_id", "address_id", "birthdate", "gender", "job_type",
                 "email_provider", "flag_phone_provided", "flag_privacy"]
ORDER_COLS = ["order_id", "customer_id", "store_id", "product_id", "direction",
              "gross_price", "price_reduction", "purchase_datetime"]
DESCRIBE_COLS = ["direction", "gross_price", "price_reduction"]


@query("profile_nulls", sql=" UNION ALL ".join(
    f"SELECT '{c}' AS column_name, CAST(count(*) FILTER (WHERE {c} IS NULL) AS BIGINT) AS null_count "
    f"FROM f_customers" for c in CUSTOMER_COLS))
def profile_nulls(c: Ctx):
    return Q.null_counts(c.customers)


@query("row_count", sql="SELECT count(*) AS row_count FROM f_orders")
def row_count(c: Ctx):
    return Q.row_count(c.orders)


@query("duplicate_row_count", sql="""
SELECT CAST((SELECT count(*) FROM f_orders) - (SELECT count(*) FROM (SELECT DISTINCT * FROM f_orders) d)
  AS BIGINT) AS duplicate_rows""")
def duplicate_row_count(c: Ctx):
    return Q.duplicate_row_count(c.orders)


@query("describe_numeric", doubles=["mean", "std", "q25", "q50", "q75"],
       sql=" UNION ALL ".join(
           f"SELECT '{c}' AS column_name, count({c}) AS count, avg({c}) AS mean, "
           f"stddev_samp({c}) AS std, CAST(min({c}) AS DOUBLE) AS min, "
           f"quantile_cont({c}, 0.25) AS q25, quantile_cont({c}, 0.5) AS q50, "
           f"quantile_cont({c}, 0.75) AS q75, CAST(max({c}) AS DOUBLE) AS max FROM f_orders"
           for c in DESCRIBE_COLS))
def describe_numeric(c: Ctx):
    return Q.describe_numeric(c.orders, DESCRIBE_COLS)


@query("distinct_preview", sql="""
SELECT column_name, CAST(rank AS BIGINT) AS rank, value FROM (
  SELECT column_name, value, row_number() OVER (PARTITION BY column_name ORDER BY value NULLS LAST) AS rank FROM (
    SELECT DISTINCT column_name, value FROM (""" + " UNION ALL ".join(
    f"SELECT '{c}' AS column_name, CAST({c} AS VARCHAR) AS value FROM f_customers" for c in CUSTOMER_COLS)
    + """) u) d) r WHERE rank <= 5""")
def distinct_preview(c: Ctx):
    return Q.distinct_preview(c.customers, 5)


@query("duplicates_by_key", sql="""
SELECT o.* FROM f_orders o JOIN (
  SELECT order_id, product_id FROM f_orders GROUP BY 1, 2 HAVING count(*) > 1) k
  ON o.order_id = k.order_id AND o.product_id = k.product_id""")
def duplicates_by_key(c: Ctx):
    return Q.duplicates(c.orders, ["order_id", "product_id"])


@query("duplicates_full_row", sql="""
SELECT o.* FROM f_orders o JOIN (
  SELECT %s FROM f_orders GROUP BY ALL HAVING count(*) > 1) k ON %s""" % (
    ", ".join(ORDER_COLS), " AND ".join(f"o.{c} IS NOT DISTINCT FROM k.{c}" for c in ORDER_COLS)))
def duplicates_full_row(c: Ctx):
    return Q.duplicates(c.orders)


@query("dedup_exact", sql="SELECT DISTINCT * FROM f_orders")
def dedup_exact(c: Ctx):
    return Q.dedup_exact(c.orders)


@query("distinct_customers",
       sql="SELECT count(DISTINCT customer_id) AS distinct_customer_id FROM f_orders")
def distinct_customers(c: Ctx):
    return Q.distinct_count(c.orders, "customer_id")


@query("class_distribution", sql="""
SELECT sentiment_label, count(*) AS count, count(*) / sum(count(*)) OVER () AS share
FROM f_labelled WHERE sentiment_label IS NOT NULL GROUP BY sentiment_label""")
def class_distribution(c: Ctx):
    return Q.class_distribution(c.labelled, "sentiment_label")
