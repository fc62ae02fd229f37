"""Oracle-side (DuckDB) definitions of the retail source tables.

The same views as ``cartographer.sources.fixtures``, written as portable SQL
CTEs over the driver's tables, plus the base joins used by many oracle
queries. Written independently of the Spark side so the check is meaningful.
"""

from __future__ import annotations

MERGED_COLS = ["order_id", "customer_id", "store_id", "product_id", "direction",
               "gross_price", "price_reduction", "purchase_datetime", "product_class",
               "address_id", "birthdate", "gender", "job_type", "email_provider",
               "flag_phone_provided", "flag_privacy", "postal_code", "district", "region",
               "account_id", "favorite_store", "loyalty_type", "loyatlty_status",
               "activation_date"]

CTES = {
    "f_customers": """
SELECT CAST(c_custkey AS STRING) AS customer_id, CAST(c_nationkey AS STRING) AS address_id,
  CASE WHEN c_custkey % 50 = 0 THEN NULL ELSE DATE '1950-01-01' + CAST((c_custkey * 37) % 18250 AS INT) END AS birthdate,
  CASE WHEN c_custkey % 20 = 7 THEN NULL WHEN c_custkey % 2 = 0 THEN 'F' ELSE 'M' END AS gender,
  CASE WHEN c_custkey % 3 = 0 THEN NULL ELSE c_mktsegment END AS job_type,
  CASE WHEN c_custkey % 9 = 0 THEN NULL WHEN c_custkey % 9 <= 4 THEN 'gmail.com' WHEN c_custkey % 9 <= 6 THEN 'libero.it'
       WHEN c_custkey % 9 = 7 THEN 'yahoo.it' ELSE CONCAT('mail', CAST(c_custkey % 5 AS STRING), '.org') END AS email_provider,
  CAST(CASE WHEN c_custkey % 10 = 0 THEN NULL WHEN c_custkey % 10 = 1 THEN 0 ELSE 1 END AS DOUBLE) AS flag_phone_provided,
  c_acctbal > 0 AS flag_privacy FROM customer""",
    "f_products": """
SELECT CAST(p_partkey AS STRING) AS product_id, REPLACE(p_brand, 'Brand#', '') AS product_class FROM part""",
    "f_orders": """
SELECT CAST(l_orderkey AS STRING) AS order_id, CAST(o_custkey AS STRING) AS customer_id, CAST(l_suppkey AS STRING) AS store_id,
  CAST(l_partkey AS STRING) AS product_id, CASE WHEN l_returnflag = 'R' THEN -1 ELSE 1 END AS direction,
  l_extendedprice AS gross_price, l_extendedprice * l_discount AS price_reduction,
  o_orderdate + INTERVAL '1' HOUR * CAST(l_orderkey % 24 AS INT) AS purchase_datetime
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey CROSS JOIN (SELECT 0 AS copy UNION ALL SELECT 1) d
  WHERE copy = 0 OR l_orderkey % 97 = 0""",
    "f_addresses": """
SELECT CAST(n_nationkey AS STRING) AS address_id, CAST(20000 + n_nationkey AS STRING) AS postal_code, n_name AS district, r_name AS region
  FROM nation JOIN region ON n_regionkey = r_regionkey CROSS JOIN (SELECT 0 AS copy UNION ALL SELECT 1) d WHERE copy = 0 OR n_nationkey % 5 = 0""",
    "f_accounts": """
SELECT CAST(c_custkey AS STRING) AS customer_id, CAST(c_custkey + 1000000 AS STRING) AS account_id, CAST(c_custkey % 50 AS STRING) AS favorite_store,
  CASE WHEN c_acctbal < 0 THEN 'standard' WHEN c_acctbal < 5000 THEN 'premium' ELSE 'business' END AS loyalty_type,
  CASE WHEN c_custkey % 4 = 0 THEN 0 ELSE 1 END AS loyatlty_status, DATE '2022-01-01' + CAST(c_custkey % 700 AS INT) AS activation_date
  FROM customer WHERE c_custkey % 13 <> 0""",
    "f_reviews": """
SELECT CAST(doc_id AS STRING) AS review_id, CAST((doc_id * 7) % CAST(FLOOR(n / 2) AS BIGINT) AS STRING) AS customer_id,
  CASE WHEN doc_id % 41 = 0 THEN NULL ELSE text END AS review_text FROM documents CROSS JOIN (SELECT COUNT(*) AS n FROM customer) c""",
    "f_labelled": """
SELECT CAST(doc_id AS STRING) AS labelled_reviews_index, text AS review_text,
  CASE WHEN toxic = 1 THEN 'negative' WHEN quality = 1 THEN 'positive' ELSE 'neutral' END AS sentiment_label
  FROM labels JOIN documents USING (doc_id)""",
    "f_scores": """
SELECT CAST(c_custkey AS STRING) AS customer_id, CAST((c_custkey * 7919) % 101 AS DOUBLE) / 100 AS score,
  CASE WHEN (c_custkey * 31) % 10 < 3 THEN 1 ELSE 0 END AS label,
  CAST((c_custkey * 7919) % 101 AS DOUBLE) / 100 AS propensity_1, CAST((c_custkey * 104729) % 101 AS DOUBLE) / 100 AS propensity_2,
  CAST((c_custkey * 1299709) % 101 AS DOUBLE) / 100 AS propensity_3 FROM customer""",
    "f_order_data": """
SELECT o.order_id, o.customer_id, o.store_id, o.product_id, o.direction, o.gross_price, o.price_reduction,
  o.purchase_datetime, p.product_class FROM f_orders o LEFT JOIN f_products p ON o.product_id = p.product_id""",
    "f_customer_data": """
SELECT c.customer_id, c.address_id, c.birthdate, c.gender, c.job_type, c.email_provider, c.flag_phone_provided,
  c.flag_privacy, a.postal_code, a.district, a.region, ac.account_id, ac.favorite_store, ac.loyalty_type,
  ac.loyatlty_status, ac.activation_date
  FROM f_customers c LEFT JOIN f_addresses a ON c.address_id = a.address_id
  LEFT JOIN f_accounts ac ON c.customer_id = ac.customer_id""",
    "f_merged": """
SELECT %(cols)s FROM (
  SELECT j.*, row_number() OVER (PARTITION BY order_id, product_id ORDER BY %(order)s) AS rn FROM (
    SELECT od.*, cd.address_id, cd.birthdate, cd.gender, cd.job_type, cd.email_provider, cd.flag_phone_provided,
      cd.flag_privacy, cd.postal_code, cd.district, cd.region, cd.account_id, cd.favorite_store, cd.loyalty_type,
      cd.loyatlty_status, cd.activation_date
    FROM f_order_data od LEFT JOIN f_customer_data cd ON od.customer_id = cd.customer_id) j) x
WHERE rn = 1""" % {
        "cols": ", ".join(MERGED_COLS),
        "order": ", ".join(f"{c} NULLS FIRST" for c in MERGED_COLS
                           if c not in ("order_id", "product_id")),
    },
    "f_sentiment": """
SELECT labelled_reviews_index, review_text, sentiment_label,
  CAST(CASE sentiment_label WHEN 'positive' THEN 1 WHEN 'neutral' THEN 0 WHEN 'negative' THEN -1 END AS BIGINT)
    AS sentiment_score FROM f_labelled""",
}


#: CTEs that several parts of a query read.
MATERIALIZED = {"x_imp", "y_line", "y_five", "y_fill"}


def with_ctes(body: str, extra: dict[str, str] | None = None, recursive: bool = False) -> str:
    """Prefix ``body`` with every fixture CTE (DuckDB inlines only those used)."""
    ctes = dict(CTES)
    ctes.update(extra or {})
    parts = [f"{name} AS {'MATERIALIZED ' if name in MATERIALIZED else ''}({sql.strip()})" for name, sql in ctes.items()]
    head = "WITH RECURSIVE " if recursive else "WITH "
    return head + ",\n".join(parts) + "\n" + body.strip()
