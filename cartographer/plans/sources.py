"""Queries over the base tables and joins (sources, samples, joins)."""

from __future__ import annotations

from pyspark.sql import functions as F

from .. import config as C
from ..operators import joins
from ..sources import fixtures, io, split_csv
from ..sources.prepared import csv_folder
from .registry import Ctx, query


@query("customer_data", sql="SELECT * FROM f_customer_data")
def customer_data(c: Ctx):
    return joins.customer_data(c.customers, c.addresses, c.accounts)


@query("order_data", sql="SELECT * FROM f_order_data")
def order_data(c: Ctx):
    return joins.order_data(c.orders, c.products)


@query("merged_data", sql="SELECT * FROM f_merged")
def merged_data(c: Ctx):
    """The merge itself, computed from the source tables (not the prepared copy)."""
    return c.build_merged()


C360_COLS = ["customer_id", "address_id", "birthdate", "gender", "job_type", "email_provider",
             "flag_phone_provided", "flag_privacy", "order_id", "store_id", "product_id",
             "direction", "gross_price", "price_reduction", "purchase_datetime", "postal_code",
             "district", "region", "product_class", "review_id", "review_text", "account_id",
             "favorite_store", "loyalty_type", "loyatlty_status", "activation_date",
             "sentiment_score"]


@query("customer_360", sql="""
SELECT c.customer_id, c.address_id, c.birthdate, c.gender, c.job_type, c.email_provider,
  c.flag_phone_provided, c.flag_privacy, o.order_id, o.store_id, o.product_id, o.direction,
  o.gross_price, o.price_reduction, o.purchase_datetime, a.postal_code, a.district, a.region,
  p.product_class, r.review_id, r.review_text, ac.account_id, ac.favorite_store, ac.loyalty_type,
  ac.loyatlty_status, ac.activation_date, s.sentiment_score
FROM f_customers c LEFT JOIN f_orders o ON c.customer_id = o.customer_id
LEFT JOIN f_addresses a ON c.address_id = a.address_id
LEFT JOIN f_products p ON o.product_id = p.product_id
LEFT JOIN f_reviews r ON c.customer_id = r.customer_id
LEFT JOIN f_accounts ac ON c.customer_id = ac.customer_id
LEFT JOIN f_sentiment s ON r.review_text = s.review_text""")
def customer_360(c: Ctx):
    return joins.customer_360(c.customers, c.orders, c.addresses, c.products, c.reviews,
                              c.accounts, c.labelled).select(*C360_COLS)


@query("orders_with_reviews", sql="""
SELECT o.*, r.review_id, r.review_text FROM f_orders o LEFT JOIN f_reviews r ON o.customer_id = r.customer_id""")
def orders_with_reviews(c: Ctx):
    return joins.orders_with_reviews(c.orders, c.reviews).select(
        "order_id", "customer_id", "store_id", "product_id", "direction", "gross_price",
        "price_reduction", "purchase_datetime", "review_id", "review_text")


@query("review_sentiment_join", sql="""
SELECT r.*, s.sentiment_score FROM f_reviews r LEFT JOIN f_sentiment s ON r.review_text = s.review_text""")
def review_sentiment_join(c: Ctx):
    return joins.review_sentiment_join(c.reviews, c.labelled).select(
        "review_id", "customer_id", "review_text", "sentiment_score")


@query("product_class_lookup", sql="SELECT DISTINCT product_id, product_class FROM f_products")
def product_class_lookup(c: Ctx):
    return joins.product_class_lookup(c.products)


@query("head_orders", sql="""
SELECT * FROM f_order_data ORDER BY order_id, product_id, customer_id, store_id, direction, gross_price,
  price_reduction, purchase_datetime LIMIT 10""")
def head_orders(c: Ctx):
    """First 10 order rows by a total order (the head/preview operator)."""
    return io.head(joins.order_data(c.orders, c.products), 10, "order_id", "product_id",
                   "customer_id", "store_id", "direction", "gross_price", "price_reduction",
                   "purchase_datetime")


@query("latest_run", sql="""
SELECT *, CAST(purchase_datetime AS DATE) AS run_date FROM f_orders
WHERE CAST(purchase_datetime AS DATE) = (SELECT max(CAST(purchase_datetime AS DATE)) FROM f_orders)""")
def latest_run(c: Ctx):
    """Rows of the newest run, with the purchase date as run stamp."""
    runs = c.orders.withColumn("run_date", F.col("purchase_datetime").cast("date"))
    return io.latest_run(runs, "run_date")


def hash_sql(*keys: str) -> str:
    """The 32-bit key hash of the samples and splits, in SQL."""
    text = " || '|' || ".join([f"'{C.SEED}'", *[f"coalesce(CAST({k} AS VARCHAR), '')" for k in keys]])
    return f"CAST('0x' || substr(md5({text}), 1, 8) AS BIGINT)"


@query("sample_fraction", sql=f"SELECT * FROM f_merged WHERE {hash_sql('order_id', 'product_id')} % 10000 < 100")
def sample_fraction(c: Ctx):
    """1% of merged order lines by hash of (order_id, product_id)."""
    return io.sample_fraction(c.merged, 0.01, "order_id", "product_id")


@query("sample_n", sql=f"SELECT * FROM f_customers ORDER BY {hash_sql('customer_id')}, customer_id LIMIT 500")
def sample_n(c: Ctx):
    """min(500, rows) customers chosen by key hash."""
    return io.sample_n(c.customers, 500, "customer_id", seed=C.SEED)


#: Tables of the CSV folder: the view that the SQL reads for each.
FOLDER = {"customers": "f_customers", "products": "f_products", "orders": "f_orders", "addresses": "f_addresses",
          "customer_accounts": "f_accounts", "customer_reviews": "f_reviews", "labelled_reviews": "f_labelled"}


def overview_sql(table: str, view: str, n: int = 3) -> str:
    """One row per column of ``view``, in SQL."""
    fields = io.SCHEMAS[table].fields
    order = ", ".join(f"{f.name} NULLS FIRST" for f in fields)
    rows = f"(SELECT *, row_number() OVER (ORDER BY {order}) AS rn FROM {view})"

    def one(i, f):
        text = f"CAST({f'CAST({f.name} AS DECIMAL(18,4))' if f.dataType.typeName() == 'double' else f.name} AS VARCHAR)"
        heads = ", ".join(f"max(CASE WHEN rn = {k + 1} THEN {text} END) AS head_{k + 1}" for k in range(n))
        return (f"SELECT '{table}' AS table_name, count(*) AS n_rows, {i} AS position, '{f.name}' AS column_name, "
                f"'{f.dataType.simpleString()}' AS data_type, count(*) - count({f.name}) AS n_missing, {heads} FROM {rows}")

    return " UNION ALL ".join(one(i, f) for i, f in enumerate(fields))


@query("folder_overview", sql=" UNION ALL ".join(overview_sql(t, v) for t, v in FOLDER.items()))
def folder_overview(c: Ctx):
    """Columns, types, row and null counts and head of each table in a folder of CSV files.

    The folder is written once per input under the shared checkpoint folder, then scanned by split tasks.
    """
    tables = {"customers": c.customers, "products": c.products, "orders": c.orders, "addresses": c.addresses,
              "customer_accounts": c.accounts, "customer_reviews": c.reviews, "labelled_reviews": c.labelled}
    inputs = [f"{c.sf_dir.rstrip('/')}/{t}.parquet" for t in ("customer", "part", "orders", "lineitem", "nation", "region", "documents", "labels")]
    return split_csv.folder_overview(io.read_folder(c.spark, csv_folder(c.spark, tables, inputs, [fixtures, io])))
