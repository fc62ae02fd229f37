"""Base joins: customer side, order side, the merged table and fan-out joins.

Join strategy is left to Catalyst/AQE: dimension sides (products, addresses,
accounts) become broadcast joins only when their measured size is under
``spark.sql.autoBroadcastJoinThreshold``; otherwise a sort-merge join with AQE
skew splitting runs. Deduplication is ``row_number() = 1`` over a total order,
which Spark plans with a partial window group limit: one row per key leaves
each map task before the shuffle, so a hot key is reduced map-side.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .. import config as C

ORDER_COLS = ["order_id", "customer_id", "store_id", "product_id", "direction",
              "gross_price", "price_reduction", "purchase_datetime"]
CUSTOMER_COLS = ["customer_id", "address_id", "birthdate", "gender", "job_type",
                 "email_provider", "flag_phone_provided", "flag_privacy"]
ADDRESS_COLS = ["postal_code", "district", "region"]
ACCOUNT_COLS = ["account_id", "favorite_store", "loyalty_type", C.LOYALTY_STATUS_COL,
                "activation_date"]
MERGED_COLS = (ORDER_COLS + ["product_class"] + CUSTOMER_COLS[1:] + ADDRESS_COLS
               + ACCOUNT_COLS)


#: Left rows of one text that a task joins at most, about.
HOT_ROWS = 100_000


def keep_first(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One row per ``keys``: the row whose remaining columns, compared in column
    order with nulls first, are smallest (a total order standing in for the
    input order of ``drop_duplicates(keep='first')``).

    ``row_number() = 1`` is planned with a partial window group limit before
    the shuffle, so every map task forwards at most one row per key: a hot
    key is reduced map-side like a partial aggregate.
    """
    rest = [c for c in df.columns if c not in keys]
    if not rest:
        return df.dropDuplicates(list(keys))
    w = Window.partitionBy(*keys).orderBy(*[F.col(c).asc_nulls_first() for c in rest])
    return df.withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") == 1).drop("_rn")


def customer_data(customers: DataFrame, addresses: DataFrame, accounts: DataFrame) -> DataFrame:
    """customers ⟕ addresses ⟕ accounts (rows fan out on duplicate addresses)."""
    return (customers.join(addresses, "address_id", "left")
            .join(accounts, "customer_id", "left")
            .select(*CUSTOMER_COLS, *ADDRESS_COLS, *ACCOUNT_COLS))


def order_data(orders: DataFrame, products: DataFrame) -> DataFrame:
    """orders ⟕ products."""
    return orders.join(products, "product_id", "left").select(*ORDER_COLS, "product_class")


def order_lines(orders: DataFrame, products: DataFrame) -> DataFrame:
    """Order side of the merged table: one row per (order_id, product_id).

    The smallest row of ``order_data`` has the smallest order tuple and the product's smallest
    class (nulls first), so both sides are reduced before they meet: rows that are
    partitioned by order stay where they are until then.
    """
    lines = keep_first(orders.select(*ORDER_COLS), ["order_id", "product_id"])
    return order_data(lines, keep_first(products.select("product_id", "product_class"), ["product_id"]))


def merged_data(orders: DataFrame, products: DataFrame, customers: DataFrame,
                addresses: DataFrame, accounts: DataFrame, partitions: int | None = None) -> DataFrame:
    """order_data ⟕ customer_data, one row per (order_id, product_id).

    ``partitions`` fixes the number of parts by customer in which both sides meet, for data without hot customers.

    Equal to joining first and keeping the first row per (order, product):
    the order-side columns lead the total order, so the kept order line is the
    smallest order-side tuple and the kept customer attributes are the smallest
    customer-side tuple of that customer. Deduplicating both sides first makes
    the big join many-to-one and shrinks its shuffle.
    """
    lines = order_lines(orders, products)
    if partitions:
        lines = lines.repartition(partitions, "customer_id")
    cust = keep_first(customer_data(customers, addresses, accounts), ["customer_id"])
    return lines.join(cust, "customer_id", "left").select(*MERGED_COLS)


def with_attributes(features: DataFrame, merged: DataFrame, attributes: Sequence[str], grain: str = "customer") -> DataFrame:
    """Feature rows ⟕ customer attributes of the merged table.

    ``grain="customer"`` reduces the attributes to one row per customer first;
    ``grain="row"`` joins every purchase row, so features repeat per purchase.
    """
    if grain not in ("customer", "row"):
        raise ValueError(f"grain is customer or row, not {grain}")
    a = merged.select("customer_id", *attributes)
    return features.join(keep_first(a, ["customer_id"]) if grain == "customer" else a, "customer_id", "left")


def customer_360(customers: DataFrame, orders: DataFrame, addresses: DataFrame,
                 products: DataFrame, reviews: DataFrame, accounts: DataFrame,
                 labelled: DataFrame) -> DataFrame:
    """customers ⟕ orders ⟕ addresses ⟕ products ⟕ reviews ⟕ accounts ⟕ sentiment.

    Customers without orders are kept. Reviews and labelled texts fan out.
    Texts are matched at review grain, before orders multiply the reviews. Orders
    meet their products, and customers their addresses and accounts, before the two
    sides meet: order rows move by product without customer columns, and once by customer.
    """
    people = customers.join(addresses, "address_id", "left").join(accounts, "customer_id", "left")
    return (people.join(orders.join(products, "product_id", "left"), "customer_id", "left")
            .join(review_sentiment_join(reviews, labelled), "customer_id", "left"))


def sentiment_scores(labelled: DataFrame) -> DataFrame:
    """Label -> score {positive: 1, neutral: 0, negative: -1, other: null}."""
    m = F.create_map(*[x for k, v in C.SENTIMENT_SCORES.items() for x in (F.lit(k), F.lit(v))])
    return labelled.withColumn("sentiment_score", m[F.col("sentiment_label")].cast("bigint"))


def orders_with_reviews(orders: DataFrame, reviews: DataFrame) -> DataFrame:
    """Order rows ⟕ the customer's reviews (many-to-many fan-out)."""
    return orders.join(reviews, "customer_id", "left")


def join_on_text(left: DataFrame, right: DataFrame, col: str) -> DataFrame:
    """``left`` ⟕ ``right`` on equality of a long text; null texts match nothing and are not shuffled.

    Rows meet by a digest of the text, and the texts are compared where digests agree. A
    digest of more than ``HOT_ROWS`` left rows is dealt over several salts, its right rows are
    copied to each; there are at most (left rows / ``HOT_ROWS``) such digests, which bounds
    the broadcast. All other rows have salt 0.
    """
    digest = F.md5(F.col(col))
    hot = (left.where(F.col(col).isNotNull()).groupBy(digest.alias("_digest")).agg(F.count(F.lit(1)).alias("_n"))
           .where(F.col("_n") > HOT_ROWS).select("_digest", F.ceil(F.col("_n") / HOT_ROWS).alias("_salts")))
    spread = F.pmod(F.xxhash64(*[c for c in left.columns if c != col]), F.coalesce("_salts", F.lit(1)))
    a = (left.where(F.col(col).isNotNull()).withColumn("_digest", digest).join(F.broadcast(hot), "_digest", "left")
         .withColumn("_salt", spread).drop("_salts"))
    b = (right.where(F.col(col).isNotNull()).withColumn("_digest", digest).join(F.broadcast(hot), "_digest", "left")
         .withColumn("_salt", F.explode(F.sequence(F.lit(0).cast("bigint"), F.coalesce("_salts", F.lit(1)) - 1))).drop("_salts")
         .withColumnRenamed(col, "_text"))
    matched = a.join(b, [a["_digest"] == b["_digest"], a["_salt"] == b["_salt"], a[col] == b["_text"]], "left").select(
        *[a[c] for c in left.columns], *[b[c] for c in right.columns if c != col])
    missing = left.where(F.col(col).isNull()).select("*", *[F.lit(None).cast(right.schema[c].dataType).alias(c) for c in right.columns if c != col])
    return matched.unionByName(missing)


def review_sentiment_join(reviews: DataFrame, labelled: DataFrame) -> DataFrame:
    """Reviews ⟕ labelled sentiment on text equality (null text never matches)."""
    s = sentiment_scores(labelled).select("review_text", "sentiment_score")
    return join_on_text(reviews, s, "review_text")


def product_class_lookup(products: DataFrame) -> DataFrame:
    return products.select("product_id", "product_class").distinct()
