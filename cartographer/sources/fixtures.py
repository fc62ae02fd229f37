"""The retail source tables, derived from the driver's TPC-H-style tables.

Each function returns the table with the reference schema (string ids,
timestamp_ntz purchase times) so the operators see the same shapes as the
original CSV inputs. Nulls and exact duplicates are planted by formula, and
duplicate rows are generated with ``explode`` of a copy index, so no Cartesian
product appears in any plan.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .tables import Tables


def _copies(planted: F.Column) -> F.Column:
    """0 for every row, and a second copy 1 where ``planted`` holds."""
    return F.explode(F.when(planted, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0))))


def customers(t: Tables) -> DataFrame:
    k = F.col("c_custkey")
    birth = F.date_add(F.lit("1950-01-01").cast("date"), ((k * 37) % 18250).cast("int"))
    email = (F.when(k % 9 == 0, None)
             .when(k % 9 <= 4, "gmail.com")
             .when(k % 9 <= 6, "libero.it")
             .when(k % 9 == 7, "yahoo.it")
             .otherwise(F.concat(F.lit("mail"), (k % 5).cast("string"), F.lit(".org"))))
    return t.customer.select(
        k.cast("string").alias("customer_id"),
        F.col("c_nationkey").cast("string").alias("address_id"),
        F.when(k % 50 == 0, None).otherwise(birth).alias("birthdate"),
        F.when(k % 20 == 7, None).when(k % 2 == 0, "F").otherwise("M").alias("gender"),
        F.when(k % 3 == 0, None).otherwise(F.col("c_mktsegment")).alias("job_type"),
        email.alias("email_provider"),
        F.when(k % 10 == 0, None).when(k % 10 == 1, 0.0).otherwise(1.0)
        .cast("double").alias("flag_phone_provided"),
        (F.col("c_acctbal") > 0).alias("flag_privacy"),
    )


def products(t: Tables) -> DataFrame:
    return t.part.select(
        F.col("p_partkey").cast("string").alias("product_id"),
        F.replace(F.col("p_brand"), F.lit("Brand#"), F.lit("")).alias("product_class"),
    )


def orders(t: Tables, by_order_id: bool = False) -> DataFrame:
    # Hash-partition the line items on the order key: the same exchange a
    # sort-merge join with orders needs at scale (so no extra shuffle there),
    # and it spreads files with few row groups over all tasks. With ``by_order_id``
    # the key is the id itself, so what groups by order later needs no further
    # exchange, and the number of parts is explicit: adaptive merging of partitions
    # goes by compressed bytes, and sorts of several merged ones spill.
    li = t.lineitem.select("l_orderkey", "l_partkey", "l_suppkey", "l_returnflag",
                           "l_extendedprice", "l_discount")
    o = t.orders.select("o_orderkey", "o_custkey", "o_orderdate")
    if by_order_id:
        n = int(t.spark.conf.get("spark.sql.shuffle.partitions"))
        j = (li.repartition(n, F.col("l_orderkey").cast("string"))
             .join(o, F.col("l_orderkey").cast("string") == F.col("o_orderkey").cast("string")))
    else:
        li = li.repartition("l_orderkey")
        j = li.join(o, li.l_orderkey == o.o_orderkey)
    hours = (F.col("l_orderkey") % 24).cast("int")
    return (j.select("*", _copies(F.col("l_orderkey") % 97 == 0).alias("copy"))
            .select(
                F.col("l_orderkey").cast("string").alias("order_id"),
                F.col("o_custkey").cast("string").alias("customer_id"),
                F.col("l_suppkey").cast("string").alias("store_id"),
                F.col("l_partkey").cast("string").alias("product_id"),
                F.when(F.col("l_returnflag") == "R", -1).otherwise(1).cast("int").alias("direction"),
                F.col("l_extendedprice").alias("gross_price"),
                (F.col("l_extendedprice") * F.col("l_discount")).alias("price_reduction"),
                F.timestamp_add("HOUR", hours, F.col("o_orderdate").cast("timestamp_ntz"))
                .alias("purchase_datetime"),
            ))


def addresses(t: Tables) -> DataFrame:
    n = t.nation
    r = t.region
    j = n.join(r, n.n_regionkey == r.r_regionkey)
    return (j.select("*", _copies(F.col("n_nationkey") % 5 == 0).alias("copy"))
            .select(
                F.col("n_nationkey").cast("string").alias("address_id"),
                (F.col("n_nationkey") + 20000).cast("string").alias("postal_code"),
                F.col("n_name").alias("district"),
                F.col("r_name").alias("region"),
            ))


def accounts(t: Tables) -> DataFrame:
    k = F.col("c_custkey")
    bal = F.col("c_acctbal")
    return t.customer.where(k % 13 != 0).select(
        k.cast("string").alias("customer_id"),
        (k + 1000000).cast("string").alias("account_id"),
        (k % 50).cast("string").alias("favorite_store"),
        F.when(bal < 0, "standard").when(bal < 5000, "premium").otherwise("business").alias("loyalty_type"),
        F.when(k % 4 == 0, 0).otherwise(1).cast("int").alias("loyatlty_status"),
        F.date_add(F.lit("2022-01-01").cast("date"), (k % 700).cast("int")).alias("activation_date"),
    )


def reviews(t: Tables) -> DataFrame:
    # number of customers as a scalar subquery (computed once, no join)
    half = t.customer.select(F.floor(F.count(F.lit(1)) / 2).cast("long")).scalar()
    d = F.col("doc_id")
    return t.documents.select(
        d.cast("string").alias("review_id"),
        ((d * 7) % half).cast("string").alias("customer_id"),
        F.when(d % 41 == 0, None).otherwise(F.col("text")).alias("review_text"),
    )


def labelled_reviews(t: Tables) -> DataFrame:
    lab = t.labels
    docs = t.documents.select("doc_id", "text")
    return lab.join(docs, "doc_id").select(
        F.col("doc_id").cast("string").alias("labelled_reviews_index"),
        F.col("text").alias("review_text"),
        F.when(F.col("toxic") == 1, "negative").when(F.col("quality") == 1, "positive")
        .otherwise("neutral").alias("sentiment_label"),
    )


def scores(t: Tables) -> DataFrame:
    """Deterministic stand-in for model output (score, label, propensities)."""
    k = F.col("c_custkey")

    def frac(mult: int) -> F.Column:
        return ((k * mult) % 101).cast("double") / 100

    return t.customer.select(
        k.cast("string").alias("customer_id"),
        frac(7919).alias("score"),
        F.when((k * 31) % 10 < 3, 1).otherwise(0).cast("int").alias("label"),
        frac(7919).alias("propensity_1"),
        frac(104729).alias("propensity_2"),
        frac(1299709).alias("propensity_3"),
    )


class Retail:
    """All source tables of one scale factor, built lazily."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.t = Tables(spark, sf_dir)

    def customers(self) -> DataFrame:
        return customers(self.t)

    def products(self) -> DataFrame:
        return products(self.t)

    def orders(self, by_order_id: bool = False) -> DataFrame:
        return orders(self.t, by_order_id)

    def addresses(self) -> DataFrame:
        return addresses(self.t)

    def accounts(self) -> DataFrame:
        return accounts(self.t)

    def reviews(self) -> DataFrame:
        return reviews(self.t)

    def labelled(self) -> DataFrame:
        return labelled_reviews(self.t)

    def scores(self) -> DataFrame:
        return scores(self.t)
