"""Steps whose shuffles, spills or memory must not grow faster than the input."""

import itertools
import random
import re
from collections import Counter

from pyspark.sql import functions as F

from cartographer.operators import basket as B
from cartographer.operators import joins
from cartographer.plans.registry import QUERIES, Ctx, load_all
from cartographer.session import cut_lineage
from conftest import SF_SMALL

load_all()


def exchanges(df):
    """Partitioning of each shuffle of the plan as first made."""
    return re.findall(r"Exchange (hashpartitioning|rangepartitioning)\((\w+)#", df._jdf.queryExecution().executedPlan().toString())


def test_customer_360_moves_order_rows_by_customer_once(spark):
    """With products too large to broadcast: no wide row is shuffled by product and back by customer."""
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        found = exchanges(QUERIES["customer_360"](spark, SF_SMALL))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    # order rows, customers (after their addresses), accounts and reviews
    assert sum(col == "customer_id" for _, col in found) == 4


def test_itemsets_are_counted_where_the_bitmaps_lie(spark):
    """No bitmap is copied, sorted or shuffled for a candidate, and the counts are those of brute force."""
    rng = random.Random(5)
    orders = {f"o{i}": set(rng.sample("abcdefgh", rng.randint(1, 6))) for i in range(300)}
    items = spark.createDataFrame([(o, x) for o, s in orders.items() for x in s], "order_id string, item string")
    bits = cut_lineage(B.order_bitmaps(items).repartition("bucket").sortWithinPartitions("bucket"))
    sets = [c for n in (2, 3, 4) for c in itertools.combinations("abcdefgh", n)]
    held = B.held_together(bits, [B.KEY_SEPARATOR.join(c) for c in sets])
    assert not re.search("Exchange|Aggregate|Sort|Join", held._jdf.queryExecution().executedPlan().toString())
    got = Counter()
    for r in held.collect():
        got[tuple(r["k"].split(B.KEY_SEPARATOR))] += r["freq"]
    assert got == Counter({c: n for c in sets if (n := sum(set(c) <= s for s in orders.values()))})


def test_merged_table_moves_order_rows_twice(spark):
    """By order and by customer only: duplicates are dropped where the order join left the rows, and parts are not merged."""
    plan = Ctx(spark, SF_SMALL).build_merged(4)._jdf.queryExecution().executedPlan().toString()
    moved = re.findall(r"Exchange \w+\((.*?), (\d+)\), (\w+)", plan)
    assert not any("order_id" in keys and "product_id" in keys for keys, _, _ in moved)
    assert any(keys.startswith("customer_id") and how == "REPARTITION_BY_NUM" for keys, _, how in moved)
    assert any("l_orderkey" in keys and how == "REPARTITION_BY_NUM" for keys, _, how in moved)


def test_products_with_several_classes_keep_the_smallest_after_lines_are_reduced(spark):
    orders = spark.createDataFrame([("o1", "c", "s2", "p1", 1, 2.0, 0.0), ("o1", "c", "s1", "p1", 1, 3.0, 0.0), ("o1", "c", "s1", "p2", 1, 1.0, 0.0),
                                    ("o2", None, "s1", "p3", 1, 1.0, None)],
                                   "order_id string, customer_id string, store_id string, product_id string, direction int, gross_price double, "
                                   "price_reduction double").withColumn("purchase_datetime", F.lit("2024-01-01").cast("timestamp_ntz"))
    products = spark.createDataFrame([("p1", "b"), ("p1", "a"), ("p2", "z"), ("p2", None)], "product_id string, product_class string")
    key = ["order_id", "product_id"]
    want = joins.keep_first(joins.order_data(orders, products), key)
    assert Counter(map(tuple, joins.order_lines(orders, products).collect())) == Counter(map(tuple, want.collect()))


def test_pairs_of_typical_orders_need_no_join(spark):
    """Rows of orders up to a block move once, by order; larger orders give the same pairs at any block size."""
    rng = random.Random(3)
    orders = {f"o{i}": rng.sample(range(100), rng.randint(1, 5)) for i in range(60)} | {"big": list(range(40))}
    items = spark.createDataFrame([(o, f"i{x:02d}") for o, s in orders.items() for x in s], "order_id string, item string")
    want = Counter((o, *p) for o, s in orders.items() for p in itertools.combinations(sorted(f"i{x:02d}" for x in s), 2))
    for block in (1, 2, 7, 38, 39, 256):
        pairs = B.item_pairs(items, block)
        assert Counter(map(tuple, pairs.collect())) == want, block
    plan = B.item_pairs(items)._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan and plan.count("Exchange hashpartitioning") == 1


def test_orders_alone_keep_their_join_key(spark):
    """Only the merged table asks for rows by order id: elsewhere narrow orders may still be broadcast by their number."""
    plan = QUERIES["describe_numeric"](spark, SF_SMALL)._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning(l_orderkey" in plan and "hashpartitioning(cast(l_orderkey" not in plan


def test_partitions_of_documents_grow_with_their_text(spark, monkeypatch):
    from cartographer.operators import sentiment as S
    docs = spark.range(200).select("id", F.concat_ws(" ", F.lit("same words"), F.concat(F.lit("word"), F.col("id") % 7)).alias("text"))
    got = []
    for size in (16 << 20, 100):
        monkeypatch.setattr(S, "PARTITION_BYTES", size)
        out = S.tfidf(docs, "id", "text")
        got.append(([tuple(r) for r in out.withColumn("tfidf", F.round("tfidf", 9)).orderBy("id", "term").collect()],
                    S.term_counts_by_doc(docs, "id", "text").rdd.getNumPartitions(), out.rdd.getNumPartitions()))
    assert got[0][0] == got[1][0] and len(got[0][0]) == 600
    assert got[0][1] == spark.sparkContext.defaultParallelism and got[1][1] == got[1][2] == 32  # 200 texts of 16 bytes, 100 in a partition


def test_rows_meet_the_classes_bought_later_where_they_lie(spark):
    """The prepared table lies by customer: neither its rows nor their copies in the windows are shuffled for the targets."""
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert not [c for _, c in exchanges(QUERIES["multilabel_matrix"](spark, SF_SMALL)) if c == "customer_id"]
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def test_a_pass_of_the_text_regression_has_no_more_tasks_than_text(spark, monkeypatch):
    from cartographer.operators import sentiment as S
    df = spark.createDataFrame([("good", "positive"), ("bad", "negative")] * 40, "review_text string, sentiment_label string").repartition(40)
    seen, estimator = [], S.Mo.estimator

    class Seen:
        def __init__(self, e):
            self.e = e

        def fit(self, rows):
            seen.append((rows.rdd.getNumPartitions(), rows.count()))
            return self.e.fit(rows)

    monkeypatch.setattr(S.Mo, "estimator", lambda *a, **k: Seen(estimator(*a, **k)))
    for size in (16 << 20, 20):  # 80 texts of 3 or 4 bytes
        monkeypatch.setattr(S, "PARTITION_BYTES", size)
        S.train_sentiment(df, "lr")
    assert seen == [(spark.sparkContext.defaultParallelism, 80), (14, 80)]
