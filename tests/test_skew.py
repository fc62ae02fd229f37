"""Hot keys: one customer / order holding a third of the rows. The skew-safe
formulations must give exactly the naive answers."""

import datetime as dt

from pyspark.sql import functions as F
from pyspark.sql.window import Window

from cartographer.operators import basket as B
from cartographer.operators import joins
from cartographer.operators.ranking import previous_in_group


def test_previous_in_group_matches_lag_under_skew(spark):
    base = dt.datetime(2024, 1, 1)
    rows = [("hot", f"o{i}", "p", base + dt.timedelta(hours=i % 500, minutes=i // 500)) for i in range(3000)]
    rows += [(f"c{j}", f"o{j}x{k}", "p", base + dt.timedelta(days=k)) for j in range(200) for k in range(30)]
    df = spark.createDataFrame(rows, "customer_id string, order_id string, product_id string, "
                                     "purchase_datetime timestamp_ntz")
    order = ["purchase_datetime", "order_id", "product_id"]
    got = previous_in_group(df, "customer_id", order, "purchase_datetime", "prev", partitions=16)
    w = Window.partitionBy("customer_id").orderBy(*order)
    want = df.withColumn("prev", F.lag("purchase_datetime").over(w))
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))
    # the hot customer really is spread over several range partitions
    parts = (df.repartitionByRange(16, "customer_id", *order).where(F.col("customer_id") == "hot")
             .select(F.spark_partition_id().alias("p")).distinct().count())
    assert parts > 1


def test_blocked_pairs_match_self_join_for_big_order(spark):
    rows = [("big", f"i{k:03d}") for k in range(600)]
    rows += [(f"o{j}", f"i{(j * 7 + k) % 600:03d}") for j in range(300) for k in range(4)]
    df = spark.createDataFrame(rows, "order_id string, product_id string")
    items = B.basket_items(df, "product_id")
    got = B.pair_counts(items, block_size=64)
    a, b = items.alias("a"), items.alias("b")
    want = (a.join(b, (F.col("a.order_id") == F.col("b.order_id")) & (F.col("a.item") < F.col("b.item")))
            .groupBy(F.col("a.item").alias("item_1"), F.col("b.item").alias("item_2")).count())
    assert got.count() == want.count()
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))


def test_keep_first_with_hot_duplicate_key(spark):
    rows = [("o1", "p1", f"s{i % 7}", float(i % 13)) for i in range(5000)] + [("o2", "p1", "s9", 1.0)]
    df = spark.createDataFrame(rows, "order_id string, product_id string, store_id string, v double")
    got = {(r.order_id, r.product_id): (r.store_id, r.v) for r in joins.keep_first(df, ["order_id", "product_id"]).collect()}
    assert got == {("o1", "p1"): ("s0", 0.0), ("o2", "p1"): ("s9", 1.0)}
