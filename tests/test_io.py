"""Sources, sinks and guards (test-only operators)."""

import os
import tempfile

import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from cartographer.operators import quality as Q
from cartographer.sources import io
from cartographer.sources.fixtures import Retail


def _tmp():
    return tempfile.mkdtemp(prefix="cartographer-test-")


def test_typed_csv_round_trip(spark):
    r = Retail(spark, SF_SMALL)
    cust = r.customers()
    path = os.path.join(_tmp(), "customers")
    io.write(cust, path, fmt="csv")
    back = io.read_csv(spark, path, "customers")
    assert back.schema == io.SCHEMAS["customers"]
    assert sorted(map(tuple, back.collect())) == sorted(map(tuple, cust.collect()))
    orders = r.orders()
    opath = os.path.join(_tmp(), "orders")
    io.write(orders.withColumn("purchase_datetime", F.date_format("purchase_datetime", "yyyy-MM-dd HH:mm:ss")),
             opath, fmt="csv")
    ob = io.read_csv(spark, opath, "orders")
    assert ob.count() == orders.count()
    assert ob.where(F.col("purchase_datetime").isNull()).count() == 0


def test_inferred_csv_scan(spark):
    path = os.path.join(_tmp(), "x")
    spark.createDataFrame([(1, "a,b", 2.5)], "i int, s string, d double").write.option("header", True).csv(path)
    df = io.read_csv(spark, path)
    assert df.first()["s"] == "a,b" and df.schema["d"].dataType.typeName() == "double"


def test_runs_and_latest(spark):
    path = os.path.join(_tmp(), "runs")
    base = spark.createDataFrame([("c1", 0.1), ("c2", 0.2)], "customer_id string, p double")
    io.write_run(base, path, "20240101_000000")
    io.write_run(base.withColumn("p", F.col("p") * 2), path, "20240201_000000")
    latest = io.latest_run(spark.read.parquet(path))
    assert sorted(r.p for r in latest.collect()) == [0.2, 0.4]


def test_table_overview_and_types(spark):
    r = Retail(spark, SF_SMALL)
    ov = io.table_overview(spark, {"customers": r.customers(), "products": r.products()})
    assert ov["products__head"].count() == 3
    types = {x.column_name: x.data_type for x in ov["customers"].collect()}
    assert types["birthdate"] == "date" and types["flag_phone_provided"] == "double"


def test_required_columns_guard(spark):
    df = spark.createDataFrame([("a", 1)], "customer_id string, x int")
    Q.require_columns(df, ["customer_id"])
    with pytest.raises(ValueError, match="gender"):
        Q.require_columns(df, ["customer_id", "gender"])


def test_binary_label_guard(spark):
    ok = spark.createDataFrame([(0,), (1,)], "y int")
    one = spark.createDataFrame([(1,), (1,)], "y int")
    bad = spark.createDataFrame([(0,), (2,)], "y int")
    assert Q.check_binary_label(ok, "y") is True
    assert Q.check_binary_label(one, "y") is False
    with pytest.raises(ValueError):
        Q.check_binary_label(bad, "y")


def test_sample_fraction_is_partition_independent(spark):
    r = Retail(spark, SF_SMALL)
    o = r.orders()
    a = io.sample_fraction(o.repartition(1), 0.2, "order_id", "product_id")
    b = io.sample_fraction(o.repartition(7), 0.2, "order_id", "product_id")
    assert sorted(map(tuple, a.collect())) == sorted(map(tuple, b.collect()))
    assert 0.1 < a.count() / o.count() < 0.3
