"""CSV files shared by several tasks: the same records as the plain scan, wherever the cuts fall."""

import csv
import io as text_io
import os
import random
import tempfile

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from cartographer.sources import io, split_csv

FIELD = st.text(alphabet='ab",\n\r é', max_size=6)


def _folder():
    return tempfile.mkdtemp(prefix="cartographer-test-")


def _write(path, rows, header=("a", "b"), end="\n"):
    with open(path, "w", newline="", encoding="utf-8") as f:
        w = csv.writer(f, lineterminator=end, quoting=csv.QUOTE_ALL)
        w.writerow(header)
        w.writerows(rows)


@settings(max_examples=150, deadline=None)
@given(rows=st.lists(st.tuples(FIELD, FIELD), max_size=12), size=st.integers(1, 40), piece=st.integers(1, 9), end=st.sampled_from(["\n", "\r\n"]))
def test_ranges_give_every_record_once(rows, size, piece, end):
    out = text_io.StringIO(newline="")
    w = csv.writer(out, lineterminator=end, quoting=csv.QUOTE_ALL)
    w.writerows(rows)
    data = out.getvalue().encode()
    path = os.path.join(_folder(), "x.csv")
    with open(path, "wb") as f:
        f.write(data)
    found, quotes = [], 0
    for first in range(0, len(data), size):
        last = min(first + size, len(data))
        found += split_csv.records("file:" + path, first, last, quotes % 2 == 1, piece)
        quotes += split_csv.count_quotes("file:" + path, first, last)
    assert [tuple(next(csv.reader(text_io.StringIO(r.decode(), newline="")))) for r in found] == rows


@pytest.mark.parametrize("split_bytes", [7, 64, 1 << 20])
def test_same_rows_as_the_plain_scan(spark, split_bytes):
    rng = random.Random(split_bytes)
    pieces = ["x", "two words", 'a "quoted" one', "line\nfeed", "comma, here", "", "è", "\n\n", '""', "7"]
    folder = _folder()
    for k in range(3):
        rows = [(f"{k}-{i}", "".join(rng.choice(pieces) for _ in range(rng.randint(0, 4)))) for i in range(rng.choice([0, 5, 40]))]
        _write(os.path.join(folder, f"part{k}.csv"), rows)
    with open(os.path.join(folder, "part4.csv"), "w") as f:
        f.write("a,b\nunquoted,field\n\n,\nlast,line without end")
    schema = "a string, b string"
    plain = spark.read.option("header", True).options(**split_csv.OPTIONS).schema(schema).csv(folder)
    ours = split_csv.scan(spark, folder, plain.schema, split_bytes)
    assert sorted(map(str, ours.collect())) == sorted(map(str, plain.collect()))


def test_one_file_is_read_by_many_tasks(spark):
    path = os.path.join(_folder(), "reviews.csv")
    _write(path, [(i, f'text {i}, with a "quote" and\na second line ' + "word " * 40) for i in range(20000)], ("review_id", "review_text"))
    size = os.path.getsize(path)
    df = io.read_csv(spark, path, schema=split_csv.StructType.fromDDL("review_id string, review_text string"), split_bytes=1 << 18)
    per_task = [r["count"] for r in df.groupBy(F.spark_partition_id()).count().collect()]
    assert len(per_task) >= size // (1 << 18) // 2 and sum(per_task) == 20000
    assert max(per_task) < 20000 / 4
    assert df.where("review_text not like '%second line%'").count() == 0


def test_types_are_inferred_from_all_rows(spark):
    path = os.path.join(_folder(), "x.csv")
    _write(path, [("1", "5000000000", "1.5", "2024-01-31", "2024-01-31 10:00:00", "true", "a", "")] * 50 +
           [("-2", "1", "2e3", "2023-02-01", "2023-02-01 00:00:01", "FALSE", "7", "")], ("i", "l", "d", "day", "at", "flag", "s", "s"))
    df = io.read_csv(spark, path, split_bytes=100)
    assert [f.dataType.simpleString() for f in df.schema] == ["int", "bigint", "double", "date", "timestamp", "boolean", "string", "string"]
    assert df.columns[-2:] == ["s6", "s7"] and df.count() == 51 and df.where("i = -2 and d = 2000 and not flag").count() == 1


def test_folder_of_tables(spark):
    folder = _folder()
    _write(os.path.join(folder, "products.csv"), [("p1", "3"), ("p2", "")], ("product_id", "product_class"))
    os.mkdir(os.path.join(folder, "notes"))
    _write(os.path.join(folder, "notes", "n1.csv"), [("1", "x")], ("id", "note"))
    _write(os.path.join(folder, "notes", "n2.csv"), [], ("id", "note"))
    os.mkdir(os.path.join(folder, "_hidden"))
    tables = io.read_folder(spark, folder)
    assert sorted(tables) == ["notes", "products"]
    rows = {(r.table_name, r.column_name): r for r in split_csv.folder_overview(tables).collect()}
    assert rows["products", "product_class"].data_type == "string" and rows["products", "product_id"].head_2 == "p2"
    assert rows["notes", "id"].data_type == "int" and rows["notes", "note"].n_rows == 1 and rows["notes", "note"].head_2 is None


def test_empty_and_compressed(spark):
    import gzip
    schema = split_csv.StructType.fromDDL("a string, b string")
    folder = _folder()
    open(os.path.join(folder, "empty.csv"), "w").close()
    assert io.read_csv(spark, folder, schema=schema).count() == 0
    _write(os.path.join(folder, "only_header.csv"), [])
    assert io.read_csv(spark, folder, schema=schema).count() == 0
    packed = _folder()
    with gzip.open(os.path.join(packed, "x.csv.gz"), "wt") as f:
        f.write('a,b\n1,"two\nlines"\n')
    assert io.read_csv(spark, packed, schema=schema).first()["b"] == "two\nlines"
