"""CSV scans in which several tasks share a file.

A line feed may stand inside quotes, so Spark's own scan of multi-line CSV gives
every file to one task. Here a file is cut into byte ranges instead:

1. one pass counts the quotes of each range (a doubled quote counts as two);
2. the sum over the ranges before it tells whether a range starts inside quotes;
3. the task of a range finds the line feeds outside quotes and returns the records
   that begin in its range; the last of them it reads to its end, past the range.

Tasks only look for borders; the fields are parsed by Spark's CSV parser
(``from_csv``), with the options of the plain scan. Nothing is shuffled but one
small row per range.

Text is UTF-8 (other bytes are replaced), records end with a line feed or a
return and line feed, empty lines are skipped, the first line of every file is its header. A
quote that is not closed runs to the end of its file, as it does in the plain scan.
"""

from __future__ import annotations

import csv
import io
import sys
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from ..session import cut_lineage

#: Bytes of one range, and bytes that a task holds of it at once.
SPLIT_BYTES, PIECE_BYTES = 32 << 20, 4 << 20
#: Records of one Arrow batch.
BATCH_RECORDS = 1000
COMPRESSED = r"(?i)\.(gz|bz2|zst|zstd|lz4|snappy|deflate|xz)$"
OPTIONS = {"escape": '"', "multiLine": "true", "timestampNTZFormat": "yyyy-MM-dd HH:mm:ss"}
#: Types tried in this order for a column of unknown type: what its values must look like.
NUMBER = r"^[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?$"
PATTERNS = {"int": r"^[+-]?[0-9]+$", "bigint": r"^[+-]?[0-9]+$", "double": NUMBER, "date": r"^[0-9]{4}-[0-9]{2}-[0-9]{2}$",
            "timestamp": r"^[0-9]{4}-[0-9]{2}-[0-9]{2}[ T][0-9]{2}:[0-9]{2}", "boolean": "(?i)^(true|false)$"}

# workers get this module's functions themselves: the package need not be installed there
cloudpickle.register_pickle_by_value(sys.modules[__name__])


def open_file(uri: str) -> pa.NativeFile:
    from pyarrow import fs
    scheme, _, rest = uri.partition(":")
    if scheme == "file" or not rest:
        return fs.LocalFileSystem().open_input_file("/" + (rest or scheme).lstrip("/"))
    files, name = fs.FileSystem.from_uri(f"{ {'s3a': 's3', 's3n': 's3'}.get(scheme, scheme)}:{rest}")
    return files.open_input_file(name)


def count_quotes(uri: str, first: int, end: int) -> int:
    total = 0
    with open_file(uri) as f:
        f.seek(first)
        while first < end and (data := f.read(min(PIECE_BYTES, end - first))):
            total += data.count(b'"')
            first += len(data)
    return total


def records(uri: str, first: int, end: int, inside: bool, piece: int = PIECE_BYTES) -> Iterator[bytes]:
    """Records that begin in bytes ``first`` to ``end`` - 1; ``inside`` tells whether ``first`` lies within quotes."""
    with open_file(uri) as f:
        at = max(first - 1, 0)  # the byte before may be the line feed that lets a record begin here
        f.seek(at)
        started, held = first == 0, []
        quoted = None if at < first else int(inside)
        while (started or at < end) and (data := f.read(piece)):
            values = np.frombuffer(data, np.uint8)
            quotes = values == 34
            if quoted is None:
                quoted = int(inside) ^ int(quotes[0])
            within = (np.cumsum(quotes, dtype=np.uint8) + np.uint8(quoted)) & 1  # counts wrap, their parity does not
            quoted, start = int(within[-1]), 0
            for feed in np.flatnonzero((values == 10) & (within == 0)).tolist():
                if started:
                    yield b"".join([*held, data[start:feed]]).removesuffix(b"\r")
                    held = []
                start = feed + 1
                started = at + start < end
                if not started and at + start >= end:
                    return
            if started:
                held.append(data[start:])
            at += len(data)
        if held:
            yield b"".join(held).removesuffix(b"\r")


def _rows(ranges: DataFrame, tasks: int, fn, ddl: str) -> DataFrame:
    """``fn(path, first, end, inside)`` of every range, as rows of ``ddl``, over ``tasks`` tasks."""
    names = [f.name for f in StructType.fromDDL(ddl)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out: list[tuple] = []
        for b in batches:
            for row in zip(*(c.to_pylist() for c in b.columns), strict=True):
                for r in fn(*row):
                    out.append(r)
                    if len(out) >= BATCH_RECORDS:
                        yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*out, strict=True)], names)
                        out = []
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*out, strict=True)], names)

    return ranges.repartition(tasks).mapInArrow(run, ddl)


def files(spark: SparkSession, path: str) -> DataFrame:
    """path and length of the files, without reading them."""
    return spark.read.format("binaryFile").load(path).select("path", "length")


def record_lines(spark: SparkSession, path: str, split_bytes: int = SPLIT_BYTES) -> tuple[DataFrame, str | None]:
    """One row (``record``) per record without headers, and the path of the first file (None: no file)."""
    found = files(spark, path)
    count, first_file = found.agg(F.sum(F.ceil(F.col("length") / split_bytes)), F.min("path")).first()
    tasks = max(1, int(count or 0))
    at = F.explode(F.sequence(F.lit(0).cast("long"), F.greatest(F.col("length") - 1, F.lit(0).cast("long")), F.lit(split_bytes).cast("long")))
    ranges = found.where("length > 0").select("path", "length", at.alias("first")).select(
        "path", "first", F.least(F.col("first") + split_bytes, "length").alias("end"), F.lit(False).alias("inside"))
    counted = cut_lineage(_rows(ranges, tasks, lambda uri, first, end, _: [(uri, first, end, count_quotes(uri, first, end))],
                                "path string, first long, end long, quotes long"))
    before = Window.partitionBy("path").orderBy("first").rowsBetween(Window.unboundedPreceding, -1)
    known = counted.select("path", "first", "end", (F.coalesce(F.sum("quotes").over(before), F.lit(0)) % 2 == 1).alias("inside"))

    def lines(uri: str, first: int, end: int, inside: bool) -> Iterator[tuple[str]]:
        header = first == 0
        for r in records(uri, first, end, inside):
            if r.strip():
                if not header:
                    yield (r.decode("utf-8", "replace"),)
                header = False

    return _rows(known, tasks, lines, "record string"), first_file


def header_names(first_file: str) -> list[str]:
    """Column names of the first line of a file that isn't empty; unnamed and repeated ones get their number."""
    line = next((r for r in records(first_file, 0, 1 << 62, False) if r.strip()), b"").decode("utf-8", "replace").removeprefix("\ufeff")
    names = next(csv.reader(io.StringIO(line, newline="")), [])
    return [n if n and names.count(n) == 1 else f"{n or '_c'}{i}" for i, n in enumerate(names)]


def infer_types(df: DataFrame) -> DataFrame:
    """String columns cast to the first type that all their values fit; one aggregate over all columns."""
    def fits(c: str, kind: str):
        return F.when(F.col(f"`{c}`").rlike(PATTERNS[kind]), F.col(f"`{c}`").try_cast(kind))

    seen = df.agg(*(F.struct(F.count(F.col(f"`{c}`")).alias("all"), *(F.count(fits(c, k)).alias(k) for k in PATTERNS)).alias(f"c{i}")
                    for i, c in enumerate(df.columns))).first()
    kinds = [next((k for k in PATTERNS if 0 < s["all"] == s[k]), "string") for s in seen]
    return df.select(*((fits(c, k) if k != "string" else F.col(f"`{c}`")).alias(c) for c, k in zip(df.columns, kinds, strict=True)))


def scan(spark: SparkSession, path: str, schema: StructType | None = None, split_bytes: int = SPLIT_BYTES) -> DataFrame:
    """The CSV file or folder ``path``; columns are taken by position.

    Without ``schema`` the first file's header names the columns and their types
    are inferred from all rows. Counting the quotes is one more pass over the
    bytes, inference another.
    """
    lines, first_file = record_lines(spark, path, split_bytes)
    if schema is None:
        if first_file is None:
            raise ValueError(f"no files to infer columns from in {path}")
        names = header_names(first_file)
        return infer_types(parse(lines, StructType([StructField(n, StringType()) for n in names])))
    return parse(lines, schema)


def parse(lines: DataFrame, schema: StructType) -> DataFrame:
    ddl = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema)
    row = lines.select(F.from_csv("record", ddl, OPTIONS).alias("r"))
    return row.select(*(F.col("r").getField(f.name).alias(f.name) for f in schema))


def any_compressed(spark: SparkSession, path: str) -> bool:
    return not files(spark, path).where(F.col("path").rlike(COMPRESSED)).isEmpty()


def overview(df: DataFrame, name: str, n: int = 3) -> DataFrame:
    """Per column of a table: table_name, position, column_name, data_type, n_rows, n_missing, and head_1 to head_n.

    The heads are the column's values, as text, in the first ``n`` rows of the total order of all columns
    (nulls first). An empty table has its columns with null heads.
    """
    def text(f):
        c = F.col(f"`{f.name}`")
        return (c.cast("decimal(18,4)") if f.dataType.typeName() in ("double", "float") else c).cast("string")

    fields = df.schema.fields
    order = [F.col(f"`{f.name}`").asc_nulls_first() for f in fields]
    top = df.orderBy(*order).limit(n).withColumn("_rank", F.row_number().over(Window.orderBy(*order)))  # n rows
    heads = top.agg(F.sort_array(F.collect_list(F.struct("_rank", *(text(f).alias(f"h{i}") for i, f in enumerate(fields)))))).scalar()
    counts = df.agg(F.count(F.lit(1)).alias("n_rows"), *(F.count(F.col(f"`{f.name}`")).alias(f"n{i}") for i, f in enumerate(fields)))
    one = counts.select(F.lit(name).alias("table_name"), "*", heads.alias("_heads"))
    each = F.array(*(F.struct(F.lit(i).alias("position"), F.lit(f.name).alias("column_name"), F.lit(f.dataType.simpleString()).alias("data_type"),
                              (F.col("n_rows") - F.col(f"n{i}")).alias("n_missing"),
                              *(F.get("_heads", F.lit(k)).getField(f"h{i}").alias(f"head_{k + 1}") for k in range(n))) for i, f in enumerate(fields)))
    return one.select("table_name", "n_rows", F.explode(each).alias("e")).select("table_name", "n_rows", "e.*")


def folder_overview(tables: dict[str, DataFrame], n: int = 3) -> DataFrame:
    """``overview`` of every table of a folder."""
    return reduce(DataFrame.unionByName, (overview(df, name, n) for name, df in tables.items()))
