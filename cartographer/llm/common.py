"""Shared helpers: Arrow batch mapping, lineage cuts, words as hashed arrays.

Every operator reads the columns it needs by name, so extra columns of any
name in the input do no harm.
"""

from __future__ import annotations

import os
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType, _parse_datatype_string

from ..session import ensure_checkpoint_dir

ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

#: Rows handed to a batch function at once: bounds the Python copies of a batch.
SLICE_ROWS = 1000
#: Rows of an Arrow batch between the JVM and Python. Texts are long: Spark's
#: default of 10,000 rows holds too much of them at once, on both sides.
ARROW_ROWS = 1000
ARROW_CONF = "spark.sql.execution.arrow.maxRecordsPerBatch"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def cut(df: DataFrame) -> DataFrame:
    """Reliable checkpoint in the shared folder of the session."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def texts(docs: DataFrame, *others: str) -> DataFrame:
    """doc_id, text (null: empty) and the other named columns."""
    return docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"), *others)


def schema_of(ddl: str) -> StructType:
    return _parse_datatype_string(ddl)


def map_arrow(df: DataFrame, fn: Callable[[Iterator[pa.RecordBatch]], Iterator[list]], ddl: str) -> DataFrame:
    """``mapInArrow`` for a generator that yields lists of columns.

    The workers get this package's folder on their path, for sessions that
    were started elsewhere; the session's Arrow batches are held to
    ``ARROW_ROWS`` if they are larger (or unlimited).
    """
    if not 0 < int(df.sparkSession.conf.get(ARROW_CONF)) <= ARROW_ROWS:
        df.sparkSession.conf.set(ARROW_CONF, str(ARROW_ROWS))
    sc = df.sparkSession.sparkContext
    paths = sc.environment.get("PYTHONPATH", "").split(":")
    if ROOT not in paths:
        sc.environment["PYTHONPATH"] = ":".join([ROOT, *filter(None, paths)])
    spark_schema = schema_of(ddl)
    schema = to_arrow_schema(spark_schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for columns in fn(batches):
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)

    return df.mapInArrow(run, spark_schema)


def map_columns(df: DataFrame, fn: Callable[..., list], ddl: str, rows: int = SLICE_ROWS) -> DataFrame:
    """Call ``fn(column, column, ...)`` with Python lists of at most ``rows`` rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[list]:
        for batch in batches:
            for at in range(0, batch.num_rows, rows):
                yield fn(*(c.to_pylist() for c in batch.slice(at, rows).columns))

    return map_arrow(df, run, ddl)


# --- words as arrays -------------------------------------------------------

#: Bytes hashed at once; words are never cut.
HASH_BYTES = 1 << 20
_BASE = np.uint64(0x9E3779B97F4A7C15)


def byte_classes(separators: bytes, lower: bool = False) -> np.ndarray:
    """256 values: 0 for separators, else 1 + the byte (A-Z lowered on request)."""
    out = np.arange(1, 257, dtype=np.uint64)
    if lower:
        out[65:91] += np.uint64(32)
    out[np.frombuffer(separators, np.uint8)] = 0
    return out


#: The white space that ends a word: space, tab, line feed, vertical tab, form feed, return.
WHITE = b" \t\n\x0b\x0c\r"
WORDS = byte_classes(WHITE)
#: Terms: lower-case runs of ASCII letters, digits and any non-ASCII byte.
TERMS = byte_classes(bytes(b for b in range(128) if not chr(b).isalnum()), lower=True)


def mix(x: np.ndarray) -> np.ndarray:
    """Finaliser: spreads each bit of a 64-bit value over all bits."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def powers(n: int) -> np.ndarray:
    out = np.full(n, _BASE, np.uint64)
    out[:1] = 1
    return np.cumprod(out, dtype=np.uint64)


def hash_words(data: np.ndarray, classes: np.ndarray = WORDS) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """64-bit hash, first byte and end byte of every word in ``data`` (UTF-8 bytes).

    A word's hash is a polynomial of its class values, so equal words have
    equal hashes wherever they stand.
    """
    hashes, firsts, ends, at, n = [], [], [], 0, len(data)
    while at < n:
        to = min(n, at + HASH_BYTES)
        while to < n and classes[data[to]]:  # to the end of a word
            step = np.flatnonzero(classes[data[to:to + HASH_BYTES]] == 0)
            to = to + int(step[0]) if len(step) else min(n, to + HASH_BYTES)
        value = classes[data[at:to]]
        inside = np.zeros(to - at + 2, np.int8)
        inside[1:-1] = value != 0
        edge = np.diff(inside)
        first, end = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
        if len(first):
            longest = int((end - first).max())
            start = np.zeros(to - at, np.int64)
            start[first] = first
            place = np.minimum(np.arange(to - at) - np.maximum.accumulate(start), longest)
            value = value * powers(longest + 1)[place]
            hashes.append(mix(np.add.reduceat(value, first)))
            firsts.append(first + at)
            ends.append(end + at)
        at = to
    join = lambda x, t: np.concatenate(x) if x else np.zeros(0, t)
    return join(hashes, np.uint64), join(firsts, np.int64), join(ends, np.int64)


def string_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of a string column without nulls, and its n + 1 offsets."""
    column = column.cast(pa.large_string()) if not pa.types.is_large_string(column.type) else column
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, np.int64)[column.offset:column.offset + len(column) + 1]
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return data[offsets[0]:offsets[-1]], offsets - offsets[0]


def slices(batches: Iterator[pa.RecordBatch], text: int = 1, size: int = 4 << 20) -> Iterator[pa.RecordBatch]:
    """Batches cut so that each holds about ``size`` bytes of text, one row at least."""
    for batch in batches:
        _, offsets = string_bytes(batch.column(text))
        at = 0
        while at < batch.num_rows:
            to = max(at + 1, int(np.searchsorted(offsets, offsets[at] + size, "right")) - 1)
            yield batch.slice(at, to - at)
            at = to


def documents_words(column: pa.Array, classes: np.ndarray = WORDS) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Bytes, then hash, first and end byte of all words, and each document's first word (n + 1 values).

    Documents are told apart by a separator put between them.
    """
    data, offsets = string_bytes(column)
    n = len(column)
    apart = np.zeros(len(data) + n, np.uint8)
    shift = np.repeat(np.arange(n), np.diff(offsets))
    apart[np.arange(len(data)) + shift] = data
    apart[offsets[1:] + np.arange(n)] = 32
    hashes, first, end = hash_words(apart, classes)
    bounds = np.searchsorted(first, np.append(offsets[:-1] + np.arange(n), len(apart)))
    return apart, hashes, first, end, bounds
