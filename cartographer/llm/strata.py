"""Ranked lexical search over a length-stratified index.

Documents of equal length normaliser m form a stratum. The index holds them in
segments of one stratum each: the documents in the order of their ids, the distinct
terms, and each term's postings by falling term frequency. As m is constant there,
a term's impact depends on its frequency alone and is computed once per frequency;
the first posting of each term bounds what a document of the segment can score.

A search visits segments in the order of these bounds and leaves out every segment
whose bound is below the score that the item's 20th best document has already (equal
bounds are visited: a smaller id may win the tie). Scores are 64-bit integers, so the
ranking is exact.

Building takes two passes over the texts: one for document frequencies, lengths and
stratum sizes, one for the postings, which are shuffled by stratum; strata above
``SEGMENT_POSTINGS`` are dealt out by a hash of the document's id. Items are searched in
blocks of bounded size against the whole index.

Terms are told apart by 64-bit hashes (at 10^9 distinct terms the odds of any clash
are about 3 %). Null texts have no terms and stand in no stratum; repeated rows are
documents and items of their own; a null doc_id ranks after all others on equal
scores. An item without terms, or whose terms no document holds, gets no row.
"""

from __future__ import annotations

import math
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import ensure_checkpoint_dir
from .common import TERMS, cut, documents_words, map_arrow, slices, texts

#: Most postings and documents of a segment; a longer document is a segment of its own.
SEGMENT_POSTINGS = 1 << 17
SEGMENT_DOCS = 1 << 12
#: Items, and bytes of their texts, that are searched at once, about.
BLOCK_ITEMS = 256
BLOCK_BYTES = 1 << 20
#: Documents returned per item.
TOP = 20
#: Normaliser: ``100 - SLOPE + SLOPE * n * N div L``, impact: ``SCALE * tf div (1000 * tf + 12 * m)``.
SLOPE = 25
SCALE = 1_000_000_000

_TERM, _LENGTH = 0, 1


def _vectors(column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Terms and frequencies of all documents, sorted by term within each; document bounds; lengths."""
    _, hashes, _, _, bounds = documents_words(column, TERMS)
    for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True):
        hashes[a:b].sort()
    new = np.ones(len(hashes), bool)
    new[1:] = hashes[1:] != hashes[:-1]
    new[bounds[:-1][bounds[:-1] < len(hashes)]] = True
    at = np.flatnonzero(new)
    return hashes[at], np.diff(np.append(at, len(hashes))), np.searchsorted(at, bounds), np.diff(bounds)


def statistics(docs: DataFrame) -> DataFrame:
    """(kind, key, docs, postings): documents by term (kind 0) and by length with all postings there (kind 1)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[list]:
        for batch in slices(batches):
            terms, _, bounds, lengths = _vectors(batch.column(1))
            terms, n = np.unique(terms, return_counts=True)
            yield [np.zeros(len(terms), np.int8), terms.view(np.int64), n, np.zeros(len(terms), np.int64)]
            sizes, at, n = np.unique(lengths, return_inverse=True, return_counts=True)
            postings = np.bincount(at, np.diff(bounds), len(sizes)).astype(np.int64)
            yield [np.ones(len(sizes), np.int8), sizes, n, postings]

    counted = map_arrow(texts(docs), run, "kind tinyint, key bigint, docs bigint, postings bigint")
    return counted.groupBy("kind", "key").agg(F.sum("docs").alias("docs"), F.sum("postings").alias("postings"))


def totals(stats: DataFrame) -> tuple[int, int]:
    """Documents with a term, and all their terms with repeats."""
    row = stats.where((F.col("kind") == _LENGTH) & (F.col("key") > 0)).agg(F.sum("docs"), F.sum(F.col("key") * F.col("docs"))).first()
    return int(row[0] or 0), int(row[1] or 0)


def build_index(docs: DataFrame, stats: DataFrame) -> DataFrame:
    """Segments: m, docs, and as binary little-endian arrays terms (64 bit), first posting of each
    and the end (32), document places (16) and frequencies (32) of the postings."""
    n_docs, n_terms = totals(stats)
    m_of = f"{100 - SLOPE} + ({SLOPE} * key * {n_docs}) div {max(n_terms, 1)}"
    # strata that need more than one group: at most all postings / SEGMENT_POSTINGS rows
    split = {r.m: int(r.groups) for r in stats.where((F.col("kind") == _LENGTH) & (F.col("key") > 0))
             .groupBy(F.expr(m_of).alias("m")).agg(F.expr(f"1 + sum(postings) div {SEGMENT_POSTINGS}").alias("groups")).where("groups > 1").collect()}

    def vectors(batches: Iterator[pa.RecordBatch]) -> Iterator[list]:
        for batch in slices(batches):
            terms, tf, bounds, lengths = _vectors(batch.column(1))
            kept = np.flatnonzero(lengths)
            m = [100 - SLOPE + SLOPE * n * n_docs // n_terms for n in lengths[kept].tolist()]
            draw = batch.column(2).to_numpy()[kept].tolist()
            tf = tf.astype("<u4")
            yield [m, [d % split.get(k, 1) for d, k in zip(draw, m, strict=True)], batch.column(0).take(pa.array(kept)),
                   [terms[bounds[i]:bounds[i + 1]].tobytes() for i in kept.tolist()], [tf[bounds[i]:bounds[i + 1]].tobytes() for i in kept.tolist()]]

    id_type = docs.schema["doc_id"].dataType.simpleString()
    drawn = texts(docs, F.xxhash64("doc_id", F.lit(7)).alias("draw"))
    rows = map_arrow(drawn, vectors, f"m bigint, part bigint, doc_id {id_type}, terms binary, tf binary")
    order = [F.col("m"), F.col("part"), F.col("doc_id").asc_nulls_last()]

    def segments(batches: Iterator[pa.RecordBatch]) -> Iterator[list]:
        held, size, at = [], 0, None
        for batch in batches:
            for m, part, doc, terms, tf in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if held and ((m, part) != at or len(held) >= SEGMENT_DOCS or size + len(terms) // 8 > SEGMENT_POSTINGS):
                    yield segment(at[0], held)
                    held, size = [], 0
                at = (m, part)
                held.append((doc, np.frombuffer(terms, np.uint64), np.frombuffer(tf, "<u4")))
                size += len(terms) // 8
        if held:
            yield segment(at[0], held)

    return map_arrow(rows.repartition("m", "part").sortWithinPartitions(*order), segments,
                     f"m bigint, docs array<{id_type}>, terms binary, firsts binary, places binary, tf binary")


def segment(m: int, held: list[tuple[object, np.ndarray, np.ndarray]]) -> list:
    """One row of the index."""
    terms, tf = np.concatenate([h[1] for h in held]), np.concatenate([h[2] for h in held])
    place = np.repeat(np.arange(len(held)), [len(h[1]) for h in held])
    by = np.lexsort((place, -tf.astype(np.int64), terms))
    terms, first = np.unique(terms[by], return_index=True)
    return [[m], [[h[0] for h in held]], [terms.astype("<u8").tobytes()], [np.append(first, len(by)).astype("<u4").tobytes()],
            [place[by].astype("<u2").tobytes()], [tf[by].astype("<u4").tobytes()]]


class Query:
    """A block of items: their terms, weights, and which items hold a term how often."""

    def __init__(self, keys: list[int], item_terms: list[np.ndarray], weight: dict[int, int]):
        self.keys = keys
        found = [np.unique(t, return_counts=True) for t in item_terms]
        item = np.repeat(np.arange(len(keys)), [len(t) for t, _ in found])
        terms = np.concatenate([t for t, _ in found]) if found else np.zeros(0, np.uint64)
        times = np.concatenate([n for _, n in found]) if found else np.zeros(0, np.int64)
        known = np.isin(terms, np.array(list(weight), np.uint64))
        self.terms, at = np.unique(terms[known], return_inverse=True)
        self.weight = np.array([weight[t] for t in self.terms.tolist()], np.int64)
        by = np.argsort(at, kind="stable")
        self.item, self.times = item[known][by], times[known][by].astype(np.int64)
        self.first = np.searchsorted(at[by], np.arange(len(self.terms) + 1))


def spread(first: np.ndarray, count: np.ndarray) -> np.ndarray:
    """first[0], first[0] + 1, ... count[0] values, then those from first[1] on, ..."""
    start = np.cumsum(count) - count
    return np.arange(int(count.sum())) + np.repeat(first - start, count)


class Visitor:
    """Best documents so far of each item of a query."""

    def __init__(self, query: Query, top: int):
        self.query, self.top = query, top
        self.best: list[list[tuple[int, bool, object]]] = [[] for _ in query.keys]
        self.least = np.ones(len(query.keys), np.int64)

    def visit(self, rows: list[tuple]) -> None:
        """Visits segments in the order of their greatest bounds."""
        q = self.query
        met = []
        for row in rows:
            m, _, terms, firsts, _, tf = row
            if not len(q.terms):
                return
            at = np.minimum(np.searchsorted(terms, q.terms), len(terms) - 1)
            mine = np.flatnonzero(terms[at] == q.terms)
            at = at[mine]
            top_tf = tf[firsts[at]].astype(np.int64)
            most = q.weight[mine] * (SCALE * top_tf // (1000 * top_tf + 12 * m))
            count = q.first[mine + 1] - q.first[mine]
            pair = spread(q.first[mine], count)
            bound = np.zeros(len(q.keys), np.int64)
            np.add.at(bound, q.item[pair], np.repeat(most, count) * q.times[pair])
            met.append((bound, mine, at, row))
        for bound, mine, at, row in sorted(met, key=lambda x: -int(x[0].max(initial=0))):
            if (bound >= self.least).any():
                self.score(bound >= self.least, mine, at, row)

    def score(self, active: np.ndarray, mine: np.ndarray, at: np.ndarray, row: tuple) -> None:
        q = self.query
        m, docs, _, firsts, places, tf = row
        rows = np.cumsum(active) - 1  # accumulator of each active item
        n = len(docs)
        count = q.first[mine + 1] - q.first[mine]
        pair, term = spread(q.first[mine], count), np.repeat(np.arange(len(mine)), count)
        wanted = active[q.item[pair]]
        pair, term = pair[wanted], term[wanted]
        lengths = (firsts[at + 1] - firsts[at]).astype(np.int64)
        where = spread(firsts[at].astype(np.int64), lengths)  # all postings of the terms, once
        freq, which = np.unique(tf[where], return_inverse=True)
        impact = SCALE * freq.astype(np.int64) // (1000 * freq.astype(np.int64) + 12 * m)
        gain = np.repeat(q.weight[mine], lengths) * impact[which]
        each = spread((np.cumsum(lengths) - lengths)[term], lengths[term])
        total = np.zeros((int(active.sum()), n), np.int64)
        cell = np.repeat(rows[q.item[pair]] * n, lengths[term]) + places[where[each]]
        np.add.at(total.reshape(-1), cell, gain[each] * np.repeat(q.times[pair], lengths[term]))
        least = self.least[active]
        if n > self.top:
            least = np.maximum(least, np.partition(total, n - self.top, axis=1)[:, n - self.top])
        for r, item in enumerate(np.flatnonzero(active).tolist()):
            good = np.flatnonzero(total[r] >= least[r])
            if not len(good):
                continue
            good = good[np.argsort(-total[r][good], kind="stable")[:self.top]]  # documents stand by id
            scored = [(-s, docs[d] is None, docs[d]) for s, d in zip(total[r][good].tolist(), good.tolist(), strict=True)]
            best = sorted(self.best[item] + scored, key=_order)[:self.top]
            self.best[item] = best
            if len(best) == self.top:
                self.least[item] = max(1, -best[-1][0])


def _order(entry: tuple[int, bool, object]) -> tuple:
    return entry[:2] if entry[1] else entry


def search(index: DataFrame, stats: DataFrame, items: DataFrame, top: int = TOP) -> DataFrame:
    """item_id, rank, doc_id, score: the ``top`` best documents of every row of ``items`` (item_id, text).

    The items are taken to the driver block by block (``BLOCK_ITEMS``, ``BLOCK_BYTES``; equal rows share a
    block), hashed into a ``Query`` and broadcast; each block reads the index once.
    """
    spark = index.sparkSession
    n_docs, _ = totals(stats)
    asked = cut(texts(items.withColumnRenamed("item_id", "doc_id")).select(F.col("doc_id").alias("item_id"), "text")
                .withColumn("key", F.monotonically_increasing_id()))
    size = asked.agg(F.count("*"), F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()
    blocks = 1 + max(size[0] // BLOCK_ITEMS, size[1] // BLOCK_BYTES)
    id_type = index.schema["docs"].dataType.elementType.simpleString()
    out = spark.createDataFrame([], f"key bigint, doc_id {id_type}, score bigint")
    for block in range(blocks):
        rows = asked.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == block).select("key", "text").toArrow()
        if not rows.num_rows:
            continue
        terms, tf, bounds, _ = _vectors(rows.column("text").combine_chunks())
        vocabulary = spark.createDataFrame([(t,) for t in np.unique(terms).view(np.int64).tolist()], "key bigint")
        held = stats.where(F.col("kind") == _TERM).join(F.broadcast(vocabulary), "key", "left_semi").select("key", "docs").collect()
        weight = {r.key % (1 << 64): math.floor(1000 * math.log((2 * n_docs + 2) / (2 * r.docs + 1))) for r in held}
        items_terms = [np.repeat(terms[a:b], tf[a:b]) for a, b in zip(bounds[:-1], bounds[1:], strict=True)]
        query = spark.sparkContext.broadcast(Query(rows.column("key").to_pylist(), items_terms, weight))

        def run(batches: Iterator[pa.RecordBatch], query=query) -> Iterator[list]:
            visitor = Visitor(query.value, top)
            for batch in batches:
                m, docs, *binary = (c.to_pylist() for c in batch.columns)
                arrays = [[np.frombuffer(b, t) for b in c] for c, t in zip(binary, ("<u8", "<u4", "<u2", "<u4"), strict=True)]
                visitor.visit(list(zip(m, docs, *arrays, strict=True)))
            rows = [(k, d, -s) for k, best in zip(query.value.keys, visitor.best, strict=True) for s, _, d in best]
            yield [list(c) for c in zip(*rows, strict=True)] if rows else [[], [], []]

        out = out.union(map_arrow(index, run, f"key bigint, doc_id {id_type}, score bigint"))
    by = Window.partitionBy("key").orderBy(F.col("score").desc(), F.col("doc_id").asc_nulls_last())
    best = out.withColumn("rank", F.row_number().over(by)).where(F.col("rank") <= top)
    return best.join(asked.select("key", "item_id"), "key").select("item_id", "rank", "doc_id", "score")


def rank_documents(docs: DataFrame, items: DataFrame, top: int = TOP) -> DataFrame:
    """Builds the index in the shared folder and searches it for all items."""
    stats = cut(statistics(docs))
    folder = f"{ensure_checkpoint_dir(docs.sparkSession).rstrip('/')}/strata-{uuid.uuid4().hex}"
    build_index(docs, stats).write.parquet(folder)
    return search(docs.sparkSession.read.parquet(folder), stats, items, top)
