"""Repeated passages by suffix arrays over groups of suffixes, dealt out by content.

A suffix is a word position with at least ``WINDOW`` words from there on; two
suffixes that share their first ``WINDOW`` words share a passage. Suffixes are
partitioned by content into groups, each small enough for one task, and a
group's suffix tree is built in memory:

* A suffix's group is named by the smallest hash of the ``GRAM``-word sequences
  in its first ``WINDOW`` words. Neighbouring suffixes mostly share it, so a
  group receives runs of suffixes as one piece of text and the words of a
  document are not copied once per suffix.
* Only groups that meet two documents are built at all. Their names are
  counted first, over all documents.
* A group of more than ``GROUP_DOCS`` documents (a passage or a phrase that
  very many share), or of more than ``BUILD_WORDS`` words in pieces of over
  ``LONG_PIECE`` (periodic text, whose windows all have one name), is split further by the longest prefix, all ``WINDOW``
  words: each part is then a single node of the tree, and the least document
  of the node is a grouping with partial minima.
* Any other group's subtree is a suffix array over its words, built by prefix
  doubling. Suffixes that are equal to depth ``WINDOW`` hang below one internal
  node; a node that holds a smaller document makes the passage a repeat there.

Documents with the same words are folded first: all but the one with the
smallest id repeat it wholly.

Words are runs without ASCII white space and are compared by 64-bit hashes of
their bytes; a node of a split group is named by two such hashes of its 50
words, 128 bits, so that windows that only share one hash stay apart. Runs
carry a 64-bit mark of their row's words instead of the words' SHA-256. Null texts have no words. Documents with a null id have no place
in the order: they lose nothing and cost others nothing. Rows that share an
id do not repeat each other.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import cut, documents_words, map_arrow, map_columns, mix, powers, slices, texts

WINDOW, GRAM = 50, 16
GROUP_DOCS = 512
#: Words whose subtrees are built together; groups are never divided. One group holds at most as
#: many in long pieces, and GROUP_DOCS * LONG_PIECE in others.
BUILD_WORDS, LONG_PIECE = 400_000, 512
#: Suffixes of one batch out of node_repeats.
NODE_ROWS = 200_000
_BASE = int(powers(2)[1])
_BACK = np.uint64(pow(_BASE, -1, 1 << 64))
EMPTY_SHA = hashlib.sha256(b"").hexdigest()


def sequence_hashes(hashes: np.ndarray, size: int) -> np.ndarray:
    """Hash of every ``size`` consecutive words, as a rolling polynomial."""
    n = len(hashes)
    if n < size:
        return np.zeros(0, np.uint64)
    back = np.full(n, _BACK, np.uint64)
    back[:1] = 1
    sums = np.zeros(n + 1, np.uint64)
    np.cumsum(hashes * powers(n), out=sums[1:])
    return mix((sums[size:] - sums[:-size]) * np.cumprod(back, dtype=np.uint64)[:n - size + 1] + np.uint64(size))


def node_hashes(hashes: np.ndarray, window: int = WINDOW) -> tuple[np.ndarray, np.ndarray]:
    """Two independent hashes of every ``window`` consecutive words."""
    return sequence_hashes(hashes, window), sequence_hashes(mix(hashes ^ np.uint64(_BASE)), window)


def group_names(hashes: np.ndarray, window: int = WINDOW, gram: int = GRAM) -> np.ndarray:
    """For every word position with ``window`` words from there on, the smallest hash of its ``gram``-word sequences."""
    low, span, width = sequence_hashes(hashes, gram), 1, window - gram + 1
    while 2 * span <= width:
        low = np.minimum(low[:-span], low[span:])
        span *= 2
    return np.minimum(low[:len(low) - (width - span)], low[width - span:]) if len(hashes) >= window else np.zeros(0, np.uint64)


def describe(docs: DataFrame) -> DataFrame:
    """doc_id, n_words, sha (hash of the words), the distinct group names of each document, and the words of those with many."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[list]:
        for b in slices(batches):
            _, hashes, _, _, bounds = documents_words(b.column(1))
            n = b.num_rows
            doc = np.repeat(np.arange(n), np.diff(bounds))
            names = group_names(hashes)
            inside = doc[:len(names)] == doc[WINDOW - 1:WINDOW - 1 + len(names)] if len(names) else np.zeros(0, bool)
            new = inside.copy()
            new[1:] &= (names[1:] != names[:-1]) | ~inside[:-1]
            # words of a piece: its suffixes up to the next piece or the document's last suffix, and those they reach over
            total = np.append(0, np.cumsum(inside))
            first = np.flatnonzero(new)
            reach = total[np.append(first[1:], len(names))] - total[first] + WINDOW - 1 if len(first) else first
            names, of = names[new], doc[:len(new)][new]
            order = np.lexsort((names, of))
            names, of, reach = names[order], of[order], reach[order]
            once = np.ones(len(names), bool)
            once[1:] = (names[1:] != names[:-1]) | (of[1:] != of[:-1])
            at = np.searchsorted(of[once], np.arange(n + 1))
            lists = pa.ListArray.from_arrays(pa.array(at, pa.int32()), pa.array(names[once].view(np.int64)))
            begin = np.flatnonzero(once)
            reach = np.add.reduceat(reach, begin) if len(begin) else reach
            large = reach > LONG_PIECE
            at_long = np.searchsorted(of[once][large], np.arange(n + 1))
            longs = pa.ListArray.from_arrays(pa.array(at_long, pa.int32()), pa.StructArray.from_arrays(
                [pa.array(names[once][large].view(np.int64)), pa.array(reach[large].astype(np.int64))], ["name", "words"]))
            shas = [hashlib.sha256(b" ".join(t.encode().split())).hexdigest() for t in b.column(1).to_pylist()]
            yield [b.column(0), np.diff(bounds), shas, lists, longs]

    return map_arrow(texts(docs), run, f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, n_words long, sha string, names array<bigint>, longs array<struct<name:bigint,words:bigint>>")


def _runs(starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First and last of each run of consecutive numbers."""
    if not len(starts):
        return starts, starts
    gap = np.flatnonzero(np.diff(starts) != 1)
    return starts[np.append(0, gap + 1)], starts[np.append(gap, len(starts) - 1)]


def segments(found: DataFrame, kind: str) -> DataFrame:
    """Runs of suffixes of one group: name, doc_id, mark, start and the words (hashes) they reach over.

    ``found`` has doc_id, text, mark and the group ``names`` to report.
    """

    def run(ids: list, text: list, marks: list, names: list) -> list:
        out: list[list] = [[], [], [], [], []]
        for doc, t, s, wanted in zip(ids, text, marks, names, strict=True):
            _, hashes, _, _, _ = documents_words(pa.array([t], pa.large_string()))
            own = group_names(hashes)
            edge = np.flatnonzero(own[1:] != own[:-1]) + 1
            first, end = np.append(0, edge), np.append(edge, len(own))
            for a, e in zip(*(x[np.isin(own[first], np.array(wanted, np.int64).view(np.uint64))].tolist() for x in (first, end)), strict=True):
                for column, x in zip(out, (int(own[a].view(np.int64)), doc, s, a, hashes[a:e + WINDOW - 1].tobytes()), strict=True):
                    column.append(x)
        return out

    return map_columns(found.select("doc_id", "text", "mark", "names"), run, f"name long, doc_id {kind}, mark long, start long, words binary", 200)


def node_classes(words: np.ndarray, ends: np.ndarray, window: int = WINDOW) -> tuple[np.ndarray, np.ndarray]:
    """Suffixes with ``window`` words before their text's end, and the tree node at that depth which each hangs below.

    ``ends`` is the end of its text for every word. The suffixes' ranks by
    their first 1, 2, 4, ... words are classes of equal prefixes; two
    overlapping ranks make the class of the whole window.
    """
    n = len(words)
    at = np.arange(n)
    rank = np.unique(words, return_inverse=True)[1].astype(np.int64) + 1
    size = 1
    while 2 * size <= window:
        after = np.zeros(n, np.int64)
        after[:n - size] = rank[size:]
        after[at + size >= ends] = 0
        rank = np.unique(rank * (n + 1) + after, return_inverse=True)[1].astype(np.int64) + 1
        size *= 2
    whole = at[at + window <= ends]
    return whole, np.unique(rank[whole] * (n + 1) + rank[whole + window - size], return_inverse=True)[1]


def tree_repeats(pieces: DataFrame, kind: str) -> DataFrame:
    """Repeated runs of suffixes (doc_id, mark, first, last) from the subtrees of all groups."""

    def build(rows: list[tuple]) -> list:
        out: list[list] = [[], [], [], []]
        if not rows:
            return out
        words = np.frombuffer(b"".join(r[4] for r in rows), np.uint64)
        sizes = np.array([len(r[4]) // 8 for r in rows])
        ends = np.repeat(np.cumsum(sizes), sizes)
        whole, node = node_classes(words, ends)
        row = np.repeat(np.arange(len(rows)), sizes)[whole]
        ids = np.array([r[1] for r in rows])
        least = np.full(int(node.max()) + 1, np.iinfo(np.int64).max)
        np.minimum.at(least, node, ids[row])
        repeat = np.flatnonzero(least[node] < ids[row])
        begin = np.cumsum(sizes) - sizes
        place = whole[repeat] - begin[row[repeat]]
        step = np.flatnonzero((np.diff(place) != 1) | (np.diff(row[repeat]) != 0))
        for a, e in zip(np.append(0, step + 1).tolist(), np.append(step, len(repeat) - 1).tolist(), strict=True) if len(repeat) else ():
            _, doc, mark, start, _ = rows[row[repeat[a]]]
            for column, x in zip(out, (doc, mark, start + int(place[a]), start + int(place[e])), strict=True):
                column.append(x)
        return out

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[list]:
        rows: list[tuple] = []
        group: list[tuple] = []  # rows of the group that is still coming in
        size = 0
        for b in batches:
            for r in zip(*(c.to_pylist() for c in b.columns), strict=True):
                if group and group[-1][0] != r[0]:
                    rows += group
                    group = []
                    if size >= BUILD_WORDS:
                        yield build(rows)
                        rows, size = [], 0
                group.append(r)
                size += len(r[4]) // 8
        yield build(rows + group)

    return map_arrow(pieces.repartition("name").sortWithinPartitions("name"), run, f"doc_id {kind}, mark long, first long, last long")


def node_repeats(found: DataFrame, kind: str) -> DataFrame:
    """Repeated suffixes of large groups: each node is named by both hashes of its ``WINDOW`` words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[list]:
        for batch in batches:
            for row in range(batch.num_rows):
                doc, t, mark, wanted = (c[row].as_py() for c in batch.columns)
                _, hashes, _, _, _ = documents_words(pa.array([t], pa.large_string()))
                at = np.flatnonzero(np.isin(group_names(hashes), np.array(wanted, np.int64).view(np.uint64)))
                node, check = (x[at].view(np.int64) for x in node_hashes(hashes))
                for k in range(0, len(at), NODE_ROWS):
                    part = at[k:k + NODE_ROWS]
                    yield [node[k:k + NODE_ROWS], check[k:k + NODE_ROWS], [doc] * len(part), [mark] * len(part), part]

    suffixes = map_arrow(found.select("doc_id", "text", "mark", "names"), run, f"node long, check long, doc_id {kind}, mark long, first long")
    least = cut(suffixes.groupBy("node", "check").agg(F.min("doc_id").alias("least"), F.max("doc_id").alias("most"))
                .where("least < most").select(F.col("node").alias("of"), F.col("check").alias("of_check"), "least"))
    return (suffixes.join(least, (F.col("node") == F.col("of")) & (F.col("check") == F.col("of_check"))).where("least < doc_id")
            .select("doc_id", "mark", "first", F.col("first").alias("last")))


def repeated_passages(docs: DataFrame, described: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Texts of the documents that share a group, and runs of repeated suffixes in them.

    ``described`` is ``describe(docs)`` without folded copies and null ids.
    """
    kind = docs.schema["doc_id"].dataType.simpleString()
    named = described.select("doc_id", "sha", F.explode("names").alias("name"))
    counted = named.select("name", "doc_id", F.lit(1).alias("one"), F.lit(0).cast("long").alias("words")).union(
        described.select(F.explode("longs").alias("e"), "doc_id").select("e.name", "doc_id", F.lit(0), "e.words"))
    shared = cut(counted.groupBy("name").agg(F.min("doc_id").alias("least"), F.max("doc_id").alias("most"), F.sum("one").alias("n"),
                                             F.sum("words").alias("words"))
                 .where("least < most").select(F.col("name").alias("of"), ((F.col("n") > GROUP_DOCS) | (F.col("words") > BUILD_WORDS)).alias("large")))
    lists = named.join(shared, F.col("name") == F.col("of")).groupBy("doc_id", "sha").agg(
        F.collect_list(F.when(~F.col("large"), F.col("name"))).alias("small_names"),
        F.collect_list(F.when(F.col("large"), F.col("name"))).alias("large_names"))
    ours = lists.withColumnRenamed("doc_id", "list_id")
    body = texts(docs.where("doc_id is not null"))

    def same_words(ids: list, text: list, sha: list, small: list, large: list) -> list:
        good = [hashlib.sha256(b" ".join(t.encode().split())).hexdigest() == s for t, s in zip(text, sha, strict=True)]
        return [[x for x, g in zip(column, good, strict=True) if g] for column in (ids, text, sha, small, large)]

    # rows that share an id but not the words meet the wrong list: drop those pairs
    met = body.join(ours, F.col("doc_id") == F.col("list_id")).select("doc_id", "text", "sha", "small_names", "large_names")
    found = cut(map_columns(met, same_words, f"doc_id {kind}, text string, sha string, small_names array<bigint>, large_names array<bigint>")
                .withColumn("mark", F.xxhash64("sha")))
    small = tree_repeats(segments(found.where(F.size("small_names") > 0).withColumn("names", F.col("small_names")), kind), kind)
    large = node_repeats(found.where(F.size("large_names") > 0).withColumn("names", F.col("large_names")), kind)
    return found.select("doc_id", "sha", "mark", "text"), small.union(large)


def remove_words(found: DataFrame, repeats: DataFrame, kind: str) -> DataFrame:
    """doc_id, sha, kept_text (kept words joined by a space) and n_removed of the documents with repeats."""
    runs = repeats.groupBy("doc_id", "mark").agg(F.collect_list(F.struct("first", "last")).alias("runs")).select(
        F.col("doc_id").alias("run_id"), F.col("mark").alias("run_mark"), "runs")

    def run(ids: list, sha: list, text: list, runs: list) -> list:
        kept, removed = [], []
        for t, spans in zip(text, runs, strict=True):
            words = t.encode().split()
            inside = np.zeros(len(words) + 1, np.int64)
            for span in spans:
                inside[span["first"]] += 1
                inside[span["last"] + WINDOW] -= 1
            keep = np.cumsum(inside)[:-1] == 0
            kept.append(b" ".join([words[i] for i in np.flatnonzero(keep)]).decode())
            removed.append(int((~keep).sum()))
        return [ids, sha, kept, removed]

    joined = found.join(runs, (F.col("doc_id") == F.col("run_id")) & (F.col("mark") == F.col("run_mark")))
    return map_columns(joined.select("doc_id", "sha", "text", "runs"), run, f"doc_id {kind}, sha string, kept_text string, n_removed long", 200)


def deduplicate_passages(docs: DataFrame) -> DataFrame:
    """doc_id, n_words, n_removed and kept_sha256 of every document."""
    kind = docs.schema["doc_id"].dataType.simpleString()
    described = cut(describe(docs))
    copies = cut(described.where(f"n_words >= {WINDOW} and doc_id is not null").groupBy("sha").agg(F.min("doc_id").alias("least"))
                 .select(F.col("sha").alias("of"), "least"))
    folded = described.join(copies, F.col("sha") == F.col("of"), "left").drop("of")
    own = folded.where("doc_id = least").select("doc_id", "sha", "names", "longs").dropDuplicates(["doc_id", "sha"])
    found, repeats = repeated_passages(docs, own)
    removed = cut(remove_words(found, repeats, kind).select(
        F.col("doc_id").alias("done_id"), F.col("sha").alias("done_sha"), "n_removed",
        F.sha2(F.col("kept_text").cast("binary"), 256).alias("kept")).dropDuplicates(["done_id", "done_sha"]))
    copy = F.col("doc_id") > F.col("least")
    return (folded.drop("names", "longs").join(removed, (F.col("doc_id") == F.col("done_id")) & (F.col("sha") == F.col("done_sha")), "left")
            .select("doc_id", "n_words",
                    F.when(copy, F.col("n_words")).otherwise(F.coalesce("n_removed", F.lit(0))).cast("long").alias("n_removed"),
                    F.when(copy, F.lit(EMPTY_SHA)).otherwise(F.coalesce("kept", "sha")).alias("kept_sha256")))
