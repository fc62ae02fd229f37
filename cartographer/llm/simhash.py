"""SimHash near-duplicates by pivot distance tables.

A document's fingerprint has bit b set if b is set in more than half of the
XXH64 hashes of its word shingles. Fingerprints link at ``max_bits`` or fewer
differing bits; documents of one connected component share its smallest id.

Pairs are found without comparing all with all:

* documents with equal fingerprints are folded into one node first;
* of ``max_bits + k`` blocks of the 64 bits, two linked fingerprints agree on
  k whole blocks, so nodes meet in one bucket per choice of k blocks; k is 2 and
  grows with the number of nodes, so that a bucket of evenly spread fingerprints
  holds at most ``MEAN_BUCKET`` of them at any size (no k loses a link);
* a bucket larger than ``GROUP`` is dealt out in chunks and every pair of
  chunks becomes a group of its own, so no task holds a large bucket;
* within a group the Hamming distances of every node to ``PIVOTS`` reference
  fingerprints are tabulated; a pair whose distances to any pivot differ by
  more than ``max_bits`` can't be linked (triangle inequality) and is
  discarded; the rest is verified by its exact Hamming distance;
* a group reports a spanning forest of its links, which keeps every
  connection and never all pairs.

Components come from alternating large-star and small-star rounds, each of
which is a join and a grouping over the remaining links.

Null texts are empty; a text without words has fingerprint zero, linked like
any other. Null ids form nodes too and lose to any id as a component's
smallest. Repeated rows each give a row.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import cut, map_arrow, map_columns, mix, texts

SHINGLE = 4
MAX_BITS = 4
SEED = 42
PIVOTS = 16
#: Nodes of two chunks that meet in one group.
GROUP = 1024
#: Nodes that a bucket of evenly spread fingerprints holds on average, at most.
MEAN_BUCKET = 64
PIVOT_FINGERPRINTS = mix(np.arange(1, PIVOTS + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))


def fingerprint(text: str, shingle: int = SHINGLE) -> int:
    words = text.encode("utf-8", "surrogatepass").lower().split()  # bytes: ASCII letters and white space only
    if not words:
        return 0
    line = b" ".join(words)
    n = max(1, len(words) - shingle + 1)
    lengths = np.fromiter(map(len, words), np.int64, len(words)) + 1
    ends = np.cumsum(lengths) - 1
    first = (ends + 1 - lengths)[:n].tolist()
    last = ends[min(shingle, len(words)) - 1:].tolist()
    digest = xxhash.xxh64_digest
    hashes = b"".join([digest(line[a:b], SEED) for a, b in zip(first, last, strict=True)])
    total = np.zeros(64, np.int64)
    rows = np.frombuffer(hashes, np.uint8).reshape(n, 8)
    for at in range(0, n, 1 << 16):
        total += np.unpackbits(rows[at:at + (1 << 16)], axis=1).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * total > n).tobytes(), "big")


#: Column that holds a text's digest while rows are told apart; inputs don't have it.
MARK = "simhash_text_md5"


def fingerprints(docs: DataFrame, shingle: int = SHINGLE, *others: str) -> DataFrame:
    """doc_id, the fingerprint as a signed long, and the named other columns."""

    def run(ids: list, text: list, *more: list) -> list:
        return [ids, np.array([fingerprint(t, shingle) for t in text], np.uint64).view(np.int64), *more]

    kinds = "".join(f", {c} {docs.schema[c].dataType.simpleString()}" for c in others)
    return map_columns(texts(docs, *others), run, f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, fp long{kinds}")


def agreeing_blocks(nodes: int, max_bits: int = MAX_BITS) -> int:
    """The least k of 2 or more whose buckets hold ``MEAN_BUCKET`` of ``nodes`` evenly spread fingerprints on average, at most.

    A bucket is named by k of ``max_bits + k`` blocks, 64 k / (max_bits + k) bits: at 4 bits
    k = 2 (21 bits, 15 keys a node) up to 1.3 * 10^8 nodes, 3 (27, 35) up to 8.6 * 10^9, 4 (32, 70) up to 2.7 * 10^11.
    """
    k = 2
    while max_bits + k < 64 and nodes > MEAN_BUCKET << (64 * k // (max_bits + k)):
        k += 1
    return k


def block_masks(max_bits: int, agree: int = 2) -> list[int]:
    """One mask for each choice of ``agree`` of ``max_bits + agree`` blocks: two
    fingerprints that differ in at most ``max_bits`` bits agree on one of the masks."""
    count = max_bits + agree
    edges = [round(i * 64 / count) for i in range(count + 1)]
    blocks = [((1 << b) - 1) ^ ((1 << a) - 1) for a, b in zip(edges, edges[1:], strict=False)]
    return [sum(chosen) for chosen in combinations(blocks, agree)]


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def group_links(key: np.ndarray, side: np.ndarray, fp: np.ndarray, max_bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Links of the rows whose keys are equal; rows stand in key order.

    In a group made of two chunks (sides 0 and 1) only pairs across count.
    """
    pivots = np.bitwise_count(fp[:, None] ^ PIVOT_FINGERPRINTS[None, :]).astype(np.int8)
    out_a, out_b = [], []
    alive = np.arange(len(fp) - 1)
    step = 1
    while len(alive):
        alive = alive[alive + step < len(fp)]
        alive = alive[key[alive] == key[alive + step]]
        a, b = alive, alive + step
        mask = (side[a] != side[b]) | (side[a] == 2)
        a, b = a[mask], b[mask]
        for p in range(PIVOTS):  # the table cuts pairs column by column
            if not len(a):
                break
            near = np.abs(pivots[a, p] - pivots[b, p]) <= max_bits
            a, b = a[near], b[near]
        linked = np.bitwise_count(fp[a] ^ fp[b]) <= max_bits
        out_a.append(a[linked])
        out_b.append(b[linked])
        step += 1
    return (np.concatenate(out_a), np.concatenate(out_b)) if out_a else (np.zeros(0, int), np.zeros(0, int))


def forest(a: np.ndarray, b: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Each node's smallest reachable node, for the nodes that have a link."""
    label = np.arange(n)
    while True:
        low = np.minimum(label[a], label[b])
        old = label.copy()
        np.minimum.at(label, a, low)
        np.minimum.at(label, b, low)
        np.minimum.at(label, old[a], low)
        np.minimum.at(label, old[b], low)
        label = label[label]
        if np.array_equal(old, label):
            break
    child = np.flatnonzero(label != np.arange(n))
    return child, label[child]


def near_links(nodes: DataFrame, max_bits: int = MAX_BITS, agree: int | None = None) -> DataFrame:
    """Links (a, b) between distinct fingerprints, a spanning forest per group.

    ``nodes`` has the distinct fingerprints as ``fp``; ``agree`` is the number of
    blocks that name a bucket, by default chosen from the number of nodes.
    """
    masks = block_masks(max_bits, agree or agreeing_blocks(nodes.count(), max_bits))
    keyed = nodes.select("fp", F.explode(F.array(*(
        F.xxhash64(F.lit(i), F.col("fp").bitwiseAND(F.lit(_signed(m)))) for i, m in enumerate(masks)))).alias("key"))
    sizes = cut(keyed.groupBy("key").agg(F.count("*").alias("n")).where("n > 1"))
    chunks = F.ceil(F.col("n") / (GROUP // 2)).cast("int")
    own = F.pmod(F.xxhash64("fp"), F.col("chunks")).cast("int")
    # a chunk meets itself and every other chunk of its bucket: side 2 within itself, else 0 and 1
    groups = (keyed.join(sizes, "key").withColumn("chunks", chunks).withColumn("own", own)
              .withColumn("other", F.explode(F.expr("sequence(0, chunks - 1)")))
              .select("fp", F.when(F.col("chunks") == 1, F.col("key")).otherwise(F.xxhash64(
                  "key", F.least("own", "other"), F.greatest("own", "other"))).alias("key"),
                  F.when(F.col("own") == F.col("other"), 2).when(F.col("own") < F.col("other"), 0).otherwise(1).alias("side")))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[list]:
        held: list[tuple] = []
        for b in batches:
            held.append(tuple(c.to_numpy(zero_copy_only=False) for c in b.columns))
            key = np.concatenate([h[1] for h in held])
            if len(key) < 4 * GROUP:
                continue
            whole = int(np.searchsorted(key == key[-1], True))  # keys before the last are complete
            columns = [np.concatenate(c) for c in zip(*held, strict=True)]
            yield links([c[:whole] for c in columns])
            held = [tuple(c[whole:] for c in columns)]
        if held:
            yield links([np.concatenate(c) for c in zip(*held, strict=True)])

    def links(columns: list[np.ndarray]) -> list:
        fp = columns[0].view(np.uint64)
        a, b = group_links(columns[1], columns[2], fp, max_bits)
        child, root = forest(a, b, len(fp))  # rows of one key only are linked, so trees stay within groups
        return [fp[child].view(np.int64), fp[root].view(np.int64)]

    dealt = groups.repartition("key").sortWithinPartitions("key")
    return map_arrow(dealt.select("fp", "key", "side"), run, "a long, b long").distinct()


def components(links: DataFrame, most_rounds: int = 50) -> DataFrame:
    """node and its component's smallest node, for the nodes of ``links`` (a, b).

    Large-star and small-star rounds until the links form stars round the
    smallest node of each component. A round groups by node with a partial
    minimum, so a node of many links costs a row per task; minima are cut off
    before they are joined, so that the join's exchanges can split such nodes.
    """
    now = cut(links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u <> v").distinct())
    mark = None
    for _ in range(most_rounds):
        both = now.select("u", "v").union(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = cut(both.groupBy("u").agg(F.min("v").alias("m")).select(F.col("u").alias("w"), F.least("u", "m").alias("m")))
        # large star: a node's larger neighbours point to its smallest
        large = (both.where("v > u").join(low, F.col("u") == F.col("w")).select(F.col("v").alias("u"), F.col("m").alias("v")).distinct())
        large = cut(large)
        # small star: a node and its smaller neighbours point to the smallest of these
        least = cut(large.groupBy("u").agg(F.min("v").alias("m")).select(F.col("u").alias("w"), "m"))
        joined = large.join(least, F.col("u") == F.col("w"))
        now = cut(joined.select(F.explode(F.array(F.struct(F.col("v").alias("u"), F.col("m").alias("v")),
                                                  F.struct("u", F.col("m").alias("v")))).alias("e"))
                  .select("e.u", "e.v").where("u <> v").distinct())
        seen = now.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if tuple(seen) == mark:
            return now.select(F.col("u").alias("node"), F.col("v").alias("root"))
        mark = tuple(seen)
    raise RuntimeError(f"components did not settle in {most_rounds} rounds")


def component_least(prints: DataFrame, least: Column, max_bits: int = MAX_BITS) -> tuple[DataFrame, DataFrame]:
    """(fp, root) of every distinct fingerprint, and (root, least) of every component: the smallest value of ``least``."""
    nodes = cut(prints.groupBy("fp").agg(F.min(least).alias("least")))
    stars = components(near_links(nodes.select("fp"), max_bits))
    rooted = cut(nodes.join(stars, F.col("fp") == F.col("node"), "left")
                 .select("fp", F.coalesce("root", "fp").alias("root"), "least"))
    return rooted.select("fp", "root"), cut(rooted.groupBy("root").agg(F.min("least").alias("least")))


def near_duplicates(docs: DataFrame, shingle: int = SHINGLE, max_bits: int = MAX_BITS) -> DataFrame:
    """doc_id, fp and component_id (the smallest doc_id reachable) of every document."""
    prints = cut(fingerprints(docs, shingle))
    rooted, least = component_least(prints, F.col("doc_id"), max_bits)
    named = rooted.join(least, "root").select(F.col("fp").alias("node"), F.col("least").alias("component_id"))
    return (prints.join(named, F.col("fp") == F.col("node"))
            .select("doc_id", "fp", "component_id"))


def deduplicate(docs: DataFrame, shingle: int = SHINGLE, max_bits: int = MAX_BITS) -> DataFrame:
    """One row of each component: the least by doc_id (nulls last), then by MD5 of the text (null: empty).

    Rows are told apart by id and text, so rows that share an id but hold different texts
    are judged each on its own component, and copies with a null id are reduced to one. Of
    rows alike in id and text one stays, whichever.
    """
    marked = docs.withColumn(MARK, F.md5(F.coalesce("text", F.lit(""))))
    prints = cut(fingerprints(marked, shingle, MARK))
    order = F.struct(F.col("doc_id").isNull().alias("missing"), F.col("doc_id").alias("id"), F.col(MARK).alias("mark"))
    _, least = component_least(prints, order, max_bits)
    # one key for the join and for the rows alike in it, so texts are shuffled once
    named = lambda id_, mark: F.concat_ws(":", mark, F.col(id_).cast("string"))
    keep = least.select(named("least.id", F.col("least.mark")).alias(MARK))
    first = marked.withColumn(MARK, named("doc_id", F.col(MARK))).join(keep, MARK, "left_semi")
    return first.dropDuplicates([MARK]).select(*docs.columns)


def digest(found: DataFrame) -> DataFrame:
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")
