"""Language-model scores from a log-frequency Bloom filter of n-gram counts.

Tokens are the lower-cased words of a text and one end. Counts of all training
tokens and of all pairs of neighbours are aggregated exactly. A pair's count is
quantised to a level (1, 2, 3, then steps of ``BASE``), and the pair is put into a Bloom
filter once per level up to its own; a probe asks for level 1, 2, ... until one is
missing, so a stored pair never reads below its level, and a pair that was never
seen reads as seen once with odds of about 2^-HASHES. Token counts stand beside the
filter as a sorted table.

With c the exact token counts, N all and V distinct training tokens::

    P1(w)     = (c(w) + 0.1) / (N + 0.1 (V + 1))
    P(w | v)  = (c(v, w) + STRENGTH * P1(w)) / (c(v) + STRENGTH)

where c(v, w) is the least count of the level found, no more than c(v) and c(w); it
is 0 for an unseen pair. But for false positives the P(w | v) sum to 1 at most.
``base_score`` sums log10 P1, ``score`` sums log10 P(w | v) over a text's tokens.

Nothing is pruned: filter and table grow with the corpus. They are built in parts by
hash range, one shuffle for counting and building, and broadcast in slices of at
most ``SLICE_BYTES``; a task works on ``CHUNK_TOKENS`` tokens at a time and goes through the
slices one after the other, holding one, so its memory does not depend on the corpus.

Equal tokens are told by 64-bit hashes, as in the Bloom filter itself. Null and blank
texts are one end. A null doc_id is never held out. Without training documents N, V
and all counts are 0 and every token scores 0. Repeated rows count as often as they occur.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import WHITE, byte_classes, cut, documents_words, map_arrow, mix, slices, texts

#: Added to each count of the base estimate.
ADDED = 0.1
#: Pseudo-counts that a history gives to the base estimate; set, not tuned.
STRENGTH = 1000.0
#: Ratio of neighbouring quantisation levels.
BASE = 1.5
#: Probes per level, and bits per pair and level (HASHES / ln 2: half the bits are set).
HASHES = 6
BITS = 8.66
#: Bytes of text behind one part, about; parts are the rows in which the model is built.
PART_BYTES = 1 << 19
#: Most bytes of a slice (one part at least).
SLICE_BYTES = 64 << 20
#: Tokens that are counted, and scored, at once.
COUNT_TOKENS = 4_000_000
CHUNK_TOKENS = 2_000_000

CLASSES = byte_classes(WHITE, lower=True)
_START, _END = np.uint64(0x2545F4914F6CDD1D), np.uint64(0x5851F42D4C957F2D)
_A, _LEVEL = np.uint64(0x9E3779B97F4A7C15), 0xD1B54A32D192ED03


def levels(most: float = 2.0**62) -> np.ndarray:
    """Least count of each level."""
    out = [1]
    while out[-1] < most:
        out.append(max(out[-1] + 1, int(out[-1] * BASE)))
    return np.array(out, np.int64)


def tokens_of(column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hashes of all tokens, of the pair each makes with the one before, and n + 1 document bounds."""
    _, hashes, _, _, bounds = documents_words(column, CLASSES)
    bounds = bounds + np.arange(len(bounds))
    out = np.empty(bounds[-1], np.uint64)
    ends = np.zeros(len(out), bool)
    ends[bounds[1:] - 1] = True
    out[ends] = _END
    out[~ends] = hashes
    before = np.empty_like(out)
    before[1:] = out[:-1]
    before[bounds[:-1]] = _START
    return out, mix(before * _A + out), bounds


def held_out(doc_id: Column | str = "doc_id") -> Column:
    """One document in ten, by the checksum of its id."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 10 == 0, F.lit(False))


# --- building --------------------------------------------------------------


def bits_of(pairs: np.ndarray, level: np.ndarray, bits: float = BITS) -> np.ndarray:
    """The filter of one part, as bytes."""
    size = max(64, -(-int(level.sum() * bits) // 64) * 64)
    held = np.zeros(size, bool)
    for k in range(1, int(level.max(initial=0)) + 1):
        pairs, level = pairs[level >= k], level[level >= k]
        for place in probes(pairs, k, np.uint64(size)):
            held[place] = True
    return np.packbits(held, bitorder="little")


def level_key(pairs: np.ndarray, level: int) -> np.ndarray:
    return mix(pairs + np.uint64(_LEVEL * level % (1 << 64)))


def probes(pairs: np.ndarray, level: int, size: np.ndarray | np.uint64) -> Iterator[np.ndarray]:
    """``HASHES`` places in filters of ``size`` bits (under 2^32) for each pair at a level."""
    key = level_key(pairs, level)
    step, low = key >> np.uint64(32) | np.uint64(1), np.uint64(0xFFFFFFFF)
    for _ in range(HASHES):
        yield (key & low) * size >> np.uint64(32)
        key = key + step


def build(docs: DataFrame, parts: int, bits: float = BITS) -> DataFrame:
    """(part, n, v, words, counts, bits): training tokens and pairs by the leading bits of their hash.

    ``n`` and ``v`` are all and distinct tokens of the part; ``words`` its sorted hashes, ``counts`` their
    counts (both 64 bit), ``bits`` the filter of its pairs.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[list]:
        held, n = [], 0

        def rows() -> Iterator[list]:
            for kind in (0, 1):
                h, times = np.unique(np.concatenate([x[kind] for x in held]), return_counts=True)
                for a in range(0, len(h), 200_000):
                    yield [np.full(len(h[a:a + 200_000]), kind, np.int8), h[a:a + 200_000].view(np.int64), times[a:a + 200_000]]

        for batch in slices(batches):
            held.append(tokens_of(batch.column(1))[:2])
            n += len(held[-1][0])
            if n >= COUNT_TOKENS:
                yield from rows()
                held, n = [], 0
        if held:
            yield from rows()

    shift = 64 - (parts.bit_length() - 1)
    part = F.shiftrightunsigned("h", shift) if parts > 1 else F.lit(0).cast("long")
    counted = map_arrow(texts(docs), count, "kind tinyint, h bigint, n bigint").withColumn("part", part)
    summed = counted.repartition("part").groupBy("part", "kind", "h").agg(F.sum("n").alias("n"))
    steps = levels()

    def fill(batches: Iterator[pa.RecordBatch]) -> Iterator[list]:
        held: list[tuple] = []

        def row() -> list:
            kind, h, n = (np.concatenate(c) for c in zip(*(x[1:] for x in held), strict=True))
            word = kind == 0
            words, counts = h[word].view(np.uint64), n[word]
            by = np.argsort(words)
            filled = bits_of(h[~word].view(np.uint64), np.searchsorted(steps, n[~word], "right"), bits)
            return [[held[0][0]], [int(counts.sum())], [len(words)], [words[by].astype("<u8").tobytes()],
                    [counts[by].astype("<i8").tobytes()], [filled.tobytes()]]

        for batch in batches:
            part, *values = (c.to_numpy() for c in batch.columns)
            edges = np.flatnonzero(np.diff(part)) + 1
            for a, b in zip([0, *edges], [*edges, len(part)], strict=True):
                if held and held[0][0] != part[a]:
                    yield row()
                    held = []
                if b > a:
                    held.append((int(part[a]), *(v[a:b] for v in values)))
        if held:
            yield row()

    return map_arrow(summed.sortWithinPartitions("part"), fill, "part bigint, n bigint, v bigint, words binary, counts binary, bits binary")


@dataclass
class Slice:
    """Parts ``first`` to ``first + len(size) - 1`` of the model."""

    first: int
    shift: int
    words: np.ndarray
    counts: np.ndarray
    start: np.ndarray  # first bit of each part
    size: np.ndarray   # its number of bits
    bits: np.ndarray

    def parts(self, hashes: np.ndarray) -> np.ndarray:
        """Number of each hash's part here; negative or too large for those of other slices."""
        if self.shift == 64:
            return np.zeros(len(hashes), np.int64)
        return (hashes >> np.uint64(self.shift)).astype(np.int64) - self.first

    def count(self, words: np.ndarray) -> np.ndarray:
        """Exact counts of sorted distinct words, 0 for words of other slices."""
        if not len(self.words):
            return np.zeros(len(words), np.int64)
        at = np.minimum(np.searchsorted(self.words, words), len(self.words) - 1)
        return np.where(self.words[at] == words, self.counts[at], 0)

    def level(self, pairs: np.ndarray) -> np.ndarray:
        """Levels found for pairs, 0 for unseen ones and those of other slices."""
        out = np.zeros(len(pairs), np.uint8)
        part = self.parts(pairs)
        alive = np.flatnonzero((part >= 0) & (part < len(self.size)))
        alive = alive[self.size[part[alive]] > 0]
        start, size, k = self.start[part[alive]], self.size[part[alive]], 0
        while len(alive):
            k += 1
            key = level_key(pairs[alive], k)
            step = key >> np.uint64(32) | np.uint64(1)
            for _ in range(HASHES):  # the same places as ``probes``, for those still there
                place = start + ((key & np.uint64(0xFFFFFFFF)) * size >> np.uint64(32))
                good = np.flatnonzero(self.bits[place >> np.uint64(3)] >> (place & np.uint64(7)).astype(np.uint8) & 1)
                if len(good) < len(alive):
                    alive, start, size, key, step = alive[good], start[good], size[good], key[good], step[good]
                key = key + step
            out[alive] = k
        return out


@dataclass
class Model:
    """Totals of the training tokens and the broadcast slices of the filter."""

    tokens: int
    distinct: int
    slices: list[Broadcast]


def fit(docs: DataFrame, bits: float = BITS) -> Model:
    """Counts all given documents; the caller leaves out the held-out ones."""
    spark = docs.sparkSession
    size = docs.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
    parts = 1 << (int(size) // PART_BYTES).bit_length()
    shift = 64 - (parts.bit_length() - 1)
    built = cut(build(docs, parts, bits))
    held = sum(F.length(c) for c in ("words", "counts", "bits"))
    n, v, held = built.agg(*(F.coalesce(F.sum(c), F.lit(0)) for c in ("n", "v", held))).first()
    number = min(parts, -(-held // SLICE_BYTES)) or 1
    out = []
    for s in range(number):
        a, b = parts * s // number, parts * (s + 1) // number
        rows = sorted(built.where((F.col("part") >= a) & (F.col("part") < b)).select("part", "words", "counts", "bits").toArrow().to_pylist(),
                      key=lambda r: r["part"])
        join = lambda name, kind: np.frombuffer(b"".join(r[name] for r in rows), kind)  # noqa: E731, B023
        sizes = np.zeros(b - a, np.uint64)
        sizes[[r["part"] - a for r in rows]] = [8 * len(r["bits"]) for r in rows]
        out.append(spark.sparkContext.broadcast(Slice(
            a, shift, join("words", "<u8"), join("counts", "<i8"), np.cumsum(sizes) - sizes, sizes, join("bits", np.uint8))))
        del rows
    return Model(int(n), int(v), out)


# --- scoring ---------------------------------------------------------------


def chunks(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[tuple[list[pa.RecordBatch], np.ndarray, np.ndarray, np.ndarray]]:
    """Batches of about ``size`` tokens together, with their tokens, pairs and document bounds."""
    held, n = [], 0

    def joined():
        shift = np.cumsum([0, *(len(x[1]) for x in held)])
        bounds = np.concatenate([[0], *(x[3][1:] + s for x, s in zip(held, shift, strict=False))])
        return [x[0] for x in held], np.concatenate([x[1] for x in held]), np.concatenate([x[2] for x in held]), bounds

    for batch in slices(batches):
        held.append((batch, *tokens_of(batch.column(1))))
        n += len(held[-1][1])
        if n >= size:
            yield joined()
            held, n = [], 0
    if held:
        yield joined()


def score(docs: DataFrame, model: Model, strength: float = STRENGTH) -> DataFrame:
    """doc_id, n_tokens, n_known, train_tokens, base_score and score of every row."""
    n, v, held = model.tokens, model.distinct, model.slices
    steps = np.append(0, levels())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[list]:
        for rows, tokens, pairs, bounds in chunks(batches, CHUNK_TOKENS):
            words, at = np.unique(tokens, return_inverse=True)
            count, level = np.zeros(len(words), np.int64), np.zeros(len(tokens), np.uint8)
            for broadcast in held:
                part = broadcast.value
                count += part.count(words)
                level += part.level(pairs)
                if len(held) > 1:  # one slice at a time: the file stays on the worker's disk
                    vars(broadcast).pop("_value", None)
            ended = count[words == _END].sum()  # each training document ended once
            base = (count + ADDED) / (n + ADDED * (v + 1))
            count, base = count[at], base[at]
            history = np.empty_like(count)
            history[1:] = count[:-1]
            history[bounds[:-1]] = ended
            pair = np.minimum(steps[level], np.minimum(count, history))
            each = lambda x: np.add.reduceat(x, bounds[:-1])  # noqa: E731, B023
            yield [pa.concat_arrays([b.column(0) for b in rows]), np.diff(bounds), each((count > 0).astype(np.int64)),
                   np.full(len(bounds) - 1, n), each(np.log10(base)), each(np.log10((pair + strength * base) / (history + strength)))]

    kind = docs.schema["doc_id"].dataType.simpleString()
    return map_arrow(texts(docs), run, f"doc_id {kind}, n_tokens bigint, n_known bigint, train_tokens bigint, base_score double, score double")


def score_documents(docs: DataFrame, bits: float = BITS) -> DataFrame:
    """Fits on the documents that are not held out and scores all."""
    scored = score(docs, fit(docs.where(~held_out()), bits))
    return scored.select("doc_id", held_out().alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score")
