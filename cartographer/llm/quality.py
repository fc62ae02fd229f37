"""Quality rules and a log-likelihood ratio of hashed n-grams.

Two multinomials over ``buckets`` hashed word n-grams (one and two words) are
counted over whole texts: one over trusted target documents, one over the raw
corpus (all documents). A document's score is the mean over its n-grams of
``log p(bucket | target) - log p(bucket | raw)``; every document whose score
reaches the threshold is kept, none is drawn at random. Log ratios are held as
integers of ``2 ** -SCALE_BITS``, so a score does not depend on the order of
summation.

Fixed rules come first: a document with too few words or too many repeated
word triples fails whatever its score.

Null texts have no words (score null). With no trusted document all ratios
are equal and only the fixed rules decide. Repeated rows count as often as
they occur.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import cut, documents_words, map_arrow, mix, slices, string_bytes, texts

#: Hash buckets of the two multinomials: the bound of the collected model.
BUCKETS = 1 << 14
#: Ids of trusted documents that are broadcast at most.
BROADCAST_IDS = 1_000_000
#: Added to each bucket's count, as a share of the mean count.
SMOOTHING = 0.5
SCALE_BITS = 24
#: Least mean log ratio of a document that is kept.
THRESHOLD = -0.1
MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50

_SYMBOL = np.zeros(256, bool)
_SYMBOL[np.frombuffer(b"#*$%&|<>", np.uint8)] = True
_STARTS = np.ones(256, bool)  # bytes that begin a code point and are no white space
_STARTS[128:192] = False
_STARTS[np.frombuffer(b" \t\n\x0b\x0c\r", np.uint8)] = False
_SECOND, _THIRD = np.uint64(0xD6E8FEB86659FD93), np.uint64(0xA0761D6478BD642F)


def ngram_buckets(hashes: np.ndarray, bounds: np.ndarray, buckets: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Bucket of each word; of each pair of neighbours; and whether a pair lies in one document."""
    one = (mix(hashes) % np.uint64(buckets)).astype(np.int64)
    two = (mix(hashes[:-1] * _SECOND + hashes[1:]) % np.uint64(buckets)).astype(np.int64)
    inside = np.ones(max(len(hashes) - 1, 0), bool)
    cuts = bounds[1:-1]
    inside[cuts[(cuts > 0) & (cuts < len(hashes))] - 1] = False
    return one, two, inside


def count_ngrams(docs: DataFrame, buckets: int = BUCKETS) -> DataFrame:
    """bucket, raw and target counts. ``docs`` has doc_id, text and the boolean ``trusted``.

    Each task adds up its own counts; the shuffle carries a row per bucket and task.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[list]:
        raw, target = np.zeros(buckets, np.int64), np.zeros(buckets, np.int64)
        for b in slices(batches):
            _, hashes, _, _, bounds = documents_words(b.column(1))
            one, two, inside = ngram_buckets(hashes, bounds, buckets)
            trusted = np.repeat(b.column(2).to_numpy(zero_copy_only=False).astype(bool), np.diff(bounds))
            for got, mask in ((raw, np.ones(len(one), bool)), (target, trusted)):
                got += np.bincount(one[mask], minlength=buckets)
                got += np.bincount(two[inside & mask[1:]], minlength=buckets)
        seen = np.flatnonzero(raw)
        yield [seen, raw[seen], target[seen]]

    return (map_arrow(texts(docs, "trusted"), run, "bucket long, raw long, target long")
            .groupBy("bucket").agg(F.sum("raw").alias("raw"), F.sum("target").alias("target")))


def log_ratios(counts: list[tuple[int, int, int]], buckets: int = BUCKETS) -> np.ndarray:
    """Integer log ratio of each bucket, in units of ``2 ** -SCALE_BITS``."""
    raw, target = np.zeros(buckets), np.zeros(buckets)
    for bucket, r, t in counts:
        raw[bucket], target[bucket] = r, t
    if not target.sum():
        return np.zeros(buckets, np.int64)
    share = lambda x: (x + SMOOTHING * x.sum() / buckets) / (x.sum() * (1 + SMOOTHING))
    return np.rint((np.log(share(target)) - np.log(share(raw))) * 2 ** SCALE_BITS).astype(np.int64)


def count_marked_grams(grams: DataFrame, buckets: int = BUCKETS) -> DataFrame:
    """bucket, raw and target counts from (grams, trusted): each document's buckets, one for every n-gram."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[list]:
        raw, target = np.zeros(buckets, np.int64), np.zeros(buckets, np.int64)
        for b in batches:
            for line, trusted in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                got = np.bincount(np.frombuffer(line, "<u4"), minlength=buckets)
                raw += got
                if trusted:
                    target += got
        seen = np.flatnonzero(raw)
        yield [seen, raw[seen], target[seen]]

    return (map_arrow(grams.select("grams", "trusted"), run, "bucket long, raw long, target long")
            .groupBy("bucket").agg(F.sum("raw").alias("raw"), F.sum("target").alias("target")))


def grams_of(docs: DataFrame, buckets: int = BUCKETS) -> DataFrame:
    """doc_id and the bucket of each of its n-grams (32 bit): what is shuffled in place of a text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[list]:
        for b in slices(batches):
            _, hashes, _, _, bounds = documents_words(b.column(1))
            one, two, inside = ngram_buckets(hashes, bounds, buckets)
            one, two, kept = one.astype("<u4"), two.astype("<u4"), np.append(inside, False)
            yield [b.column(0), [one[x:y].tobytes() + (two[x:y - 1][kept[x:y - 1]].tobytes() if y - x > 1 else b"")
                                 for x, y in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True)]]

    return map_arrow(texts(docs), run, f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, grams binary")


def fit_ratios(docs: DataFrame, trusted: DataFrame, buckets: int = BUCKETS, broadcast_ids: int = BROADCAST_IDS) -> np.ndarray:
    """Counts both multinomials; ``trusted`` holds the doc_ids of the target (nulls match nothing).

    One pass over the texts. Up to ``broadcast_ids`` trusted ids are broadcast to it; of more, the
    documents' n-gram buckets (no text) are joined with the ids by a shuffle.
    """
    ids = cut(trusted.select(F.col("doc_id").alias("trusted_id")).where("trusted_id is not null").distinct())
    flag = F.col("trusted_id").isNotNull().alias("trusted")
    if ids.count() <= broadcast_ids:
        marked = docs.select("doc_id", "text").join(F.broadcast(ids), F.col("doc_id") == F.col("trusted_id"), "left")
        counts = count_ngrams(marked.select("doc_id", "text", flag), buckets)
    else:
        marked = grams_of(docs, buckets).join(ids, F.col("doc_id") == F.col("trusted_id"), "left")
        counts = count_marked_grams(marked.select("grams", flag), buckets)
    return log_ratios([tuple(r) for r in counts.collect()], buckets)  # a row per bucket at most


def per_document(values: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Sum of each document's values, exact for integers."""
    sums = np.concatenate(([0], np.cumsum(values)))
    return sums[bounds[1:]] - sums[bounds[:-1]]


def repeated_words(hashes: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Per document, the words in three-word windows that occur twice or more in it."""
    n = len(hashes)
    if n < 3:
        return np.zeros(len(bounds) - 1, np.int64)
    doc = np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))
    inside = doc[:-2] == doc[2:]
    key = mix(hashes[:-2] * _SECOND + hashes[1:-1] * _THIRD + hashes[2:]) + mix(doc[2:].astype(np.uint64) * _SECOND)
    order = np.argsort(key, kind="stable")
    order = order[inside[order]]
    sorted_key = key[order]
    same = np.zeros(len(order) + 1, bool)
    same[1:-1] = sorted_key[1:] == sorted_key[:-1]
    starts = order[same[1:] | same[:-1]]
    covered = np.zeros(n, np.int64)
    for k in range(3):
        covered[starts + k] = 1
    return per_document(covered, bounds)


def duplicate_lines(text: str) -> int:
    """Lines with a word that equal an earlier line."""
    lines = [x for x in text.split("\n") if x.strip(" \t\x0b\x0c\r")]
    return len(lines) - len(set(lines))


RULES = ("n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, "
         "base_failed boolean, kept boolean, score double")


def apply_rules(docs: DataFrame, ratios: np.ndarray, threshold: float = THRESHOLD) -> DataFrame:
    """One row per document with its counts, score and verdict."""
    buckets = len(ratios)
    floor = int(np.ceil(threshold * 2 ** SCALE_BITS))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[list]:
        for b in slices(batches):
            text = b.column(1)
            data, hashes, _, _, bounds = documents_words(text)
            n_words = np.diff(bounds)
            _, offsets = string_bytes(text)
            places = offsets + np.arange(len(offsets))  # a separator stands after each document
            word_chars, n_symbols = per_document(_STARTS[data], places), per_document(_SYMBOL[data], places)
            lines = [duplicate_lines(t) if "\n" in t else 0 for t in text.to_pylist()]
            repeat = repeated_words(hashes, bounds)
            one, two, inside = ngram_buckets(hashes, bounds, buckets)
            total = ratios[one]
            total[1:] += np.where(inside, ratios[two], 0)
            total = per_document(total, bounds)
            n = n_words + np.maximum(n_words - 1, 0)
            failed = (n_words < MIN_WORDS) | (100 * repeat > MAX_REPEAT_PERCENT * n_words)
            score = np.where(n > 0, total / np.maximum(n, 1) / 2 ** SCALE_BITS, np.nan)
            yield [b.column(0), n_words, word_chars, n_symbols, lines, repeat, failed,
                   ~failed & (total >= floor * n), pa.array(score, from_pandas=True)]

    return map_arrow(texts(docs), run, f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, {RULES}")
