"""I-Match fingerprints over randomised lexicons.

Terms (lower-case runs of letters and digits) whose inverse document
frequency lies in a chosen band form the lexicon. A document's signature for
a lexicon subset is a hash of its sorted distinct terms in that subset; its
fingerprint is the row of signatures for several random subsets. Subsets come
in levels of falling density, so that documents of any length have subsets
that hold about one of their terms; a signature there survives an edit that
spares those terms.

The likeness of two fingerprints is the share of equal signatures among those
that are not empty in both, from the sparsest level where at least half are
not to the sparsest of all.
That estimates the overlap of the two term sets.

The fingerprint of a text with less than ``LEAST_KNOWN`` of its terms in the
lexicon has a second row of signatures, of random subsets of all its terms. It
decides where the lexicon says little about one of two such texts:
their terms are in a large group of copies (above the band), in a rare language
(below it) or in a script without spaces. Terms of more than ``LONG_TERM`` bytes
count there as the sequences of ``GRAM_BYTES`` bytes in them.

The lexicon holds at most (distinct terms of a mean document) / ``MIN_SHARE``
terms whatever the size of the corpus, which bounds its broadcast. Document
frequencies are counted over all documents.

Null texts are empty. Documents are followed in the order of doc_id (nulls
first), then of a hash of the text; the first document follows the last.
Equal texts have equal fingerprints; repeated rows count as documents.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import TERMS, cut, documents_words, map_arrow, map_columns, mix, powers, slices, texts

#: Band of document frequency, as shares of all documents (idf from ln 10 to ln 2000); two documents at least.
MIN_SHARE, MAX_SHARE = 0.0005, 0.1
#: Densities of the lexicon subsets and subsets of each density.
DENSITIES = tuple(2.0 ** -k for k in (1, 3, 5, 7, 9, 11))
SUBSETS = 16
DIGITS = 4
#: Bytes from which a term is no word (scripts without spaces), and of the sequences that stand for it.
LONG_TERM, GRAM_BYTES = 40, 9
#: Share of a text's terms in the lexicon from which the lexicon's signatures suffice.
LEAST_KNOWN = 0.5
#: Documents of a range of ids that are followed in one task; the most ranges.
RANGE_ROWS, MOST_RANGES = 1000, 100_000
_EMPTY = "0" * DIGITS
PART = len(DENSITIES) * SUBSETS * DIGITS  # of a fingerprint: the lexicon's signatures, then those of all terms

_SEEDS = mix(np.arange(1, len(DENSITIES) * SUBSETS + 1, dtype=np.uint64) * np.uint64(0xD6E8FEB86659FD93))
_LIMITS = np.repeat(np.array([int(d * 2 ** 64) - 1 for d in DENSITIES], np.uint64), SUBSETS)


def _distinct(hashes: np.ndarray, doc: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct hashes of each of ``n`` documents, and its first (n + 1 values)."""
    order = np.lexsort((hashes, doc))
    hashes, doc = hashes[order], doc[order]
    new = np.ones(len(hashes), bool)
    new[1:] = (hashes[1:] != hashes[:-1]) | (doc[1:] != doc[:-1])
    return hashes[new], np.searchsorted(doc[new], np.arange(n + 1))


def distinct_terms(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct term hashes of each document, and its first (n + 1 values)."""
    _, hashes, _, _, bounds = documents_words(column, TERMS)
    n = len(bounds) - 1
    return _distinct(hashes, np.repeat(np.arange(n), np.diff(bounds)), n)


def with_grams(column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """``distinct_terms``, then the same with byte sequences in place of long terms."""
    data, hashes, first, end, bounds = documents_words(column, TERMS)
    n = len(bounds) - 1
    doc = np.repeat(np.arange(n), np.diff(bounds))
    terms = _distinct(hashes, doc, n)
    long = end - first > LONG_TERM
    if not long.any():
        return *terms, *terms
    grams, of = [hashes[~long]], [doc[~long]]
    for a, e, d in zip(first[long].tolist(), end[long].tolist(), doc[long].tolist(), strict=True):
        value = np.lib.stride_tricks.sliding_window_view(TERMS[data[a:e]], GRAM_BYTES)
        grams.append(np.unique(mix((value * powers(GRAM_BYTES)).sum(1, dtype=np.uint64))))
        of.append(np.full(len(grams[-1]), d))
    return *terms, *_distinct(np.concatenate(grams), np.concatenate(of), n)


def document_frequencies(docs: DataFrame) -> DataFrame:
    """term (hash) and the number of documents that hold it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[list]:
        held: list[tuple[np.ndarray, np.ndarray]] = []

        def merged() -> tuple[np.ndarray, np.ndarray]:
            terms, counts = (np.concatenate(x) for x in zip(*held, strict=True))
            order = np.argsort(terms, kind="stable")
            first = np.flatnonzero(np.diff(terms[order], prepend=terms[order[:1]] + np.uint64(1)))
            return terms[order][first], np.add.reduceat(counts[order], first)

        for b in slices(batches):
            terms = distinct_terms(b.column(1))[0]
            if len(terms):
                held.append(np.unique(terms, return_counts=True))
            if sum(len(t) for t, _ in held) > 2_000_000:
                held = [merged()]
                if len(held[0][0]) > 1_000_000:
                    yield [held[0][0].view(np.int64), held[0][1]]
                    held = []
        if held:
            terms, counts = merged()
            yield [terms.view(np.int64), counts]

    return map_arrow(texts(docs), run, "term long, n long").groupBy("term").agg(F.sum("n").alias("n"))


def lexicon(docs: DataFrame, min_share: float = MIN_SHARE, max_share: float = MAX_SHARE) -> np.ndarray:
    """Sorted hashes of the terms in the band."""
    n = docs.count()
    kept = document_frequencies(docs).where((F.col("n") >= max(2.0, min_share * n)) & (F.col("n") <= max_share * n))
    return np.sort(np.array([r[0] for r in kept.select("term").toLocalIterator()], np.int64).view(np.uint64))


def _signatures(out: np.ndarray, subset: np.ndarray | int, doc: np.ndarray, terms: np.ndarray) -> None:
    """Fills the signatures of one subset, or of a subset per term; terms are sorted within document and subset."""
    if not len(terms):
        return
    cell = doc * out.shape[1] + subset
    first = np.flatnonzero(np.diff(cell, prepend=-1))
    sizes = np.diff(np.append(first, len(cell)))
    place = np.arange(len(cell)) - np.repeat(first, sizes)
    signature = mix(np.add.reduceat(mix(terms) * powers(int(sizes.max()))[place], first)) & np.uint64(0xFFFF)
    out.reshape(-1)[cell[first]] = np.maximum(signature, np.uint64(1))


def _all_terms(terms: np.ndarray, doc: np.ndarray, n: int) -> np.ndarray:
    """Signatures of subsets of all terms: of a level's classes of equal hash bits, ``SUBSETS`` are subsets."""
    out = np.zeros((n, len(_SEEDS)), np.uint64)
    for level, density in enumerate(DENSITIES):
        bits, at = round(-np.log2(density)), level * SUBSETS
        drawn = mix(terms ^ _SEEDS[at])
        if 2 ** bits >= SUBSETS:
            own = (drawn & np.uint64(2 ** bits - 1)).astype(np.int64)
            chosen = np.flatnonzero(own < SUBSETS)
            order = chosen[np.lexsort((own[chosen], doc[chosen]))]  # stable: terms stay sorted
            _signatures(out, at + own[order], doc[order], terms[order])
        else:  # fewer classes than subsets: bits of their own for each
            for k in range(SUBSETS):
                chosen = np.flatnonzero(drawn >> np.uint64(k * bits) & np.uint64(2 ** bits - 1) == 0)
                _signatures(out, at + k, doc[chosen], terms[chosen])
    return out


def fingerprints(column: pa.Array, words: np.ndarray) -> list[str]:
    """Fingerprint of each text: ``DIGITS`` hex digits per subset of the lexicon, then perhaps of all terms."""
    terms, bounds, every, every_bounds = with_grams(column)
    n = len(column)
    if len(words):
        at = np.minimum(np.searchsorted(words, terms), len(words) - 1)
        known = words[at] == terms
    else:
        known = np.zeros(len(terms), bool)
    mine, of = terms[known], np.repeat(np.arange(n), np.diff(bounds))[known]
    out = np.zeros((n, len(_SEEDS)), np.uint64)
    for k, (seed, limit) in enumerate(zip(_SEEDS, _LIMITS, strict=True)):
        chosen = np.flatnonzero(mix(mine ^ seed) <= limit)
        _signatures(out, k, of[chosen], mine[chosen])
    result = [x.tobytes().hex() for x in out.astype(">u2")]
    sizes = np.diff(every_bounds)
    few = np.bincount(of, minlength=n) < LEAST_KNOWN * sizes
    doc = np.cumsum(few) - 1
    other = _all_terms(every[np.repeat(few, sizes)], np.repeat(doc[few], sizes[few]), int(few.sum()))
    for i, x in zip(np.flatnonzero(few).tolist(), other.astype(">u2"), strict=True):
        result[i] += x.tobytes().hex()
    return result


def _levels(a: str, b: str) -> list[tuple[int, int]]:
    """Signatures that are not empty in both, and equal ones, of each level."""
    width = DIGITS * SUBSETS
    levels = []
    for at in range(0, len(a), width):
        pairs = [(a[i:i + DIGITS], b[i:i + DIGITS]) for i in range(at, at + width, DIGITS)]
        pairs = [p for p in pairs if p != (_EMPTY, _EMPTY)]
        levels.append((len(pairs), sum(x == y for x, y in pairs)))
    return levels


def _start(levels: list[tuple[int, int]]) -> int:
    return max((i for i, x in enumerate(levels) if 2 * x[0] >= SUBSETS), default=-1)


def lexicon_says_little(a: str) -> bool:
    """No term in the lexicon, or so few beside all terms that their signatures end two levels (a factor of 16) before."""
    known, every = a[:PART], a[PART:]
    return known == "0" * PART or _start(_levels(known, known)) < _start(_levels(every, every)) - 1


def likeness(a: str, b: str) -> float:
    if a == b:
        return 1.0
    both = len(a) == len(b) == 2 * PART
    part = slice(PART, None) if both and (lexicon_says_little(a) or lexicon_says_little(b)) else slice(PART)
    levels = _levels(a[part], b[part])
    filled, equal = map(sum, zip(*levels[max(0, _start(levels)):], strict=True))
    return equal / filled if filled else 0.0


def edited(text: str, following: str) -> str:
    """``text`` with its last quarter replaced by the beginning of ``following``."""
    m = len(text) // 4
    return text[:len(text) - m] + following[:m]


def _press(text: str) -> bytes:
    raw = text.encode()
    return len(raw).to_bytes(8, "big") + pa.compress(raw, codec="zstd", asbytes=True)


def _unpress(data: bytes) -> str:
    return pa.decompress(data[8:], int.from_bytes(data[:8], "big"), codec="zstd", asbytes=True).decode()


def _compared(rows: list[tuple], following: list[tuple], words: np.ndarray) -> list[list]:
    """n_chars, hash and fingerprint of the edited text, and both likenesses, for rows (text, fingerprint)."""
    new = [edited(t, f[0]) for (t, _), f in zip(rows, following, strict=True)]
    prints = fingerprints(pa.array(new, pa.large_string()), words)
    return [[len(t) for t, _ in rows], [hashlib.sha256(t.encode()).hexdigest() for t in new], list(map(bytes.fromhex, prints)),
            [likeness(p, q) for (_, p), q in zip(rows, prints, strict=True)],
            [likeness(p, f[1]) for (_, p), f in zip(rows, following, strict=True)]]


RESULT = "n_chars long, edited_sha256 string, edited_fingerprint binary, near_edited double, near_next double, fingerprint binary"


def match_edited(docs: DataFrame) -> DataFrame:
    """Fingerprint of each document and of its edited text, and their likeness to each other and to the next document's.

    Documents are dealt out in ranges of doc_id and followed in order within a
    range; the last of a range meets the first of the next range in a second,
    small step over one row per range.
    """
    spark, kind = docs.sparkSession, docs.schema["doc_id"].dataType.simpleString()
    words = spark.sparkContext.broadcast(lexicon(docs))
    n = docs.count()
    ranges = max(1, min(MOST_RANGES, n // RANGE_ROWS))
    edges = docs.agg(F.percentile_approx("doc_id", [i / ranges for i in range(1, ranges)], max(10_000, 10 * ranges))).first()[0] if ranges > 1 else None
    edges = np.array(sorted(set(edges or [])), np.int64)

    def prints(batches: Iterator[pa.RecordBatch]) -> Iterator[list]:
        for b in slices(batches):
            ids, text = b.column(0).to_pylist(), b.column(1).to_pylist()
            place = [0 if i is None else 1 + int(np.searchsorted(edges, i, "right")) for i in ids]
            yield [ids, list(map(bytes.fromhex, fingerprints(b.column(1), words.value))), [hashlib.blake2b(t.encode(), digest_size=8).digest() for t in text],
                   [_press(t) for t in text], place]

    dealt = (map_arrow(texts(docs), prints, f"doc_id {kind}, fingerprint binary, tie binary, body binary, place int")
             .repartition("place").sortWithinPartitions("place", "doc_id", "tie"))

    def follow(batches: Iterator[pa.RecordBatch]) -> Iterator[list]:
        last = None  # the row whose follower is still to come
        for batch in batches:
            for at in range(0, batch.num_rows, 500):
                rows, firsts, follower, begins = [], [], [], []
                out: list[tuple] = []
                part = batch.slice(at, 500)
                for doc, fp, body, place in zip(*(part.column(c).to_pylist() for c in ("doc_id", "fingerprint", "body", "place")), strict=True):
                    text, fp = _unpress(body), fp.hex()
                    first = last is None or last[3] != place
                    if last is not None:
                        if first:
                            out.append((last[0], None, last[1], last[4], last[2], last[3]))  # the last of its range waits
                        else:
                            rows.append((last[1], last[2]))
                            follower.append((text, fp))
                            firsts.append((last[0], last[3], last[4]))
                    last = (doc, text, fp, place, first)
                yield _rows(firsts, rows, _compared(rows, follower, words.value), out)
        if last is not None:
            yield _rows([], [], [[], [], [], [], []], [(last[0], None, last[1], last[4], last[2], last[3])])

    def _rows(known: list, rows: list, got: list, waiting: list) -> list:
        head = [_press(r[0]) if k[2] else None for k, r in zip(known, rows, strict=True)] + [_press(w[2]) if w[3] else None for w in waiting]
        return [[k[0] for k in known] + [w[0] for w in waiting], *(g + [None] * len(waiting) for g in got),
                [bytes.fromhex(r[1]) for r in rows] + [bytes.fromhex(w[4]) for w in waiting], [k[1] for k in known] + [w[5] for w in waiting],
                head, [None] * len(known) + [_press(w[2]) for w in waiting]]

    done = cut(map_arrow(dealt, follow, f"doc_id {kind}, {RESULT}, place int, head binary, tail binary"))
    places = sorted(r[0] for r in done.where("tail is not null").select("place").collect())  # one per range
    after = spark.createDataFrame(list(zip(places, places[1:] + places[:1], strict=True)), "at int, then int")
    heads = done.where("head is not null").select(F.col("place").alias("then"), "head", F.col("fingerprint").alias("next_print"))
    open_ends = (done.where("tail is not null").join(F.broadcast(after), F.col("place") == F.col("at"))
                 .select("doc_id", "fingerprint", "tail", "then").join(heads, "then"))

    def close(ids: list, prints: list, tails: list, heads: list, next_prints: list) -> list:
        rows = [(_unpress(t), p.hex()) for t, p in zip(tails, prints, strict=True)]
        got = _compared(rows, [(_unpress(h), p.hex()) for h, p in zip(heads, next_prints, strict=True)], words.value)
        return [ids, *got, prints]

    closed = map_columns(open_ends.select("doc_id", "fingerprint", "tail", "head", "next_print"), close, f"doc_id {kind}, {RESULT}", 100)
    order = ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]
    written = {c: F.lower(F.hex(c)) for c in ("fingerprint", "edited_fingerprint")}  # as bytes until here
    return done.where("tail is null").select(*order).unionByName(closed.select(*order)).withColumns(written)
