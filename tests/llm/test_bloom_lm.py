import math
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
import tables

from cartographer.llm import bloom_lm, queries

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def tokens(text):
    return [*re.findall("[^\x20\x09-\x0d]+", (text or "").translate(LOWER)), None]


def out(doc_id):
    return doc_id is not None and zlib.crc32(str(doc_id).encode()) % 10 == 0


def brute_model(docs):
    """Token and pair counts, and a row's expected values, from plain dictionaries."""
    one, two, started = Counter(), Counter(), 0
    for d, t in docs:
        if not out(d):
            w = tokens(t)
            started += 1
            one.update(w)
            two.update(zip(["<start>", *w[:-1]], w, strict=True))
    n, v = sum(one.values()), len(one)
    steps = bloom_lm.levels()

    def row(doc_id, text):
        w = tokens(text)
        base = score = 0.0
        for before, x in zip(["<start>", *w[:-1]], w, strict=True):
            p = (one[x] + .1) / (n + .1 * (v + 1))
            c, h = two[(before, x)], started if before == "<start>" else one[before]
            c = min(int(steps[np.searchsorted(steps, c, "right") - 1]) if c else 0, one[x], h)
            base += math.log10(p)
            score += math.log10((c + bloom_lm.STRENGTH * p) / (h + bloom_lm.STRENGTH))
        return out(doc_id), len(w), sum(one[x] > 0 for x in w), n, base, score
    return row


def close(got, want, slack=0.0):
    assert got[:4] == want[:4]
    assert got[4] == pytest.approx(want[4], abs=1e-6, rel=1e-9)
    assert got[5] == pytest.approx(want[5], abs=1e-6 + slack, rel=1e-9)


def test_query_matches_brute_force(spark):
    """With a filter too sparse for false positives the scores are those of the quantised counts."""
    docs = tables.small_documents(spark, tables.SF_SMALL)
    row = brute_model(docs)
    real = {r.doc_id: tuple(r)[1:] for r in queries.op11_bloom_lm(spark, tables.SF_SMALL).collect()}
    table = spark.read.parquet(f"{tables.SF_SMALL}/documents.parquet")
    got = {r.doc_id: tuple(r)[1:] for r in bloom_lm.score_documents(table, bits=400.0).collect()}
    assert len(got) == len(real) == len(docs)
    for d, t in docs:
        want = row(d, t)
        close(got[d], want)
        # the real filter reads no pair lower; a false positive adds one count to some of the tokens
        assert real[d][:4] == want[:4] and want[5] - 1e-6 <= real[d][5] <= want[5] + 0.1 * want[1]


def test_awkward_rows_and_slices(spark, monkeypatch):
    rows = tables.awkward_rows()
    row = brute_model([(r[0], r[1]) for r in rows])
    want = sorted(((str(r[0]), *row(r[0], r[1])) for r in rows))
    for small in (False, True):
        if small:
            for name, value in (("PART_BYTES", 5_000), ("SLICE_BYTES", 100_000), ("COUNT_TOKENS", 700), ("CHUNK_TOKENS", 900)):
                monkeypatch.setattr(bloom_lm, name, value)
            assert len(bloom_lm.fit(tables.frame(spark, rows)).slices) > 3
        got = sorted((str(r.doc_id), *tuple(r)[1:]) for r in bloom_lm.score_documents(tables.frame(spark, rows), bits=400.0).collect())
        assert len(got) == len(want)
        for a, b in zip(got, want, strict=True):
            assert a[0] == b[0]
            close(a[1:], b[1:])


def test_empty_tables(spark):
    assert bloom_lm.score_documents(tables.empty(spark)).count() == 0
    none = bloom_lm.score(tables.frame(spark, [(1, "a b", "en", "s", 3)]), bloom_lm.fit(tables.empty(spark))).collect()
    assert [tuple(r) for r in none] == [(1, 3, 0, 0, 0.0, 0.0)]


def test_levels_are_never_read_too_low_and_rarely_too_high():
    rng = np.random.default_rng(2)
    pairs = rng.integers(0, 2**64, 60_000, np.uint64, endpoint=False)
    counts = rng.geometric(.5, 30_000) ** rng.integers(1, 4, 30_000)
    steps = bloom_lm.levels()
    level = np.searchsorted(steps, counts, "right")
    bits = bloom_lm.bits_of(pairs[:30_000], level)
    part = bloom_lm.Slice(0, 64, np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(1, np.uint64), np.array([8 * len(bits)], np.uint64), bits)
    found = part.level(pairs).astype(int)
    assert (found[:30_000] >= level).all()
    assert (found[:30_000] > level).mean() < 1.5 / 2**bloom_lm.HASHES + .01
    assert .3 / 2**bloom_lm.HASHES < (found[30_000:] > 0).mean() < 2 / 2**bloom_lm.HASHES
    assert (steps[level - 1] <= counts).all() and (counts < steps[level]).all()
    assert steps[:6].tolist() == [1, 2, 3, 4, 6, 9]


def test_probabilities_sum_to_one_at_most(spark):
    """P(x | a) from log10 P(a x end) = log10 P(a | start) + log10 P(x | a) + log10 P(end | x), over all x."""
    rng = np.random.default_rng(5)
    train = [(i, " ".join(rng.choice(list("abcde"), 30)), "en", "s", 1) for i in range(40)]
    model = bloom_lm.fit(tables.frame(spark, train), bits=400.0)
    words = [*"abcde", "never"]
    ask = [*(f"a {x}" for x in words), *words, "a"]
    got = {r.doc_id: r.score for r in bloom_lm.score(tables.frame(spark, [(i, t, "en", "s", 1) for i, t in enumerate(ask)]), model, strength=20.0).collect()}
    of = {t: got[i] for i, t in enumerate(ask)}
    one, two = Counter(), Counter()
    for r in train:
        w = tokens(r[1])
        one.update(w)
        two.update(zip(["<start>", *w[:-1]], w, strict=True))
    n, v, steps = sum(one.values()), len(one), bloom_lm.levels()

    def p(x, h, of_h):
        c = two[(h, x)]
        c = int(steps[np.searchsorted(steps, c, "right") - 1]) if c else 0
        return (c + 20 * (one[x] + .1) / (n + .1 * (v + 1))) / (of_h + 20)

    for x in words:
        want = math.log10(p("a", "<start>", len(train)) * p(x, "a", one["a"]) * p(None, x, one[x]))
        assert of[f"a {x}"] == pytest.approx(want, abs=1e-9)
    assert sum(p(x, "a", one["a"]) for x in [*words, None]) <= 1 + 1e-12


def test_word_order_matters(spark):
    rng = np.random.default_rng(3)
    line = [f"w{i}" for i in range(60)]
    docs = [(i, " ".join(line), "en", "s", 1) for i in range(40)]
    shuffled = " ".join(rng.permutation(line))
    model = bloom_lm.fit(tables.frame(spark, docs))
    got = {r.doc_id: r for r in bloom_lm.score(tables.frame(spark, [(1, " ".join(line), "en", "s", 1), (2, shuffled, "en", "s", 1)]), model, strength=5.0).collect()}
    assert got[1].base_score == pytest.approx(got[2].base_score) and got[1].score > got[2].score + 30


def test_pairs_of_tokens():
    hashes, pairs, bounds = bloom_lm.tokens_of(pa.array(["A b", "", "a B a b"]))
    assert bounds.tolist() == [0, 3, 4, 9]
    assert hashes[0] == hashes[4] and pairs[0] == pairs[4] and pairs[1] == pairs[5] == pairs[7] and pairs[3] != pairs[2] == pairs[8]
