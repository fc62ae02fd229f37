import hashlib
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
import tables
from tables import SF_SMALL

from cartographer.llm import common, imatch, queries


def term_hash(term):
    return int(common.hash_words(np.frombuffer(term, np.uint8), common.TERMS)[0][0])


def terms_of(text):
    return set(re.findall(rb"[A-Za-z0-9\x80-\xff]+", text.encode().lower()))


def brute_lexicon(docs):
    df = Counter(t for _, text in docs for t in terms_of(text))
    return {t for t, n in df.items() if max(2, imatch.MIN_SHARE * len(docs)) <= n <= imatch.MAX_SHARE * len(docs)}


def check(docs, got):
    order = sorted(docs, key=lambda d: (d[0] is not None, d[0] or 0, hashlib.blake2b(d[1].encode(), digest_size=8).digest()))
    words = np.sort(np.array([term_hash(t) for t in brute_lexicon(docs)], np.uint64))
    want = Counter()
    for k, (i, text) in enumerate(order):
        following = order[(k + 1) % len(order)][1]
        m = len(text) // 4
        new = text[:len(text) - m] + following[:m]
        a, b, c = imatch.fingerprints(pa.array([text, new, following]), words)
        want[(i, len(text), hashlib.sha256(new.encode()).hexdigest(), a, b, imatch.likeness(a, b), imatch.likeness(a, c))] += 1
    assert Counter(tuple(r) for r in got.collect()) == want


def test_query(spark):
    check(tables.small_documents(spark, SF_SMALL), queries.op8_imatch(spark, SF_SMALL))


@pytest.mark.parametrize("rows", [2, 1000])
def test_awkward_rows_in_many_ranges(spark, monkeypatch, rows):
    monkeypatch.setattr(imatch, "RANGE_ROWS", rows)
    data = tables.awkward_rows()
    check(tables.clean(data), imatch.match_edited(tables.frame(spark, data)))


def test_single_and_empty_tables(spark):
    check([(1, "alone here")], imatch.match_edited(tables.frame(spark, [(1, "alone here", None, None, None)])))
    assert imatch.match_edited(tables.empty(spark)).count() == 0


def test_signature_is_of_sorted_distinct_terms():
    words = np.sort(np.array([term_hash(t) for t in (b"alpha", b"beta", b"gamma", b"delta")], np.uint64))
    a, b, c = imatch.fingerprints(pa.array(["alpha beta Gamma", "gamma, BETA beta alpha; other", "alpha delta"]), words)
    assert a == b != c
    assert imatch.likeness(a, b) == 1.0 and 0 <= imatch.likeness(a, c) < 1


def test_edits_stay_near_and_others_do_not(spark):
    got = queries.op8_imatch(spark, "/root/testdata/sf0.01").where("n_chars > 400").collect()
    assert np.mean([r.near_edited for r in got]) > 0.4
    assert np.median([r.near_next for r in got]) == 0
    assert np.mean([r.near_edited > r.near_next for r in got]) > 0.95


def test_copies_and_scripts_outside_the_band_keep_their_matches(spark):
    """A third of the rows are copies: their terms are too frequent for the lexicon; a script without spaces has none in it."""
    copy = tables.words(200, 50, 4000)
    chinese = "".join(chr(0x4E00 + x) for x in np.random.default_rng(5).integers(0, 3000, 400))
    rows = [(i, copy if i % 3 == 0 else tables.words(200, 51 + i, 4000), "en", "a", 1) for i in range(90)] + [(90, chinese, "zh", "a", 1)]
    got = {r.doc_id: r for r in imatch.match_edited(tables.frame(spark, rows)).collect()}
    near = [got[i].near_edited for i in [*range(0, 90, 3), 90]]
    assert np.mean(near) > 0.25 and min(near) > 0
    assert np.median([r.near_next for r in got.values()]) < 0.1
    check(tables.clean(rows), imatch.match_edited(tables.frame(spark, rows)))
