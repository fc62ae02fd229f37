import math
import re
from collections import Counter

import numpy as np
import tables

from cartographer.llm import queries, strata
from cartographer.llm.common import cut

TERM = re.compile("[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def terms(text):
    return TERM.findall((text or "").translate(LOWER))


def brute_rank(docs, items, top=20):
    """Rows (item_id, rank, doc_id, score) by scoring every document for every item."""
    found = [(d, Counter(terms(t))) for d, t in docs if terms(t)]
    n, all_terms = len(found), sum(sum(c.values()) for _, c in found)
    df = Counter(t for _, c in found for t in c)
    out = []
    for item, text in items:
        asked = Counter(terms(text))
        scored = []
        for d, c in found:
            m = 75 + 25 * sum(c.values()) * n // all_terms
            score = sum(k * math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1))) * (10**9 * c[t] // (1000 * c[t] + 12 * m))
                        for t, k in asked.items() if t in c)
            if score > 0:
                scored.append((-score, d is None, d or 0, d))
        out += [(item, k + 1, d, -s) for k, (s, _, _, d) in enumerate(sorted(scored)[:top])]
    return Counter(out)


def test_query_matches_brute_force(spark):
    docs = tables.small_documents(spark, tables.SF_SMALL)
    items = [tuple(r) for r in spark.read.parquet(f"{tables.SF_SMALL}/benchmark.parquet").select("item_id", "text").collect()]
    got = Counter((r.item_id, r.rank, r.doc_id, r.score) for r in queries.op12_search(spark, tables.SF_SMALL).collect())
    assert got == brute_rank(docs, items) and len(got) == 20 * len(items)


def awkward_items(spark):
    rows = [(1, None), (2, ""), (3, "x y Y z"), (4, "same same one"), (4, "same same one"), (None, "a3 b7 c9 ÄRGER ärger"), (5, "nowhere-at-all"),
            (6, tables.words(300, 1)), (7, tables.words(70, 99))]
    return rows, spark.createDataFrame(rows, "item_id long, text string")


def test_awkward_rows(spark):
    rows = tables.awkward_rows()
    items, frame = awkward_items(spark)
    got = Counter(tuple(r) for r in strata.rank_documents(tables.frame(spark, rows), frame).collect())
    assert got == brute_rank([(r[0], r[1]) for r in rows], items)
    assert strata.rank_documents(tables.empty(spark), frame).count() == 0
    assert strata.rank_documents(tables.frame(spark, rows), frame.limit(0)).count() == 0


def test_small_segments_and_blocks(spark, monkeypatch):
    """Strata split into many groups, segments of a few documents, an item a block: the same rows."""
    rows = [(i, f"copy of a text {i % 2} b", "en", "s", 1) for i in range(90)] + tables.awkward_rows()
    items, frame = awkward_items(spark)
    items = [*items, (8, "copy text 1")]
    frame = frame.union(spark.createDataFrame([(8, "copy text 1")], frame.schema))
    monkeypatch.setattr(strata, "SEGMENT_POSTINGS", 40)
    monkeypatch.setattr(strata, "SEGMENT_DOCS", 3)
    monkeypatch.setattr(strata, "BLOCK_ITEMS", 2)
    got = Counter(tuple(r) for r in strata.rank_documents(tables.frame(spark, rows), frame, top=5).collect())
    assert got == brute_rank([(r[0], r[1]) for r in rows], items, top=5)


def test_segments_hold_one_stratum_with_postings_by_frequency(spark):
    docs = spark.read.parquet(f"{tables.SF_SMALL}/documents.parquet")
    stats = cut(strata.statistics(docs))
    n, all_terms = strata.totals(stats)
    texts = {r.doc_id: Counter(terms(r.text)) for r in docs.collect()}
    seen = 0
    for r in strata.build_index(docs, stats).collect():
        assert {75 + 25 * sum(texts[d].values()) * n // all_terms for d in r.docs} == {r.m}
        assert r.docs == sorted(r.docs)
        first, tf = np.frombuffer(r.firsts, "<u4"), np.frombuffer(r.tf, "<u4").astype(int)
        assert all((np.diff(tf[a:b]) <= 0).all() for a, b in zip(first[:-1], first[1:], strict=True))
        assert sorted(tf.tolist()) == sorted(v for d in r.docs for v in texts[d].values())
        seen += len(r.docs)
    assert seen == n


def test_bounds_leave_segments_out():
    """A segment whose bound is below the least score kept is not scored."""
    rng = np.random.default_rng(1)
    low, high = (strata.segment(m, [(m * 100 + d, np.array([5], np.uint64), np.array([t], "<u4")) for d, t in enumerate(tfs)])
                 for m, tfs in ((500, [1] * 30), (75, rng.integers(3, 9, 30))))
    rows = [(r[0][0], r[1][0], *(np.frombuffer(r[k][0], t) for k, t in ((2, "<u8"), (3, "<u4"), (4, "<u2"), (5, "<u4")))) for r in (low, high)]
    visitor, visited = strata.Visitor(strata.Query([0], [np.array([5], np.uint64)], {5: 7}), 20), []
    score = visitor.score
    visitor.score = lambda *a: (visited.append(a[-1][0]), score(*a))
    visitor.visit(rows)
    assert visited == [75] and len(visitor.best[0]) == 20
