import hashlib
from collections import Counter

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F
from tables import SF_SMALL
import tables

from cartographer.llm import queries, simhash


def brute_print(text):
    w = text.encode().lower().split()
    if not w:
        return 0
    h = [xxhash.xxh64_intdigest(b" ".join(w[i:i + 4]), 42) for i in range(max(1, len(w) - 3))]
    return sum(1 << k for k in range(64) if 2 * sum(x >> k & 1 for x in h) > len(h))


def brute_components(prints, ids):
    f = np.array(prints, np.uint64)
    near = np.bitwise_count(f[:, None] ^ f[None, :]) <= simhash.MAX_BITS
    label = np.arange(len(f))
    while True:
        new = np.where(near, label[None, :], len(f)).min(1)
        if (new == label).all():
            break
        label = new
    least = {}
    for k, i in zip(label, ids, strict=True):
        least[k] = i if least.get(k) is None else least[k] if i is None else min(i, least[k])
    return [least[k] for k in label]


def check(docs, got):
    ids, prints = [d for d, _ in docs], [brute_print(t) for _, t in docs]
    want = Counter((i, f"{p:016x}", c) for i, p, c in zip(ids, prints, brute_components(prints, ids), strict=True))
    assert Counter((r.doc_id, r.fingerprint, r.component_id) for r in got) == want


def test_query_against_all_pairs(spark):
    check(tables.small_documents(spark, SF_SMALL), queries.op4_simhash(spark, SF_SMALL).collect())


def test_awkward_rows(spark):
    rows = tables.awkward_rows()
    check(tables.clean(rows), simhash.digest(simhash.near_duplicates(tables.frame(spark, rows))).collect())


def test_empty_table(spark):
    assert simhash.near_duplicates(tables.empty(spark)).count() == 0
    assert simhash.deduplicate(tables.empty(spark)).count() == 0


@pytest.mark.parametrize(("group", "agree"), [(8, 2), (1024, 2), (1024, 3), (8, 4)])
def test_hot_buckets_lose_no_link(spark, monkeypatch, group, agree):
    """Fingerprints that crowd round a few centres: chains, large buckets, far ones."""
    monkeypatch.setattr(simhash, "GROUP", group)
    rng = np.random.default_rng(3)
    centres = rng.integers(0, 2**63, 4).astype(np.uint64)
    fps = {int(c) ^ sum(1 << int(b) for b in rng.choice(64, rng.integers(0, 7), replace=False)) for c in centres for _ in range(120)}
    fps = sorted(fps | {0, 1, 2**64 - 1})
    nodes = spark.createDataFrame([(simhash._signed(f),) for f in fps], "fp long")
    stars = {r.node: r.root for r in simhash.components(simhash.near_links(nodes, agree=agree)).collect()}
    got = [stars.get(simhash._signed(f), simhash._signed(f)) for f in fps]
    want = brute_components(fps, [simhash._signed(f) for f in fps])
    assert len(set(zip(got, want, strict=True))) == len(set(got)) == len(set(want))


@pytest.mark.parametrize("agree", [1, 2, 3, 4])
def test_masks_meet(agree):
    masks = simhash.block_masks(simhash.MAX_BITS, agree)
    rng = np.random.default_rng(1)
    for _ in range(300):
        diff = sum(1 << int(b) for b in rng.choice(64, simhash.MAX_BITS, replace=False))
        assert any(diff & m == 0 for m in masks)


def test_blocks_grow_with_the_nodes():
    sizes = [0, 10**6, 10**8, 10**9, 10**10, 10**11]
    chosen = [simhash.agreeing_blocks(n) for n in sizes]
    assert chosen == [2, 2, 2, 3, 4, 4]
    for n, k in zip(sizes, chosen, strict=True):
        bits = min(m.bit_count() for m in simhash.block_masks(simhash.MAX_BITS, k))
        assert n / 2 ** (bits + 1) <= simhash.MEAN_BUCKET  # blocks are rounded to whole bits


def test_deduplicate_keeps_one_row_of_each_group(spark):
    """Of every component of rows the least by (id, nulls last) and text digest; rows sharing an id are told apart by text."""
    rows = tables.awkward_rows()
    kept = simhash.deduplicate(tables.frame(spark, rows))
    assert kept.columns == tables.frame(spark, rows).columns
    mark = lambda t: hashlib.md5((t or "").encode()).hexdigest()
    ranked = sorted(range(len(rows)), key=lambda i: (rows[i][0] is None, rows[i][0] or 0, mark(rows[i][1])))
    place = {i: k for k, i in enumerate(ranked)}
    least = brute_components([brute_print(r[1] or "") for r in rows], [place[i] for i in range(len(rows))])
    want = Counter({(rows[ranked[k]][0], rows[ranked[k]][1] or "") for k in least})
    assert Counter((r.doc_id, r.text or "") for r in kept.collect()) == want


def test_deduplicate_with_shared_and_null_ids(spark):
    rows = [(1, "a b c d e", "en", "s", 1), (1, "totally other words stand here now", "en", "s", 1), (2, "a b c d e", "en", "s", 1),
            (None, "copies without an id are reduced too", "en", "s", 1), (None, "copies without an id are reduced too", "en", "s", 1)]
    got = Counter((r.doc_id, r.text) for r in simhash.deduplicate(tables.frame(spark, rows)).collect())
    assert got == Counter([(1, "a b c d e"), (1, "totally other words stand here now"), (None, "copies without an id are reduced too")])
