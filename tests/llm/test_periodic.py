import hashlib
import random
import re
import time
import zlib

import numpy as np
import pytest
import tables

from cartographer.llm import periodic, queries


def brute_runs(words):
    """All maximal runs by trying every period and start."""
    n, out = len(words), []
    for q in range(1, n // periodic.EXPONENT + 1):
        same = [words[i] == words[i + q] for i in range(n - q)]
        i = 0
        while i < n - q:
            if not same[i]:
                i += 1
                continue
            j = i
            while j < n - q and same[j]:
                j += 1
            length = j - i + q
            smaller = any(all(words[x] == words[x + p] for x in range(i, i + length - p)) for p in range(1, q))
            if length >= max(6, 4 * q) and not smaller:
                out.append((i, length, q))
            i = j
    return sorted(out, key=lambda r: (r[0], r[2]))


def brute_row(doc_id, text, plant=True):
    words = re.findall("[^\x20\x09-\x0d]+", text or "")
    n = len(words)
    if plant and doc_id is not None and n:
        h = zlib.crc32(str(doc_id).encode())
        g = h // 10
        if h % 10 == 0:
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]
    runs = brute_runs(words)
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    best = min(runs, key=lambda r: (-r[1], r[0], r[2])) if runs else None
    kept = [w for i, w in enumerate(words) if not any(s + q <= i < s + n_ for s, n_, q in runs)]
    return (doc_id, len(runs), *((best[0], best[1], best[2], 1000 * best[1] // best[2]) if best else (None,) * 4),
            sha("".join(f"{s},{n_},{q}\n" for s, n_, q in runs)), sha(" ".join(kept)))


def test_trees_against_plain_extension():
    rng = random.Random(4)
    for _ in range(60):
        s = [rng.randint(1, rng.choice([1, 2, 5])) for _ in range(rng.randint(1, 60))] + [0]
        tree = periodic.ExtensionTree(s)
        assert tree.order.tolist() == sorted(range(len(s)), key=lambda i: s[i:])
        i, j = (np.array(x) for x in zip(*((i, j) for i in range(len(s)) for j in range(len(s)) if i != j), strict=True))
        want = [next(k for k in range(len(s)) if s[a + k] != s[b + k]) for a, b in zip(i.tolist(), j.tolist(), strict=True)]
        assert tree.extension(i, j).tolist() == want


def test_runs_against_brute_force():
    rng = random.Random(5)
    for _ in range(400):
        size, n = rng.choice([1, 2, 2, 3, 6]), rng.randint(0, 70)
        s = [rng.randint(0, size) for _ in range(n)]
        if n and rng.random() < .6:
            a, p = rng.randrange(n), rng.randint(1, 12)
            s = [x if i < a else s[a + (i - a) % p] for i, x in enumerate(s)]
        got = [tuple(r) for r in periodic.runs_of(np.array(s)).tolist()]
        assert got == brute_runs(s), s


def test_stretches_lose_no_run():
    rng = random.Random(6)
    for _ in range(60):
        docs = []
        for _ in range(8):
            n, size = rng.randint(0, 160), rng.choice([1, 3, 50])
            s = [str(rng.randint(0, size)) for _ in range(n)]
            for _ in range(2):
                if n:
                    a, p, m = rng.randrange(n), rng.randint(1, 30), rng.randint(4, 120)
                    s = [x if not a <= i < a + m else s[a + (i - a) % p] for i, x in enumerate(s)]
            docs.append(s)
        _, ids, bounds = periodic.numbered([" ".join(s).encode() for s in docs])
        got = {k: [] for k in range(len(docs))}
        for a, b in periodic.stretches(ids, bounds).tolist():
            doc = int(np.searchsorted(bounds, a, "right")) - 1
            got[doc] += [(s + a - bounds[doc], n, q) for s, n, q in periodic.runs_of(ids[a:b]).tolist()]
        assert got == {k: brute_runs(s) for k, s in enumerate(docs)}


def test_query_matches_brute_force(spark):
    docs = [d for d in tables.small_documents(spark, tables.SF_SMALL)]
    got = {r.doc_id: tuple(r) for r in queries.op13_periodic(spark, tables.SF_SMALL).collect()}
    assert len(got) == len(docs)
    some = 0
    for doc_id, text in docs:
        if len(text) < 12_000:
            assert got[doc_id] == brute_row(doc_id, text)
            some += got[doc_id][1] > 0
    assert some > 5


def test_awkward_rows(spark):
    rows = tables.awkward_rows()
    got = periodic.digest(periodic.periodic_runs(tables.frame(spark, rows))).collect()
    assert len(got) == len(rows)
    small = [r for r in rows if len(r[1] or "") < 6000]
    want = {brute_row(r[0], r[1], plant=False) for r in small}
    assert {tuple(r) for r in got} >= want
    assert periodic.digest(periodic.periodic_runs(periodic.planted(tables.frame(spark, rows)))).count() == len(rows)
    assert periodic.digest(periodic.periodic_runs(periodic.planted(tables.empty(spark)))).count() == 0


@pytest.mark.parametrize("text", ["a " * 60_000, "a b c d " * 15_000, " ".join(map(str, range(30_000))) + " x" * 9])
def test_long_texts(text):
    at = time.perf_counter()
    _, ids, bounds = periodic.numbered([text.encode()])
    found = [periodic.runs_of(ids[a:b]) for a, b in periodic.stretches(ids, bounds).tolist()]
    assert sum(map(len, found)) == 1 and time.perf_counter() - at < 30


def test_spans_and_collapsed_text(spark):
    rows = [(1, "start  buy now buy now buy now buy now\nend", "en", "s", 1), (2, "x x x x x", "en", "s", 1)]
    got = {r.doc_id: (r.collapsed, [tuple(x) for x in r.runs]) for r in periodic.periodic_runs(tables.frame(spark, rows)).collect()}
    assert got == {1: ("start buy now end", [(1, 8, 2)]), 2: ("x x x x x", [])}
