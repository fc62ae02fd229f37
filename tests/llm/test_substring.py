import hashlib
import random
from collections import Counter

import numpy as np
import pytest
import tables
from tables import SF_SMALL

from cartographer.llm import queries, substring


def brute(docs):
    split = [(i, t.encode().split()) for i, t in docs]
    first = {}
    for i, w in split:
        for k in range(len(w) - 49):
            if i is not None:
                key = tuple(w[k:k + 50])
                first[key] = min(first.get(key, i), i)
    out = Counter()
    for i, w in split:
        gone = np.zeros(len(w), bool)
        for k in range(len(w) - 49):
            if i is not None and first[tuple(w[k:k + 50])] < i:
                gone[k:k + 50] = True
        kept = b" ".join(x for x, g in zip(w, gone, strict=True) if not g)
        out[(i, len(w), int(gone.sum()), hashlib.sha256(kept).hexdigest())] += 1
    return out


def as_counter(df):
    return Counter((r.doc_id, r.n_words, r.n_removed, r.kept_sha256) for r in df.collect())


@pytest.mark.parametrize("group", [2, 512])
def test_query(spark, monkeypatch, group):
    monkeypatch.setattr(substring, "GROUP_DOCS", group)
    assert as_counter(queries.op10_substring(spark, SF_SMALL)) == brute(tables.small_documents(spark, SF_SMALL))


@pytest.mark.parametrize("group", [1, 512])
def test_awkward_rows(spark, monkeypatch, group):
    monkeypatch.setattr(substring, "GROUP_DOCS", group)
    rows = tables.awkward_rows() + [(19, tables.words(200, 30), "en", "a", 1), (21, tables.words(100, 1), "en", "a", 1),
                                    (22, tables.words(49, 1), "en", "a", 1), (23, tables.words(50, 1), "en", "a", 1)]
    assert as_counter(substring.deduplicate_passages(tables.frame(spark, rows))) == brute(tables.clean(rows))


def test_shared_passages_at_random(spark, monkeypatch):
    """Passages of 45 to 60 words, chained, nested and repeated within documents."""
    monkeypatch.setattr(substring, "BUILD_WORDS", 2000)
    rng = random.Random(8)
    passages = [tables.words(rng.randint(45, 60), 100 + k, 5) for k in range(6)]
    rows = []
    for i in range(60):
        parts = [rng.choice([rng.choice(passages), tables.words(rng.randint(1, 30), 1000 + 10 * i + j, 5)]) for j in range(rng.randint(1, 5))]
        rows.append((i, rng.choice([" ", "\n"]).join(parts), None, None, None))
    assert as_counter(substring.deduplicate_passages(tables.frame(spark, rows))) == brute(tables.clean(rows))


def test_empty_table(spark):
    assert substring.deduplicate_passages(tables.empty(spark)).count() == 0


def test_nodes_are_classes_of_equal_windows():
    rng = np.random.default_rng(2)
    sizes = [0 + n for n in (5, 9, 30, 3, 40)]
    words = rng.integers(0, 2, sum(sizes)).astype(np.uint64)
    ends = np.repeat(np.cumsum(sizes), sizes)
    for window in (1, 2, 3, 5, 8):
        whole, node = substring.node_classes(words, ends, window)
        assert whole.tolist() == [i for i in range(len(words)) if i + window <= ends[i]]
        seen = {}
        for i, k in zip(whole, node, strict=True):
            assert seen.setdefault(tuple(words[i:i + window]), k) == k
        assert len(set(seen.values())) == len(seen)


def test_groups_of_many_words_are_built_without_a_tree(spark, monkeypatch):
    """Periodic text puts whole documents into one group, whatever their number."""
    rows = [(i, "buy now " * (2000 + i) + tables.words(60, i), "en", "a", 1) for i in range(4)] + [(9, tables.words(100, 1), "en", "a", 1)]
    built, small = [], substring.segments
    monkeypatch.setattr(substring, "BUILD_WORDS", 5000)
    monkeypatch.setattr(substring, "segments", lambda found, kind: built.append(small(found, kind)) or built[-1])
    assert as_counter(substring.deduplicate_passages(tables.frame(spark, rows))) == brute(tables.clean(rows))
    assert max((len(r.words) // 8 for r in built[0].collect()), default=0) <= substring.LONG_PIECE


def test_windows_that_share_a_hash_stay_apart(spark, monkeypatch):
    """With the first hash of every window forced to zero the second one alone keeps different windows apart."""
    true = substring.node_hashes

    def clash(hashes, window=50):
        first, second = true(hashes, window)
        return first * 0, second

    monkeypatch.setattr(substring, "GROUP_DOCS", 1)
    monkeypatch.setattr(substring, "node_hashes", clash)
    shared = tables.words(60, 7)
    rows = [(i, f"{tables.words(80, 100 + i)} {shared} {tables.words(70, 200 + i)}", "en", "a", 1) for i in range(8)]
    assert as_counter(substring.deduplicate_passages(tables.frame(spark, rows))) == brute(tables.clean(rows))


def test_the_two_hashes_of_a_window_are_independent():
    words = np.arange(1, 5000, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    first, second = substring.node_hashes(words)
    assert len(first) == len(second) == len(words) - 49 and not (first == second).any()
    again = substring.node_hashes(np.append(words[100:], words[:100]))
    assert (again[0][:4000] == first[100:4100]).all() and (again[1][:4000] == second[100:4100]).all()
