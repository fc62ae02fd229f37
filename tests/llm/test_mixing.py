import hashlib
import math
import re
from collections import Counter, defaultdict

import pytest
import tables
from tables import SF_SMALL

from cartographer.llm import mixing, queries


def brute_mix(rows, target=mixing.TARGET_ENTROPY, repeats=mixing.MAX_REPEATS, budget=None):
    docs = {}
    for doc, text, _, source, _ in rows:
        n = len(re.findall(r"[^ \t\n\x0b\f\r]+", text or ""))
        old = docs.get(doc, (None, 0))
        named = [s for s in (old[0], source) if s is not None]
        docs[doc] = (min(named) if named else None, old[1] + n)
    tokens = Counter()
    for s, n in docs.values():
        tokens[s] += n
    tokens = {s: n for s, n in tokens.items() if n}
    if not tokens:
        return Counter()
    total = sum(tokens.values())
    budget = total if budget is None else budget
    share = {s: n / total for s, n in tokens.items()}

    def weights(alpha):
        z = sum(x ** alpha for x in share.values())
        return {s: x ** alpha / z for s, x in share.items()}

    def entropy(w):
        return -sum(x * math.log(x) for x in w.values())

    # the whole grid at a coarser step is too slow; bisection on the same grid
    def largest(holds):
        low, high = 0, mixing.STEPS + 1
        while high - low > 1:
            mid = (low + high) // 2
            low, high = (mid, high) if holds(weights(mid / mixing.STEPS)) else (low, mid)
        return low

    flat = largest(lambda w: entropy(w) >= target * math.log(len(share)))
    most = lambda w: max(w[s] / share[s] for s in share) * budget / total
    over = largest(lambda w: most(w) > repeats) + 1 if most(weights(0)) > repeats else 0
    w = weights(min(max(flat, over), mixing.STEPS) / mixing.STEPS)
    out = Counter()
    for s in share:
        quota = math.floor(w[s] * budget * mixing.SLACK)
        mine = [(i, n) for i, (k, n) in docs.items() if k == s]
        for block in range(quota // tokens[s] + 1):
            at = block * tokens[s]
            for _, i, n in sorted((hashlib.md5(f"{mixing.SEED}:{block}:{'' if i is None else i}".encode()).hexdigest(), i, n) for i, n in mine):
                if quota > 0 and at + n <= quota:
                    out[(i, s, block, at, n, quota)] += 1
                at += n
    return out


def as_counter(df):
    return Counter((r.doc_id, r.source, r.block, r.start, r.n_tokens, r.quota) for r in df.collect())


def test_query(spark):
    rows = [(r.doc_id, r.text, None, r.source, None) for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").collect()]
    assert as_counter(queries.op5_mixing(spark, SF_SMALL)) == brute_mix(rows)


@pytest.mark.parametrize("limits", [{}, {"target_entropy": 1.0}, {"target_entropy": 1.0, "max_repeats": 1.5}, {"target_entropy": 0.0},
                                    {"budget": 1000}, {"budget": 400_000, "target_entropy": 1.0, "max_repeats": 20.0}])
def test_awkward_rows(spark, limits):
    rows = tables.awkward_rows()
    want = brute_mix(rows, limits.get("target_entropy", mixing.TARGET_ENTROPY), limits.get("max_repeats", mixing.MAX_REPEATS), limits.get("budget"))
    assert as_counter(mixing.mix(tables.frame(spark, rows), **limits)) == want


def test_documents_follow_the_mixture(spark):
    rows = tables.awkward_rows()
    docs = tables.frame(spark, rows)
    mixed = mixing.mix_documents(docs, target_entropy=1.0)
    assert mixed.columns == docs.columns
    drawn = Counter(k[0] for k, n in brute_mix(rows, 1.0).items() for _ in range(n))
    held = defaultdict(int, Counter(r[0] for r in rows))
    assert Counter(r.doc_id for r in mixed.collect()) == {i: n * held[i] for i, n in drawn.items()}


def test_a_whole_pass_holds_every_document(spark):
    rows = [(i, "w " * (i % 7 + 1), None, f"s{i % 3}", 1) for i in range(60)]
    assert mixing.mix(tables.frame(spark, rows), target_entropy=0.0).count() == 60


def test_empty_and_blank_tables(spark):
    assert mixing.mix(tables.empty(spark)).count() == 0
    assert mixing.mix_documents(tables.empty(spark)).count() == 0
    assert mixing.mix(tables.frame(spark, [(1, None, None, "a", None), (2, " ", None, "b", 1)])).count() == 0


def test_plan_has_no_python(spark):
    plan = mixing.mix_documents(tables.frame(spark, tables.awkward_rows()))._jdf.queryExecution().toString()
    assert not re.search("Python|Pandas|MapInArrow", plan)
