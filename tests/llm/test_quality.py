import math
import re
from collections import Counter

import numpy as np
from tables import SF_SMALL
import tables

from cartographer.llm import common, quality, queries

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute_rules(text):
    w = WORD.findall(text)
    grams = Counter(zip(w, w[1:], w[2:], strict=False))
    covered = {k + j for k in range(len(w) - 2) if grams[tuple(w[k:k + 3])] > 1 for j in range(3)}
    lines = [x for x in text.split("\n") if WORD.search(x)]
    return (len(w), sum(map(len, w)), sum(text.count(x) for x in "#*$%&|<>"), len(lines) - len(set(lines)), len(covered),
            len(w) < 50 or 100 * len(covered) > 50 * len(w))


def columns(r):
    return (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed)


def bucket_of(sequence):
    import pyarrow as pa
    _, hashes, _, _, bounds = common.documents_words(pa.array([" ".join(sequence)]))
    one, two, _ = quality.ngram_buckets(hashes, bounds, quality.BUCKETS)
    return int(one[0] if len(sequence) == 1 else two[0])


def test_query_against_brute_force(spark):
    docs = tables.small_documents(spark, SF_SMALL)
    trusted = {r.doc_id for r in spark.read.parquet(f"{SF_SMALL}/labels.parquet").where("quality = 1 and toxic = 0").collect()}
    grams, raw, target, known = {}, Counter(), Counter(), {}
    for doc, text in docs:
        w = WORD.findall(text)
        for g in [(x,) for x in w] + list(zip(w, w[1:], strict=False)):
            if g not in known:
                known[g] = bucket_of(g)
        grams[doc] = [known[g] for g in [(x,) for x in w] + list(zip(w, w[1:], strict=False))]
        raw.update(grams[doc])
        if doc in trusted:
            target.update(grams[doc])
    b, s = quality.BUCKETS, quality.SMOOTHING
    share = lambda c, k: (c[k] + s * c.total() / b) / (c.total() * (1 + s))
    got = {r.doc_id: r for r in queries.op3_quality(spark, SF_SMALL).collect()}
    for doc, text in docs:
        r, want = got[doc], brute_rules(text)
        assert columns(r) == want
        if grams[doc]:
            score = sum(math.log(share(target, k) / share(raw, k)) for k in grams[doc]) / len(grams[doc])
            assert abs(r.score - score) < 1e-6
            assert r.kept == (not want[-1] and score >= quality.THRESHOLD) or abs(score - quality.THRESHOLD) < 1e-6


def test_clean_documents_stay_and_junk_goes(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    got = queries.op3_quality(spark, "/root/testdata/sf0.01").join(labels, "doc_id").where("not base_failed").collect()
    assert docs.count() == 1000
    assert np.mean([r.kept for r in got if r.quality == 1]) > 0.99
    assert np.mean([r.kept for r in got if r.quality == 0]) < 0.5


def test_awkward_rows(spark):
    rows = tables.awkward_rows()
    docs = tables.frame(spark, rows)
    ratios = quality.fit_ratios(docs, spark.createDataFrame([(7,), (7,), (None,), (999,)], "doc_id long"))
    got = quality.apply_rules(docs, ratios).collect()
    want = Counter((i, brute_rules(t)) for i, t in tables.clean(rows))
    assert Counter((r.doc_id, columns(r)) for r in got) == want
    assert all((r.score is None) == (r.n_words == 0) for r in got)


def test_no_trusted_and_empty_tables(spark):
    docs, none = tables.empty(spark), spark.createDataFrame([], "doc_id long")
    assert quality.apply_rules(docs, quality.fit_ratios(docs, none)).count() == 0
    some = tables.frame(spark, tables.awkward_rows())
    got = quality.apply_rules(some, quality.fit_ratios(some, none)).collect()
    assert all(r.kept == (not r.base_failed) for r in got)


def test_every_trusted_document_counts(spark):
    docs = tables.frame(spark, [(i, tables.words(80, i), "en", "a", 1) for i in range(30)])
    trusted = spark.createDataFrame([(i,) for i in range(0, 30, 2)] + [(0,), (None,)], "doc_id long")
    whole = quality.fit_ratios(docs, trusted)
    assert whole.any() and (quality.fit_ratios(docs, trusted, broadcast_ids=4) == whole).all()
