import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import tables

from cartographer.llm import language, queries


def test_held_out_accuracy(spark):
    sf = "/root/testdata/sf0.01"
    truth = {r.doc_id: r for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    got = queries.op7_language(spark, sf).collect()
    assert sorted(r.doc_id for r in got) == sorted(truth)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) and 0 <= r.score <= 1 for r in got)
    held = [r for r in got if r.held_out]
    assert len(held) > 200
    assert np.mean([r.lang_pred == truth[r.doc_id].lang for r in held]) > 0.97


def test_sample_has_no_held_out_document(spark):
    rows = [(i, f"text{i} letters", "en" if zlib.crc32(str(i).encode()) % 3 == 1 else "fr", "s", 1) for i in range(300)]
    assert {k for k, _ in language.training_windows(tables.frame(spark, rows))} == {"fr"}


def test_gradients():
    rng = np.random.default_rng(1)
    p = {k: v.astype(np.float64) for k, v in language.new_params(2, rng).items()}
    data, mask = language.window_matrix([b"abcab", b"xyz"], 5)
    target = np.array([0, 1])
    _, grads = language.loss_and_grads(p, data, mask, target)
    for k in p:
        at = tuple(np.argwhere(np.abs(grads[k]) == np.abs(grads[k]).max())[0])
        old, step = p[k][at], 1e-5
        p[k][at] = old + step
        up = language.loss_and_grads(p, data, mask, target)[0]
        p[k][at] = old - step
        down = language.loss_and_grads(p, data, mask, target)[0]
        p[k][at] = old
        assert abs((up - down) / 2 / step - grads[k][at]) < 1e-6


def test_pooling_reads_every_byte():
    """Whole texts, in windows: the mean over positions, however documents are batched."""
    p = language.new_params(3, np.random.default_rng(4))
    docs = ["a", "", "b" * 127, "c" * 129, "xyz " * 500]
    together = language.pool(p, *language.string_bytes(pa.array(docs)))
    for text, got in zip(docs, together, strict=True):
        raw, total = text.encode(), np.zeros(3)
        for at in range(0, len(raw), language.WINDOW_BYTES):
            data, mask = language.window_matrix([raw[at:at + language.WINDOW_BYTES]], language.WINDOW_BYTES)
            total += sum((prob[:, 0] for t, prob in language.label_positions(p, data) if mask[t, 0]), np.zeros(3))
        assert np.allclose(got, total / max(1, len(raw)), atol=1e-5)


def test_awkward_rows(spark):
    rows = tables.awkward_rows()
    got = language.identify(tables.frame(spark, rows)).collect()
    assert Counter(r.doc_id for r in got) == Counter(r[0] for r in rows)
    for r in got:
        if r.doc_id in (1, 2, 3):
            assert (r.lang_pred, r.score) == ("und", 0.0)
        if r.doc_id is None:
            assert not r.held_out
    assert {r.lang_pred for r in got} <= {"en", "de", "fr", "und"}


def test_nothing_to_learn_from(spark):
    got = language.identify(tables.frame(spark, [(1, "hello there", None, "a", 1), (2, None, "en", "a", 1)])).collect()
    assert {(r.doc_id, r.lang_pred, r.score) for r in got} == {(1, "und", 0.0), (2, "und", 0.0)}
    assert language.identify(tables.empty(spark)).count() == 0
    assert language.keep_identified(tables.empty(spark)).count() == 0


def test_filter_keeps_clean_documents(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    kept = language.keep_identified(docs)
    assert kept.columns == docs.columns
    clean = docs.where("n_chars >= 60").select("doc_id")
    assert clean.join(kept, "doc_id", "left_anti").count() <= 0.005 * clean.count()
