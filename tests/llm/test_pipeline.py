import zlib
from collections import Counter

import corpus_pipeline
import numpy as np
import tables
from test_mixing import brute_mix
from test_simhash import brute_components, brute_print
from tokenizers import Tokenizer

from cartographer.llm import language, packing, queries, secrets

SF = tables.SF_SMALL


def test_run_matches_brute_force(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text", "lang", "source", "n_chars")
    rows = [tuple(r) for r in docs.collect()]
    # language: the network itself is tested elsewhere; its verdicts are taken as they are
    verdicts = {r.doc_id: r for r in language.predict(docs, *language.fit(docs)).collect()}
    rows = [r for r in rows if verdicts[r[0]].lang_pred != "und" and verdicts[r[0]].score >= language.MIN_SCORE]
    least = brute_components([brute_print(r[1]) for r in rows], [r[0] for r in rows])
    rows = [r for r, c in zip(rows, least, strict=True) if r[0] == c]

    def redacted(text):
        out, at = "", 0
        for s, _, e, _ in secrets.find_spans(text):
            if s >= at:
                out += text[at:s] + "[SECRET]"
            at = max(at, e)
        return out + text[at:]

    rows = [(r[0], redacted(r[1]), *r[2:]) for r in rows]
    text = {r[0]: r[1] for r in rows}
    drawn = Counter(k[0] for k, n in brute_mix(rows).items() for _ in range(n))
    tokenizer = Tokenizer.from_file(queries.vocabulary())
    want = Counter()
    for doc, n in drawn.items():
        ids = np.array([*tokenizer.encode(text[doc], add_special_tokens=False).ids, packing.END_ID], "<u4")
        for s in range(0, len(ids), packing.WINDOW):
            piece = ids[s:s + packing.WINDOW]
            want[(doc, s, len(piece), zlib.crc32(piece.tobytes()), len(ids))] += n
    got = corpus_pipeline.run(spark, SF).collect()
    assert Counter((r.doc_id, r.start, r.length, r.ids_crc32, r.doc_tokens) for r in got) == want


def test_stages_return_the_columns_of_documents(spark):
    docs = tables.frame(spark, tables.awkward_rows()).select("doc_id", "text", "lang", "source", "n_chars")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, SF)
        assert out.dtypes == docs.dtypes
        out.collect()
    assert corpus_pipeline.STAGES[-1][1](spark, docs, SF).count() >= docs.count()


def test_stages_on_an_empty_table(spark):
    docs = tables.empty(spark).select("doc_id", "text", "lang", "source", "n_chars")
    assert all(stage(spark, docs, SF).count() == 0 for _, stage in corpus_pipeline.STAGES)
