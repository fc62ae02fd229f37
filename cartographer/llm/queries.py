"""The queries opN_<name> and, where SQL can express them, their DuckDB SQL."""

from __future__ import annotations

import os
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import bloom_lm, imatch, language, mixing, packing, periodic, pseudonyms, quality, secrets, simhash, strata, substring, warc_zip
from .common import table

#: Session setting that holds the key of the pseudonyms, and the key of sessions without it: public, for
#: tests and trials only, as anyone can undo its pseudonyms.
KEY_SETTING = "spark.cartographer.pseudonymKey"
PSEUDONYM_KEY = "cartographer-pseudonyms-1"


def vocabulary() -> str:
    """Vocabulary file of the packing query."""
    import public_tokenizers

    return os.environ.get("CARTOGRAPHER_VOCABULARY") or public_tokenizers.path("word_bpe_49k.json")


def op1_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.digest(secrets.scan_secrets(table(spark, sf_dir, "documents")))


def op2_pseudonyms(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pseudonyms.counted(pseudonyms.pseudonymise(table(spark, sf_dir, "documents"), spark.conf.get(KEY_SETTING, PSEUDONYM_KEY)))


def op3_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    trusted = table(spark, sf_dir, "labels").where("quality = 1 and coalesce(toxic, 0) = 0")
    return quality.apply_rules(docs, quality.fit_ratios(docs, trusted))


def op4_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.digest(simhash.near_duplicates(table(spark, sf_dir, "documents")))


def op5_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents")).withColumn("weight", F.round("weight", 9))


def op6_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), vocabulary())


def op7_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language.identify(table(spark, sf_dir, "documents"))


def op8_imatch(spark: SparkSession, sf_dir: str) -> DataFrame:
    return imatch.match_edited(table(spark, sf_dir, "documents"))


def op9_warc_zip(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    return warc_zip.digest(warc_zip.archive_and_read(pages), pages.schema["page_id"].dataType.simpleString())


def op10_substring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring.deduplicate_passages(table(spark, sf_dir, "documents"))


def op11_bloom_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bloom_lm.score_documents(table(spark, sf_dir, "documents"))


def op12_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return strata.rank_documents(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op13_periodic(spark: SparkSession, sf_dir: str) -> DataFrame:
    return periodic.digest(periodic.periodic_runs(periodic.planted(table(spark, sf_dir, "documents"))))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (op1_secrets, op2_pseudonyms, op3_quality, op4_simhash, op5_mixing, op6_packing, op7_language, op8_imatch, op9_warc_zip, op10_substring,
                            op11_bloom_lm, op12_search, op13_periodic)}

WARC_SQL = f"""
SELECT page_id, strlen(h) AS payload_bytes, sha1(h) AS payload_digest,
  CASE WHEN latest IS DISTINCT FROM page_id AND latest IS NOT NULL THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN latest IS DISTINCT FROM page_id THEN latest END AS refers_to
FROM (SELECT page_id, h, CASE WHEN strlen(h) >= {warc_zip.REVISIT_BYTES} THEN max(page_id) OVER (PARTITION BY h) ELSE page_id END AS latest
  FROM (SELECT page_id, coalesce(html, '') AS h FROM pages) p) q
"""

_LAST = substring.WINDOW - 1
PASSAGES_SQL = rf"""
WITH d AS MATERIALIZED (SELECT row_number() OVER () AS rid, doc_id, regexp_extract_all(coalesce(text, ''), '[^ \t\n\x0B\f\r]+') AS w FROM documents),
win AS MATERIALIZED (SELECT rid, doc_id, i, array_to_string(w[i:i + {_LAST}], ' ') AS s FROM (SELECT rid, doc_id, w, unnest(range(1, len(w) - {_LAST} + 1)) AS i FROM d) t),
hit AS (SELECT rid, i FROM win JOIN (SELECT s, min(doc_id) AS least FROM win GROUP BY s) f USING (s) WHERE least < doc_id),
pos AS (SELECT rid, unnest(w) AS word, generate_subscripts(w, 1) AS i FROM d),
cov AS (SELECT p.rid, p.i, p.word, max(CASE WHEN h.i IS NULL THEN 0 ELSE 1 END) OVER (PARTITION BY p.rid ORDER BY p.i
  ROWS BETWEEN {_LAST} PRECEDING AND CURRENT ROW) AS gone FROM pos p LEFT JOIN hit h ON p.rid = h.rid AND p.i = h.i),
kept AS (SELECT rid, sum(gone)::BIGINT AS n_removed, string_agg(word, ' ' ORDER BY i) FILTER (WHERE gone = 0) AS line FROM cov GROUP BY rid)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_removed, 0)::BIGINT AS n_removed, sha256(coalesce(line, '')) AS kept_sha256
FROM d LEFT JOIN kept USING (rid)
"""

_TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
SEARCH_SQL = f"""
WITH d AS MATERIALIZED (SELECT row_number() OVER () AS rid, doc_id, regexp_extract_all({_LOWER}, '{_TERM}') AS ts FROM documents),
size AS (SELECT count(*)::BIGINT AS n, sum(len(ts))::BIGINT AS l FROM d WHERE len(ts) > 0),
i AS MATERIALIZED (SELECT row_number() OVER () AS iid, item_id, regexp_extract_all({_LOWER}, '{_TERM}') AS ts FROM benchmark),
it AS MATERIALIZED (SELECT iid, item_id, t, count(*)::BIGINT AS times FROM (SELECT iid, item_id, unnest(ts) AS t FROM i) u GROUP BY ALL),
p AS MATERIALIZED (SELECT rid, doc_id, 100 - {strata.SLOPE} + ({strata.SLOPE} * k * n) // l AS m, t, count(*)::BIGINT AS tf
  FROM (SELECT rid, doc_id, len(ts)::BIGINT AS k, unnest(ts) AS t FROM d) u CROSS JOIN size WHERE t IN (SELECT t FROM it) GROUP BY rid, doc_id, m, t),
w AS (SELECT t, floor(1000 * ln((2 * n + 2)::DOUBLE / (2 * df + 1)::DOUBLE))::BIGINT AS w FROM (SELECT t, count(*)::BIGINT AS df FROM p GROUP BY t) x CROSS JOIN size),
s AS (SELECT iid, item_id, rid, doc_id, sum(times * w * (({strata.SCALE} * tf) // (1000 * tf + 12 * m)))::BIGINT AS score
  FROM it JOIN w USING (t) JOIN p USING (t) GROUP BY iid, item_id, rid, doc_id),
r AS (SELECT item_id, row_number() OVER (PARTITION BY iid ORDER BY score DESC, doc_id NULLS LAST)::INT AS rank, doc_id, score FROM s WHERE score > 0)
SELECT * FROM r WHERE rank <= {strata.TOP}
"""

ORACLE: dict[str, str] = {"op5_mixing": mixing.MIX_SQL, "op9_warc_zip": WARC_SQL, "op10_substring": PASSAGES_SQL, "op12_search": SEARCH_SQL}
