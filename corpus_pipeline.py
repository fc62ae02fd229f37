"""A training corpus from ``documents``: language, near-duplicates, secrets, mixture, windows.

Each stage is written as Parquet to the session's shared folder and reread as
the next one's input, so a lost executor costs tasks of one stage at most. All
stages but the last return the columns of ``documents``.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from cartographer.llm import language, mixing, packing, secrets, simhash
from cartographer.llm.common import table
from cartographer.llm.queries import vocabulary
from cartographer.session import ensure_checkpoint_dir


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a recognised language go; a null lang is filled."""
    return language.keep_identified(docs)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates stays."""
    return simhash.deduplicate(docs)


def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets in the texts are replaced; no document goes."""
    return secrets.redact_secrets(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the target weights of their sources ask for."""
    return mixing.mix_documents(docs)


def pack_windows(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents, placed in windows."""
    return packing.pack(docs, vocabulary())


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("language ID", identify_language),
    ("SimHash near-dedup", drop_near_duplicates),
    ("secret scans", redact_secrets),
    ("mixing sources to target weights", mix_sources),
    ("packing", pack_windows),
]

#: SQL expresses neither the language model nor the packer; the tests hold a brute-force version.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Applies the stages to ``documents``; every stage's Parquet stays in the shared folder."""
    folder = f"{ensure_checkpoint_dir(spark).rstrip('/')}/corpus-{uuid.uuid4().hex}"
    docs = table(spark, sf_dir, "documents")
    for k, (_, stage) in enumerate(STAGES):
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/stage-{k}")
        docs = spark.read.parquet(f"{folder}/stage-{k}")
    return docs
