"""Corpus pipeline: quality, near-duplicates, secrets, mixture, tokens.

Each stage takes (spark, docs, sf_dir) and all that its predecessor kept; ``run``
writes every stage's result as Parquet under ``spark.checkpoint.dir`` and reads it
again, so a lost executor never repeats more than one stage. All stages but the last
return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from shoplake.llm import bpe, mixing, neardup, quality, secret_scan
from shoplake.llm.common import staged, table
from shoplake.llm.queries import tokenizer


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops the documents that the classifier rejects."""
    model = quality.fit(docs, table(spark, sf_dir, "labels"), quality.learnable())
    return quality.accepted(docs, model)


def dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one document of each class of near-duplicates."""
    return neardup.deduplicated(docs)


def secrets_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Replaces live-looking secrets; widely copied examples stay."""
    return secret_scan.redact(docs)


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Takes each source's share: whole documents, repeated or left out, and parts at the ends of a run."""
    return mixing.mix(docs)


def tokens_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens and token ids of every text, and the text that the ids decode to."""
    return bpe.encode(docs, *tokenizer(), decoded=True)


STAGES = [
    ("quality classifier", quality_stage),
    ("near-duplicates", dedup_stage),
    ("secrets", secrets_stage),
    ("mixture", mixing_stage),
    ("tokens", tokens_stage),
]

#: Latent-semantic voting, similarity classes and byte-pair merges aren't SQL; tests/llm compares with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = staged(stage(spark, docs, sf_dir), "pipeline_" + name.replace(" ", "_"))
    return docs
