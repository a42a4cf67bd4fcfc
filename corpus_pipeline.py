"""Corpus pipeline: quality rules, near-duplicates, secrets, mixing, tokens.

``STAGES`` lists (name, function); each function takes (spark, docs, sf_dir)
and returns a DataFrame, which is written as Parquet and read again as the next
stage's ``docs``.  ``run`` applies them to ``documents``.

Defined cases, in all stages: a null text is an empty one, which the quality
rules reject; a very long text stays one row, and whole; repeated rows are
copies, of which the Jaccard join keeps one; null and repeated ids are kept
apart by their texts; an empty table passes through as one; columns beside those
of ``documents`` are kept up to the last stage.  Ties: a score equal to the quality
threshold is kept, and of a group of near copies the smallest id, then row hash.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from hourlake.llm import bpe, jaccard, mixing, quality, secrets
from hourlake.llm.common import share_package
from hourlake.session import ensure_checkpoint_dir


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the quality rules, scored by their words and word
    pairs; the trusted target is the labelled documents of quality 1."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return quality.keep_quality(docs, labels.where("quality = 1"), grams=quality.WORDS)


def jaccard_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies."""
    share_package(spark)
    return jaccard.keep_one_of_class(docs)


def secrets_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with their secrets masked."""
    share_package(spark)
    return secrets.redact_secrets(docs)


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents replicated to target weights, in shuffled order."""
    return mixing.mix_sources(docs).select(*docs.columns)


def tokens_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Number of tokens of each document, and digests of them and of the text
    decoded from them."""
    share_package(spark)
    return bpe.bpe_report(docs)


STAGES = [("quality_rules", quality_stage), ("ngram_jaccard_join", jaccard_stage), ("secret_scans", secrets_stage),
          ("source_mixing", mixing_stage), ("byte_bpe", tokens_stage)]

#: Learned ratios, tokens and hashes of this library: SQL cannot express them.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply the stages to ``documents``; each one's rows are written to the
    shared folder and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    folder = f"{ensure_checkpoint_dir(spark)}/pipeline-{uuid.uuid4().hex}"
    for name, stage in STAGES[:-1]:
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{name}")
        docs = spark.read.parquet(f"{folder}/{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
