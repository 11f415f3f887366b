"""Corpus pipeline: quality, exact copies, near copies, benchmark passages, tokens.

Each stage takes (spark, docs, sf_dir) and works on all that the one before it
kept; ``run`` writes each stage's rows to the shared folder and reads them back.
All stages but the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from stridelake.llm import decontaminate, exact_dedup, near_copies, piece_bpe, quality
from stridelake.llm.common import Scratch, table


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents that the classifier scores under its threshold."""
    return quality.keep_good(docs, table(spark, sf_dir, "labels"))


def exact_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep the row with the smallest id of equal normalised texts."""
    return exact_dedup.exact_dedup(docs, Scratch(spark, "pipeline-exact"))


def near_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep the document with the smallest id of each group whose texts are 0.8 alike in five-word shingles."""
    return near_copies.near_copies(docs, Scratch(spark, "pipeline-near"))


def benchmark_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents of which benchmark windows cover a twentieth of the words or more."""
    return decontaminate.drop_contaminated(docs, table(spark, sf_dir, "benchmark"), Scratch(spark, "pipeline-benchmark"))


def token_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Encode and decode every document that is left."""
    return piece_bpe.round_trip(docs, keep_text=False)


STAGES = [
    ("quality", quality_stage),
    ("exact_dedup", exact_stage),
    ("near_dedup", near_stage),
    ("decontaminate", benchmark_stage),
    ("sentencepiece", token_stage),
]

#: SQL expresses neither the classifier, SimHash nor the tokenizer; the tests hold
#: the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    scratch = Scratch(spark, "pipeline")
    docs = table(spark, sf_dir, "documents")
    for k, (name, stage) in enumerate(STAGES):
        docs = scratch.save(stage(spark, docs, sf_dir), f"{k}-{name}")
        if k:
            scratch.drop(f"{k - 1}-{STAGES[k - 1][0]}")
    return docs
