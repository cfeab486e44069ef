"""The corpus pipeline: five stages over ``documents``, each on all that its predecessor kept.

A stage is a function (spark, docs, sf_dir) -> DataFrame. ``run`` writes every stage's rows as Parquet in the shared
checkpoint folder and hands the reread table on, so a lost executor never costs more than the stage it hits.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from telemetra.llm.ngram_join import drop_near_copies
from telemetra.llm.packing import pack
from telemetra.llm.quality import quality_filter
from telemetra.llm.secret_scan import redact_secrets
from telemetra.llm.staging import stage
from telemetra.llm.toxicity import drop_toxic


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules reject go."""
    return quality_filter(docs)


def toxicity_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents predicted toxic go."""
    return drop_toxic(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def ngram_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near copies the document with the smallest id stays."""
    return drop_near_copies(docs)


def secret_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets are replaced by a mark; every document stays."""
    return redact_secrets(docs)


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The place of every document's pieces in sequences of at most 4096 tokens."""
    return pack(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality_rules", quality_stage),
    ("toxicity", toxicity_stage),
    ("ngram_jaccard_join", ngram_stage),
    ("secret_scan", secret_stage),
    ("best_fit_packing", packing_stage),
]

# Training a classifier and byte-pair merges have no SQL form; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages, from the documents of ``sf_dir`` to their packed pieces."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, step in STAGES:
        docs = stage(step(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
