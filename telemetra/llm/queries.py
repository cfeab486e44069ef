"""The registered queries of this subpackage and their DuckDB SQL."""

from __future__ import annotations

from collections.abc import Callable

import corpus_pipeline
import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from telemetra.llm import (
    alignment,
    bpe_transducer,
    embedding_forest,
    license_scan,
    ngram_join,
    packing,
    pii,
    quality,
    secret_scan,
    sharding,
    spelling,
    token_counts,
    toxicity,
)


def _documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def op1_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.ngram_join(_documents(spark, sf_dir))


def op2_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan.license_digest(_documents(spark, sf_dir))


def op3_embedding_forest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embedding_forest.embedding_forest(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))


def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.toxicity(_documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/labels.parquet"))


def op5_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan.secret_digest(_documents(spark, sf_dir))


def op6_vector_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard_digest(_documents(spark, sf_dir))


def op7_bpe_transducer(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe_transducer.encode_digest(_documents(spark, sf_dir), public_tokenizers.path("word_bpe_49k.json"))


def op8_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(_documents(spark, sf_dir), public_tokenizers.path("word_bpe_49k.json"))


def op9_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality_digest(_documents(spark, sf_dir))


def op10_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.token_counts(_documents(spark, sf_dir), public_tokenizers.path("byte_bpe_50k.json"))


def op11_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.pii_digest(_documents(spark, sf_dir))


def op12_cross_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alignment.cross_alignment(_documents(spark, sf_dir), public_tokenizers.path("byte_bpe_50k.json"),
                                     public_tokenizers.path("piece_bpe_32k.model"))[0]


def op13_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.spelling_variants(_documents(spark, sf_dir))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_ngram_join": op1_ngram_join,
    "op2_license_scan": op2_license_scan,
    "op3_embedding_forest": op3_embedding_forest,
    "op4_toxicity": op4_toxicity,
    "op5_secret_scan": op5_secret_scan,
    "op6_vector_sharding": op6_vector_sharding,
    "op7_bpe_transducer": op7_bpe_transducer,
    "op8_best_fit_packing": op8_best_fit_packing,
    "op9_quality_rules": op9_quality_rules,
    "op10_token_counts": op10_token_counts,
    "op11_pii": op11_pii,
    "op12_cross_alignment": op12_cross_alignment,
    "op13_spelling_variants": op13_spelling_variants,
    "pipeline": corpus_pipeline.run,
}

_FORMS = ", ".join(f"'{w}'" for w in quality.STOP_FORMS)

ORACLE: dict[str, str] = {
    "op9_quality_rules": rf"""
WITH w AS (
  SELECT doc_id, coalesce(text, '') AS t,
    list_filter(regexp_split_to_array(coalesce(text, ''), '[ \t\n\x0B\f\r]+'), lambda x: x <> '') AS ws,
    list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^ \t\n\x0B\f\r]')) AS ls
  FROM documents),
grams AS (
  SELECT doc_id, p, ws[p] || ' ' || ws[p + 1] || ' ' || ws[p + 2] AS g
  FROM (SELECT doc_id, ws, unnest(range(1, len(ws) - 1)) AS p FROM w WHERE len(ws) >= 3)),
twice AS (SELECT doc_id, p, count(*) OVER (PARTITION BY doc_id, g) AS c FROM grams),
rep AS (
  SELECT doc_id, count(DISTINCT q) AS r
  FROM (SELECT doc_id, unnest([p, p + 1, p + 2]) AS q FROM twice WHERE c >= 2) GROUP BY doc_id),
m AS (
  SELECT w.doc_id, CAST(len(ws) AS BIGINT) AS n_words, CAST(length(array_to_string(ws, '')) AS BIGINT) AS word_chars,
    CAST(length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
    CAST(len(ls) - len(list_distinct(ls)) AS BIGINT) AS n_dup_lines, len(ls) AS n_lines,
    CAST(coalesce(r, 0) AS BIGINT) AS n_repeat_words,
    (length(t) - length(replace(t, '!!', ''))) / 2 AS n_bangs,
    len(list_filter(list_distinct(ws), lambda x: x IN ({_FORMS}))) AS n_stop_words
  FROM w LEFT JOIN rep ON rep.doc_id = w.doc_id),
f AS (SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM m)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  NOT base_failed AND NOT (n_words < 50 OR n_repeat_words > 0.5 * n_words OR n_symbols > 0.1 * n_words
    OR n_bangs > 0.3 * n_words OR word_chars < 2.0 * n_words OR word_chars > 25.0 * n_words OR n_stop_words < 2
    OR n_dup_lines > 0.5 * n_lines) AS kept
FROM f""",
}
