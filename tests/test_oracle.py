"""Every registered query against its DuckDB oracle on the smallest scale."""

import os
import sys

import duckdb
import pytest

from conftest import ROOT, SF_SMALL

sys.path.insert(0, os.path.join(ROOT, "scripts"))
import __spark_entry__ as entry  # noqa: E402
from check_oracle import TABLES, digest  # noqa: E402

KEYS = sorted(entry.oracle_sql())


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        p = os.path.join(SF_SMALL, f"{t}.parquet")
        if os.path.exists(p):
            c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return c


# Queries that SQL cannot express, and the file that holds them against brute force.
TESTED_OTHERWISE = {
    "op1_ngram_join": "llm/test_ngram_join.py", "op2_license_scan": "llm/test_text_operators.py",
    "op3_embedding_forest": "llm/test_embedding_forest.py", "op4_toxicity": "llm/test_text_operators.py",
    "op5_secret_scan": "llm/test_text_operators.py", "op6_vector_sharding": "llm/test_text_operators.py",
    "op7_bpe_transducer": "llm/test_tokens.py", "op8_best_fit_packing": "llm/test_tokens.py",
    "op10_token_counts": "llm/test_tokens.py", "op11_pii": "llm/test_pii.py", "op12_cross_alignment": "llm/test_alignment.py",
    "op13_spelling_variants": "llm/test_spelling.py", "pipeline": "llm/test_pipeline.py"}


def test_every_query_has_an_oracle():
    assert set(entry.catalog.QUERIES) == set(entry.catalog.ORACLE)
    rest = set(entry.queries()) - set(entry.oracle_sql())
    assert rest <= set(TESTED_OTHERWISE)
    assert all(os.path.exists(os.path.join(ROOT, "tests", TESTED_OTHERWISE[name])) for name in rest)


@pytest.mark.parametrize("key", KEYS)
def test_matches_oracle(spark, con, key):
    df = entry.queries()[key](spark, SF_SMALL)
    srows = [tuple(r) for r in df.collect()]
    rel = con.sql(entry.oracle_sql()[key])
    drows = rel.fetchall()
    assert sorted(df.columns) == sorted(rel.columns)
    assert len(srows) == len(drows)
    assert digest(df.columns, srows) == digest(rel.columns, drows)


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.count() > 0
    assert "station_id" in df.columns
