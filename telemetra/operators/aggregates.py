"""Counts and page metadata."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def count_rows(df: DataFrame, alias: str = "total") -> DataFrame:
    """One row: number of rows of ``df``."""
    return df.agg(F.count(F.lit(1)).alias(alias))


def count_distinct(df: DataFrame, col: str, alias: str) -> DataFrame:
    """One row: number of distinct non-NULL values (A2)."""
    return df.agg(F.countDistinct(col).alias(alias))


def page_metadata(df: DataFrame, page: int, page_size: int) -> DataFrame:
    """One row: page, page_size, total_records, total_pages (A3).

    ``total_pages`` is the ceiling division, 0 for an empty result.
    """
    total = F.count(F.lit(1))
    return df.agg(
        F.lit(page).cast("bigint").alias("page"),
        F.lit(page_size).cast("bigint").alias("page_size"),
        total.alias("total_records"),
        F.floor((total + F.lit(page_size - 1)) / F.lit(page_size)).cast("bigint").alias("total_pages"),
    )
