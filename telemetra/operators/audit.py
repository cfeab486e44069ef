"""Per-file audit, failure lists and run summary of an ingest.

All per-file results are grouped aggregates (partial aggregation before the
shuffle). Failure lists are emitted in chunks of at most ``chunk_lines``
source lines, so no group ever holds more than a bounded number of records;
concatenating a file's chunks in ``(part, chunk_no)`` order gives the full
list in the historic order (tokenize failures first, then invalid rows).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from telemetra.functions.text import python_list_repr
from telemetra.operators.parse import failed_record_json
from telemetra.operators.windows import first_n_per_group
from telemetra.schema import FAILED_SAMPLE_SIZE

CHUNK_LINES = 10_000


def file_counts(rows: DataFrame, headers: DataFrame) -> DataFrame:
    """Valid / invalid / tokenize row counts for every file with a first line."""
    counts = rows.groupBy("file_path").agg(
        F.count_if(F.col("kind") == "valid").alias("n_valid"),
        F.count_if(F.col("kind") == "invalid").alias("n_invalid"),
        F.count_if(F.col("kind") == "tokenize").alias("n_tokenize"),
    )
    h = headers.select("file_path", "file_name", "file_error")
    return (h.join(counts, "file_path", "left")
             .na.fill(0, ["n_valid", "n_invalid", "n_tokenize"]))


def file_audit(rows: DataFrame, headers: DataFrame, mode: str = "strict") -> DataFrame:
    """One row per file: counts, error flag, and whether it is audited / ledgered (A4).

    strict:  failures = all invalid + tokenize rows; a file with neither valid
             rows nor failures is not audited (it is retried next run); a file
             with failures only is ``all_invalid``.
    lenient: every file is audited; a file without valid rows reports its
             invalid rows only. Every failed row counts: the 200-row cut of the
             historic audit is a choice of the reader (``failures(limit=200)``).
    Files with a file error (headerless and too wide) are neither audited nor
    ledgered. ``success_count`` counts rows attempted, duplicates included.
    """
    c = file_counts(rows, headers)
    nv, ni, nt = F.col("n_valid"), F.col("n_invalid"), F.col("n_tokenize")
    ok_file = F.col("file_error").isNull()
    if mode == "strict":
        fail = ni + nt
        record = nv + fail
        audited = ok_file & ((nv > 0) | (fail > 0))
    elif mode == "lenient":
        fail = F.when(nv == 0, ni).otherwise(nt + ni)
        record = F.when(nv == 0, ni).otherwise(nv + fail)
        audited = ok_file
    else:
        raise ValueError(f"unknown mode {mode!r}")
    error = (F.when(~ok_file, F.col("file_error"))
              .when(audited & (nv == 0), F.lit("all_invalid")))
    return c.select(
        "file_path", "file_name",
        F.when(audited, record).cast("bigint").alias("record_count"),
        F.when(audited, nv).cast("bigint").alias("success_count"),
        F.when(audited, fail).cast("bigint").alias("fail_count"),
        error.alias("error"),
        audited.alias("audited"),
        audited.alias("ledgered"),
        F.when(ok_file, nv).otherwise(0).cast("bigint").alias("inserted"),
        F.when(audited, fail).otherwise(0).cast("bigint").alias("skipped"),
    )


def failures(rows: DataFrame, limit: int | None = None) -> DataFrame:
    """Failed rows of files without a file error, in audit order.

    All of them by default. ``limit`` asks for a shorter report: all tokenize
    failures and the first ``limit`` invalid rows of each file (W2).
    """
    f = rows.filter((F.col("kind") != "valid") & F.col("file_error").isNull())
    if limit is not None:
        tok = f.filter(F.col("kind") == "tokenize")
        inv = first_n_per_group(f.filter(F.col("kind") == "invalid"), "file_path", [F.col("line_no")], limit)
        f = tok.unionByName(inv)
    return f.select(
        "file_path", "file_name", "line_no", "kind",
        F.when(F.col("kind") == "tokenize", 0).otherwise(1).alias("part"),
        (F.col("record") if "record" in rows.columns else failed_record_json(F.col("kind"))).alias("record"),
    )


def failed_records_json(rows: DataFrame, chunk_lines: int = CHUNK_LINES) -> DataFrame:
    """Failure lists as JSON arrays, one row per (file, part, chunk of source lines) (A5)."""
    f = failures(rows)
    grouped = f.groupBy("file_path", "file_name", "part", F.floor(F.col("line_no") / chunk_lines).alias("chunk_no"))
    agg = grouped.agg(
        F.count(F.lit(1)).alias("n_records"),
        F.array_sort(F.collect_list(F.struct("line_no", "record"))).alias("recs"),
    )
    return agg.select(
        "file_path", "file_name", "part", F.col("chunk_no").cast("bigint").alias("chunk_no"), "n_records",
        F.concat(F.lit("["), F.array_join(F.transform("recs", lambda x: x["record"]), ","), F.lit("]"))
        .alias("failed_records"),
    )


def failed_samples(rows: DataFrame, n: int = FAILED_SAMPLE_SIZE) -> DataFrame:
    """First ``n`` invalid station ids per file, as the ingest log lists them."""
    inv = rows.filter((F.col("kind") == "invalid") & F.col("file_error").isNull())
    top = first_n_per_group(inv, "file_path", [F.col("line_no")], n)
    agg = top.groupBy("file_path", "file_name").agg(
        F.array_sort(F.collect_list(F.struct("line_no", "k_StationID"))).alias("s"))
    return agg.select("file_path", "file_name",
                      python_list_repr(F.transform("s", lambda x: x["k_StationID"])).alias("examples"))


def run_summary(audit: DataFrame) -> DataFrame:
    """One row: files, rows inserted, rows skipped, files with an error."""
    return audit.agg(
        F.count(F.lit(1)).alias("files"),
        F.coalesce(F.sum("inserted"), F.lit(0)).cast("bigint").alias("inserted"),
        F.coalesce(F.sum("skipped"), F.lit(0)).cast("bigint").alias("skipped"),
        F.count_if(F.col("error").isNotNull()).alias("files_with_error"),
    )
