"""Folder ingest: CSV files -> readings, quarantine, failure lists, audit, ledger.

The raw text is scanned once and staged as lines; the per-file header table and the parsed rows are made from them and
staged once each in the checkpoint folder (lineage cuts that survive executor loss). Every sink reads the staged rows,
and the stages go when the ledger is written. Sink order is readings
-> quarantine/failures -> audit -> ledger: the ledger commits a file's rows of this run, so a crash at any place leaves
nothing to be seen but readings, which a repeated run finds by their ``uuid``.
"""

from __future__ import annotations

import datetime as _dt
import uuid as _uuid

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from telemetra.functions.datetime import obs_date
from telemetra.operators import audit as audit_ops
from telemetra.operators.parse import clean_lines, failed_record_json, file_headers, parse_lines, readings_from
from telemetra.operators.store import AUDIT, FAILURES, QUARANTINE, TableStore, typed_columns, unprocessed_files
from telemetra.session import remove_path, scratch_path
from telemetra.sources.files import (CSV_GLOB, HIDDEN_FILE_ERROR, UNREAD_FILE_ERROR, hidden_logger_files,
                                     list_logger_files, partly_read_files, scan_logger_files, unreadable_files)
from telemetra.sources.records import records

EMPTY_FILE_ERROR = "no columns to parse from file"
MAX_NAMES = 5000    # so many new files are named to the reader; where there are more, it prunes by their times alone


class Stages:
    """Staged tables of one run."""

    def __init__(self, spark: SparkSession):
        self.spark = spark
        self.paths: list[str] = []

    def write(self, df: DataFrame, name: str) -> DataFrame:
        path = scratch_path(self.spark, name)
        self.paths.append(path)
        df.write.parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def clear(self) -> None:
        for path in self.paths:
            remove_path(self.spark, path)


def _error_rows(files: DataFrame, error: str) -> DataFrame:
    """Per-file results of files that could not be read."""
    none = [F.lit(None).cast("bigint").alias(c) for c in ("record_count", "success_count", "fail_count")]
    return files.select("file_path", "file_name", *none, F.lit(error).alias("error"), F.lit(False).alias("audited"),
                        F.lit(False).alias("ledgered"), F.lit(0).cast("bigint").alias("inserted"),
                        F.lit(0).cast("bigint").alias("skipped"))


def ingest_lines(spark: SparkSession, lines: DataFrame, store: TableStore, *, mode: str = "strict",
                 run_id: str | None = None, now: _dt.datetime | None = None,
                 candidates: DataFrame | None = None) -> DataFrame:
    """Ingest one batch of lines into ``store``; returns the per-file results, which outlive the run's other stages.

    ``candidates`` (file_path, file_name) lists every file of the batch: lines
    of other files are left out, and files without a single non-blank line
    are reported as errors.
    """
    run_id = run_id or _uuid.uuid4().hex
    ts = F.lit(now).cast("timestamp") if now is not None else F.current_timestamp()
    stages = Stages(spark)
    headers = file_headers(clean_lines(lines))
    if candidates is not None:
        headers = headers.join(candidates.select("file_path"), "file_path", "left_semi")
    headers = stages.write(headers, "headers")
    rows, _ = parse_lines(lines, mode, headers)
    # Failures keep their record, valid rows their cells and typed values; neither needs the split line any more.
    rows = rows.withColumn("record", F.when(F.col("kind") != "valid", failed_record_json(F.col("kind"))))
    rows = stages.write(rows.drop("tokens", "keys", "width", "k_StationID").withColumns(typed_columns("v_")), "parsed-rows")

    # readings (K1)
    store.append_readings(readings_from(rows, keep=list(typed_columns())).withColumn("obs_date", obs_date(F.col("ts"))))

    # quarantine + failure lists
    run = F.lit(run_id).alias("run_id")
    store.append_run_table(QUARANTINE, audit_ops.failures(rows).select("file_name", "line_no", "kind", "record", run))
    store.append_run_table(FAILURES, audit_ops.failed_records_json(rows).drop("file_path").withColumn("run_id", run))

    # audit (A4) and per-file results, empty files included as errors
    per_file = audit_ops.file_audit(rows, headers, mode)
    if candidates is not None:
        empty = candidates.join(headers.select("file_path"), "file_path", "left_anti")
        per_file = per_file.unionByName(_error_rows(empty, EMPTY_FILE_ERROR))
    results = Stages(spark).write(per_file.withColumn("run_id", run).withColumn("timestamp", ts), "per-file")
    store.append_run_table(AUDIT, results.filter("audited").select(
        "file_name", "record_count", "success_count", "fail_count", "error", "timestamp", "run_id"))

    # ledger last (K2)
    store.append_ledger(results.filter("ledgered").select("file_name", F.col("timestamp").alias("processed_at"), "run_id"))
    stages.clear()
    return results


def _readable_records(spark: SparkSession, src_dir: str, glob: str, todo: DataFrame, oldest: str,
                      names: list[str] | None, stages: Stages) -> tuple[DataFrame, set[str]]:
    """Records of the new files, and the base names of those that could not be read.

    A scan that fails is repeated without the files that it failed for; files are looked at one by one only then. An
    error that is no file's own, or the trouble of more than ``MAX_NAMES`` files, is raised.
    """
    bad: set[str] = set()
    while True:
        scanned = scan_logger_files(spark, src_dir, glob, oldest, names, bad)
        wanted = scanned.join(todo.select("file_path"), "file_path", "left_semi")
        try:
            return records(wanted, stages.write), bad
        except (Py4JJavaError, PySparkException) as error:
            cut = partly_read_files(spark, src_dir, todo, glob, oldest, names, bad)
            found = unreadable_files(error, cut, MAX_NAMES + 1) - bad
            if not found or len(bad | found) > MAX_NAMES:
                raise
            bad |= found


def ingest_folder(spark: SparkSession, src_dir: str, table_dir: str, *, mode: str = "strict",
                  run_id: str | None = None, now: _dt.datetime | None = None, glob: str = CSV_GLOB) -> DataFrame:
    """Ingest every CSV file of ``src_dir`` not yet in the ledger; returns the run summary.

    Files are skipped by base name, as the ledger keys them. The folder is
    read once. Of up to ``MAX_NAMES`` new files the reader opens these alone;
    of more, all files not older than the oldest new one, and lines of files
    that are not new are dropped at the scan. A quoted cell may hold line breaks. A file whose name hides
    it from the reader is reported as an error; so is a file that cannot be read to its end, of which nothing is kept
    and which the next run tries again.
    """
    store = TableStore(spark, table_dir)
    stages = Stages(spark)
    files = list_logger_files(spark, src_dir, glob)
    todo = stages.write(unprocessed_files(files, store.ledger()).select("file_path", "file_name", "modified", "size"), "todo")
    oldest = todo.agg(F.min("modified").cast("string")).first()[0]
    hidden = spark.createDataFrame([(n, n) for n in hidden_logger_files(spark, src_dir)], "file_path string, file_name string")
    per_file = _error_rows(hidden, HIDDEN_FILE_ERROR).select(*AUDIT_COLUMNS)
    if oldest is not None:
        named = [r[0] for r in todo.select("file_name").limit(MAX_NAMES + 1).collect()]
        lines, bad = _readable_records(spark, src_dir, glob, todo, oldest, named if len(named) <= MAX_NAMES else None, stages)
        unread = F.col("file_name").isin(*sorted(bad))
        cut_off = spark.createDataFrame(todo.filter(unread).select("file_path", "file_name").collect(),
                                        "file_path string, file_name string")  # at most MAX_NAMES, needed after the stages
        per_file = per_file.unionByName(_error_rows(cut_off, UNREAD_FILE_ERROR).select(*AUDIT_COLUMNS))
        per_file = per_file.unionByName(ingest_lines(
            spark, lines, store, mode=mode, run_id=run_id, now=now, candidates=todo.filter(~unread)).select(*AUDIT_COLUMNS))
    stages.clear()
    return audit_ops.run_summary(per_file)


AUDIT_COLUMNS = ["file_path", "file_name", "inserted", "skipped", "error"]

from telemetra.streaming.incremental import ingest_stream  # noqa: E402,F401  (re-export)
