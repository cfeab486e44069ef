"""Table changes on Parquet: insert-ignore, ledger upsert, delete, update.

Tables live under one folder:

    readings/    Parquet partitioned by obs_date (NULL dates in the default partition)
    quarantine/  failed rows, one JSON record each, partitioned by run_id
    failures/    failure lists in bounded chunks, partitioned by run_id
    audit/       one row per file and run, partitioned by run_id
    ledger/      append-only log (file_name, processed_at, run_id); current = latest per file
    stations/    the station master

The ledger entry of a file is written last and commits the run's rows of that
file: run tables are read through it, so what a crashed run left behind is
never seen, and the run that repeats its files replaces it. Readings are
appended through an anti-join on ``uuid``, so a repeated run changes nothing.
Rewrites (delete/update) go through a staged copy under ``rewrites/`` with an
intent written last: from then on the rewrite counts as decided, each of its
steps may be repeated, and the next change of the readings completes what a
crash left. A table that was never written is an empty frame of its schema.
Summaries of the readings are kept beside them, see ``operators.summaries``.
"""

from __future__ import annotations

import os
import uuid as _uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from telemetra.functions.datetime import obs_date, parse_datetime
from telemetra.functions.validate import SENTINEL_DATETIMES
from telemetra import schema
from telemetra.functions.ids import prefix_station_id
from telemetra.functions.text import strip_ws
from telemetra.operators.summaries import Summaries, on_days
from telemetra.schema import CANONICAL, MEASUREMENTS, VALUE_SUFFIX
from telemetra.session import remove_path, scratch_path

READINGS, QUARANTINE, FAILURES, AUDIT, LEDGER_DIR = "readings", "quarantine", "failures", "audit", "ledger"
STATIONS = "stations"
SCHEMAS = {READINGS: schema.READINGS, QUARANTINE: schema.QUARANTINE, FAILURES: schema.FAILURES, AUDIT: schema.AUDIT,
           LEDGER_DIR: schema.LEDGER, STATIONS: schema.STATIONS}
MAX_FILE_ROWS = 5_000_000
_NUMBER = r"^[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?$"


# --- pure DataFrame operators ------------------------------------------------

def _has_pipe(columns: list[str]) -> Column:
    cells = [F.coalesce(F.col(c), F.lit("")) for c in columns if c in CANONICAL]
    return F.exists(F.array(*cells), lambda x: x.contains("|")) if cells else F.lit(False)


def rows_to_insert(batch: DataFrame, existing: DataFrame) -> DataFrame:
    """``INSERT ... ON CONFLICT (uuid) DO NOTHING``: first row per uuid, minus stored uuids."""
    first = batch.dropDuplicates(["uuid"])
    return first.join(existing.select("uuid"), "uuid", "left_anti").select(*batch.columns)


def ledger_upsert(old: DataFrame, new: DataFrame) -> DataFrame:
    """Ledger after an upsert: one row per file with its latest processing time (K2)."""
    return (old.select("file_name", "processed_at").unionByName(new.select("file_name", "processed_at"))
               .groupBy("file_name").agg(F.max("processed_at").alias("processed_at")))


def unprocessed_files(files: DataFrame, ledger: DataFrame) -> DataFrame:
    """Candidate files whose base name is not in the ledger."""
    return files.join(ledger.select("file_name").distinct(), "file_name", "left_anti")


def sentinel_predicate(values: list[str] = SENTINEL_DATETIMES) -> Column:
    """Rows a sentinel DELETE removes; a NULL DateTime is not removed."""
    return F.coalesce(F.col("DateTime").isin(*values), F.lit(False))


def delete_sentinels(df: DataFrame, values: list[str] = SENTINEL_DATETIMES) -> DataFrame:
    """Rows left after deleting the known impossible clock values (K4)."""
    return df.filter(~sentinel_predicate(values))


def measurement(text: Column) -> Column:
    """A cell as DOUBLE, NULL when it is not a plain number."""
    x = strip_ws(text)
    return F.when(x.rlike(_NUMBER), x.try_cast("double"))


def typed_columns(prefix: str = "") -> dict[str, Column]:
    """The clock and the measurements of a row's text columns, named ``prefix`` + column, as typed columns."""
    values = {c + VALUE_SUFFIX: measurement(F.col(prefix + c)) for c in MEASUREMENTS}
    return {"ts": parse_datetime(F.col(prefix + "DateTime")), **values}


def typed_readings(df: DataFrame) -> DataFrame:
    """Stored form of readings: text columns + uuid + parsed ts, measurements as numbers, and obs_date."""
    typed = [column.alias(name) for name, column in typed_columns().items()]
    return df.select(*CANONICAL, "uuid", *typed).withColumn("obs_date", obs_date(F.col("ts")))


def by_day(df: DataFrame) -> DataFrame:
    """Rows dealt by day for a partitioned write: small days share a task, large ones are split over several."""
    return df.hint("rebalance", "obs_date")


# --- table folder --------------------------------------------------------------

def has_data(spark: SparkSession, path: str) -> bool:
    """Whether a table folder holds a data file. Only a missing path or a folder without one counts as absent; any
    other trouble is raised."""
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    files = target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not files.exists(target):
        return False
    depth = len(target.toUri().getPath().rstrip("/")) + 1
    found = files.listFiles(target, True)
    while found.hasNext():
        parts = found.next().getPath().toUri().getPath()[depth:].split("/")
        if not any(p.startswith(".") or p.startswith("_") and "=" not in p for p in parts):
            return True
    return False


class TableStore:
    """The Parquet tables of one deployment under ``root``."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root
        self.summaries = Summaries(self)

    def path(self, name: str) -> str:
        return os.path.join(self.root, name)

    def stored(self, name: str) -> DataFrame:
        """Every row written to a table, those of unfinished runs included (K6: empty before the first write)."""
        if not has_data(self.spark, self.path(name)):
            return self.spark.createDataFrame([], SCHEMAS[name])
        return self.spark.read.schema(SCHEMAS[name]).parquet(self.path(name))

    def read(self, name: str) -> DataFrame:
        """The rows of a table; of the run tables those that the ledger commits."""
        rows = self.stored(name)
        if name not in (QUARANTINE, FAILURES, AUDIT):
            return rows
        done = self.stored(LEDGER_DIR).select(F.col("file_name").alias("_file"), F.col("run_id").alias("_run"))
        # An entry without a run id was written before runs were recorded and commits all rows of its file.
        same = (rows["file_name"] == done["_file"]) & (done["_run"].isNull() | (rows["run_id"] == done["_run"]))
        return rows.join(done, same, "left_semi")

    def ledger(self) -> DataFrame:
        """Current ledger: latest ``processed_at`` per file name."""
        log = self.stored(LEDGER_DIR)
        return ledger_upsert(log.limit(0), log)

    def append_ledger(self, entries: DataFrame) -> None:
        """Upsert = append to the log; readers take the latest entry per file (K2)."""
        entries.select("file_name", "processed_at", "run_id").write.mode("append").parquet(self.path(LEDGER_DIR))

    def append_run_table(self, name: str, df: DataFrame) -> None:
        """Write one run's rows; a replay of the same run_id replaces them (K3)."""
        (df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
         .partitionBy("run_id").parquet(self.path(name)))

    def append_readings(self, batch: DataFrame) -> None:
        """Insert typed readings, ignoring uuids already stored (K1).

        Same uuid means same raw cells, hence the same DateTime and obs_date,
        so only the batch's date partitions need checking. That holds unless
        a cell contains the joiner ``|`` (two rows could then share a key text
        across dates): such rows are checked against the whole uuid column.
        ``batch`` should be a staged (materialised) DataFrame: it is read
        twice, once for its dates and once for the insert.
        """
        self.recover()
        existing = self.stored(READINGS)
        days = batch.groupBy("obs_date").agg(F.max(_has_pipe(batch.columns)).alias("piped")).collect()  # bounded: days
        same_day = existing.filter(on_days([d["obs_date"] for d in days]))
        self.summaries.intend([d["obs_date"] for d in days])
        rows = rows_to_insert(batch, same_day)
        if any(d["piped"] for d in days):
            piped = _has_pipe(batch.columns)
            rows = rows.filter(~piped).unionByName(rows_to_insert(rows.filter(piped), existing))
        self._write_days(rows, "append", self.path(READINGS))
        self.summaries.finish()

    @staticmethod
    def _write_days(rows: DataFrame, mode: str, path: str) -> None:
        """Write rows by day, inside a file by station: row groups hold few stations, and their statistics and Bloom filters
        let a query of one station skip the others."""
        (by_day(rows).sortWithinPartitions("obs_date", "StationID").write.mode(mode)
         .option("partitionOverwriteMode", "dynamic").option("maxRecordsPerFile", MAX_FILE_ROWS)
         .option("parquet.bloom.filter.enabled#StationID", "true").option("parquet.bloom.filter.adaptive.enabled", "true")
         .partitionBy("obs_date").parquet(path))

    def _drop_partitions(self, days: list) -> None:
        """Remove whole ``obs_date`` partition folders (HDFS, S3 and local alike)."""
        jvm = self.spark.sparkContext._jvm
        conf = self.spark.sparkContext._jsc.hadoopConfiguration()
        for d in days:
            name = "__HIVE_DEFAULT_PARTITION__" if d is None else d.isoformat()
            path = jvm.org.apache.hadoop.fs.Path(self.path(READINGS) + f"/obs_date={name}")
            path.getFileSystem(conf).delete(path, True)

    def rewrite_readings(self, affected: Column, transform) -> None:
        """Rewrite the readings partitions holding rows that match ``affected`` (K4/K5 on stored data).

        The affected days are collected (bounded by the number of days). Their
        rows go through ``transform`` and are staged; then the intent is
        written, and the staged copy takes the place of those partitions.
        """
        self.recover()
        current = self.stored(READINGS)
        days = [r[0] for r in current.filter(affected).select("obs_date").distinct().collect()]
        if not days:
            return
        folder = self.path(os.path.join("rewrites", _uuid.uuid4().hex[:12]))
        self._write_days(transform(current.filter(on_days(days))), "overwrite", folder + "/rows")
        changed = current.filter(affected).select("uuid", "StationID")
        staged = self._staged(folder)
        after = staged.join(changed.select("uuid"), "uuid", "left_semi").select("StationID")
        changed.select("StationID").union(after).distinct().write.parquet(folder + "/stations")
        self.spark.createDataFrame([(d,) for d in days], "obs_date date").write.parquet(folder + "/intent")
        self._complete(folder)

    def _staged(self, folder: str) -> DataFrame:
        if not has_data(self.spark, folder + "/rows"):
            return self.spark.createDataFrame([], schema.READINGS)
        return self.spark.read.schema(schema.READINGS).parquet(folder + "/rows")

    def _complete(self, folder: str) -> None:
        """The steps of a decided rewrite; all of them may be repeated."""
        staged = self._staged(folder)
        days = [r[0] for r in self.spark.read.parquet(folder + "/intent").collect()]
        moved = staged.filter(~on_days(days))
        new_days = [r[0] for r in moved.select("obs_date").distinct().collect()]
        self.summaries.intend([*days, *new_days], self.spark.read.parquet(folder + "/stations"))
        # Rows that now belong to other days go there first; a repetition finds them by their uuid.
        if new_days:
            there = self.stored(READINGS).filter(on_days(new_days))
            self._write_days(rows_to_insert(moved, there), "append", self.path(READINGS))
        stay = staged.filter(on_days(days))
        kept = {r[0] for r in stay.select("obs_date").distinct().collect()}
        if kept:
            self._write_days(stay, "overwrite", self.path(READINGS))
        self._drop_partitions([d for d in days if d not in kept])
        self.summaries.finish()
        remove_path(self.spark, folder)

    def recover(self) -> None:
        """Complete decided rewrites that a crash interrupted; undecided ones have changed nothing and go."""
        jvm = self.spark.sparkContext._jvm
        root = jvm.org.apache.hadoop.fs.Path(self.path("rewrites"))
        files = root.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())
        if not files.exists(root):
            return
        for status in files.listStatus(root):
            folder = os.path.join(self.path("rewrites"), status.getPath().getName())
            if files.exists(jvm.org.apache.hadoop.fs.Path(folder + "/intent/_SUCCESS")):
                self._complete(folder)
            else:
                remove_path(self.spark, folder)

    def delete_sentinel_readings(self, values: list[str] = SENTINEL_DATETIMES) -> None:
        """Stored-table form of the sentinel DELETE (K4): only partitions holding them change."""
        pred = sentinel_predicate(values)
        self.rewrite_readings(pred, lambda df: df.filter(~pred))

    def update_readings(self, affected: Column, column: str, value: Column) -> None:
        """Stored-table UPDATE ... SET column = value WHERE affected: the key stays, the typed columns follow the text,
        and a row whose day changes moves to that day's partition."""
        self.rewrite_readings(affected, lambda df: typed_readings(df.withColumn(
            column, F.when(affected, value).otherwise(F.col(column)))))

    # --- station master ---

    def write_stations(self, stations: DataFrame) -> None:
        """Replace the stored station master; ``stations`` may be read from it."""
        staged_path = scratch_path(self.spark, "stations")
        stations.select(*schema.STATIONS.names).write.parquet(staged_path)
        self.spark.read.schema(schema.STATIONS).parquet(staged_path).write.mode("overwrite").parquet(self.path(STATIONS))
        remove_path(self.spark, staged_path)

    def prefix_station_ids(self) -> None:
        """UPDATE of all stored station ids: put '&' in front (K5)."""
        self.write_stations(self.stored(STATIONS).withColumn("id", prefix_station_id(F.col("id"))))
