"""Maintained summaries of the stored readings.

    summaries/day_counts/    (StationID, n) partitioned by obs_date
    summaries/day_sketches/  (sketch): one distinct-station sketch per day, partitioned by obs_date
    summaries/latest/        version=<k>: the MAX_LATEST newest readings of every station; the highest finished version counts
    summaries/intent-<id>/   days and stations that a change of the readings touches, written before it

A change writes its intent, then the readings, then refreshes the touched days and stations from the readings, then
removes the intent. Every step may be repeated. Where a crash left an intent, the next call finishes it first, so what a
reader gets always equals the same query over the readings.
"""

from __future__ import annotations

import uuid as _uuid

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from telemetra import schema
from telemetra.operators.windows import latest_n
from telemetra.schema import MAX_LATEST
from telemetra.session import remove_path

COUNTS = "StationID string, n long, obs_date date"
SKETCHES = "sketch binary, obs_date date"
SKETCH_BITS = 12    # relative standard error of a distinct count: about 1.04 / sqrt(2 ** 12) = 1.6 %


def on_days(days: list) -> Column:
    """Rows of these days; ``None`` among them stands for rows without a day."""
    known = [d for d in days if d is not None]
    found = F.coalesce(F.col("obs_date").isin(*known), F.lit(False)) if known else F.lit(False)
    return found | F.col("obs_date").isNull() if None in days else found


class Summaries:
    """The summaries of one table folder; ``store`` is its ``TableStore``."""

    def __init__(self, store):
        self.store, self.spark, self.root = store, store.spark, store.path("summaries")

    # --- files ---

    def _names(self, folder: str) -> list[str]:
        path = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
        files = path.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())
        return sorted(s.getPath().getName() for s in files.listStatus(path)) if files.exists(path) else []

    def _versions(self) -> list[int]:
        """Finished versions of ``latest``: a write ends with its _SUCCESS file."""
        folder = f"{self.root}/latest"
        return sorted(int(n.split("=")[1]) for n in self._names(folder)
                      if n.startswith("version=") and "_SUCCESS" in self._names(f"{folder}/{n}"))

    def kept(self) -> bool:
        """Whether this folder keeps summaries."""
        return bool(self._versions())

    def _intents(self) -> list[str]:
        return [f"{self.root}/{n}" for n in self._names(self.root) if n.startswith("intent-") and "_SUCCESS" in self._names(f"{self.root}/{n}")]

    def _stored(self, name: str, ddl: str) -> DataFrame:
        folder = f"{self.root}/{name}"
        if not any(n.startswith("obs_date=") for n in self._names(folder)):
            return self.spark.createDataFrame([], ddl)
        return self.spark.read.schema(ddl).parquet(folder)

    # --- changes ---

    def build(self) -> None:
        """Begin to keep summaries: made from all stored readings, kept by every change from now on."""
        days = [r[0] for r in self.store.stored("readings").select("obs_date").distinct().collect()]  # bounded: days
        self._write_days(days)
        self._write_latest(latest_n(self.store.stored("readings"), MAX_LATEST))

    def intend(self, days: list, stations: DataFrame | None = None) -> str | None:
        """Record what a change is about to touch. ``stations`` (StationID) lists the stations that may lose or move
        readings; a change that only adds readings needs none."""
        if not self.kept():
            return None
        path = f"{self.root}/intent-{_uuid.uuid4().hex[:12]}"
        rows = self.spark.createDataFrame([(d, None, True) for d in days], "obs_date date, StationID string, is_day boolean")
        if stations is not None:
            rows = rows.unionByName(stations.select(F.lit(None).cast("date").alias("obs_date"), "StationID",
                                                    F.lit(False).alias("is_day")).distinct())
        rows.write.parquet(path)
        return path

    def finish(self) -> None:
        """Refresh what the recorded changes touch."""
        for path in self._intents():
            rows = self.spark.read.parquet(path)
            days = [r[0] for r in rows.filter("is_day").select("obs_date").distinct().collect()]
            self._refresh(days, rows.filter("NOT is_day").select("StationID"))
            remove_path(self.spark, path)

    def _write_days(self, days: list) -> None:
        readings = self.store.stored("readings").filter(on_days(days))
        counts = readings.groupBy("obs_date", "StationID").agg(F.count("*").alias("n"))
        left = self._overwrite("day_counts", counts.select("StationID", "n", "obs_date"))
        sketches = self._stored("day_counts", COUNTS).filter(on_days(days)).groupBy("obs_date").agg(
            F.hll_sketch_agg("StationID", SKETCH_BITS).alias("sketch"))
        self._overwrite("day_sketches", sketches.select("sketch", "obs_date"))
        for d in set(days) - left:
            name = "__HIVE_DEFAULT_PARTITION__" if d is None else d.isoformat()
            for table in ("day_counts", "day_sketches"):
                remove_path(self.spark, f"{self.root}/{table}/obs_date={name}")

    def _overwrite(self, table: str, rows: DataFrame) -> set:
        """Replace the days of ``rows``; returns them."""
        staged = f"{self.root}/{table}-{_uuid.uuid4().hex[:12]}"
        rows.write.parquet(staged)
        rows = self.spark.read.schema(rows.schema).parquet(staged)
        (rows.hint("rebalance", "obs_date").write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
         .partitionBy("obs_date").parquet(f"{self.root}/{table}"))
        days = {r[0] for r in rows.select("obs_date").distinct().collect()}
        remove_path(self.spark, staged)
        return days

    def _write_latest(self, rows: DataFrame) -> None:
        old = self._versions()
        new = old[-1] + 1 if old else 1
        rows.select(*schema.READINGS.names).write.mode("overwrite").parquet(f"{self.root}/latest/version={new}")
        for v in old[:-1]:  # the last one may still be read
            remove_path(self.spark, f"{self.root}/latest/version={v}")

    def _refresh(self, days: list, stations: DataFrame) -> None:
        """Counts of ``days`` from the readings. The newest rows of a station that only got rows are among its newest
        so far and the rows of the touched days; those of ``stations`` are ranked over their whole history."""
        self._write_days(days)
        readings = self.store.stored("readings")
        rows = self._latest().filter(~on_days(days)).unionByName(readings.filter(on_days(days)))
        if not stations.isEmpty():
            touched = stations.distinct()
            rows = rows.join(touched, rows["StationID"].eqNullSafe(touched["StationID"]), "left_anti").unionByName(
                readings.join(touched, readings["StationID"].eqNullSafe(touched["StationID"]), "left_semi"))
        self._write_latest(latest_n(rows, MAX_LATEST))

    # --- reads ---

    def _latest(self) -> DataFrame:
        return self.spark.read.schema(schema.READINGS).parquet(f"{self.root}/latest/version={self._versions()[-1]}")

    def _ready(self) -> bool:
        if not self.kept():
            return False
        self.finish()
        return True

    def latest(self) -> DataFrame:
        """The newest readings of every station, at most ``MAX_LATEST`` each: ``latest_readings`` over these rows equals
        ``latest_readings`` over all."""
        return self._latest() if self._ready() else latest_n(self.store.stored("readings"), MAX_LATEST)

    def day_counts(self) -> DataFrame:
        """(StationID, n, obs_date): number of readings of every station and day."""
        if self._ready():
            return self._stored("day_counts", COUNTS)
        return self.store.stored("readings").groupBy("StationID", "obs_date").agg(F.count("*").alias("n"))

    def distinct_stations(self, start_date=None, end_date=None, exact: bool = True) -> DataFrame:
        """One row: stations with a reading in a range of days (A2), from the counts; or, as ``exact=False``, an estimate
        from one sketch per day with a standard error of about 1.6 %."""
        from telemetra.operators.filters import filter_date
        if exact or not self._ready():
            days = filter_date(self.day_counts(), start_date, end_date)
            return days.agg(F.countDistinct("StationID").alias("stations"))
        days = filter_date(self._stored("day_sketches", SKETCHES), start_date, end_date)
        return days.agg(F.coalesce(F.hll_sketch_estimate(F.hll_union_agg("sketch")), F.lit(0)).cast("bigint").alias("stations"))


def page_days(day_totals: DataFrame, offset: int, size: int) -> DataFrame:
    """(obs_date, before): the days that hold the rows ``offset`` to ``offset + size`` of all rows, newest day first, rows
    without a day last, and the number of rows on later days. ``day_totals`` (obs_date, n) has one row per day, so its
    prefix sum is one small sort."""
    order = Window.orderBy(F.col("obs_date").desc_nulls_last()).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    summed = day_totals.withColumn("through", F.sum("n").over(order)).withColumn("before", F.col("through") - F.col("n"))
    return summed.filter((F.col("through") > offset) & (F.col("before") < offset + size)).select("obs_date", "before")
