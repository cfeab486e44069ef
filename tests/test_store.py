"""Stored-table changes: insert-ignore across runs, '|' cells, sentinel delete."""

import datetime as dt

from pyspark.sql import functions as F

from telemetra.functions.ids import row_uuid
from telemetra.operators.store import TableStore, typed_readings
from telemetra.schema import CANONICAL


def _batch(spark, rows):
    data = [tuple(r) + (None,) * (len(CANONICAL) - len(r)) for r in rows]
    df = spark.createDataFrame(data, ", ".join(f"{c} string" for c in CANONICAL))
    return typed_readings(df.withColumn("uuid", row_uuid([F.col(c) for c in CANONICAL])))


def test_insert_ignore_and_sentinel_delete(spark, tmp_path):
    store = TableStore(spark, str(tmp_path))
    store.append_readings(_batch(spark, [("&00000001", "01/01/24 10:00", "1"), ("&00000001", "01/01/24 10:00", "1"),
                                         ("&00000002", "00/00/00 00:00", "2"), ("&00000003", "02/01/24 11:00", "a|b")]))
    assert store.read("readings").count() == 3
    # same rows again (one of them with a '|' cell) plus one new row: only the new row lands
    store.append_readings(_batch(spark, [("&00000001", "01/01/24 10:00", "1"), ("&00000003", "02/01/24 11:00", "a|b"),
                                         ("&00000004", "03/01/24 12:00", "4")]))
    r = store.read("readings")
    assert r.count() == 4 and r.select("uuid").distinct().count() == 4
    store.append_readings(_batch(spark, [("&00000005", "22/05/25 12:82", "5"), ("&00000006", "03/01/24 13:00", "6")]))
    store.delete_sentinel_readings()
    left = {x.StationID for x in store.read("readings").collect()}
    assert "&00000005" not in left and "&00000002" not in left and {"&00000001", "&00000003", "&00000004", "&00000006"} <= left
    days = {x.obs_date for x in store.read("readings").collect()}
    assert dt.date(2024, 1, 3) in days


def test_date_filter_prunes_stored_partitions(spark, tmp_path):
    from telemetra.operators.filters import filter_date
    from telemetra.plans.stations import station_readings
    from telemetra.sources import fixtures as fx
    from conftest import SF_SMALL

    store = TableStore(spark, str(tmp_path))
    store.append_readings(fx.readings(spark, SF_SMALL))
    stored = store.read("readings")
    df = filter_date(stored, "2024-01-05", "2024-01-06").select("StationID")
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(obs_date" in plan and "ReadSchema: struct<StationID:string>" in plan
    page = station_readings(stored, fx.stations(spark, SF_SMALL), start_date="2024-01-05", end_date="2024-01-06")
    assert "PartitionFilters: [isnotnull(obs_date" in page._jdf.queryExecution().executedPlan().toString()
    assert df.count() == fx.readings(spark, SF_SMALL).filter("obs_date BETWEEN '2024-01-05' AND '2024-01-06'").count()


def test_update_moves_rows_to_their_new_day(spark, tmp_path):
    store = TableStore(spark, str(tmp_path))
    store.append_readings(_batch(spark, [("&00000001", "22/05/25 10:00", "a|b"), ("&00000002", "22/05/25 10:00", "2"),
                                         ("&00000003", "23/05/25 11:00", "3")]))
    store.update_readings(F.col("StationID") != "&00000002", "DateTime", F.lit("24/05/25 09:00"))
    rows = {r.StationID: (r.DateTime, r.ts, r.obs_date) for r in store.read("readings").collect()}
    moved = ("24/05/25 09:00", dt.datetime(2025, 5, 24, 9), dt.date(2025, 5, 24))
    assert rows == {"&00000001": moved, "&00000003": moved,
                    "&00000002": ("22/05/25 10:00", dt.datetime(2025, 5, 22, 10), dt.date(2025, 5, 22))}


def test_files_follow_days_not_tasks(spark, tmp_path):
    import os

    small = {"spark.sql.adaptive.advisoryPartitionSizeInBytes": "16k",
             "spark.sql.adaptive.coalescePartitions.minPartitionSize": "1k"}
    old = {k: spark.conf.get(k) for k in small}
    n = 31 * 64
    rows = spark.range(0, n + 20_000, 1, 64).select(
        F.concat(F.lit("&"), F.lpad(F.hex("id"), 8, "0")).alias("StationID"),
        F.concat(F.lpad(F.when(F.col("id") < n, F.col("id") % 31 + 1).otherwise(7).cast("string"), 2, "0"),
                 F.lit("/01/24 10:00")).alias("DateTime"), *[F.col("id").cast("string").alias(c) for c in CANONICAL[2:]])
    batch = typed_readings(rows.withColumn("uuid", F.md5("StationID")))
    try:
        for k, v in small.items():
            spark.conf.set(k, v)
        TableStore(spark, str(tmp_path)).append_readings(batch)
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)
    files = {d: len([f for f in os.listdir(tmp_path / "readings" / d) if f.endswith(".parquet")])
             for d in os.listdir(tmp_path / "readings") if d.startswith("obs_date")}
    assert len(files) == 31 and sum(files.values()) < 31 * 8
    assert files["obs_date=2024-01-07"] > 1


def test_stored_station_ids_get_their_prefix(spark, tmp_path):
    from telemetra.sources import fixtures as fx
    from conftest import SF_SMALL

    store = TableStore(spark, str(tmp_path))
    store.write_stations(fx.stations(spark, SF_SMALL))
    before = {r.id for r in store.read("stations").collect()}
    store.prefix_station_ids()
    assert {r.id for r in store.read("stations").collect()} == {"&" + i for i in before}



def _scan_metric(df, name):
    """Sum of a metric over the plan's scans, after running it."""
    plan = df._jdf.queryExecution().executedPlan()
    df._jdf.queryExecution().toRdd().count()
    plan = plan.executedPlan() if "AdaptiveSparkPlan" in plan.nodeName() else plan
    leaves = plan.collectLeaves()
    return sum(leaves.apply(i).metrics().apply(name).value() for i in range(leaves.size()))


def test_a_station_query_skips_row_groups(spark, tmp_path):
    rows = spark.range(0, 40_000, 1, 8).select(
        F.concat(F.lit("&"), F.lpad(F.hex(F.col("id") % 400), 8, "0")).alias("StationID"),
        F.concat(F.lpad((F.col("id") % 2 + 1).cast("string"), 2, "0"), F.lit("/01/24 10:00")).alias("DateTime"),
        *[F.col("id").cast("string").alias(c) for c in CANONICAL[2:]])
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    conf.setInt("parquet.block.size", 100_000)
    conf.setInt("parquet.page.size.row.check.min", 10)
    conf.setInt("parquet.block.size.row.check.min", 10)
    try:
        TableStore(spark, str(tmp_path)).append_readings(typed_readings(rows.withColumn("uuid", F.md5(F.col("AT")))))
    finally:
        for name in ("parquet.block.size", "parquet.page.size.row.check.min", "parquet.block.size.row.check.min"):
            conf.unset(name)
    stored = TableStore(spark, str(tmp_path)).read("readings")
    one = stored.filter("StationID = '&0000000A'").select("uuid")
    assert one.count() == 100
    assert _scan_metric(one, "numOutputRows") < 10_000 < _scan_metric(stored.select("uuid"), "numOutputRows")
