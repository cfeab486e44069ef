"""Maintained summaries against the same queries over all readings, after inserts, late rows, deletes, updates, crashes."""

import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from telemetra.operators.store import TableStore
from telemetra.operators.summaries import Summaries
from telemetra.operators.windows import latest_n
from telemetra.plans import stations as plans
from telemetra.schema import MAX_LATEST
from telemetra.sources import fixtures as fx


def rows(df):
    return sorted(map(str, df.collect()))


def agrees(store, stations):
    stored = store.stored("readings")
    assert rows(store.summaries.day_counts().select("StationID", "obs_date", "n")) == rows(
        stored.groupBy("StationID", "obs_date").agg(F.count("*").alias("n")))
    assert rows(store.summaries.latest().select("uuid", "DateTime")) == rows(latest_n(stored, MAX_LATEST).select("uuid", "DateTime"))
    assert store.summaries.distinct_stations().first()[0] == stored.select("StationID").distinct().count()


@pytest.fixture(scope="module")
def stations(spark):
    return fx.stations(spark, SF_SMALL)


@pytest.fixture(scope="module")
def source(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("readings") / "t")
    df = store_form(fx.readings(spark, SF_SMALL))
    # Few stations, so that one of them has far more readings than a summary holds.
    few = F.concat(F.lit("&0000000"), F.conv(F.crc32(F.col("uuid").cast("binary")) % 9, 10, 16))
    df = df.withColumn("StationID", few).withColumn("DateTime", F.when(F.crc32("MobileNumber") % 20 == 0, "00/00/00 00:00").otherwise(F.col("DateTime")))
    store_form(df).write.parquet(path)
    return spark.read.parquet(path)


def store_form(df):
    from telemetra.operators.store import typed_readings
    return typed_readings(df)


def test_kept_through_inserts_late_rows_deletes_and_updates(spark, tmp_path, source, stations):
    store = TableStore(spark, str(tmp_path))
    part = F.crc32("Battery") % 3
    store.append_readings(source.filter(part == 0))
    assert not store.summaries.kept()
    store.summaries.build()
    agrees(store, stations)
    store.append_readings(source.filter(part == 1))     # rows of all days: late ones too
    agrees(store, stations)
    store.append_readings(source.filter(part <= 1))     # nothing new
    agrees(store, stations)
    store.delete_sentinel_readings()
    agrees(store, stations)
    store.update_readings(F.col("uuid") < "2", "DateTime", F.lit("24/05/25 09:00"))
    agrees(store, stations)
    store.update_readings(F.col("uuid") > "f", "StationID", F.lit("&000000FF"))
    agrees(store, stations)
    store.append_readings(source.filter(part == 2))
    agrees(store, stations)


@pytest.fixture(scope="module")
def table(spark, tmp_path_factory, stations):
    store = TableStore(spark, str(tmp_path_factory.mktemp("table")))
    all_rows = fx.readings(spark, SF_SMALL)
    store.append_readings(store_form(all_rows))
    store.summaries.build()
    return store


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_queries_equal_those_over_the_readings(spark, table, stations):
    stored = table.stored("readings")
    for filters in ({}, {"zone": "asia"}, {"start_date": "2024-01-05", "end_date": "2024-01-20", "station_type": "aws"}):
        assert rows(plans.count_readings_kept(table, stations, **filters)) == rows(plans.count_readings(stored, stations, **dict(filters)))
        for page in (1, 2, 7):
            a = plans.station_readings_jump(table, stations, page=page, page_size=20, **filters)
            assert a.collect() == plans.station_readings(stored, stations, page=page, page_size=20, **filters).collect()
            assert rows(plans.station_readings_page_info_kept(table, stations, page=page, page_size=20, **filters)) == rows(
                plans.station_readings_page_info(stored, stations, page=page, page_size=20, **filters))
    assert plans.latest_readings_kept(table, stations, limit=5).collect() == plans.latest_readings(stored, stations, limit=5).collect()
    ranged = table.summaries.distinct_stations("2024-01-05", "2024-01-06")
    assert rows(ranged) == rows(stored.filter("obs_date BETWEEN '2024-01-05' AND '2024-01-06'").agg(F.countDistinct("StationID").alias("stations")))
    exact = table.summaries.distinct_stations().first()[0]
    assert abs(table.summaries.distinct_stations(exact=False).first()[0] - exact) <= 0.05 * exact


def test_summaries_are_read_instead_of_readings(table, stations):
    readings = table.path("readings")
    for df in (plans.count_readings_kept(table, stations), plans.latest_readings_kept(table, stations)):
        assert readings not in " ".join(df.inputFiles())
    deep = plans.station_readings_jump(table, stations, page=40, page_size=10)
    days = {f.split("obs_date=")[1].split("/")[0] for f in deep.inputFiles() if "obs_date=" in f}
    pruned = plan(deep)
    assert "PartitionFilters: [" in pruned and "obs_date" in pruned.split("PartitionFilters: [")[1][:200]
    assert days


@pytest.mark.parametrize("step", ["_write_days", "_drop_partitions", "finish", "intend"])
def test_a_rewrite_that_crashed_is_completed_by_the_next_call(spark, tmp_path, monkeypatch, source, stations, step):
    store = TableStore(spark, str(tmp_path))
    store.append_readings(source)
    store.summaries.build()
    want = store.stored("readings").filter("DateTime <> '00/00/00 00:00'").count()
    moved = store.stored("readings").filter("uuid < '1'").count()
    owner = TableStore if step in ("_write_days", "_drop_partitions") else Summaries
    real, calls = getattr(owner, step), []

    def crash(self, *args, **kwargs):
        calls.append(args)
        if len(calls) == (2 if step == "_write_days" else 1):
            raise RuntimeError("driver gone")
        return real(self, *args, **kwargs) if step != "_write_days" else real(*((self, *args)), **kwargs)

    with monkeypatch.context() as m:
        m.setattr(owner, step, staticmethod(crash) if step == "_write_days" else crash)
        with pytest.raises(RuntimeError):
            store.rewrite_readings(F.col("DateTime").isin("00/00/00 00:00") | (F.col("uuid") < "1"), lambda df: store_form(
                df.filter("DateTime <> '00/00/00 00:00'").withColumn("DateTime", F.when(F.col("uuid") < "1", "24/05/25 09:00").otherwise(F.col("DateTime")))))
    store = TableStore(spark, str(tmp_path))
    store.recover()
    stored = store.stored("readings")
    assert stored.count() == want == stored.select("uuid").distinct().count()
    assert stored.filter("obs_date = '2025-05-24'").count() <= moved and stored.filter("uuid < '1' AND obs_date <> '2025-05-24'").count() == 0
    agrees(store, stations)
