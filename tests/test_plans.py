"""Physical plan checks: pushdown, broadcast, top-k per group, no Python UDFs."""

from telemetra.plans.stations import latest_readings, station_readings
from telemetra.sources import fixtures as fx
from telemetra.operators import parse

from conftest import SF_SMALL


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_latest_uses_partial_window_group_limit(spark):
    df = latest_readings(fx.readings(spark, SF_SMALL), fx.stations(spark, SF_SMALL), limit=3)
    assert "WindowGroupLimit" in _plan(df)


def _final_plan(df):
    query = df._jdf.queryExecution()
    query.toRdd().count()
    return query.executedPlan().toString()


def test_small_master_is_broadcast_and_large_is_not(spark):
    r, s = fx.readings(spark, SF_SMALL), fx.stations(spark, SF_SMALL)
    assert "BroadcastHashJoin" in _final_plan(latest_readings(r, s, limit=3))
    limits = ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold")
    try:
        for name in limits:
            spark.conf.set(name, "-1")
        plan = _final_plan(latest_readings(r, s, limit=3))
    finally:
        for name in limits:
            spark.conf.unset(name)
    assert "SortMergeJoin" in plan


def test_filtered_latest_semi_joins_first(spark):
    df = latest_readings(fx.readings(spark, SF_SMALL), fx.stations(spark, SF_SMALL), zone="asia")
    assert "LeftSemi" in _plan(df)


def test_page_is_top_k_not_full_sort(spark):
    df = station_readings(fx.readings(spark, SF_SMALL), fx.stations(spark, SF_SMALL), page=2, page_size=10)
    assert "TakeOrderedAndProject" in _plan(df)


def test_no_python_udfs_in_ingest(spark):
    rows, _ = parse.parse_lines(fx.messy_lines(spark, SF_SMALL))
    p = _plan(rows)
    assert "BatchEvalPython" not in p and "ArrowEvalPython" not in p


def test_scan_prunes_columns(spark):
    df = fx.readings(spark, SF_SMALL).select("StationID")
    p = _plan(df)
    assert "ReadSchema: struct<user_id:bigint>" in p
