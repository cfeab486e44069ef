"""Properties: keys equal Python's uuid5, pages tile the result, latest-1 within latest-3."""

import uuid as pyuuid

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from telemetra.functions.ids import row_uuid
from telemetra.functions.patterns import like_literal, make_pattern
from telemetra.plans.stations import latest_readings, station_readings
from telemetra.sources import fixtures as fx

from conftest import SF_SMALL

cells = st.lists(st.text(alphabet=st.characters(blacklist_categories=("Cs",)), max_size=12), min_size=1, max_size=5)


@settings(max_examples=25, deadline=None)
@given(cells)
def test_row_uuid_equals_python_uuid5(spark, values):
    df = spark.createDataFrame([tuple(values)], [f"c{i}" for i in range(len(values))])
    got = df.select(row_uuid([F.col(c) for c in df.columns])).first()[0]
    assert got == str(pyuuid.uuid5(pyuuid.NAMESPACE_DNS, "|".join(values)))


def test_uuid_golden(spark):
    df = spark.createDataFrame([("a", "nan", "None", "é")], ["a", "b", "c", "d"])
    assert df.select(row_uuid([F.col(c) for c in df.columns])).first()[0] == "3d16426c-7401-54c9-a662-e46c3d31eb23"


def test_pages_tile_the_result(spark):
    r, s = fx.readings(spark, SF_SMALL), fx.stations(spark, SF_SMALL)
    total = r.join(s, r.StationID == s.id).filter(F.col("zone") == "ASIA").count()
    seen = []
    for page in range(1, total // 40 + 2):
        seen += [tuple(x) for x in station_readings(r, s, zone="asia", page=page, page_size=40).collect()]
    assert len(seen) == total == len(set(seen))


def test_latest_1_within_latest_3(spark):
    r, s = fx.readings(spark, SF_SMALL), fx.stations(spark, SF_SMALL)
    one = {tuple(x) for x in latest_readings(r, s, limit=1).collect()}
    three = {tuple(x) for x in latest_readings(r, s, limit=3).collect()}
    assert one and one <= three


def test_semi_join_rewrite_equals_plain_form(spark):
    r, s = fx.readings(spark, SF_SMALL), fx.stations(spark, SF_SMALL)
    filtered = {tuple(x) for x in latest_readings(r, s, station_type="aws", limit=2).collect()}
    plain = {tuple(x) for x in latest_readings(r, s, limit=2).filter(F.lower("type").ilike("%aws%")).collect()}
    assert filtered == plain


def test_make_pattern_and_like_escapes():
    assert make_pattern("  Kamrup (Metro), - ") == "%kamrup metro %"
    assert like_literal("%a\\b%") == "%ab%"
    assert like_literal("%a\\_b%") == "%a\\_b%"


def test_argument_bounds(spark):
    import pytest
    r, s = fx.readings(spark, SF_SMALL), fx.stations(spark, SF_SMALL)
    with pytest.raises(ValueError):
        station_readings(r, s, page_size=501)
    with pytest.raises(ValueError):
        latest_readings(r, s, limit=21)
    with pytest.raises(ValueError):
        station_readings(r, s, start_date="2024/13/45")
    for bad in (dict(page=0), dict(page_size=0)):
        with pytest.raises(ValueError):
            station_readings(r, s, **bad)


def test_cursor_pages_tile_the_result(spark):
    from telemetra.plans.stations import station_readings_after

    r, s = fx.readings(spark, SF_SMALL).cache(), fx.stations(spark, SF_SMALL).cache()
    total = r.join(s, r.StationID == s.id).filter(F.col("zone") == "ASIA").count()
    seen, after = [], None
    while page := station_readings_after(r, s, after=after, zone="asia", page_size=90).collect():
        seen += [x.uuid for x in page]
        after = (page[-1].ts, page[-1].uuid)
    r.unpersist()
    s.unpersist()
    assert len(seen) == total == len(set(seen))


def test_building_a_station_query_runs_no_job(spark):
    r, s = fx.readings(spark, SF_SMALL), fx.stations(spark, SF_SMALL)
    tracker = spark.sparkContext.statusTracker()
    before = set(tracker.getJobIdsForGroup(None))
    station_readings(r, s, zone="asia"), latest_readings(r, s, zone="asia")
    assert set(tracker.getJobIdsForGroup(None)) == before


@settings(max_examples=30, deadline=None)
@given(st.lists(st.text(alphabet='ab", x', max_size=14), min_size=1, max_size=30))
def test_cells_equal_the_csv_module(spark, lines):
    import csv

    from telemetra.functions.text import tokenize, unclosed_quote

    df = spark.createDataFrame([(x,) for x in lines], "line string")
    got = df.select("line", tokenize(F.col("line")).alias("cells"), unclosed_quote(F.col("line")).alias("open")).collect()
    for row in got:
        want = next(csv.reader([row.line, "@end@"])) if row.line else [""]
        assert row.open == any("@end@" in c for c in want)
        assert row.open or row.cells == want


def test_list_text_is_pythons(spark):
    from telemetra.functions.text import python_list_repr

    cells = ["O'N", "t\tb", 'q"q', "both'\"", "\\", "\x00\x7f", "é", ""]
    got = spark.createDataFrame([(cells,)], "cells array<string>").select(python_list_repr(F.col("cells"))).first()[0]
    assert got == str(cells)


def test_clocks_ignore_the_session_zone(spark):
    import datetime as dt

    from telemetra.functions.datetime import parse_datetime

    old = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "America/New_York")
        got = spark.createDataFrame([("10/03/24 02:30",)], "x string").select(parse_datetime(F.col("x"))).first()[0]
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)
    assert got == dt.datetime(2024, 3, 10, 2, 30)


def test_aws_type_is_stripped_of_any_white_space(spark):
    from telemetra.operators.projections import is_aws

    df = spark.createDataFrame([("AWS\t",), ("\u00a0aws\n",), ("AWLR",), (None,)], "t string")
    assert [r[0] for r in df.select(is_aws(F.col("t"))).collect()] == [True, True, False, False]

