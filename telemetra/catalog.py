"""Registered queries: one Spark callable and one DuckDB oracle SQL per operator key.

Every callable takes ``(spark, sf_dir)``, reads the driver tables of that
scale through the fixture views, and returns a lazy DataFrame over all rows.
The SQL strings compute the same result in DuckDB from their own literals, with
the fixture views inlined as CTEs.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from telemetra.functions import datetime as fdt
from telemetra.functions import ids, patterns, text, validate
from telemetra.operators import aggregates, filters, joins, projections, quality
from telemetra.plans import stations as plans
from telemetra.schema import AWS_EXTRA_FIELDS, BASE_FIELDS
from telemetra.session import scratch_path
from telemetra.sources import fixtures as fx
from telemetra.sources.fixtures import duck_with
from telemetra.sources.records import records

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn
    return deco


def _views(spark: SparkSession, sf_dir: str):
    return fx.readings(spark, sf_dir), fx.stations(spark, sf_dir)


# --- DuckDB projection helpers ---------------------------------------------

_D_STATION = 'm.id AS station_id, m.longitude, m.latitude, m.zone, m.name, m."type", m.location, m.district'
_D_QUOTE = {"DateTime": '"DateTime"', "AT": '"AT"'}


def _q(c: str) -> str:
    return _D_QUOTE.get(c, c)


def _d_readings(alias: str = "d", payload: bool = False) -> str:
    base = [f"{alias}.{_q(c)}" for c in BASE_FIELDS]
    if payload:
        extra = [f"CASE WHEN lower(trim(coalesce(m.\"type\",''))) = 'aws' THEN {alias}.{_q(c)} END AS {_q(c)}"
                 for c in AWS_EXTRA_FIELDS]
    else:
        extra = [f"{alias}.{_q(c)}" for c in AWS_EXTRA_FIELDS]
    return ", ".join(base + extra)


_D_READING_ALL = ('StationID, "DateTime", MobileNumber, Battery, WaterLevel, HourlyRain, DailyRain, "AT", SnowDepth, '
                  'Evaporation, WS, WD, At_pressure, RH, Sun_Radiation, uuid, ts, obs_date')
_D_WS = "' '||" + "||".join(f"chr({c})" for c in (9, 10, 11, 12, 13, 28, 29, 30, 31, 133, 160, 5760, *range(8192, 8203), 8232,
                                                  8233, 8239, 8287, 12288))


def _d_strip(x: str) -> str:
    return f"trim({x}, {_D_WS})"


# ===========================================================================
# Q1: paged readings (+ envelope) and its parts
# ===========================================================================

_PAGE = dict(start_date="2024-01-05", end_date="25-01-2024", zone="america", page=2, page_size=50)


@register("station_page", duck_with("readings", "stations") + f"""
SELECT {_D_STATION}, {_d_readings(payload=True)} FROM readings d JOIN stations m ON m.id = d.StationID
WHERE d.obs_date BETWEEN DATE '2024-01-05' AND DATE '2024-01-25' AND lower(m.zone) ILIKE '%america%'
ORDER BY d.ts DESC NULLS LAST, d.uuid LIMIT 50 OFFSET 50""")
def q_station_page(spark, sf_dir):
    r, s = _views(spark, sf_dir)
    return plans.station_readings(r, s, **_PAGE)


@register("station_page_2", duck_with("readings", "stations") + f"""
SELECT {_D_STATION}, {_d_readings(payload=True)} FROM readings d JOIN stations m ON m.id = d.StationID
WHERE lower(m.district) ILIKE '%nation_1%' AND lower(m."type") ILIKE '%arg%'
ORDER BY d.ts DESC NULLS LAST, d.uuid LIMIT 20 OFFSET 40""")
def q_station_page_2(spark, sf_dir):
    r, s = _views(spark, sf_dir)
    return plans.station_readings(r, s, district=" Nation_1", station_type="ARG", page=3, page_size=20)


@register("station_page_text", duck_with("readings", "stations") + f"""
SELECT {_D_STATION}, {_d_readings(payload=True)} FROM readings d JOIN stations m ON m.id = d.StationID
WHERE d.obs_date >= DATE '2024-01-10' AND lower(m.location) ILIKE '%household%'
ORDER BY d."DateTime" DESC NULLS FIRST, d.uuid LIMIT 100 OFFSET 0""")
def q_station_page_text(spark, sf_dir):
    r, s = _views(spark, sf_dir)
    return plans.station_readings(r, s, start_date="2024-01-10", location="(Household)", page=1,
                                  page_size=100, order="text")


@register("station_page_cursor", duck_with("readings", "stations") + f"""
SELECT {_D_STATION}, {_d_readings(payload=True)}, d.ts, d.uuid FROM readings d JOIN stations m ON m.id = d.StationID
WHERE lower(m.zone) ILIKE '%asia%' AND (d.ts IS NULL OR d.ts < TIMESTAMP '2024-01-20 12:00:00'
  OR (d.ts = TIMESTAMP '2024-01-20 12:00:00' AND d.uuid > '8'))
ORDER BY d.ts DESC NULLS LAST, d.uuid LIMIT 50""")
def q_station_page_cursor(spark, sf_dir):
    r, s = _views(spark, sf_dir)
    return plans.station_readings_after(r, s, after=("2024-01-20 12:00:00", "8"), zone="Asia", page_size=50)


@register("station_page_jump", duck_with("readings", "stations") + f"""
SELECT {_D_STATION}, {_d_readings(payload=True)} FROM readings d JOIN stations m ON m.id = d.StationID
WHERE d.obs_date BETWEEN DATE '2024-01-05' AND DATE '2024-01-25' AND lower(m.zone) ILIKE '%america%'
ORDER BY d.ts DESC NULLS LAST, d.uuid LIMIT 50 OFFSET 950""")
def q_station_page_jump(spark, sf_dir):
    """A deep page that reads its own days only."""
    return plans.station_readings_jump(_kept_table(spark, sf_dir), fx.stations(spark, sf_dir), **{**_PAGE, "page": 20})


@register("page_metadata_maintained", duck_with("readings", "stations") + """
SELECT CAST(2 AS BIGINT) AS page, CAST(50 AS BIGINT) AS page_size, CAST(count(*) AS BIGINT) AS total_records,
       CAST((count(*) + 49) // 50 AS BIGINT) AS total_pages
FROM readings d JOIN stations m ON m.id = d.StationID
WHERE d.obs_date BETWEEN DATE '2024-01-05' AND DATE '2024-01-25' AND lower(m.zone) ILIKE '%america%'""")
def q_page_metadata_maintained(spark, sf_dir):
    """The page envelope from the maintained day counts (A1, A3)."""
    return plans.station_readings_page_info_kept(_kept_table(spark, sf_dir), fx.stations(spark, sf_dir), **_PAGE)


@register("page_metadata", duck_with("readings", "stations") + """
SELECT CAST(2 AS BIGINT) AS page, CAST(50 AS BIGINT) AS page_size, count(*) AS total_records,
       CAST((count(*) + 49) // 50 AS BIGINT) AS total_pages
FROM readings d JOIN stations m ON m.id = d.StationID
WHERE d.obs_date BETWEEN DATE '2024-01-05' AND DATE '2024-01-25' AND lower(m.zone) ILIKE '%america%'""")
def q_page_metadata(spark, sf_dir):
    r, s = _views(spark, sf_dir)
    return plans.station_readings_page_info(r, s, **_PAGE)


@register("count_readings", duck_with("readings", "stations") + """
SELECT count(*) AS total FROM readings d JOIN stations m ON m.id = d.StationID
WHERE d.obs_date <= DATE '2024-01-20'""")
def q_count_readings(spark, sf_dir):
    r, s = _views(spark, sf_dir)
    return plans.count_readings(r, s, end_date="2024-01-20")


@register("join_station_readings", duck_with("readings", "stations") + f"""
SELECT {_D_STATION}, {_d_readings()}, d.uuid FROM readings d JOIN stations m ON m.id = d.StationID""")
def q_join_station_readings(spark, sf_dir):
    r, s = _views(spark, sf_dir)
    return projections.project_station_reading(joins.join_station_readings(r, s), keep=["uuid"])


@register("project_station_reading", duck_with("readings", "stations") + f"""
SELECT {_D_STATION}, {_d_readings()} FROM readings d JOIN stations m ON m.id = d.StationID""")
def q_project_station_reading(spark, sf_dir):
    r, s = _views(spark, sf_dir)
    return projections.project_station_reading(joins.join_station_readings(r, s))


@register("payload_by_type", duck_with("readings", "stations") + f"""
SELECT {_D_STATION}, {_d_readings(payload=True)}, d.uuid FROM readings d JOIN stations m ON m.id = d.StationID""")
def q_payload_by_type(spark, sf_dir):
    r, s = _views(spark, sf_dir)
    joined = joins.join_station_readings(r, s)
    return projections.payload_by_type(projections.project_station_reading(joined, keep=["uuid"]))


def _d_json_obj(payload_extra: bool) -> str:
    keys = ["station_id", "longitude", "latitude", "zone", "name", "type", "location", "district"]
    src = {"station_id": "m.id", "type": 'm."type"'}
    parts = [f"'{k}', {src.get(k, 'm.' + k)}" for k in keys]
    parts += [f"'{c}', d.{_q(c)}" for c in BASE_FIELDS]
    if payload_extra:
        parts += [f"'{c}', d.{_q(c)}" for c in AWS_EXTRA_FIELDS]
    return "json_object(" + ", ".join(parts) + ")"


@register("payload_json", duck_with("readings", "stations") + f"""
SELECT d.uuid, CASE WHEN lower(trim(coalesce(m."type",''))) = 'aws' THEN {_d_json_obj(True)}::VARCHAR
       ELSE {_d_json_obj(False)}::VARCHAR END AS record
FROM readings d JOIN stations m ON m.id = d.StationID""")
def q_payload_json(spark, sf_dir):
    r, s = _views(spark, sf_dir)
    joined = joins.join_station_readings(r, s)
    return projections.payload_json(projections.project_station_reading(joined, keep=["uuid"]), keep=["uuid"])


# ===========================================================================
# Q2: latest N per station
# ===========================================================================

def _d_latest(n: int, where: str = "") -> str:
    return duck_with("readings", "stations") + f"""
, ranked AS (SELECT *, row_number() OVER (PARTITION BY StationID ORDER BY ts DESC NULLS LAST, uuid) AS rn FROM readings)
SELECT {_D_STATION}, {_d_readings('d', payload=True)} FROM ranked d JOIN stations m ON m.id = d.StationID
WHERE d.rn <= {n} {where}"""


@register("latest_n_per_station", _d_latest(3))
def q_latest_n(spark, sf_dir):
    r, s = _views(spark, sf_dir)
    return plans.latest_readings(r, s, limit=3)


def _kept_table(spark, sf_dir):
    """A scratch table of all readings whose summaries were built after two thirds of them, late rows included."""
    table = store.TableStore(spark, scratch_path(spark, "kept-table"))
    rows = store.typed_readings(fx.readings(spark, sf_dir))
    late = F.crc32(F.col("uuid").cast("binary")) % 3 == 0
    table.append_readings(rows.filter(~late))
    table.summaries.build()
    table.append_readings(rows)
    return table


@register("latest_n_maintained", _d_latest(3))
def q_latest_n_maintained(spark, sf_dir):
    """Latest readings from the maintained newest rows of every station."""
    return plans.latest_readings_kept(_kept_table(spark, sf_dir), fx.stations(spark, sf_dir), limit=3)


@register("distinct_stations_maintained", duck_with("readings") + """SELECT count(DISTINCT StationID) AS stations FROM readings
WHERE obs_date BETWEEN DATE '2024-01-05' AND DATE '2024-01-12'""")
def q_distinct_stations_maintained(spark, sf_dir):
    """Stations with a reading in a range of days, from the maintained day counts (A2)."""
    return _kept_table(spark, sf_dir).summaries.distinct_stations("2024-01-05", "2024-01-12")


@register("latest_1_per_station", _d_latest(1, "AND lower(m.\"type\") ILIKE '%aws%' AND lower(m.zone) ILIKE '%asia%'"))
def q_latest_1(spark, sf_dir):
    r, s = _views(spark, sf_dir)
    return plans.latest_readings(r, s, station_type="aws", zone="Asia")


@register("latest_count", "SELECT count(*) AS total_records FROM (" + _d_latest(
    2, "AND lower(m.district) ILIKE '%nation_2%'") + ")")
def q_latest_count(spark, sf_dir):
    r, s = _views(spark, sf_dir)
    return aggregates.count_rows(plans.latest_readings(r, s, district="NATION_2", limit=2), "total_records")


# ===========================================================================
# Q3/Q6: station metadata and fuzzy filters
# ===========================================================================

_D_META = 'id, district, name, location, zone, latitude, longitude, "type"'


def _d_meta(where: str, gid: bool = False) -> str:
    cols = ("gid, " if gid else "") + _D_META
    return duck_with("stations") + f"SELECT {cols} FROM stations WHERE {where} ORDER BY id"


@register("station_metadata", _d_meta("lower(location) ILIKE '%machinery%'"))
def q_station_metadata(spark, sf_dir):
    return plans.station_metadata(fx.stations(spark, sf_dir), location="Machinery")


@register("station_metadata_gid", _d_meta("lower(\"type\") ILIKE '%aws%' AND lower(zone) ILIKE '%asia%'", gid=True))
def q_station_metadata_gid(spark, sf_dir):
    return plans.station_metadata(fx.stations(spark, sf_dir), station_type="AWS", zone=" Asia ", with_gid=True)


@register("metadata_all", _d_meta("TRUE", gid=True))
def q_metadata_all(spark, sf_dir):
    return plans.station_metadata(fx.stations(spark, sf_dir), with_gid=True)


@register("metadata_count", duck_with("stations") + """
SELECT count(*) AS total_records FROM stations WHERE lower(district) ILIKE '%nation_1%'""")
def q_metadata_count(spark, sf_dir):
    return aggregates.count_rows(plans.station_metadata(fx.stations(spark, sf_dir), district="nation_1"),
                                 "total_records")


@register("filter_fuzzy_district", _d_meta("lower(district) ILIKE '%nation_2%'"))
def q_filter_fuzzy_district(spark, sf_dir):
    return plans.station_metadata(fx.stations(spark, sf_dir), district=" NATION_2 ")


@register("filter_fuzzy_location", _d_meta("lower(location) ILIKE '%building%'"))
def q_filter_fuzzy_location(spark, sf_dir):
    return plans.station_metadata(fx.stations(spark, sf_dir), location="(Building)")


@register("filter_fuzzy_zone", _d_meta("lower(zone) ILIKE '%middle east%'"))
def q_filter_fuzzy_zone(spark, sf_dir):
    return plans.station_metadata(fx.stations(spark, sf_dir), zone="Middle East")


@register("filter_fuzzy_type", _d_meta("lower(\"type\") ILIKE '%awlr%'"))
def q_filter_fuzzy_type(spark, sf_dir):
    return plans.station_metadata(fx.stations(spark, sf_dir), station_type="awlr")


@register("filter_fuzzy_normalized", _d_meta(
    "lower(replace(replace(replace(location, '-', ''), '(', ''), ')', '')) ILIKE '%machinery nation_1%'", gid=True))
def q_filter_fuzzy_normalized(spark, sf_dir):
    return plans.station_metadata(fx.stations(spark, sf_dir), location="Machinery (Nation_1)",
                                  match="normalized", with_gid=True)


@register("filter_exact_type", _d_meta("\"type\" = 'ARG'"))
def q_filter_exact_type(spark, sf_dir):
    return plans.station_metadata(fx.stations(spark, sf_dir), station_type="ARG", match="exact")


@register("filter_exact_basin", duck_with("stations") + """
SELECT id, zone AS basin, name, "type" FROM stations WHERE zone = 'ASIA' ORDER BY id""")
def q_filter_exact_basin(spark, sf_dir):
    s = fx.stations(spark, sf_dir).withColumnRenamed("zone", "basin")
    return filters.filter_stations(s, match="exact", basin="ASIA").select("id", "basin", "name", "type").orderBy("id")


@register("filter_combined", _d_meta(
    "lower(district) ILIKE '%nation_1%' AND lower(zone) ILIKE '%america%' AND lower(\"type\") ILIKE '%arg%' "
    "AND lower(location) ILIKE '%automobile%'"))
def q_filter_combined(spark, sf_dir):
    return plans.station_metadata(fx.stations(spark, sf_dir), district="nation_1", zone="AMERICA",
                                  station_type="arg", location="automobile")


# ===========================================================================
# Q5: basin-era routes (master ``basin`` = zone, readings ``DailyRainfall``)
# ===========================================================================

def _basin_views(spark, sf_dir):
    r, s = _views(spark, sf_dir)
    return r.withColumnRenamed("DailyRain", "DailyRainfall"), s.withColumnRenamed("zone", "basin")


_D_BASIN = ('m.id AS station_id, m.longitude, m.latitude, m.zone AS basin, m.name, m."type", d.MobileNumber, '
            'd.Battery, d.WaterLevel, d.HourlyRain, d.DailyRain AS DailyRainfall, d."DateTime"')


@register("basin_page", duck_with("readings", "stations") + f"""
SELECT {_D_BASIN} FROM readings d JOIN stations m ON m.id = d.StationID
WHERE d.obs_date BETWEEN DATE '2024-01-02' AND DATE '2024-01-28' AND m."type" = 'AWLR' AND m.zone = 'EUROPE'
ORDER BY d."DateTime" DESC NULLS FIRST, d.uuid LIMIT 50 OFFSET 100""")
def q_basin_page(spark, sf_dir):
    r, s = _basin_views(spark, sf_dir)
    return plans.basin_station_readings(r, s, start_date="2024-01-02", end_date="2024-01-28",
                                        station_type="AWLR", basin="EUROPE", page=3, page_size=50)


@register("basin_latest", duck_with("readings", "stations") + f"""
, ranked AS (SELECT *, row_number() OVER (PARTITION BY StationID ORDER BY ts DESC NULLS LAST, uuid) AS rn FROM readings)
SELECT {_D_BASIN} FROM ranked d JOIN stations m ON m.id = d.StationID
WHERE d.rn <= 2 AND m.zone = 'AFRICA'""")
def q_basin_latest(spark, sf_dir):
    r, s = _basin_views(spark, sf_dir)
    return plans.basin_latest_readings(r, s, basin="AFRICA", limit=2)


@register("project_basin_reading", duck_with("readings", "stations") + f"""
SELECT {_D_BASIN} FROM readings d JOIN stations m ON m.id = d.StationID""")
def q_project_basin_reading(spark, sf_dir):
    r, s = _basin_views(spark, sf_dir)
    return projections.project_basin_reading(joins.join_station_readings(r, s))


# ===========================================================================
# Readings scans and filters
# ===========================================================================

_D_READ = duck_with("readings") + f"SELECT {_D_READING_ALL} FROM readings "


@register("scan_readings", _D_READ + "ORDER BY obs_date, uuid")
def q_scan_readings(spark, sf_dir):
    return fx.readings(spark, sf_dir).select("*").orderBy("obs_date", "uuid")


@register("filter_date_between", _D_READ + "WHERE obs_date BETWEEN DATE '2024-01-05' AND DATE '2024-01-10'")
def q_filter_date_between(spark, sf_dir):
    return filters.filter_date(fx.readings(spark, sf_dir), "2024-01-05", "10-01-2024")


@register("filter_date_from", _D_READ + "WHERE obs_date >= DATE '2024-01-25'")
def q_filter_date_from(spark, sf_dir):
    return filters.filter_date(fx.readings(spark, sf_dir), start="2024-01-25")


@register("filter_date_until", _D_READ + "WHERE obs_date <= DATE '2024-01-03'")
def q_filter_date_until(spark, sf_dir):
    return filters.filter_date(fx.readings(spark, sf_dir), end="2024-01-03")


@register("filter_day", _D_READ + "WHERE obs_date = DATE '2024-01-15'")
def q_filter_day(spark, sf_dir):
    return filters.filter_day(fx.readings(spark, sf_dir), "2024-01-15")


@register("filter_date_arg_dmy", _D_READ + "WHERE obs_date BETWEEN DATE '2024-01-05' AND DATE '2024-01-09'")
def q_filter_date_arg_dmy(spark, sf_dir):
    return filters.filter_date(fx.readings(spark, sf_dir), "05-01-2024", "2024-01-09")


@register("filter_date_between_ddmmyy", _D_READ + "WHERE obs_date BETWEEN DATE '2024-01-25' AND DATE '2024-02-02'")
def q_filter_date_between_ddmmyy(spark, sf_dir):
    return filters.filter_date_ddmmyy(fx.readings(spark, sf_dir), "25/01/24", "02/02/24")


_IDS = ["&00000001", "&00000005", "&0000000A", "&00000010", "&00000063"]


@register("filter_station_in", _D_READ + "WHERE StationID IN ('" + "','".join(_IDS) + "')")
def q_filter_station_in(spark, sf_dir):
    return filters.filter_station_in(fx.readings(spark, sf_dir), _IDS)


@register("filter_station_eq", _D_READ + "WHERE StationID = '&00000007'")
def q_filter_station_eq(spark, sf_dir):
    return filters.filter_station_eq(fx.readings(spark, sf_dir), "&00000007")


@register("count_distinct_stations", duck_with("readings") + "SELECT count(DISTINCT StationID) AS n_stations FROM readings")
def q_count_distinct_stations(spark, sf_dir):
    return aggregates.count_distinct(fx.readings(spark, sf_dir), "StationID", "n_stations")


# ===========================================================================
# Data quality over raw cells
# ===========================================================================

_D_RAW = duck_with("raw_readings") + "SELECT line_no, file_name, StationID, \"DateTime\", WaterLevel FROM raw_readings "
_D_DT_FORMATS = ("['%d-%m-%y %H:%M:%S', '%d-%m-%y %H:%M', '%d-%m-%Y %H:%M:%S', '%d-%m-%Y %H:%M', "
                 "'%Y-%m-%d %H:%M:%S', '%Y-%m-%d %H:%M']")


def _d_parse_ts(x: str) -> str:
    return f"try_strptime(replace({_d_strip(x)}, '/', '-'), {_D_DT_FORMATS})"


def _d_valid_dt(x: str) -> str:
    s = _d_strip(x)
    return (f"coalesce(regexp_full_match({s}, '\\d{{2}}[-/]\\d{{2}}[-/]\\d{{2}} \\d{{2}}:\\d{{2}}(:\\d{{2}})?') OR "
            f"regexp_full_match({s}, '(\\d{{2}}[-/]\\d{{2}}[-/]\\d{{4}}|\\d{{4}}[-/]\\d{{2}}[-/]\\d{{2}}) "
            f"\\d{{2}}:\\d{{2}}(:\\d{{2}})?'), false)")


def _d_valid_sid(x: str) -> str:
    return f"coalesce(regexp_full_match({_d_strip(x)}, '&[a-fA-F0-9]{{8}}'), false)"


@register("dq_bad_station_id", _D_RAW + "WHERE NOT regexp_full_match(StationID, '&[a-fA-F0-9]{8}')")
def q_dq_bad_station_id(spark, sf_dir):
    return quality.dq_bad_station_id(fx.raw_readings(spark, sf_dir))


@register("dq_bad_datetime", _D_RAW + """WHERE NOT regexp_full_match("DateTime", '\\d{2}[-/]\\d{2}[-/]\\d{2} \\d{2}:\\d{2}:\\d{2}')
  AND NOT regexp_full_match("DateTime", '\\d{2}[-/]\\d{2}[-/]\\d{2} \\d{2}:\\d{2}')""")
def q_dq_bad_datetime(spark, sf_dir):
    return quality.dq_bad_datetime_rows(fx.raw_readings(spark, sf_dir))


@register("dq_sentinels", _D_RAW + "WHERE \"DateTime\" = '22/05/25 12:82' OR \"DateTime\" = '00/00/00 00:00'")
def q_dq_sentinels(spark, sf_dir):
    return quality.dq_sentinels(fx.raw_readings(spark, sf_dir))


@register("dq_unparseable_datetime", _D_RAW + f"WHERE {_d_valid_dt('\"DateTime\"')} AND {_d_parse_ts('\"DateTime\"')} IS NULL")
def q_dq_unparseable_datetime(spark, sf_dir):
    return quality.dq_unparseable_datetime(fx.raw_readings(spark, sf_dir))


# ===========================================================================
# Scalar functions, one result row per raw row
# ===========================================================================

def _raw_select(spark, sf_dir, **cols):
    r = fx.raw_readings(spark, sf_dir)
    return r.select("line_no", *[c.alias(k) for k, c in cols.items()])


def _d_raw_select(**cols) -> str:
    return duck_with("raw_readings") + "SELECT line_no, " + ", ".join(f"{v} AS {k}" for k, v in cols.items()) \
        + " FROM raw_readings"


_D_CELLS = ["StationID", '"DateTime"', "MobileNumber", "Battery", "WaterLevel", "HourlyRain", "DailyRain", '"AT"', "SnowDepth",
            "Evaporation", "WS", "WD", "At_pressure", "RH", "Sun_Radiation"]


@register("row_uuid", duck_with("readings") + "SELECT MobileNumber, StationID, "
          + fx.duck_uuid("||'|'||".join(f"coalesce({c},'None')" for c in _D_CELLS)) + " AS uuid FROM readings")
def q_row_uuid(spark, sf_dir):
    r = fx.readings(spark, sf_dir)
    return r.select("MobileNumber", "StationID", ids.row_uuid([F.col(c.strip('"')) for c in _D_CELLS]).alias("uuid"))


@register("valid_station_id", _d_raw_select(ok=_d_valid_sid("StationID")))
def q_valid_station_id(spark, sf_dir):
    return _raw_select(spark, sf_dir, ok=validate.valid_station_id(F.col("StationID")))


@register("valid_datetime", _d_raw_select(ok=_d_valid_dt('"DateTime"')))
def q_valid_datetime(spark, sf_dir):
    return _raw_select(spark, sf_dir, ok=validate.valid_datetime(F.col("DateTime")))


_D_DATE_SHAPES = [r"\d{4}[-/]\d{2}[-/]\d{2}", r"\d{2}[-/]\d{2}[-/]\d{4}", r"\d{2}[-/]\d{2}[-/]\d{2}", r"\d{8}"]


_D_DATE_SHAPES = [r"\d{4}[-/]\d{2}[-/]\d{2}", r"\d{2}[-/]\d{2}[-/]\d{4}", r"\d{2}[-/]\d{2}[-/]\d{2}", r"\d{8}"]


def _d_looks_like_date(x: str, v0: bool = False) -> str:
    s = _d_strip(x)
    full = " OR ".join(f"regexp_full_match({s}, '{p}')" for p in _D_DATE_SHAPES)
    if v0:
        hint = f"regexp_matches({s}, '\\d{{2}}:\\d{{2}}') OR regexp_matches({s}, '\\s\\d{{2}}')"
    else:
        hint = f"contains({s}, ':') OR regexp_matches({s}, '\\d{{2}}\\s+\\d{{2}}')"
    return f"coalesce({s} <> '' AND ({full} OR {hint}), false)"


@register("looks_like_date", _d_raw_select(ok=_d_looks_like_date("StationID")))
def q_looks_like_date(spark, sf_dir):
    return _raw_select(spark, sf_dir, ok=validate.looks_like_date(F.col("StationID")))


@register("looks_like_date_v0", _d_raw_select(ok=_d_looks_like_date('"DateTime"', v0=True)))
def q_looks_like_date_v0(spark, sf_dir):
    return _raw_select(spark, sf_dir, ok=validate.looks_like_date_v0(F.col("DateTime")))


@register("short_digits", _d_raw_select(ok=f"coalesce(regexp_full_match({_d_strip('StationID')}, '[0-9]{{1,5}}'), false)"))
def q_short_digits(spark, sf_dir):
    return _raw_select(spark, sf_dir, ok=validate.short_digits(F.col("StationID")))


@register("cast_timestamp", _d_raw_select(ts=_d_parse_ts('"DateTime"')))
def q_cast_timestamp(spark, sf_dir):
    return _raw_select(spark, sf_dir, ts=fdt.parse_datetime(F.col("DateTime")))


@register("cast_date", _d_raw_select(obs_date=f"CAST({_d_parse_ts('\"DateTime\"')} AS DATE)"))
def q_cast_date(spark, sf_dir):
    return _raw_select(spark, sf_dir, obs_date=fdt.obs_date(fdt.parse_datetime(F.col("DateTime"))))


def _d_pattern(x: str, drop: str) -> str:
    inner = f"lower({_d_strip(x)})"
    for ch in drop:
        inner = f"replace({inner}, '{ch}', '')"
    return f"'%'||{inner}||'%'"


@register("make_pattern", duck_with("stations") + f"SELECT id, {_d_pattern('location', '-(),')} AS pattern FROM stations")
def q_make_pattern(spark, sf_dir):
    s = fx.stations(spark, sf_dir)
    return s.select("id", patterns.make_pattern_col(F.col("location")).alias("pattern"))


_D_NAME_LOC = "name||' (x-y), '||location"


@register("make_pattern_basic", duck_with("stations") + f"SELECT id, {_d_pattern(_D_NAME_LOC, '-()')} AS pattern FROM stations")
def q_make_pattern_basic(spark, sf_dir):
    s = fx.stations(spark, sf_dir)
    v = F.concat(F.col("name"), F.lit(" (x-y), "), F.col("location"))
    return s.select("id", patterns.make_pattern_col(v, patterns.PATTERN_DROP_BASIC).alias("pattern"))


@register("update_station_id", duck_with("stations") + """
SELECT gid, '&'||id AS id, district, name, location, zone, latitude, longitude, "type" FROM stations""")
def q_update_station_id(spark, sf_dir):
    s = fx.stations(spark, sf_dir)
    return s.withColumn("id", ids.prefix_station_id(F.col("id")))



# ===========================================================================
# Ingest: lines -> aligned rows, validation, quarantine, audit (Q4 parts)
# ===========================================================================

from telemetra.operators import audit as audit_ops  # noqa: E402
from telemetra.operators import parse as parse_ops  # noqa: E402

# Fixed values of the oracle, written out here so that a wrong constant of the package shows.
EXPECTED_COLUMNS = ["StationID", "DateTime", "MobileNumber", "Battery", "WaterLevel", "HourlyRain", "DailyRain", "AT",
                    "SnowDepth", "Evaporation", "WS", "WD", "At.pressure", "RH", "Sun Radiation"]
CANONICAL = ["StationID", "DateTime", "MobileNumber", "Battery", "WaterLevel", "HourlyRain", "DailyRain", "AT",
             "SnowDepth", "Evaporation", "WS", "WD", "At_pressure", "RH", "Sun_Radiation"]
_D_NA_LIST = """('', '#N/A', '#N/A N/A', '#NA', '-1.#IND', '-1.#QNAN', '-NaN', '-nan', '1.#IND', '1.#QNAN', '<NA>', 'N/A',
  'NA', 'NULL', 'NaN', 'None', 'n/a', 'nan', 'null')"""
_D_ALIAS_MAP = """MAP {'stationid': 'StationID', 'station': 'StationID', 'stid': 'StationID', 'stnid': 'StationID',
  'dateandtime': 'DateTime', 'datetime': 'DateTime', 'date_time': 'DateTime', 'datetimestamp': 'DateTime', 'date': 'Date',
  'time': 'Time', 'mobilenumber': 'MobileNumber', 'mobile': 'MobileNumber', 'mob': 'MobileNumber', 'battery': 'Battery',
  'batt': 'Battery', 'batteryvolt': 'Battery', 'batteryvoltage': 'Battery', 'waterlevel': 'WaterLevel', 'wl': 'WaterLevel',
  'hourlyrain': 'HourlyRain', 'hourrain': 'HourlyRain', 'dailyrain': 'DailyRain', 'dailyrainfall': 'DailyRain',
  'rain24': 'DailyRain', 'at': 'AT', 'airtemp': 'AT', 'temp': 'AT', 'snowdepth': 'SnowDepth', 'snow': 'SnowDepth',
  'evaporation': 'Evaporation', 'evap': 'Evaporation', 'ws': 'WS', 'wd': 'WD', 'atpressure': 'At.pressure',
  'pressure': 'At.pressure', 'baro': 'At.pressure', 'rh': 'RH', 'humidity': 'RH', 'sunradiation': 'Sun Radiation',
  'solar': 'Sun Radiation', 'radiation': 'Sun Radiation'}"""
_D_EXPECTED = """['StationID', 'DateTime', 'MobileNumber', 'Battery', 'WaterLevel', 'HourlyRain', 'DailyRain', 'AT',
  'SnowDepth', 'Evaporation', 'WS', 'WD', 'At.pressure', 'RH', 'Sun Radiation']"""


def _d_nan(x: str) -> str:
    return f"CASE WHEN {x} IS NULL OR {x} IN {_D_NA_LIST} THEN 'nan' ELSE {x} END"


def _d_norm_header(x: str) -> str:
    s = _d_strip(x)
    key = f"lower(replace(replace(replace({s}, '&', ''), ' ', ''), '_', ''))"
    return f"coalesce(map_extract_value({_D_ALIAS_MAP}, {key}), {s})"


def _d_valid_expr(mode: str) -> str:
    if mode == "strict":
        return f"({_d_valid_sid('k_StationID')} AND {_d_valid_dt('k_DateTime')})"
    s = _d_strip("k_StationID")
    return (f"({s} <> '' AND NOT {_d_looks_like_date('k_StationID')} "
            f"AND NOT coalesce(regexp_full_match({s}, '[0-9]{{1,5}}'), false))")


_D_CLOSED = """'^"((?:[^"]|"")*)"'"""


def _d_parse(src: str, mode: str = "strict") -> str:
    """CTEs ``d_tok, d_hdr, d_rows, d_cells, d_parsed`` over a line CTE ``src``."""
    clean = "replace(replace(line, chr(0), ''), chr(65533), '')"
    cells = []
    for e, c in zip(EXPECTED_COLUMNS, CANONICAL):
        pos = f"coalesce(list_position(header, '{e}'), 0)"
        cell = f"CASE WHEN {pos} > 0 AND {pos} <= n THEN tokens[{pos}] END"
        cells.append(f"{cell} AS c_{c}")
    for extra in ("Date", "Time"):
        pos = f"coalesce(list_position(header, '{extra}'), 0)"
        cells.append(f"CASE WHEN {pos} > 0 AND {pos} <= n THEN tokens[{pos}] END AS c_{extra}")
    vk = []
    for c in CANONICAL:
        v = f"CASE WHEN c_{c} IN {_D_NA_LIST} THEN NULL ELSE c_{c} END"
        k = f"CASE WHEN c_{c} IS NULL THEN 'None' WHEN c_{c} IN {_D_NA_LIST} THEN 'nan' ELSE c_{c} END"
        if c == "DateTime":
            kd = f"CASE WHEN c_Date IS NULL THEN 'None' WHEN c_Date IN {_D_NA_LIST} THEN 'nan' ELSE c_Date END"
            kt = f"CASE WHEN c_Time IS NULL THEN 'None' WHEN c_Time IN {_D_NA_LIST} THEN 'nan' ELSE c_Time END"
            merged = f"{_d_strip(kd)}||' '||{_d_strip(kt)}"
            v = f"CASE WHEN split_dt THEN {merged} ELSE {v} END"
            k = f"CASE WHEN split_dt THEN {merged} ELSE {k} END"
        vk.append(f"{v} AS v_{c}")
        vk.append(f"{k} AS k_{c}")
    key = "||'|'||".join(f"k_{c}" for c in CANONICAL)
    blank = "coalesce(" + ", ".join(f"v_{c}" for c in CANONICAL) + ") IS NULL"
    return f""", d_tok AS (
SELECT file_path, file_name, line_no, list_transform(cells, lambda x: CASE WHEN regexp_matches(x, {_D_CLOSED})
    THEN replace(regexp_extract(x, {_D_CLOSED}, 1), '""', '"')||regexp_replace(x, {_D_CLOSED}, '') ELSE x END) AS tokens,
  len(list_filter(cells, lambda x: starts_with(x, '"') AND NOT regexp_matches(x, {_D_CLOSED}))) > 0 AS unclosed
FROM (SELECT file_path, file_name, line_no, regexp_extract_all(','||{clean}, ',("(?:[^"]|"")*"[^,]*|[^,]*)', 1) AS cells
  FROM {src} WHERE {_d_strip(clean)} <> '')),
d_first AS (SELECT file_path, arg_min(line_no, line_no) AS first_line_no, arg_min(tokens, line_no) AS ftok
            FROM d_tok GROUP BY file_path),
d_hdr AS (SELECT file_path, first_line_no, len(ftok) AS width,
  coalesce(list_bool_or(list_transform(ftok, lambda x: contains(lower({_d_nan('x')}), 'station')
                                                      OR contains(lower({_d_nan('x')}), 'date'))), false) AS has_header,
  CASE WHEN has_header THEN list_transform(ftok, lambda x: {_d_norm_header(_d_nan('x'))})
       ELSE list_slice({_D_EXPECTED}, 1, least(width, 15)) END AS header,
  CASE WHEN NOT has_header AND width > 15 THEN 'error' END AS file_error
  FROM d_first),
d_rows AS (SELECT t.*, h.width, h.header, h.file_error, len(t.tokens) AS n,
  list_contains(h.header, 'Date') AND list_contains(h.header, 'Time') AS split_dt
  FROM d_tok t JOIN d_hdr h USING (file_path) WHERE NOT (h.has_header AND t.line_no = h.first_line_no)),
d_cells AS (SELECT file_path, file_name, line_no, tokens, n > width OR unclosed AS bad, n, file_error, split_dt, {", ".join(cells)} FROM d_rows),
d_vk AS (SELECT file_path, file_name, line_no, tokens, bad, n, file_error, {", ".join(vk)} FROM d_cells),
d_parsed AS (SELECT *, CASE WHEN bad THEN 'tokenize' WHEN {_d_valid_expr(mode)} THEN 'valid' ELSE 'invalid' END AS kind,
  CASE WHEN NOT bad AND {_d_valid_expr(mode)} THEN {_uuid_of(key)} END AS uuid
  FROM d_vk WHERE bad OR NOT ({blank}))
"""


def _uuid_of(name_sql: str) -> str:
    return fx.duck_uuid(name_sql)


def _parsed(spark, sf_dir, source=fx.raw_lines, mode="strict"):
    rows, headers = parse_ops.parse_lines(source(spark, sf_dir), mode)
    return rows, headers


_D_V = ", ".join(f"v_{c} AS {_q(c)}" for c in CANONICAL)
def _s_v():
    return [F.col("v_" + c).alias(c) for c in CANONICAL]


@register("tokenize_rows", duck_with("raw_lines") + _d_parse("raw_lines") + """
SELECT file_name, line_no, CAST(n AS BIGINT) AS n_cells FROM d_parsed WHERE kind <> 'tokenize'""")
def q_tokenize_rows(spark, sf_dir):
    rows, _ = _parsed(spark, sf_dir)
    return rows.filter(F.col("kind") != "tokenize").select(
        "file_name", "line_no", F.size("tokens").cast("bigint").alias("n_cells"))


@register("tokenize_multiline", duck_with("raw_lines") + """, sized AS (
SELECT *, CASE WHEN line_no%11=0 THEN 2 WHEN line_no%7=0 THEN 3 ELSE 1 END AS parts FROM raw_lines)
SELECT file_name, CAST(sum(parts) OVER (PARTITION BY file_name ORDER BY line_no) - parts AS BIGINT) AS line_no,
  split_part(line, ',', 1) AS first_cell,
  CASE WHEN line_no%11=0 THEN '1'||chr(10)||'2, "3"' WHEN line_no%7=0 THEN 'a'||chr(10)||chr(10)||'b'
       ELSE split_part(line, ',', 3) END AS third_cell,
  CAST(CASE WHEN line_no%11=0 THEN 3 WHEN line_no%7=0 THEN 4 WHEN line_no%59=0 THEN 4 ELSE 3 END AS BIGINT) AS n_cells
FROM sized""")
def q_tokenize_multiline(spark, sf_dir):
    """Records over several lines, from lines of splits (S3)."""
    from telemetra.plans.ingest import Stages

    rows = records(fx.physical_lines(spark, sf_dir), Stages(spark).write)
    cells = rows.select("file_name", "line_no", text.tokenize(F.col("line")).alias("cells"))
    return cells.select("file_name", "line_no", F.col("cells")[0].alias("first_cell"), F.col("cells")[2].alias("third_cell"),
                        F.size("cells").cast("bigint").alias("n_cells"))


def _d_shown(x: str) -> str:
    """One cell of the historic list text; the fixtures hold no control characters."""
    x = f"replace({x}, '\\', '\\\\')"
    return (f"CASE WHEN contains({x}, '''') AND NOT contains({x}, '\"') THEN '\"'||{x}||'\"' "
            f"ELSE ''''||replace({x}, '''', '\\''')||'''' END")


_D_LIST_REPR = f"'['||array_to_string(list_transform(tokens, lambda x: {_d_shown('x')}), ', ')||']'"


@register("tokenize_bad_rows", duck_with("raw_lines") + _d_parse("raw_lines") + f"""
SELECT file_name, line_no, {_D_LIST_REPR} AS raw FROM d_parsed WHERE kind = 'tokenize'""")
def q_tokenize_bad_rows(spark, sf_dir):
    rows, _ = _parsed(spark, sf_dir)
    return rows.filter(F.col("kind") == "tokenize").select(
        "file_name", "line_no", text.python_list_repr(F.col("tokens")).alias("raw"))


@register("clean_bytes", duck_with("messy_lines") + """
SELECT file_name, line_no, replace(replace(line, chr(0), ''), chr(65533), '') AS line FROM messy_lines""")
def q_clean_bytes(spark, sf_dir):
    m = fx.messy_lines(spark, sf_dir)
    return m.select("file_name", "line_no", text.clean_bytes(F.col("line")).alias("line"))


def _d_headers(src: str) -> str:
    return duck_with(src) + _d_parse(src) + """
SELECT d_first.file_path AS file_name, has_header, CAST(width AS BIGINT) AS width, array_to_string(header, '|') AS header
FROM d_hdr JOIN d_first USING (file_path)"""


def _s_headers(spark, sf_dir, source):
    _, headers = _parsed(spark, sf_dir, source)
    return headers.select(F.col("file_path").alias("file_name"), "has_header", F.col("width").cast("bigint"),
                          F.array_join("header", "|").alias("header"))


@register("header_detect", _d_headers("header_lines").replace(
    "array_to_string(header, '|') AS header", "d_hdr.first_line_no"))
def q_header_detect(spark, sf_dir):
    _, headers = _parsed(spark, sf_dir, fx.header_lines)
    return headers.select(F.col("file_path").alias("file_name"), "has_header",
                          F.col("width").cast("bigint"), "first_line_no")


@register("header_normalize", _d_headers("header_lines"))
def q_header_normalize(spark, sf_dir):
    return _s_headers(spark, sf_dir, fx.header_lines)


@register("header_positional", _d_headers("raw_lines"))
def q_header_positional(spark, sf_dir):
    return _s_headers(spark, sf_dir, fx.raw_lines)


@register("align_schema", duck_with("header_lines") + _d_parse("header_lines") + f"""
SELECT file_name, line_no, {_D_V} FROM d_parsed WHERE kind <> 'tokenize'""")
def q_align_schema(spark, sf_dir):
    rows, _ = _parsed(spark, sf_dir, fx.header_lines)
    return rows.filter(F.col("kind") != "tokenize").select("file_name", "line_no", *_s_v())


@register("merge_date_time", duck_with("header_lines") + _d_parse("header_lines") + """
SELECT file_name, line_no, v_DateTime AS "DateTime" FROM d_parsed
WHERE kind <> 'tokenize'""")
def q_merge_date_time(spark, sf_dir):
    rows, _ = _parsed(spark, sf_dir, fx.header_lines)
    return rows.filter(F.col("kind") != "tokenize").select("file_name", "line_no", F.col("v_DateTime").alias("DateTime"))


@register("drop_blank_rows", duck_with("messy_lines") + _d_parse("messy_lines") + """
SELECT file_name, line_no FROM d_parsed""")
def q_drop_blank_rows(spark, sf_dir):
    rows, _ = _parsed(spark, sf_dir, fx.messy_lines)
    return rows.select("file_name", "line_no")


@register("missing_values", duck_with("messy_lines") + _d_parse("messy_lines") + f"""
SELECT file_name, line_no, {_D_V} FROM d_parsed WHERE kind <> 'tokenize'""")
def q_missing_values(spark, sf_dir):
    rows, _ = _parsed(spark, sf_dir, fx.messy_lines)
    return rows.filter(F.col("kind") != "tokenize").select("file_name", "line_no", *_s_v())


@register("uuid_tokens", duck_with("messy_lines") + _d_parse("messy_lines").replace(
    "d_parsed AS (SELECT *,", "d_parsed AS (SELECT *, " + "||'|'||".join(f"k_{c}" for c in CANONICAL) + " AS key_text,")
    + "SELECT file_name, line_no, key_text FROM d_parsed WHERE kind <> 'tokenize'")
def q_uuid_tokens(spark, sf_dir):
    rows, _ = _parsed(spark, sf_dir, fx.messy_lines)
    return rows.filter(F.col("kind") != "tokenize").select(
        "file_name", "line_no", F.concat_ws("|", F.col("keys")).alias("key_text"))


def _d_valid(src: str, mode: str) -> str:
    return duck_with(src) + _d_parse(src, mode) + f"""
SELECT file_name, line_no, {_D_V}, uuid FROM d_parsed WHERE kind = 'valid' AND file_error IS NULL"""


@register("validate_strict", _d_valid("raw_lines", "strict"))
def q_validate_strict(spark, sf_dir):
    rows, _ = _parsed(spark, sf_dir)
    return rows.filter((F.col("kind") == "valid") & F.col("file_error").isNull()).select(
        "file_name", "line_no", *_s_v(), "uuid")


@register("validate_lenient", _d_valid("raw_lines", "lenient"))
def q_validate_lenient(spark, sf_dir):
    rows, _ = _parsed(spark, sf_dir, mode="lenient")
    return rows.filter((F.col("kind") == "valid") & F.col("file_error").isNull()).select(
        "file_name", "line_no", *_s_v(), "uuid")


def _d_record_json() -> str:
    rec = "json_object(" + ", ".join(f"'{e}', v_{c}" for e, c in zip(EXPECTED_COLUMNS, CANONICAL)) + ")::VARCHAR"
    tok = f"json_object('error', 'tokenize', 'raw', {_D_LIST_REPR})::VARCHAR"
    return f"CASE WHEN kind = 'tokenize' THEN {tok} ELSE {rec} END"


def _d_failures(src: str, mode: str) -> str:
    base = duck_with(src) + _d_parse(src, mode)
    sel = f"""SELECT file_path, file_name, line_no, kind, CASE WHEN kind = 'tokenize' THEN 0 ELSE 1 END AS part,
  {_d_record_json()} AS record FROM d_parsed WHERE kind <> 'valid' AND file_error IS NULL"""
    return base + ", d_fail AS (" + sel + ")\n"


@register("quarantine_strict", _d_failures("raw_lines", "strict") + """
SELECT file_name, line_no, kind, record FROM d_fail""")
def q_quarantine_strict(spark, sf_dir):
    rows, _ = _parsed(spark, sf_dir)
    return audit_ops.failures(rows).select("file_name", "line_no", "kind", "record")


@register("quarantine_lenient", _d_failures("raw_lines", "lenient") + """
SELECT file_name, line_no, kind, record FROM d_fail""")
def q_quarantine_lenient(spark, sf_dir):
    rows, _ = _parsed(spark, sf_dir, mode="lenient")
    return audit_ops.failures(rows).select("file_name", "line_no", "kind", "record")


@register("quarantine_union", _d_failures("messy_lines", "strict") + """
SELECT file_name, line_no, kind, part FROM d_fail""")
def q_quarantine_union(spark, sf_dir):
    rows, _ = _parsed(spark, sf_dir, fx.messy_lines)
    return audit_ops.failures(rows).select("file_name", "line_no", "kind", "part")


@register("failed_capped", _d_failures("raw_lines", "lenient") + """
SELECT file_name, line_no FROM d_fail WHERE kind = 'invalid'""")
def q_failed_capped(spark, sf_dir):
    rows, _ = _parsed(spark, sf_dir, mode="lenient")
    return audit_ops.failures(rows).filter(F.col("kind") == "invalid").select("file_name", "line_no")


@register("failed_records_json", _d_failures("raw_lines", "strict") + """
SELECT file_name, CAST(part AS INTEGER) AS part, CAST(floor(line_no / 10000) AS BIGINT) AS chunk_no,
  count(*) AS n_records, '['||string_agg(record, ',' ORDER BY line_no)||']' AS failed_records
FROM d_fail GROUP BY file_name, part, floor(line_no / 10000)""")
def q_failed_records_json(spark, sf_dir):
    rows, _ = _parsed(spark, sf_dir)
    return audit_ops.failed_records_json(rows).drop("file_path")


@register("failed_samples", duck_with("raw_lines") + _d_parse("raw_lines") + f"""
, ranked AS (SELECT file_name, line_no, k_StationID,
   row_number() OVER (PARTITION BY file_path ORDER BY line_no) AS rn FROM d_parsed WHERE kind = 'invalid' AND file_error IS NULL)
SELECT file_name, '['||string_agg({_d_shown('k_StationID')}, ', ' ORDER BY line_no)||']' AS examples
FROM ranked WHERE rn <= 5 GROUP BY file_name""")
def q_failed_samples(spark, sf_dir):
    rows, _ = _parsed(spark, sf_dir)
    return audit_ops.failed_samples(rows).drop("file_path")


def _d_audit(src: str, mode: str) -> str:
    base = duck_with(src) + _d_parse(src, mode)
    if mode == "strict":
        fail, record, audited = "ni + nt", "nv + ni + nt", "file_error IS NULL AND (nv > 0 OR ni + nt > 0)"
    else:
        fail = "CASE WHEN nv = 0 THEN ni ELSE nt + ni END"
        record = "CASE WHEN nv = 0 THEN ni ELSE nv + nt + ni END"
        audited = "file_error IS NULL"
    return base + f""", d_counts AS (
SELECT h.file_path, f.file_name, h.file_error,
  count(*) FILTER (WHERE p.kind = 'valid') AS nv, count(*) FILTER (WHERE p.kind = 'invalid') AS ni,
  count(*) FILTER (WHERE p.kind = 'tokenize') AS nt
FROM d_hdr h JOIN (SELECT DISTINCT file_path, file_name FROM d_tok) f USING (file_path)
LEFT JOIN d_parsed p USING (file_path) GROUP BY h.file_path, f.file_name, h.file_error),
d_audit AS (SELECT file_path, file_name,
  CASE WHEN {audited} THEN CAST({record} AS BIGINT) END AS record_count,
  CASE WHEN {audited} THEN CAST(nv AS BIGINT) END AS success_count,
  CASE WHEN {audited} THEN CAST({fail} AS BIGINT) END AS fail_count,
  CASE WHEN file_error IS NOT NULL THEN file_error WHEN ({audited}) AND nv = 0 THEN 'all_invalid' END AS error,
  {audited} AS audited, {audited} AS ledgered,
  CAST(CASE WHEN file_error IS NULL THEN nv ELSE 0 END AS BIGINT) AS inserted,
  CAST(CASE WHEN {audited} THEN {fail} ELSE 0 END AS BIGINT) AS skipped
FROM d_counts)
"""


@register("file_audit", _d_audit("raw_lines", "strict") + "SELECT * EXCLUDE (file_path) FROM d_audit")
def q_file_audit(spark, sf_dir):
    rows, headers = _parsed(spark, sf_dir)
    return audit_ops.file_audit(rows, headers, "strict").drop("file_path")


@register("file_audit_lenient", _d_audit("messy_lines", "lenient") + "SELECT * EXCLUDE (file_path) FROM d_audit")
def q_file_audit_lenient(spark, sf_dir):
    rows, headers = _parsed(spark, sf_dir, fx.messy_lines, "lenient")
    return audit_ops.file_audit(rows, headers, "lenient").drop("file_path")


@register("run_summary", _d_audit("messy_lines", "strict") + """
SELECT count(*) AS files, CAST(coalesce(sum(inserted), 0) AS BIGINT) AS inserted,
  CAST(coalesce(sum(skipped), 0) AS BIGINT) AS skipped, count(*) FILTER (WHERE error IS NOT NULL) AS files_with_error
FROM d_audit""")
def q_run_summary(spark, sf_dir):
    rows, headers = _parsed(spark, sf_dir, fx.messy_lines)
    return audit_ops.run_summary(audit_ops.file_audit(rows, headers, "strict"))


# ===========================================================================
# Table changes: insert-ignore, ledger, unprocessed files, delete
# ===========================================================================

from telemetra.operators import store  # noqa: E402


@register("insert_ignore_conflicts", duck_with("readings") + f"""
, batch AS (SELECT * FROM readings WHERE obs_date >= DATE '2024-01-15'
            UNION ALL SELECT * FROM readings WHERE obs_date = DATE '2024-01-20'),
existing AS (SELECT uuid FROM readings WHERE obs_date <= DATE '2024-01-20')
SELECT DISTINCT {_D_READING_ALL} FROM batch WHERE uuid NOT IN (SELECT uuid FROM existing)""")
def q_insert_ignore_conflicts(spark, sf_dir):
    r = fx.readings(spark, sf_dir)
    batch = filters.filter_date(r, start="2024-01-15").unionByName(filters.filter_day(r, "2024-01-20"))
    existing = filters.filter_date(r, end="2024-01-20")
    return store.rows_to_insert(batch, existing)


_D_FILES = "(SELECT DISTINCT file_name, strptime(substr(file_name,1,8), '%Y%m%d') AS d FROM raw_lines)"


@register("ledger_upsert", duck_with("raw_lines") + f"""
, old AS (SELECT file_name, TIMESTAMP '2024-02-01 00:00:00' AS processed_at FROM {_D_FILES} WHERE dayofmonth(d) < 16),
new AS (SELECT file_name, TIMESTAMP '2024-02-02 06:00:00' AS processed_at FROM {_D_FILES} WHERE dayofmonth(d) >= 10)
SELECT file_name, max(processed_at) AS processed_at FROM (SELECT * FROM old UNION ALL SELECT * FROM new) GROUP BY file_name""")
def q_ledger_upsert(spark, sf_dir):
    files = _s_files(spark, sf_dir)
    old = files.filter(F.dayofmonth("d") < 16).select(
        "file_name", F.lit("2024-02-01 00:00:00").cast("timestamp_ntz").alias("processed_at"))
    new = files.filter(F.dayofmonth("d") >= 10).select(
        "file_name", F.lit("2024-02-02 06:00:00").cast("timestamp_ntz").alias("processed_at"))
    return store.ledger_upsert(old, new)


def _s_files(spark, sf_dir):
    lines = fx.raw_lines(spark, sf_dir)
    return lines.select("file_name").distinct().withColumn(
        "d", F.to_date(F.substring("file_name", 1, 8), "yyyyMMdd"))


@register("unprocessed_files", duck_with("raw_lines") + f"""
SELECT file_name FROM {_D_FILES} WHERE file_name NOT IN (SELECT file_name FROM {_D_FILES} WHERE dayofmonth(d) < 16)""")
def q_unprocessed_files(spark, sf_dir):
    files = _s_files(spark, sf_dir)
    ledger = files.filter(F.dayofmonth("d") < 16).select("file_name")
    return store.unprocessed_files(files.select("file_name"), ledger)


@register("delete_sentinels", _D_RAW + "WHERE NOT coalesce(\"DateTime\" IN ('22/05/25 12:82', '00/00/00 00:00'), false)")
def q_delete_sentinels(spark, sf_dir):
    return store.delete_sentinels(fx.raw_readings(spark, sf_dir))


_D_VALUES = ", ".join(f"TRY_CAST({_d_strip(_q(c))} AS DOUBLE) AS {c}_value" for c in CANONICAL[3:])
_D_STORED = duck_with("messy_lines") + _d_parse("messy_lines") + f"""
, ins AS (SELECT DISTINCT {", ".join(f"v_{c} AS {_q(c)}" for c in CANONICAL)}, uuid FROM d_parsed
          WHERE kind = 'valid' AND file_error IS NULL)
SELECT *, {_d_parse_ts('"DateTime"')} AS ts, {_D_VALUES}, CAST({_d_parse_ts('"DateTime"')} AS DATE) AS obs_date FROM ins"""


@register("ingest_pipeline", _D_STORED)
def q_ingest_pipeline(spark, sf_dir):
    """Lines -> stored readings of one ingest into an empty table (Q4 without the folder I/O)."""
    rows, _ = _parsed(spark, sf_dir, fx.messy_lines)
    return store.typed_readings(parse_ops.readings_from(rows).dropDuplicates(["uuid"]))


def _ingested_twice(spark, sf_dir) -> store.TableStore:
    """A scratch table folder into which the whole batch was ingested two times."""
    from telemetra.plans.ingest import ingest_lines
    from telemetra.session import scratch_path

    table = store.TableStore(spark, scratch_path(spark, "ingest-twice"))
    lines = fx.messy_lines(spark, sf_dir)
    for _ in range(2):
        files = store.unprocessed_files(lines.select("file_path", "file_name").distinct(), table.ledger())
        ingest_lines(spark, lines, table, candidates=files)
    return table


@register("ingest_stored", _D_STORED)
def q_ingest_stored(spark, sf_dir):
    """What the readings table holds after two ingests of the same files."""
    return _ingested_twice(spark, sf_dir).read(store.READINGS)


@register("ingest_audited", _d_audit("messy_lines", "strict") + """
SELECT file_name, record_count, success_count, fail_count, error, CAST(1 AS BIGINT) AS entries FROM d_audit WHERE ledgered""")
def q_ingest_audited(spark, sf_dir):
    """Audit rows and ledger entries per file after two ingests of the same files."""
    table = _ingested_twice(spark, sf_dir)
    entries = table.stored(store.LEDGER_DIR).groupBy("file_name").agg(F.count("*").alias("entries"))
    return table.read(store.AUDIT).drop("timestamp", "run_id").join(entries, "file_name")
