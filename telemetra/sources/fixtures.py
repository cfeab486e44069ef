"""Station-telemetry views derived from the driver's Parquet tables.

The driver tables (``events``, ``customer``, ``nation``, ``region``) stand in
for the readings table and the station master, so every query's work grows
with the input scale. Each view exists twice: as a Spark DataFrame built with
this package's own functions, and as DuckDB SQL (``DUCKDB_CTES``) that the
oracle inlines independently.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from telemetra.functions.datetime import obs_date, parse_datetime
from telemetra.functions.ids import row_uuid
from telemetra.schema import CANONICAL


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))


def _hex_id(c):
    return F.lpad(F.hex(c), 8, "0")


def stations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Station master: one station per customer; district = nation, zone = region."""
    c = table(spark, sf_dir, "customer")
    n = table(spark, sf_dir, "nation")
    r = table(spark, sf_dir, "region")
    # nation/region are fixed 25/5-row dimensions: broadcasting them is bounded.
    j = (c.join(F.broadcast(n), c.c_nationkey == n.n_nationkey)
          .join(F.broadcast(r), n.n_regionkey == r.r_regionkey))
    kind = (F.when(c.c_custkey % 4 == 0, "AWS").when(c.c_custkey % 4 == 1, "ARG")
             .when(c.c_custkey % 4 == 2, "AWLR").otherwise("ARG+AWLR"))
    return j.select(
        c.c_custkey.alias("gid"),
        F.concat(F.lit("&"), _hex_id(c.c_custkey)).alias("id"),
        n.n_name.alias("district"),
        c.c_name.alias("name"),
        F.concat(c.c_mktsegment, F.lit(" ("), n.n_name, F.lit(")")).alias("location"),
        r.r_name.alias("zone"),
        (n.n_nationkey + F.lit(0.5)).cast("double").alias("latitude"),
        (n.n_regionkey + F.lit(90.5)).cast("double").alias("longitude"),
        kind.alias("type"),
    )


def readings_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Readings as the loggers deliver them: 15 text columns (one per event)."""
    e = table(spark, sf_dir, "events")
    eid = e.event_id
    s = lambda x: x.cast("string")
    cols = {
        "StationID": F.concat(F.lit("&"), _hex_id(e.user_id)),
        "DateTime": F.date_format(e.ts, "dd/MM/yy HH:mm:ss"),
        "MobileNumber": F.concat(F.lit("9"), s(eid)),
        "Battery": s(F.round(e.value * 100).cast("bigint")),
        "WaterLevel": s(eid % 1000),
        "HourlyRain": s(eid % 7),
        "DailyRain": s(eid % 31),
        "AT": s(eid % 40),
        "SnowDepth": F.lit(None).cast("string"),
        "Evaporation": s(eid % 5),
        "WS": s(eid % 20),
        "WD": s(eid % 360),
        "At_pressure": s(F.lit(990) + eid % 30),
        "RH": s(eid % 100),
        "Sun_Radiation": F.when(eid % 3 != 0, s(eid % 900)),
    }
    return e.select(*[v.alias(k) for k, v in cols.items()])


def with_reading_keys(df: DataFrame) -> DataFrame:
    """Add the stored key and typed columns to text readings: uuid, ts, obs_date."""
    return (df.withColumn("uuid", row_uuid([F.col(c) for c in CANONICAL]))
              .withColumn("ts", parse_datetime(F.col("DateTime")))
              .withColumn("obs_date", obs_date(F.col("ts"))))


def readings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stored readings table: 15 text columns + uuid + ts + obs_date."""
    return with_reading_keys(readings_text(spark, sf_dir))


def raw_readings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Readings as parsed cells before validation, with injected defects."""
    e = table(spark, sf_dir, "events")
    eid = e.event_id
    hid = _hex_id(e.user_id)
    sid = (F.when(eid % 83 == 0, hid)
            .when(eid % 79 == 0, F.lit("01-01-2024"))
            .when(eid % 73 == 0, F.lit("123"))
            .when(eid % 71 == 0, F.lit(None).cast("string"))
            .when(eid % 67 == 0, F.concat(F.lit(" &"), F.lower(hid), F.lit(" ")))
            .otherwise(F.concat(F.lit("&"), hid)))
    dt = (F.when(eid % 97 == 0, F.lit("00/00/00 00:00"))
           .when(eid % 89 == 0, F.lit("22/05/25 12:82"))
           .when(eid % 61 == 0, F.lit("bad"))
           .when(eid % 3 == 0, F.date_format(e.ts, "yyyy-MM-dd HH:mm:ss"))
           .when(eid % 3 == 1, F.date_format(e.ts, "dd-MM-yyyy HH:mm"))
           .otherwise(F.date_format(e.ts, "dd/MM/yy HH:mm:ss")))
    return e.select(
        eid.alias("line_no"),
        F.concat(F.date_format(e.ts, "yyyyMMdd"), F.lit(".csv")).alias("file_name"),
        sid.alias("StationID"),
        dt.alias("DateTime"),
        (eid % 1000).cast("string").alias("WaterLevel"),
    )


def raw_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw CSV lines, one file per day; some lines carry an extra cell."""
    r = raw_readings(spark, sf_dir)
    line = F.concat(F.coalesce(r.StationID, F.lit("")), F.lit(","), r.DateTime, F.lit(","),
                    F.when(r.line_no % 59 == 0, F.lit("x,y")).otherwise(r.WaterLevel))
    return r.select(F.col("file_name").alias("file_path"), "file_name", "line_no", line.alias("line"))


def messy_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``raw_lines`` with blank lines, all-empty rows, short rows, junk characters and double quotes: around cells,
    around a comma, inside a cell, doubled, before more text, and without end."""
    r = raw_lines(spark, sf_dir)
    n, line = F.col("line_no"), F.col("line")
    sid, clock = F.split_part(line, F.lit(","), F.lit(1)), F.split_part(line, F.lit(","), F.lit(2))
    messy = (F.when(n % 17 == 0, F.lit(""))
              .when(n % 13 == 0, F.lit(",,"))
              .when(n % 23 == 0, F.split_part(line, F.lit(","), F.lit(1)))
              .when(n % 19 == 0, F.concat(line, F.lit("\x00")))
              .when(n % 29 == 0, F.concat(F.lit("\ufffd"), line))
              .when(n % 31 == 0, F.concat(F.lit('"'), sid, F.lit('","'), clock, F.lit('","1,5"')))
              .when(n % 37 == 0, F.concat(line, F.lit('" 3"')))
              .when(n % 41 == 0, F.concat(F.lit('"'), sid, F.lit('"x,'), clock, F.lit(",7")))
              .when(n % 43 == 0, F.concat(sid, F.lit(","), clock, F.lit(',"5""6"')))
              .when(n % 47 == 0, F.concat(F.lit('"'), line))
              .otherwise(line))
    return r.select("file_path", "file_name", "line_no", messy.alias("line"))


def physical_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``raw_lines`` as a scan delivers them: some records have a quoted cell with line breaks and so are several lines.
    Splits hold a few hundred lines and cut records anywhere."""
    r = raw_lines(spark, sf_dir)
    n = F.col("line_no")
    stem = F.concat(F.split_part("line", F.lit(","), F.lit(1)), F.lit(","), F.split_part("line", F.lit(","), F.lit(2)))
    record = (F.when(n % 11 == 0, F.concat(stem, F.lit(',"1\n2, ""3"""')))
              .when(n % 7 == 0, F.concat(stem, F.lit(',"a\n\nb",5" x'))).otherwise(F.col("line")))
    parts = r.select("file_path", "file_name", "line_no", F.posexplode(F.split(record, "\n")).alias("part", "line"))
    block = F.floor((F.col("line_no") * 3 + F.col("part")) / 500)
    order = Window.partitionBy("file_path", "block").orderBy("line_no", "part")
    return parts.withColumn("block", block).select(
        "file_path", "file_name", "block", (F.row_number().over(order) + 10 * F.col("block")).cast("bigint").alias("rid"), "line")


# Header text per file kind (day of month % 3): aliases with "&", blanks and
# case; split Date/Time; the dotted pressure name and an unknown column.
HEADER_KINDS = ["Station ID,Date & Time,WL", "STNID,Date,Time,Batt", "Station,DateTimeStamp,At.pressure,Unknown Col"]


def header_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One header line (line_no -1) per daily file, then its data lines."""
    r = raw_readings(spark, sf_dir)
    kind = F.dayofmonth(F.to_date(F.substring(F.col("file_name"), 1, 8), "yyyyMMdd")) % 3
    sid = F.coalesce(F.col("StationID"), F.lit(""))
    data = F.when(kind == 1, F.concat(sid, F.lit(","), F.replace(F.col("DateTime"), F.lit(" "), F.lit(",")),
                                      F.lit(","), F.col("WaterLevel"))) \
            .otherwise(F.concat(sid, F.lit(","), F.col("DateTime"), F.lit(","), F.col("WaterLevel")))
    body = r.select(F.col("file_name").alias("file_path"), "file_name", "line_no", data.alias("line"))
    heads = (r.groupBy("file_name").agg(F.lit(-1).cast("bigint").alias("line_no"))
              .withColumn("kind", kind)
              .select(F.col("file_name").alias("file_path"), "file_name", "line_no",
                      F.element_at(F.array(*[F.lit(h) for h in HEADER_KINDS]), F.col("kind") + 1).alias("line")))
    return body.unionByName(heads)


# ---------------------------------------------------------------------------
# DuckDB side of the same views, inlined as CTEs by the oracle SQL.
# ---------------------------------------------------------------------------

_UUID_SQL = (
    "substr(h,1,8)||'-'||substr(h,9,4)||'-5'||substr(h,14,3)||'-'||"
    "substr('89ab',(strpos('0123456789abcdef',substr(h,17,1))-1)%4+1,1)||substr(h,18,3)||'-'||substr(h,21,12)"
)


def duck_uuid(name_sql: str) -> str:
    """UUIDv5 (DNS namespace) of a text expression, in DuckDB SQL."""
    return ("(SELECT " + _UUID_SQL + " FROM (SELECT sha1(unhex('6ba7b8109dad11d180b400c04fd430c8')||encode("
            + name_sql + ")) AS h))")


_READ_COLS = ["StationID", '"DateTime"', "MobileNumber", "Battery", "WaterLevel", "HourlyRain", "DailyRain",
              '"AT"', "SnowDepth", "Evaporation", "WS", "WD", "At_pressure", "RH", "Sun_Radiation"]
_KEY_SQL = "||'|'||".join(f"coalesce({c},'None')" for c in _READ_COLS)

DUCK_STATIONS = """stations AS (
SELECT c_custkey AS gid, '&'||printf('%08X', c_custkey) AS id, n_name AS district, c_name AS name,
  c_mktsegment||' ('||n_name||')' AS location, r_name AS zone, CAST(n_nationkey+0.5 AS DOUBLE) AS latitude,
  CAST(n_regionkey+90.5 AS DOUBLE) AS longitude,
  CASE c_custkey%4 WHEN 0 THEN 'AWS' WHEN 1 THEN 'ARG' WHEN 2 THEN 'AWLR' ELSE 'ARG+AWLR' END AS "type"
FROM customer JOIN nation ON c_nationkey=n_nationkey JOIN region ON n_regionkey=r_regionkey)"""

DUCK_READINGS = """readings_text AS (
SELECT '&'||printf('%08X', user_id) AS StationID, strftime(ts,'%d/%m/%y %H:%M:%S') AS "DateTime",
  '9'||CAST(event_id AS VARCHAR) AS MobileNumber, CAST(CAST(round(value*100) AS BIGINT) AS VARCHAR) AS Battery,
  CAST(event_id%1000 AS VARCHAR) AS WaterLevel, CAST(event_id%7 AS VARCHAR) AS HourlyRain,
  CAST(event_id%31 AS VARCHAR) AS DailyRain, CAST(event_id%40 AS VARCHAR) AS "AT", CAST(NULL AS VARCHAR) AS SnowDepth,
  CAST(event_id%5 AS VARCHAR) AS Evaporation, CAST(event_id%20 AS VARCHAR) AS WS, CAST(event_id%360 AS VARCHAR) AS WD,
  CAST(990+event_id%30 AS VARCHAR) AS At_pressure, CAST(event_id%100 AS VARCHAR) AS RH,
  CASE WHEN event_id%3=0 THEN NULL ELSE CAST(event_id%900 AS VARCHAR) END AS Sun_Radiation,
  CAST(date_trunc('second', ts) AS TIMESTAMP) AS ts, CAST(ts AS DATE) AS obs_date
FROM events),
readings_h AS (
SELECT t.*, sha1(unhex('6ba7b8109dad11d180b400c04fd430c8')||encode(""" + _KEY_SQL + """)) AS h FROM readings_text t),
readings AS (
SELECT * EXCLUDE (h), """ + _UUID_SQL + """ AS uuid FROM readings_h)"""

DUCK_RAW_READINGS = """raw_readings AS (
SELECT event_id AS line_no, strftime(ts,'%Y%m%d')||'.csv' AS file_name,
  CASE WHEN event_id%83=0 THEN printf('%08X', user_id) WHEN event_id%79=0 THEN '01-01-2024' WHEN event_id%73=0 THEN '123'
       WHEN event_id%71=0 THEN NULL WHEN event_id%67=0 THEN ' &'||printf('%08x', user_id)||' ' ELSE '&'||printf('%08X', user_id) END AS StationID,
  CASE WHEN event_id%97=0 THEN '00/00/00 00:00' WHEN event_id%89=0 THEN '22/05/25 12:82' WHEN event_id%61=0 THEN 'bad'
       WHEN event_id%3=0 THEN strftime(ts,'%Y-%m-%d %H:%M:%S') WHEN event_id%3=1 THEN strftime(ts,'%d-%m-%Y %H:%M')
       ELSE strftime(ts,'%d/%m/%y %H:%M:%S') END AS "DateTime",
  CAST(event_id%1000 AS VARCHAR) AS WaterLevel
FROM events)"""

DUCK_RAW_LINES = """raw_lines AS (
SELECT file_name AS file_path, file_name, line_no, coalesce(StationID,'')||','||"DateTime"||','||
  CASE WHEN line_no%59=0 THEN 'x,y' ELSE WaterLevel END AS line FROM raw_readings)"""


DUCK_MESSY_LINES = """messy_lines AS (
SELECT file_path, file_name, line_no,
  CASE WHEN line_no%17=0 THEN '' WHEN line_no%13=0 THEN ',,' WHEN line_no%23=0 THEN split_part(line, ',', 1)
       WHEN line_no%19=0 THEN line||chr(0) WHEN line_no%29=0 THEN chr(65533)||line
       WHEN line_no%31=0 THEN '"'||split_part(line, ',', 1)||'","'||split_part(line, ',', 2)||'","1,5"'
       WHEN line_no%37=0 THEN line||'" 3"' WHEN line_no%41=0 THEN '"'||split_part(line, ',', 1)||'"x,'||split_part(line, ',', 2)||',7'
       WHEN line_no%43=0 THEN split_part(line, ',', 1)||','||split_part(line, ',', 2)||',"5""6"'
       WHEN line_no%47=0 THEN '"'||line ELSE line END AS line
FROM raw_lines)"""

DUCK_HEADER_LINES = """header_body AS (
SELECT file_name AS file_path, file_name, line_no,
  CASE WHEN dayofmonth(strptime(substr(file_name,1,8), '%Y%m%d'))%3 = 1
       THEN coalesce(StationID,'')||','||replace("DateTime", ' ', ',')||','||WaterLevel
       ELSE coalesce(StationID,'')||','||"DateTime"||','||WaterLevel END AS line
FROM raw_readings),
header_lines AS (
SELECT * FROM header_body UNION ALL
SELECT file_name, file_name, CAST(-1 AS BIGINT),
  ['""" + "', '".join(HEADER_KINDS) + """'][dayofmonth(strptime(substr(file_name,1,8), '%Y%m%d'))%3 + 1]
FROM (SELECT DISTINCT file_name FROM raw_readings))"""


def duck_with(*ctes: str) -> str:
    """``WITH`` clause over the named fixture CTEs (dependencies added in order)."""
    order = []
    names = set(ctes)
    if "messy_lines" in names:
        names.add("raw_lines")
    if "raw_lines" in names or "header_lines" in names:
        names.add("raw_readings")
    for name, sql in (("stations", DUCK_STATIONS), ("readings", DUCK_READINGS),
                      ("raw_readings", DUCK_RAW_READINGS), ("raw_lines", DUCK_RAW_LINES),
                      ("messy_lines", DUCK_MESSY_LINES), ("header_lines", DUCK_HEADER_LINES)):
        if name in names:
            order.append(sql)
    return "WITH " + ",\n".join(order) + "\n"
