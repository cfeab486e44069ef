"""Fixed schemas, column lists and lookup values of the telemetry data model."""

from __future__ import annotations

from pyspark.sql import types as T

# --- Fixed values that must equal the reading format of the logger files ---
# Target columns of a reading, in storage and key order, as the loggers and
# the historic tables spell them.
EXPECTED_COLUMNS = [
    "StationID", "DateTime", "MobileNumber", "Battery", "WaterLevel",
    "HourlyRain", "DailyRain", "AT", "SnowDepth",
    "Evaporation", "WS", "WD", "At.pressure", "RH", "Sun Radiation",
]

# Header aliases: normalised header text -> target column (fixed values).
# A header is normalised by trimming, dropping "&", " " and "_" and
# lower-casing; unknown headers keep their trimmed original text.
HEADER_ALIASES = {
    "stationid": "StationID", "station": "StationID", "stid": "StationID", "stnid": "StationID",
    "dateandtime": "DateTime", "datetime": "DateTime", "date_time": "DateTime", "datetimestamp": "DateTime",
    "date": "Date", "time": "Time",
    "mobilenumber": "MobileNumber", "mobile": "MobileNumber", "mob": "MobileNumber",
    "battery": "Battery", "batt": "Battery", "batteryvolt": "Battery", "batteryvoltage": "Battery",
    "waterlevel": "WaterLevel", "wl": "WaterLevel",
    "hourlyrain": "HourlyRain", "hourrain": "HourlyRain",
    "dailyrain": "DailyRain", "dailyrainfall": "DailyRain", "rain24": "DailyRain",
    "at": "AT", "airtemp": "AT", "temp": "AT",
    "snowdepth": "SnowDepth", "snow": "SnowDepth",
    "evaporation": "Evaporation", "evap": "Evaporation",
    "ws": "WS", "wd": "WD",
    "atpressure": "At.pressure", "pressure": "At.pressure", "baro": "At.pressure",
    "rh": "RH", "humidity": "RH",
    "sunradiation": "Sun Radiation", "solar": "Sun Radiation", "radiation": "Sun Radiation",
}

# Cell texts that a CSV reader treats as a missing value (the pandas default
# NA list, fixed values). A missing cell hashes as the token "nan"; a cell
# that does not exist at all (short row, absent column) hashes as "None".
NA_TEXT = [
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan",
    "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None",
    "n/a", "nan", "null",
]
NAN_TOKEN = "nan"
NONE_TOKEN = "None"

# Namespace of the row key: the DNS namespace of RFC 4122 UUIDv5 (fixed value).
UUID_NAMESPACE_HEX = "6ba7b8109dad11d180b400c04fd430c8"

# Characters removed by a full strip: every character that the loggers' reader takes for white space.
WHITESPACE = (" \t\r\n\f\v\x1c\x1d\x1e\x1f\x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008"
              "\u2009\u200a\u2028\u2029\u202f\u205f\u3000")

# Payload field groups: every station gets BASE_FIELDS, AWS stations also
# AWS_EXTRA_FIELDS (stored names, see CANONICAL below).
BASE_FIELDS = ["MobileNumber", "Battery", "WaterLevel", "HourlyRain", "DailyRain", "DateTime"]
AWS_EXTRA_FIELDS = ["AT", "SnowDepth", "Evaporation", "WS", "WD", "At_pressure", "RH", "Sun_Radiation"]

# --- end of fixed values ---


def canonical(name: str) -> str:
    """Stored column name: space and dot become underscore."""
    return name.replace(" ", "_").replace(".", "_")


CANONICAL = [canonical(c) for c in EXPECTED_COLUMNS]
# Stored beside their text as DOUBLE, NULL where the text is no number.
MEASUREMENTS = CANONICAL[3:]
VALUE_SUFFIX = "_value"

READINGS_RAW = T.StructType(
    [T.StructField(c, T.StringType()) for c in CANONICAL] + [T.StructField("uuid", T.StringType())]
)

READINGS = T.StructType(
    list(READINGS_RAW.fields)
    + [T.StructField("ts", T.TimestampNTZType())]
    + [T.StructField(c + VALUE_SUFFIX, T.DoubleType()) for c in MEASUREMENTS]
    + [T.StructField("obs_date", T.DateType())]
)

AUDIT = T.StructType([
    T.StructField("file_name", T.StringType()),
    T.StructField("record_count", T.LongType()),
    T.StructField("success_count", T.LongType()),
    T.StructField("fail_count", T.LongType()),
    T.StructField("error", T.StringType()),
    T.StructField("timestamp", T.TimestampType()),
    T.StructField("run_id", T.StringType()),
])

QUARANTINE = T.StructType([
    T.StructField("file_name", T.StringType()),
    T.StructField("line_no", T.LongType()),
    T.StructField("kind", T.StringType()),
    T.StructField("record", T.StringType()),
    T.StructField("run_id", T.StringType()),
])

FAILURES = T.StructType([
    T.StructField("file_name", T.StringType()),
    T.StructField("part", T.IntegerType()),
    T.StructField("chunk_no", T.LongType()),
    T.StructField("n_records", T.LongType()),
    T.StructField("failed_records", T.StringType()),
    T.StructField("run_id", T.StringType()),
])

LEDGER = T.StructType([
    T.StructField("file_name", T.StringType()),
    T.StructField("processed_at", T.TimestampType()),
    T.StructField("run_id", T.StringType()),
])

STATIONS = T.StructType([
    T.StructField("gid", T.LongType()),
    T.StructField("id", T.StringType()),
    T.StructField("district", T.StringType()),
    T.StructField("name", T.StringType()),
    T.StructField("location", T.StringType()),
    T.StructField("zone", T.StringType()),
    T.StructField("latitude", T.DoubleType()),
    T.StructField("longitude", T.DoubleType()),
    T.StructField("type", T.StringType()),
])

# Bounds of the public query arguments.
MAX_PAGE_SIZE = 500
DEFAULT_PAGE_SIZE = 50
MAX_LATEST = 20
FAILED_SAMPLE_SIZE = 5
