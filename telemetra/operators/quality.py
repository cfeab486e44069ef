"""Data-quality inspections over stored readings."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from telemetra.functions.datetime import parse_datetime
from telemetra.functions.validate import (SENTINEL_DATETIMES, STATION_ID_PATTERN, anchored, dq_bad_datetime,
                                          valid_datetime)


def dq_bad_station_id(readings: DataFrame) -> DataFrame:
    """Readings whose raw StationID is not ``&`` + 8 hex digits (F9). NULL ids are not listed."""
    return readings.filter(~F.col("StationID").rlike(anchored(STATION_ID_PATTERN)))


def dq_bad_datetime_rows(readings: DataFrame) -> DataFrame:
    """Readings whose DateTime matches neither two-digit-year shape."""
    return readings.filter(dq_bad_datetime(F.col("DateTime")))


def dq_sentinels(readings: DataFrame, values: list[str] = SENTINEL_DATETIMES) -> DataFrame:
    """Readings carrying one of the known impossible clock values."""
    return readings.filter(F.col("DateTime").isin(*values))


def dq_unparseable_datetime(readings: DataFrame) -> DataFrame:
    """Shape-valid clocks that are not real times, e.g. minute 82 or day 00."""
    dt = F.col("DateTime")
    return readings.filter(valid_datetime(dt) & parse_datetime(dt).isNull())
