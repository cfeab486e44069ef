"""Joins: station x readings and the semi-join pushdown.

No side is hinted: the planner broadcasts a side from its size on disk (``spark.sql.autoBroadcastJoinThreshold``) and
adaptive execution from its size at run time; larger sides are shuffled and their skewed partitions split.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def join_station_readings(readings: DataFrame, stations: DataFrame, how: str = "inner") -> DataFrame:
    """Readings joined to their station on ``stations.id = readings.StationID``.

    The join is exact: padded or differently-cased ids do not match. Duplicate
    station ids multiply readings, as an equi-join does.
    """
    return readings.join(stations, readings["StationID"] == stations["id"], how)


def semi_join_stations(readings: DataFrame, stations: DataFrame) -> DataFrame:
    """Readings whose StationID occurs in ``stations.id`` (R4 pushdown)."""
    ids = stations.select(F.col("id").alias("_sid"))
    return readings.join(ids, readings["StationID"] == ids["_sid"], "left_semi")
