"""Output shapes: station x reading projection and the type-dependent payload."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from telemetra.functions.text import strip_ws
from telemetra.schema import AWS_EXTRA_FIELDS, BASE_FIELDS

STATION_COLUMNS = [("id", "station_id"), ("longitude", "longitude"), ("latitude", "latitude"),
                   ("zone", "zone"), ("name", "name"), ("type", "type"), ("location", "location"),
                   ("district", "district")]
METADATA_COLUMNS = ["id", "district", "name", "location", "zone", "latitude", "longitude", "type"]
READING_COLUMNS = BASE_FIELDS + AWS_EXTRA_FIELDS


def station_reading_columns() -> list[Column]:
    return [F.col(src).alias(dst) for src, dst in STATION_COLUMNS]


def project_station_reading(joined: DataFrame, keep: list[str] = ()) -> DataFrame:
    """8 station columns (``id`` as ``station_id``) + 14 reading columns."""
    return joined.select(*station_reading_columns(), *[F.col(c) for c in READING_COLUMNS],
                         *[F.col(c) for c in keep])


def is_aws(type_col: Column) -> Column:
    """AWS test: equality after trim and lower; NULL type counts as ``''``."""
    return F.lower(strip_ws(F.coalesce(type_col, F.lit("")))) == F.lit("aws")


def payload_by_type(df: DataFrame) -> DataFrame:
    """Tabular payload: the 8 AWS extras are NULL unless the station is AWS."""
    aws = is_aws(F.col("type"))
    return df.select(
        *[c for c in df.columns if c not in AWS_EXTRA_FIELDS],
        *[F.when(aws, F.col(c)).alias(c) for c in AWS_EXTRA_FIELDS],
    ).select(*df.columns)


def payload_json(df: DataFrame, keep: list[str] = ()) -> DataFrame:
    """One JSON object per record, as the HTTP payload lists it.

    Non-AWS records omit the extra keys; AWS records carry them even when null.
    """
    base = [F.col(dst) for _, dst in STATION_COLUMNS] + [F.col(c) for c in BASE_FIELDS]
    extra = [F.col(c) for c in AWS_EXTRA_FIELDS]
    opts = {"ignoreNullFields": "false"}
    record = F.when(is_aws(F.col("type")), F.to_json(F.struct(*base, *extra), opts)) \
              .otherwise(F.to_json(F.struct(*base), opts))
    return df.select(*[F.col(c) for c in keep], record.alias("record"))


def project_metadata(stations: DataFrame, with_gid: bool = False) -> DataFrame:
    """Station metadata columns; ``with_gid`` adds the surrogate key first."""
    cols = (["gid"] if with_gid else []) + METADATA_COLUMNS
    return stations.select(*cols)


BASIN_READING_COLUMNS = ["MobileNumber", "Battery", "WaterLevel", "HourlyRain", "DailyRainfall", "DateTime"]


def project_basin_reading(joined: DataFrame) -> DataFrame:
    """Older basin-era projection."""
    return joined.select(
        F.col("id").alias("station_id"), "longitude", "latitude", "basin", "name", "type",
        *BASIN_READING_COLUMNS,
    )
