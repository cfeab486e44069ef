"""User-level station queries: paged readings, latest N per station, metadata (Q1-Q3, Q5, Q6).

Each returns a lazy DataFrame; building one runs no job. Station filters are
applied to the (small) station side before the join, which is equivalent to
filtering the joined rows since they only read station columns.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from telemetra.operators.aggregates import page_metadata
from telemetra.operators.filters import date_range_predicate, filter_stations, station_predicates
from telemetra.operators.joins import join_station_readings, semi_join_stations
from telemetra.operators.projections import (READING_COLUMNS, payload_by_type, project_basin_reading,
                                             project_metadata, project_station_reading)
from telemetra.operators.summaries import on_days, page_days
from telemetra.operators.windows import latest_n
from telemetra.schema import DEFAULT_PAGE_SIZE, MAX_LATEST, MAX_PAGE_SIZE


def _check_page(page, page_size) -> tuple[int, int]:
    """Defaults and bounds of the paging arguments."""
    page = 1 if page is None else page
    page_size = DEFAULT_PAGE_SIZE if page_size is None else page_size
    if page < 1:
        raise ValueError("page must be >= 1")
    if not 1 <= page_size <= MAX_PAGE_SIZE:
        raise ValueError(f"page_size must be within 1..{MAX_PAGE_SIZE}")
    return int(page), int(page_size)


def reading_order(order: str = "time") -> list[Column]:
    """Page order, newest first, with ``uuid`` as the total-order tie-breaker (O1).

    ``time`` orders by the parsed clock (unparseable last); ``text`` by the raw
    ``DateTime`` text, as the historic route did (NULLs first, as there).
    """
    if order == "time":
        return [F.col("ts").desc_nulls_last(), F.col("uuid").asc()]
    if order == "text":
        return [F.col("DateTime").desc_nulls_first(), F.col("uuid").asc()]
    raise ValueError(f"unknown order {order!r}")


def _filtered_join(readings: DataFrame, stations: DataFrame, start_date, end_date, match: str,
                   station_filters: dict) -> DataFrame:
    p = date_range_predicate(start_date, end_date)
    if p is not None:
        readings = readings.filter(p)
    stations = filter_stations(stations, match=match, **station_filters)
    return join_station_readings(readings, stations)


def station_readings(readings: DataFrame, stations: DataFrame, *, start_date=None, end_date=None,
                     station_type=None, zone=None, location=None, district=None,
                     page=1, page_size=DEFAULT_PAGE_SIZE, order: str = "time") -> DataFrame:
    """One page of readings joined with their station, newest first (Q1).

    LIMIT/OFFSET over a total order is planned as a top-(offset+limit) per
    partition, so a page costs in proportion to its number. For deep pages
    use ``station_readings_after``, whose cost does not depend on the depth.
    """
    page, page_size = _check_page(page, page_size)
    joined = _filtered_join(readings, stations, start_date, end_date, "fuzzy",
                            dict(station_type=station_type, zone=zone, location=location, district=district))
    out = (project_station_reading(joined, keep=["ts", "uuid"])
           .orderBy(*reading_order(order))
           .offset((page - 1) * page_size)
           .limit(page_size))
    return payload_by_type(out.drop("ts", "uuid"))


def after_predicate(ts, uuid: str) -> Column:
    """Rows behind the cursor (ts, uuid) in time order, newest first, unparseable clocks last."""
    if ts is None:
        return F.col("ts").isNull() & (F.col("uuid") > F.lit(uuid))
    clock = F.lit(str(ts)).cast("timestamp_ntz")
    return F.col("ts").isNull() | (F.col("ts") < clock) | ((F.col("ts") == clock) & (F.col("uuid") > F.lit(uuid)))


def station_readings_after(readings: DataFrame, stations: DataFrame, *, after: tuple | None = None, start_date=None,
                           end_date=None, station_type=None, zone=None, location=None, district=None,
                           page_size=DEFAULT_PAGE_SIZE) -> DataFrame:
    """The ``page_size`` readings behind a cursor, in the order of ``station_readings``, with their own cursor (Q1).

    ``after`` is the (ts, uuid) of the last row seen, ``None`` for the first page. It is a filter on the readings,
    so every partition keeps ``page_size`` rows at most, at any depth; a day behind the cursor's is pruned.
    """
    _, page_size = _check_page(1, page_size)
    if after is not None:
        ts, uuid = after
        readings = readings.filter(after_predicate(ts, uuid))
        if ts is not None:
            readings = readings.filter(F.col("obs_date").isNull() | (F.col("obs_date") <= F.lit(str(ts)[:10]).cast("date")))
    joined = _filtered_join(readings, stations, start_date, end_date, "fuzzy",
                            dict(station_type=station_type, zone=zone, location=location, district=district))
    return payload_by_type(project_station_reading(joined, keep=["ts", "uuid"])
                           .orderBy(*reading_order("time")).limit(page_size))


def station_readings_page_info(readings: DataFrame, stations: DataFrame, *, start_date=None, end_date=None,
                               station_type=None, zone=None, location=None, district=None,
                               page=1, page_size=DEFAULT_PAGE_SIZE) -> DataFrame:
    """Page envelope of ``station_readings``: page, page_size, total_records, total_pages (A1, A3)."""
    page, page_size = _check_page(page, page_size)
    joined = _filtered_join(readings, stations, start_date, end_date, "fuzzy",
                            dict(station_type=station_type, zone=zone, location=location, district=district))
    return page_metadata(joined.select("id"), page, page_size)


def count_readings(readings: DataFrame, stations: DataFrame, **filters) -> DataFrame:
    """Total of the filtered station x reading join (A1)."""
    start, end = filters.pop("start_date", None), filters.pop("end_date", None)
    joined = _filtered_join(readings, stations, start, end, "fuzzy", filters)
    return joined.agg(F.count(F.lit(1)).alias("total"))


def count_readings_kept(store, stations: DataFrame, **filters) -> DataFrame:
    """``count_readings`` from the maintained day counts of a ``TableStore``: the readings are not read (A1)."""
    start, end = filters.pop("start_date", None), filters.pop("end_date", None)
    joined = _filtered_join(store.summaries.day_counts(), stations, start, end, "fuzzy", filters)
    return joined.agg(F.coalesce(F.sum("n"), F.lit(0)).cast("bigint").alias("total"))


def station_readings_page_info_kept(store, stations: DataFrame, *, page=1, page_size=DEFAULT_PAGE_SIZE, **filters) -> DataFrame:
    """``station_readings_page_info`` from the maintained day counts (A3)."""
    page, page_size = _check_page(page, page_size)
    total = F.col("total")
    return count_readings_kept(store, stations, **filters).select(
        F.lit(page).cast("bigint").alias("page"), F.lit(page_size).cast("bigint").alias("page_size"),
        total.alias("total_records"), F.floor((total + (page_size - 1)) / page_size).cast("bigint").alias("total_pages"))


def latest_readings_kept(store, stations: DataFrame, **arguments) -> DataFrame:
    """``latest_readings`` over the maintained newest rows of every station: the history is not read."""
    if arguments.get("order", "time") != "time":
        raise ValueError("the maintained rows are the newest by time")
    return latest_readings(store.summaries.latest(), stations, **arguments)


def station_readings_jump(store, stations: DataFrame, *, start_date=None, end_date=None, page=1,
                          page_size=DEFAULT_PAGE_SIZE, **station_filters) -> DataFrame:
    """``station_readings`` that jumps to its page: prefix sums over the maintained day counts, filters included, pick
    the days that hold the page's rows, and only those days are read (O5, Q1).

    Finding the days is a job of its own over the counts; their number is bounded by the page's rows.
    """
    page, page_size = _check_page(page, page_size)
    offset = (page - 1) * page_size
    joined = _filtered_join(store.summaries.day_counts(), stations, start_date, end_date, "fuzzy", station_filters)
    days = page_days(joined.groupBy("obs_date").agg(F.sum("n").alias("n")), offset, page_size).collect()
    readings = store.stored("readings").filter(on_days([d["obs_date"] for d in days]))
    joined = join_station_readings(readings, filter_stations(stations, match="fuzzy", **station_filters))
    out = (project_station_reading(joined, keep=["ts", "uuid"]).orderBy(*reading_order("time"))
           .offset(offset - min((d["before"] for d in days), default=0)).limit(page_size))
    return payload_by_type(out.drop("ts", "uuid"))


def latest_readings(readings: DataFrame, stations: DataFrame, *, station_type=None, zone=None,
                    district=None, location=None, limit: int = 1, order: str = "time",
                    match: str = "fuzzy") -> DataFrame:
    """Latest ``limit`` readings of every station that passes the filters (Q2).

    The rank covers each station's readings; when a station filter is set the
    readings are first semi-joined to the passing station ids (R4). Equal
    result, since the rank partition key is the join key. Without a filter
    every call ranks the whole history: one scan, at most ``limit`` rows per
    station and input partition shuffled.
    """
    limit = 1 if limit is None else int(limit)
    if not 1 <= limit <= MAX_LATEST:
        raise ValueError(f"limit must be within 1..{MAX_LATEST}")
    filters = dict(station_type=station_type, zone=zone, district=district, location=location)
    if match == "exact":
        filters = {"type" if k == "station_type" else k: v for k, v in filters.items()}
    stations_f = filter_stations(stations, match=match, **filters)
    if station_predicates(match, **filters):
        readings = semi_join_stations(readings, stations_f)
    joined = join_station_readings(latest_n(readings, limit), stations_f)
    text_order = F.col("DateTime").desc_nulls_first() if order == "text" else F.col("ts").desc_nulls_last()
    out = (project_station_reading(joined, keep=["ts", "uuid"])
           .orderBy(F.col("station_id"), text_order, F.col("uuid")))
    return payload_by_type(out.drop("ts", "uuid"))


def station_metadata(stations: DataFrame, *, district=None, location=None, zone=None, station_type=None,
                     with_gid: bool = False, match: str = "fuzzy") -> DataFrame:
    """Station master rows that pass the filters, ordered by id (Q3, Q6)."""
    f = filter_stations(stations, match=match, district=district, location=location, zone=zone,
                        station_type=station_type)
    return project_metadata(f, with_gid=with_gid).orderBy("id")


# --- basin-era routes: master with ``basin``, readings with ``DailyRainfall`` (Q5) ---

def basin_station_readings(readings: DataFrame, stations: DataFrame, *, start_date=None, end_date=None,
                           station_type=None, basin=None, page=1, page_size=DEFAULT_PAGE_SIZE,
                           order: str = "text") -> DataFrame:
    """Older paged route: exact type/basin filters, 12 columns (Q5)."""
    page, page_size = _check_page(page, page_size)
    joined = _filtered_join(readings, stations, start_date, end_date, "exact",
                            {"type": station_type, "basin": basin})
    return (joined.orderBy(*reading_order(order))
            .offset((page - 1) * page_size).limit(page_size)
            .transform(project_basin_reading))


def basin_latest_readings(readings: DataFrame, stations: DataFrame, *, station_type=None, basin=None,
                          limit: int = 1) -> DataFrame:
    """Older latest route: exact type/basin filters, 12 columns (Q5)."""
    limit = 1 if limit is None else int(limit)
    if not 1 <= limit <= MAX_LATEST:
        raise ValueError(f"limit must be within 1..{MAX_LATEST}")
    filters = {"type": station_type, "basin": basin}
    stations_f = filter_stations(stations, match="exact", **filters)
    if station_predicates("exact", **filters):
        readings = semi_join_stations(readings, stations_f)
    joined = join_station_readings(latest_n(readings, limit), stations_f)
    return (joined.orderBy("StationID", F.col("DateTime").desc_nulls_first(), "uuid")
            .transform(project_basin_reading))


__all__ = ["station_readings", "station_readings_after", "station_readings_jump", "count_readings_kept",
           "station_readings_page_info_kept", "latest_readings_kept", "station_readings_page_info", "count_readings", "latest_readings",
           "station_metadata", "basin_station_readings", "basin_latest_readings", "READING_COLUMNS"]
