"""Predicates over readings and stations."""

from __future__ import annotations

import functools
import operator

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from telemetra.functions.datetime import parse_date_arg, parse_ddmmyy_arg
from telemetra.functions.patterns import fuzzy_match, fuzzy_match_normalized


def date_range_predicate(start=None, end=None, date_col: str = "obs_date") -> Column | None:
    """Inclusive day range; either end optional (F1-F3). ``None`` when no bound."""
    s, e = parse_date_arg(start), parse_date_arg(end)
    c = F.col(date_col)
    if s is not None and e is not None:
        return c.between(F.lit(s), F.lit(e))
    if s is not None:
        return c >= F.lit(s)
    if e is not None:
        return c <= F.lit(e)
    return None


def filter_date(df: DataFrame, start=None, end=None, date_col: str = "obs_date") -> DataFrame:
    p = date_range_predicate(start, end, date_col)
    return df if p is None else df.filter(p)


def filter_day(df: DataFrame, day, date_col: str = "obs_date") -> DataFrame:
    """Readings of one calendar day."""
    return df.filter(F.col(date_col) == F.lit(parse_date_arg(day)))


def filter_date_ddmmyy(df: DataFrame, start: str, end: str | None = None, date_col: str = "obs_date") -> DataFrame:
    """Inspection form with ``dd/MM/yy`` literals: BETWEEN, or ``>=`` without an end."""
    s = parse_ddmmyy_arg(start)
    if end is None:
        return df.filter(F.col(date_col) >= F.lit(s))
    return df.filter(F.col(date_col).between(F.lit(s), F.lit(parse_ddmmyy_arg(end))))


STATION_FILTER_COLUMNS = {"district": "district", "location": "location", "zone": "zone", "station_type": "type"}


def station_predicates(match: str = "fuzzy", **values) -> list[Column]:
    """Optional station filters; an empty or ``None`` value is no filter.

    ``match``: ``fuzzy`` (one-sided, the current routes), ``normalized``
    (two-sided, older district route) or ``exact`` (older type/basin routes).
    """
    preds = []
    for arg, value in values.items():
        if not value:
            continue
        col = STATION_FILTER_COLUMNS.get(arg, arg)
        if match == "fuzzy":
            preds.append(fuzzy_match(F.col(col), value))
        elif match == "normalized":
            preds.append(fuzzy_match_normalized(F.col(col), value))
        elif match == "exact":
            preds.append(F.coalesce(F.col(col) == F.lit(value), F.lit(False)))
        else:
            raise ValueError(f"unknown match mode {match!r}")
    return preds


def all_of(preds: list[Column]) -> Column:
    """AND of optional predicates; TRUE when there are none (F8)."""
    return functools.reduce(operator.and_, preds, F.lit(True))


def filter_stations(df: DataFrame, match: str = "fuzzy", **values) -> DataFrame:
    preds = station_predicates(match, **values)
    return df.filter(all_of(preds)) if preds else df


def filter_station_in(df: DataFrame, ids: list[str], col: str = "StationID") -> DataFrame:
    """Station id list."""
    return df.filter(F.col(col).isin(*ids))


def filter_station_eq(df: DataFrame, sid: str, col: str = "StationID") -> DataFrame:
    """Single station id."""
    return df.filter(F.col(col) == F.lit(sid))
