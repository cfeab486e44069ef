"""Row validity rules of the strict and lenient ingest modes."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from telemetra.functions.text import strip_ws

# --- Fixed values: the accepted shapes of station ids and logger clocks ---
STATION_ID_PATTERN = r"^&[a-fA-F0-9]{8}$"
DATETIME_PATTERNS = [
    r"^\d{2}[-/]\d{2}[-/]\d{2} \d{2}:\d{2}(:\d{2})?$",
    r"^(\d{2}[-/]\d{2}[-/]\d{4}|\d{4}[-/]\d{2}[-/]\d{2}) \d{2}:\d{2}(:\d{2})?$",
]
# Inspection-query shapes: two-digit year with seconds, and without.
DQ_DATETIME_PATTERNS = [
    r"^\d{2}[-/]\d{2}[-/]\d{2} \d{2}:\d{2}:\d{2}$",
    r"^\d{2}[-/]\d{2}[-/]\d{2} \d{2}:\d{2}$",
]
# Lenient mode: a station id that looks like a date is rejected.
DATE_TOKEN_PATTERNS = [
    r"\d{4}[-/]\d{2}[-/]\d{2}",
    r"\d{2}[-/]\d{2}[-/]\d{4}",
    r"\d{2}[-/]\d{2}[-/]\d{2}",
    r"\d{8}",
]
DATE_HINT_PATTERN = r"\d{2}\s+\d{2}"
# Older lenient rule: a clock-like or blank-then-two-digits fragment anywhere.
DATE_HINT_PATTERNS_V0 = [r"\d{2}:\d{2}", r"\s\d{2}"]
SENTINEL_DATETIMES = ["22/05/25 12:82", "00/00/00 00:00"]
# --- end of fixed values ---


def anchored(pattern: str) -> str:
    """Whole-string form for ``rlike`` (a find): ``^``/``$`` become ``\\A``/``\\z``.

    Java's ``$`` also matches before a final newline; ``\\z`` does not.
    """
    body = pattern
    if body.startswith("^"):
        body = body[1:]
    if body.endswith("$"):
        body = body[:-1]
    return rf"\A(?:{body})\z"


def _full(c: Column, pattern: str) -> Column:
    return c.rlike(anchored(pattern))


def valid_station_id(c: Column) -> Column:
    """``&`` + 8 hex digits after a full strip; NULL is not valid."""
    return F.coalesce(_full(strip_ws(c), STATION_ID_PATTERN), F.lit(False))


def valid_datetime(c: Column) -> Column:
    """Two-digit year, or four-digit year leading or trailing; seconds optional."""
    s = strip_ws(c)
    return F.coalesce(_full(s, DATETIME_PATTERNS[0]) | _full(s, DATETIME_PATTERNS[1]), F.lit(False))


def looks_like_date(c: Column) -> Column:
    """Lenient rejection rule: a date token, a colon, or two digit pairs split by blanks."""
    s = strip_ws(c)
    full = None
    for p in DATE_TOKEN_PATTERNS:
        m = _full(s, p)
        full = m if full is None else (full | m)
    hint = s.contains(":") | s.rlike(DATE_HINT_PATTERN)
    return F.coalesce((s != F.lit("")) & (full | hint), F.lit(False))


def looks_like_date_v0(c: Column) -> Column:
    """The older lenient rule: date token, clock fragment or blank + two digits (C9, older)."""
    s = strip_ws(c)
    full = None
    for p in DATE_TOKEN_PATTERNS:
        m = _full(s, p)
        full = m if full is None else (full | m)
    hint = s.rlike(DATE_HINT_PATTERNS_V0[0]) | s.rlike(DATE_HINT_PATTERNS_V0[1])
    return F.coalesce((s != F.lit("")) & (full | hint), F.lit(False))


def short_digits(c: Column) -> Column:
    """A run of 1 to 5 ASCII digits after a full strip."""
    return F.coalesce(strip_ws(c).rlike(r"\A[0-9]{1,5}\z"), F.lit(False))


def strict_valid(station_token: Column, datetime_token: Column) -> Column:
    """Strict row rule (F15): both the station id and the clock have the accepted shape."""
    return valid_station_id(station_token) & valid_datetime(datetime_token)


def lenient_valid(station_token: Column) -> Column:
    """Lenient row rule (F16): a non-empty id that is not date-like and not a short digit run."""
    s = strip_ws(station_token)
    return F.coalesce((s != F.lit("")) & ~looks_like_date(s) & ~short_digits(s), F.lit(False))


def dq_bad_datetime(c: Column) -> Column:
    """Inspection rule: clock text that matches neither two-digit-year shape.

    Like the SQL it mirrors, a NULL clock is neither matching nor failing.
    """
    return ~c.rlike(anchored(DQ_DATETIME_PATTERNS[0])) & ~c.rlike(anchored(DQ_DATETIME_PATTERNS[1]))
