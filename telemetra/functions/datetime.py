"""Logger clock text -> timestamps and dates; query date arguments."""

from __future__ import annotations

import datetime as _dt
import re

from pyspark.sql import Column
from pyspark.sql import functions as F

from telemetra.functions.text import strip_ws

# Day-first dates with a two- and a four-digit year are rewritten to year-first text, clocks without seconds get them.
_REWRITES = [(r"^(\d{2})-(\d{2})-(\d{2}) ", "20$3-$2-$1 "), (r"^(\d{2})-(\d{2})-(\d{4}) ", "$3-$2-$1 "), (r"^(.{16})$", "$1:00")]
_CLOCK = r"^\d{4}-\d{2}-\d{2} \d{2}:\d{2}:\d{2}$"


def parse_datetime(c: Column) -> Column:
    """Logger ``DateTime`` text -> TIMESTAMP_NTZ, NULL when it is not a real clock value.

    ``/`` and ``-`` separators are both accepted; shape-valid but impossible
    values (minute 82, day 00, 31 February) give NULL instead of an error. The
    text is a wall clock without zone: no session zone takes part.
    """
    x = F.translate(strip_ws(c), "/", "-")
    for shape, to in _REWRITES:
        x = F.regexp_replace(x, shape, to)
    return F.regexp_extract(x, _CLOCK, 0).try_cast("timestamp_ntz")


def obs_date(ts: Column) -> Column:
    """Calendar day of a reading."""
    return F.to_date(ts)


_ISO = re.compile(r"^\s*(\d{4})-(\d{1,2})-(\d{1,2})\s*$")
_DMY = re.compile(r"^\s*(\d{1,2})-(\d{1,2})-(\d{4})\s*$")
_DMY2 = re.compile(r"^\s*(\d{1,2})[-/](\d{1,2})[-/](\d{2})\s*$")


def parse_date_arg(value) -> _dt.date | None:
    """Query date argument: ``YYYY-MM-DD`` or ``DD-MM-YYYY``.

    ``None`` and ``""`` mean "no bound". Anything else that is not a real date
    raises ``ValueError`` up front instead of failing inside the job.
    """
    if value is None or value == "":
        return None
    if isinstance(value, _dt.datetime):
        return value.date()
    if isinstance(value, _dt.date):
        return value
    m = _ISO.match(str(value))
    if m:
        return _dt.date(int(m[1]), int(m[2]), int(m[3]))
    m = _DMY.match(str(value))
    if m:
        return _dt.date(int(m[3]), int(m[2]), int(m[1]))
    raise ValueError(f"date argument {value!r} is neither YYYY-MM-DD nor DD-MM-YYYY")


def parse_ddmmyy_arg(value: str) -> _dt.date:
    """Ad-hoc date literal ``dd/MM/yy`` as the inspection queries write it."""
    m = _DMY2.match(str(value))
    if not m:
        raise ValueError(f"date literal {value!r} is not dd/MM/yy")
    return _dt.date(2000 + int(m[3]), int(m[2]), int(m[1]))
