"""Fuzzy match patterns for station metadata filters."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from telemetra.functions.text import strip_ws

# Characters removed from a search value. The older metadata routes removed the first three only.
PATTERN_DROP = "-(),"
PATTERN_DROP_BASIC = "-()"


def make_pattern_col(c: Column, drop: str = PATTERN_DROP) -> Column:
    """LIKE pattern of a search value: outer blanks trimmed, lower case, without the dropped characters, in ``%``."""
    return F.concat(F.lit("%"), F.translate(F.lower(strip_ws(c)), drop, ""), F.lit("%"))


def make_pattern(value: str, drop: str = PATTERN_DROP) -> str:
    """``make_pattern_col`` of a value known when the query is built."""
    kept = [ch for ch in value.strip().lower() if ch not in drop]
    return "%" + "".join(kept) + "%"


def make_pattern_basic(value: str) -> str:
    """The three-character variant of ``make_pattern`` (no comma removal)."""
    return make_pattern(value, PATTERN_DROP_BASIC)


def like_literal(pattern: str) -> str:
    """Make a LIKE pattern safe for Spark with the escaping rules of the SQL database.

    A backslash escapes the next character; before anything other than
    ``%``, ``_`` or ``\\`` it just yields that character (Spark would raise).
    A trailing lone backslash is taken literally.
    """
    out = []
    i = 0
    while i < len(pattern):
        ch = pattern[i]
        if ch == "\\":
            if i + 1 < len(pattern):
                nxt = pattern[i + 1]
                out.append("\\" + nxt if nxt in "%_\\" else nxt)
                i += 2
                continue
            out.append("\\\\")
        else:
            out.append(ch)
        i += 1
    return "".join(out)


def fuzzy_match(c: Column, value: str, drop: str = PATTERN_DROP) -> Column:
    """One-sided fuzzy contains: ``lower(col) ILIKE make_pattern(value)``.

    Only the search value loses punctuation; NULL columns never match.
    """
    return F.coalesce(F.lower(c).ilike(like_literal(make_pattern(value, drop))), F.lit(False))


def fuzzy_match_normalized(c: Column, value: str) -> Column:
    """Two-sided form: the column also loses ``- ( )`` before the match."""
    col_norm = F.lower(F.translate(c, PATTERN_DROP_BASIC, ""))
    return F.coalesce(col_norm.ilike(like_literal(make_pattern(value, PATTERN_DROP_BASIC))), F.lit(False))
