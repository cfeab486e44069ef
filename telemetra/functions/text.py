"""Text helpers for raw logger lines: cleaning, tokenising, missing values, headers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from telemetra.schema import HEADER_ALIASES, NA_TEXT, NAN_TOKEN, WHITESPACE

# A cell of a line that starts with a comma. A double quote counts only at the start of a cell: there it opens a part
# that ends at the next quote that is not doubled, and what follows up to the comma is plain text. The quantifiers
# are possessive, so a line is read once whatever it holds.
_QUOTED = r'"[^"]*+(?:""[^"]*+)*+"'
_CELL = f",({_QUOTED}[^,]*+|[^,]*+)"
_OPENED = rf'(?s)^"([^"]*+(?:""[^"]*+)*+)"(.*)$'


def strip_ws(c: Column) -> Column:
    """Full whitespace strip (Spark ``trim`` only removes spaces)."""
    return F.btrim(c, F.lit(WHITESPACE))


def clean_bytes(c: Column) -> Column:
    """Drop NUL characters and byte sequences that are not valid UTF-8."""
    valid = F.make_valid_utf8(c)
    return F.replace(F.replace(valid, F.lit("�"), F.lit("")), F.lit("\x00"), F.lit(""))


def is_blank_line(c: Column) -> Column:
    """Lines a CSV reader skips: empty or whitespace only."""
    return strip_ws(c) == F.lit("")


def _cells(line: Column) -> Column:
    return F.regexp_extract_all(F.concat(F.lit(","), line), F.lit(_CELL), 1)


def tokenize(c: Column) -> Column:
    """Split one CSV line into cells (S3): a quoted part loses its quotes, doubled quotes inside it are folded.

    A cell whose quote is never closed stays as it is; see ``unclosed_quote``.
    """
    def unfold(x: Column) -> Column:
        inner = F.replace(F.regexp_extract(x, _OPENED, 1), F.lit('""'), F.lit('"'))
        return F.when(x.startswith('"') & x.rlike(_OPENED), F.concat(inner, F.regexp_extract(x, _OPENED, 2))).otherwise(x)

    return F.when(c.contains('"'), F.transform(_cells(c), unfold)).otherwise(F.split(c, ",", -1))


def unclosed_quote(c: Column) -> Column:
    """True for a line with a cell whose opening quote has no end; such a line cannot be split and is a failure."""
    return F.when(c.contains('"'), F.exists(_cells(c), lambda x: x.startswith('"') & ~x.rlike(_OPENED))).otherwise(F.lit(False))


def _alias_map() -> Column:
    return F.create_map(*[F.lit(x) for kv in HEADER_ALIASES.items() for x in kv])


def normalize_header(c: Column) -> Column:
    """Map one header cell to its target column name."""
    stripped = strip_ws(c)
    key = F.lower(F.translate(stripped, "& _", ""))
    return F.coalesce(F.try_element_at(_alias_map(), key), stripped)


def header_text(c: Column) -> Column:
    """Header cell as the text a reader shows for it: NA-like cells read as ``nan``."""
    return F.when(c.isNull() | c.isin(*NA_TEXT), F.lit(NAN_TOKEN)).otherwise(c)


# How the historic list text shows characters that do not print.
_ESCAPES = {"\\": "\\\\", "\t": "\\t", "\n": "\\n", "\r": "\\r"} | {
    chr(k): f"\\x{k:02x}" for k in (*range(32), *range(127, 161), 173) if k not in (9, 10, 13)}


def python_list_repr(tokens: Column) -> Column:
    """Render an array of cells the way the historic audit stored a bad line.

    A cell stands in single quotes, or in double quotes if it holds a single and no double quote; backslashes,
    control characters and, inside single quotes, single quotes are escaped.
    """
    def shown(x: Column) -> Column:
        escapes = F.create_map(*[F.lit(v) for pair in _ESCAPES.items() for v in pair])
        x = F.array_join(F.transform(F.split(x, ""), lambda c: F.coalesce(F.try_element_at(escapes, c), c)), "")
        double = x.contains("'") & ~x.contains('"')
        return F.when(double, F.concat(F.lit('"'), x, F.lit('"'))).otherwise(
            F.concat(F.lit("'"), F.replace(x, F.lit("'"), F.lit("\\'")), F.lit("'")))

    return F.concat(F.lit("["), F.array_join(F.transform(tokens, shown), ", "), F.lit("]"))
