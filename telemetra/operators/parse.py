"""Logger CSV lines -> aligned readings, quarantine and per-file facts.

Input is a line DataFrame ``(file_path, file_name, line_no, line)`` where
``line_no`` orders lines within a file. Everything is column expressions; the
only per-file state (width and header, from each file's first non-blank line)
comes from a ``min`` aggregate that is joined back to the lines.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from telemetra.functions.ids import uuid5
from telemetra.functions.text import (clean_bytes, header_text, is_blank_line, normalize_header, python_list_repr,
                                      strip_ws, tokenize, unclosed_quote)
from telemetra.functions.validate import lenient_valid, strict_valid
from telemetra.schema import CANONICAL, EXPECTED_COLUMNS, NA_TEXT, NAN_TOKEN, NONE_TOKEN

HEADERLESS_WIDTH_ERROR = "headerless file wider than the {n} expected columns".format(n=len(EXPECTED_COLUMNS))


def clean_lines(lines: DataFrame) -> DataFrame:
    """Clean bytes and skip blank lines."""
    cleaned = lines.withColumn("line", clean_bytes(F.col("line")))
    return cleaned.filter(~is_blank_line(F.col("line")))


def _has_header(tokens: Column) -> Column:
    """A first line is a header when any cell mentions ``station`` or ``date``."""
    return F.exists(tokens, lambda x: F.lower(header_text(x)).contains("station")
                    | F.lower(header_text(x)).contains("date"))


def file_headers(cleaned: DataFrame) -> DataFrame:
    """One row per file: first line, width, header flag, column names, error.

    The first line number per file is a hash aggregate with fixed-width
    buffers (partial aggregation, no sort of the lines); only the lines it
    picks are split into cells.
    """
    first_no = cleaned.groupBy("file_path").agg(F.min("line_no").alias("line_no"))
    first = (cleaned.join(first_no, ["file_path", "line_no"])
             .select("file_path", "file_name", F.struct("line_no", tokenize(F.col("line")).alias("tokens")).alias("first")))
    ftok = F.col("first.tokens")
    width = F.size(ftok)
    has_header = _has_header(ftok)
    positional = F.slice(F.array(*[F.lit(c) for c in EXPECTED_COLUMNS]), 1, F.least(width, F.lit(len(EXPECTED_COLUMNS))))
    named = F.transform(ftok, lambda x: normalize_header(header_text(x)))
    h = first.select(
        "file_path", "file_name",
        F.col("first.line_no").alias("first_line_no"),
        width.alias("width"),
        has_header.alias("has_header"),
        F.when(has_header, named).otherwise(positional).alias("header"),
        F.when(~has_header & (width > len(EXPECTED_COLUMNS)), F.lit(HEADERLESS_WIDTH_ERROR)).alias("file_error"),
    )
    # 1-based cell position of each target column in this file (0: absent),
    # as one array in target order, plus Date/Time positions for the merge.
    # Per-file facts, so the per-line work is a bounds check and a lookup.
    hdr = F.col("header")
    pos = F.array(*[F.array_position(hdr, F.lit(e)).cast("int") for e in EXPECTED_COLUMNS]).alias("pos")
    split_dt = (F.array_contains(hdr, "Date") & F.array_contains(hdr, "Time")).alias("split_dt")
    return h.select("*", pos, F.array_position(hdr, F.lit("Date")).cast("int").alias("pos_date"),
                    F.array_position(hdr, F.lit("Time")).cast("int").alias("pos_time"), split_dt)


def attach_headers(cleaned: DataFrame, headers: DataFrame) -> DataFrame:
    """Split every data line and give it its file's width and column names; drop header lines.

    The header table has one row per file; lines of files that it does not
    hold are dropped. Its size on disk or at run time decides how it is
    joined.
    """
    j = cleaned.join(headers.drop("file_name"), "file_path")
    header_line = F.col("has_header") & (F.col("line_no") == F.col("first_line_no"))
    cut = j.filter(~header_line).withColumn("unclosed", unclosed_quote(F.col("line")))
    return cut.withColumn("tokens", tokenize(F.col("line")))


def _cell_at(pos: Column) -> Column:
    """Cell at a 1-based position, NULL when the column is absent or the row is short."""
    tokens = F.col("tokens")
    return F.when((pos > 0) & (pos <= F.size(tokens)), F.get(tokens, pos - 1))


def _token(cell: Column) -> Column:
    """Key text of a cell: ``None`` if it does not exist, ``nan`` if NA-like (C17).

    Split cells are never NULL, so NULL here means "does not exist".
    """
    return F.when(cell.isNull(), F.lit(NONE_TOKEN)).when(cell.isin(*NA_TEXT), F.lit(NAN_TOKEN)).otherwise(cell)


def align(rows: DataFrame) -> DataFrame:
    """Fixed 15 columns by name.

    ``vals`` holds the stored values (NA-like -> NULL), ``keys`` the texts
    the row key hashes, both in target order. When both ``Date`` and
    ``Time`` columns exist they are merged into ``DateTime`` (stripped,
    space-joined, missing halves as their key text).
    """
    cells = F.transform(F.col("pos"), _cell_at)
    merged = F.concat(strip_ws(_token(_cell_at(F.col("pos_date")))), F.lit(" "),
                      strip_ws(_token(_cell_at(F.col("pos_time")))))
    a = rows.select("file_path", "file_name", "line_no", "tokens", "unclosed", "width", "file_error", "split_dt",
                    cells.alias("cells"), merged.alias("merged"))
    dt = 1  # index of DateTime
    vals = F.transform("cells", lambda c, i: F.when((i == dt) & F.col("split_dt"), F.col("merged"))
                       .when(~c.isin(*NA_TEXT), c))
    keys = F.transform("cells", lambda c, i: F.when((i == dt) & F.col("split_dt"), F.col("merged"))
                       .otherwise(_token(c)))
    return a.select("file_path", "file_name", "line_no", "tokens", "unclosed", "width", "file_error",
                    vals.alias("vals"), keys.alias("keys"))


def classify(rows: DataFrame, mode: str = "strict") -> DataFrame:
    """Mark each line ``tokenize`` (too many cells, or a quote without end), ``valid`` or ``invalid``; drop blank rows.

    Rows blank in all 15 columns are dropped before validation (F14). The row
    key is computed for valid rows only (C1). Output: the 15 value columns
    ``v_<col>``, ``k_StationID`` (for samples) and ``uuid``.
    """
    too_long = (F.size(F.col("tokens")) > F.col("width")) | F.col("unclosed")
    aligned = align(rows)
    blank = ~F.exists("vals", lambda v: v.isNotNull())
    sid, dtk = F.col("keys")[0], F.col("keys")[1]
    if mode == "strict":
        ok = strict_valid(sid, dtk)
    elif mode == "lenient":
        ok = lenient_valid(sid)
    else:
        raise ValueError(f"unknown mode {mode!r}")
    kind = F.when(too_long, F.lit("tokenize")).when(ok, F.lit("valid")).otherwise(F.lit("invalid"))
    keyed = aligned.filter(too_long | ~blank).withColumn("kind", kind)
    uuid = F.when(F.col("kind") == "valid", uuid5(F.concat_ws("|", F.col("keys"))))
    return keyed.select(
        "file_path", "file_name", "line_no", "tokens", "width", "file_error", "kind",
        *[F.col("vals")[i].alias("v_" + c) for i, c in enumerate(CANONICAL)],
        F.col("keys")[0].alias("k_StationID"), uuid.alias("uuid"), "keys",
    )


def parse_lines(lines: DataFrame, mode: str = "strict", headers: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """Lines -> (classified rows, per-file headers). See the module docstring.

    ``headers`` passes a header table already made from the same lines, for
    instance a stored one that holds only the files wanted.
    """
    cleaned = clean_lines(lines)
    if headers is None:
        headers = file_headers(cleaned)
    return classify(attach_headers(cleaned, headers), mode), headers


def failed_record_json(kind: Column) -> Column:
    """One failure as the audit stores it.

    Tokenize failures: ``{"error": "tokenize", "raw": <cells as a list>}``;
    invalid rows: the 15 cells under their original names, NULL as ``null``.
    """
    opts = {"ignoreNullFields": "false"}
    record = F.to_json(F.struct(*[F.col("v_" + c).alias(e) for e, c in zip(EXPECTED_COLUMNS, CANONICAL)]), opts)
    tok = F.to_json(F.struct(F.lit("tokenize").alias("error"), python_list_repr(F.col("tokens")).alias("raw")), opts)
    return F.when(kind == "tokenize", tok).otherwise(record)


def readings_from(rows: DataFrame, keep: list[str] = ()) -> DataFrame:
    """Valid rows as stored readings: 15 text columns + uuid (the typed columns are added by the sink)."""
    return rows.filter((F.col("kind") == "valid") & F.col("file_error").isNull()).select(
        *[F.col("v_" + c).alias(c) for c in CANONICAL], "uuid", *keep)
