"""Physical lines -> numbered CSV records; a quoted cell may hold line breaks.

A file is read once, as lines of splits, and staged. What follows is derived from the staged lines alone, so nothing
that happens to the files later moves a line. No file is gathered in one task:

1. Every split is counted; the sums of the splits before it give the file's line numbers, from 0.
2. A line with a double quote is a function of the state in which it begins, outside a quoted cell or inside one, to the
   state in which it ends. Only these lines' states are shuffled, without their text. They are composed inside each
   split, each split's composition over the splits before it, and so every such line gets its state.
3. A record of several lines goes from a line that ends inside to the next one that ends outside. Its lines are joined by
   a line feed and carry the number of the first. All other lines stay where they are.

A quote that is not closed within ``MAX_RECORD_LINES`` lines, or at all, joins nothing: its lines are read one by one.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

MAX_RECORD_LINES = 10_000
SPLIT = ["file_path", "block"]

_QUOTED = r'"[^"]*+(?:""[^"]*+)*+"'
# Whole cells, each with its comma, and then a quote that opens a cell and has no end.
_ENDS_INSIDE = rf'^(?:(?:{_QUOTED}[^,]*+|[^",][^,]*+)?+,)*+"[^"]*+(?:""[^"]*+)*+\z'
_TO_CLOSING = r'^[^"]*+(?:""[^"]*+)*+"'


def ends_inside(line: Column) -> Column:
    """Whether a line that begins a record ends inside a quoted cell."""
    return line.rlike(_ENDS_INSIDE)


def stays_inside(line: Column) -> Column:
    """Whether a line that begins inside a quoted cell ends inside one."""
    rest = F.regexp_replace(line, _TO_CLOSING + "[^,]*+", "")
    return ~line.rlike(_TO_CLOSING) | ends_inside(rest)


def with_states(lines: DataFrame) -> DataFrame:
    """Add ``out_open`` and ``in_open``: the state after a line that holds a quote, by the state before it; else NULL."""
    quoted = F.col("line").contains('"')
    return lines.withColumns({"out_open": F.when(quoted, ends_inside(F.col("line"))),
                              "in_open": F.when(quoted, stays_inside(F.col("line")))})


def composed(rows: DataFrame, ordered: Window) -> DataFrame:
    """Add ``fixed`` and ``after``, of the functions (``out_open``, ``in_open``) up to each row: whether the state before
    them plays no part, and the state after them if it was outside."""
    flip = (F.col("out_open") & ~F.col("in_open")).cast("long")
    constant = F.when(F.col("out_open") == F.col("in_open"), F.struct(F.col("out_open").alias("open"), "flips"))
    rows = rows.withColumn("flips", F.sum(flip).over(ordered))
    rows = rows.withColumn("last", F.last(constant, ignorenulls=True).over(ordered))
    odd = (F.col("flips") - F.coalesce("last.flips", F.lit(0))) % 2 == 1
    return rows.withColumns({"fixed": F.col("last").isNotNull(), "after": F.coalesce("last.open", F.lit(False)) != odd}).drop("flips", "last")


_SO_FAR = (Window.unboundedPreceding, Window.currentRow)


def split_table(lines: DataFrame) -> DataFrame:
    """One row per split: number of its first line in the file, ``rid`` of that line, and the state in which it begins."""
    counted = lines.groupBy(*SPLIT).agg(F.min("rid").alias("first_rid"), F.count("*").alias("n_lines"))
    quotes = lines.filter("out_open IS NOT NULL").select(*SPLIT, "rid", "out_open", "in_open")
    ends = composed(quotes, Window.partitionBy(*SPLIT).orderBy("rid").rowsBetween(*_SO_FAR)).groupBy(*SPLIT).agg(
        F.max_by(F.struct("fixed", "after"), "rid").alias("s"))
    # A split as a function: what it makes of a begin outside and of a begin inside.
    outside = F.coalesce("s.after", F.lit(False))
    begun_inside = F.when(F.coalesce("s.fixed", F.lit(False)), outside).otherwise(~outside)
    splits = counted.join(ends, SPLIT, "left").withColumns({"out_open": outside, "in_open": begun_inside})
    of_file = Window.partitionBy("file_path").orderBy("block")
    return composed(splits, of_file.rowsBetween(*_SO_FAR)).select(
        *SPLIT, "first_rid",
        F.coalesce(F.sum("n_lines").over(of_file.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("first_no"),
        F.coalesce(F.lag("after").over(of_file), F.lit(False)).alias("begins_inside"))


def numbered(lines: DataFrame, splits: DataFrame) -> DataFrame:
    """Lines with ``line_no``, their number in the file from 0."""
    return lines.join(splits, SPLIT).withColumn("line_no", F.col("first_no") + F.col("rid") - F.col("first_rid"))


def record_spans(lines: DataFrame, splits: DataFrame, max_lines: int = MAX_RECORD_LINES) -> DataFrame:
    """(file_path, start_no, end_no) of the records that span several lines."""
    inside = Window.partitionBy(*SPLIT).orderBy("rid")
    quotes = numbered(lines.filter("out_open IS NOT NULL").drop("line"), splits.select(*SPLIT, "first_rid", "first_no", "begins_inside"))
    begun = F.col("begins_inside")
    states = composed(quotes, inside.rowsBetween(*_SO_FAR)).withColumn(
        "after", F.when(F.col("fixed"), F.col("after")).otherwise(F.col("after") != begun))
    states = states.withColumn("before", F.coalesce(F.lag("after").over(inside), begun))
    # First lines and last lines of records take turns in a file.
    turns = states.filter("before <> after").select(*SPLIT, "rid", "line_no", "after").withColumn(
        "next_no", F.lead("line_no").over(inside))
    heads = turns.groupBy(*SPLIT).agg(F.min("line_no").alias("head_no"))
    later = Window.partitionBy("file_path").orderBy("block").rowsBetween(1, 1)
    heads = heads.select(*SPLIT, F.first("head_no").over(later).alias("later_no"))
    spans = turns.filter("after").join(heads, SPLIT).select(
        "file_path", F.col("line_no").alias("start_no"), F.coalesce("next_no", "later_no").alias("end_no"))
    return spans.filter(F.col("end_no") - F.col("start_no") < max_lines)


def join_records(lines: DataFrame, spans: DataFrame) -> DataFrame:
    """Numbered lines with each span as one line, numbered as its first."""
    kept = ["file_path", "file_name", "line_no", "line"]
    members = spans.select("file_path", "start_no", F.explode(F.sequence("start_no", "end_no")).alias("line_no"))
    single = lines.join(members.select("file_path", "line_no"), ["file_path", "line_no"], "left_anti").select(*kept)
    # A group is one record: at most MAX_RECORD_LINES lines.
    several = lines.join(members, ["file_path", "line_no"]).groupBy("file_path", "file_name", "start_no").agg(
        F.array_sort(F.collect_list(F.struct("line_no", "line"))).alias("parts"))
    joined = several.select("file_path", "file_name", F.col("start_no").alias("line_no"),
                            F.array_join(F.transform("parts", lambda p: p["line"]), "\n").alias("line"))
    return single.unionByName(joined)


def records(lines: DataFrame, stage, max_lines: int = MAX_RECORD_LINES) -> DataFrame:
    """(file_path, file_name, line_no, line) of physical lines (file_path, file_name, block, rid, line).

    ``block`` orders the splits of a file and ``rid`` the lines of a split, without gaps. ``stage(df, name)`` writes a
    table and reads it back; the lines are staged once, with their splits and spans.
    """
    lines = stage(with_states(lines), "lines")
    splits = stage(split_table(lines), "splits")
    spans = stage(record_spans(lines, splits, max_lines), "spans")
    placed = numbered(lines, splits)
    if spans.isEmpty():  # most folders: no cell holds a line break
        return placed.select("file_path", "file_name", "line_no", "line")
    return join_records(placed, spans)
