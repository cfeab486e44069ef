"""CSV records over several lines, against the CSV reader of the standard library."""

import csv
import io
import os
import random

import pytest

from telemetra.functions.text import tokenize
from telemetra.operators.store import TableStore
from telemetra.plans import ingest
from telemetra.plans.ingest import ingest_folder
from telemetra.sources import records as rec
from telemetra.sources.files import scan_logger_files


def stager(spark, folder):
    def stage(df, name):
        path = os.path.join(str(folder), f"{name}-{len(os.listdir(str(folder)))}")
        df.write.parquet(path)
        return spark.read.schema(df.schema).parquet(path)
    return stage


def physical(spark, files, split_lines):
    """Lines of ``files`` (name -> text) in splits of ``split_lines`` lines; rids of a split begin anywhere."""
    rows = []
    for name, text in files.items():
        for k, line in enumerate(text.split("\n")):
            block = k // split_lines
            rows.append((name, name, block * 1000, 7 * block + 100 * (block % 3) + k % split_lines, line))
    return spark.createDataFrame(rows, "file_path string, file_name string, block long, rid long, line string").repartition(5)


def reader(text):
    """(number of its first line, cells) of every record that ends; lines behind a quote without end stand alone."""
    lines, out, at = text.split("\n"), [], 0
    source = csv.reader(io.StringIO(text + "\n"))
    for cells in source:
        if source.line_num == len(lines) and _open("\n".join(lines[at:])):
            break
        out.append((at, cells))
        at = source.line_num
    return out, at


def _open(text):
    """Whether a record never ends: one more line with a closing quote adds to its last cell."""
    return any("\0" in c and len(c) > 1 for c in next(csv.reader(io.StringIO(text + "\n\0\"\n")), []))


@pytest.mark.parametrize("split_lines", [1, 3])
def test_records_equal_the_csv_reader(spark, tmp_path, split_lines):
    rng = random.Random(split_lines)
    files = {f"f{k}.csv": "".join(rng.choice(['"', '"', ",", ",", "\n", "\n", "a", '""', " ", '"\n"', '"x"']) for _ in range(rng.randint(1, 90)))
             for k in range(120)}
    out = rec.records(physical(spark, files, split_lines), stager(spark, tmp_path))
    got = {}
    for r in out.select("file_name", "line_no", "line", tokenize(out.line).alias("cells")).collect():
        got.setdefault(r.file_name, {})[r.line_no] = (r.line, r.cells)
    for name, text in files.items():
        want, tail = reader(text)
        lines = text.split("\n")
        assert sorted(got[name]) == [n for n, _ in want] + list(range(tail, len(lines))), repr(text)
        for n, cells in want:
            assert got[name][n][1] == (cells or [""]), (repr(text), n)
        for n in range(tail, len(lines)):
            assert got[name][n][0] == lines[n]


def test_long_spans_join_nothing(spark, tmp_path):
    files = {"a.csv": 'x,"1\n2\n3",y\n"4\n5\n6\n7",z\nlast'}
    rows = rec.records(physical(spark, files, 2), stager(spark, tmp_path), max_lines=3).sort("line_no").collect()
    assert [r.line for r in rows] == ['x,"1\n2\n3",y', '"4', "5", "6", '7",z', "last"]


def test_no_window_over_a_file_and_no_text_in_the_shuffle(spark, tmp_path):
    lines = rec.with_states(physical(spark, {"a.csv": 'x,"1\n2"'}, 1))
    plan = rec.split_table(lines)._jdf.queryExecution().optimizedPlan().toString()
    assert "Window" in plan and all("line#" not in x for x in plan.split("\n") if "Window" in x or "Aggregate" in x)


def write(folder, name, text):
    os.makedirs(folder, exist_ok=True)
    with open(os.path.join(folder, name), "w") as f:
        f.write(text)


MULTI = ('StationID,DateTime,Mobile,WL\n&5604C1D8,22/05/25 06:00,"first\nsecond, ""third""",1.5\n'
         '\n&5604C1D8,22/05/25 06:15,"a\n\n\nb",2.5\n&5604C1D8,22/05/25 06:30,5" x,3\n&5604C1D8,22/05/25 06:45,"open,4\n&5604C1D8,22/05/25 07:00,7,5\n')


@pytest.mark.parametrize("split_bytes", [64, 1 << 20])
def test_cells_with_line_breaks_are_ingested(spark, tmp_path, split_bytes):
    src, tables = str(tmp_path / "src"), str(tmp_path / "t")
    write(src, "m.csv", MULTI)
    write(src, "n.csv", 'StationID,DateTime,"free\nnote",WL\n&5604C1D9,22/05/25 06:00,x,1\n')
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", split_bytes)
    try:
        assert scan_logger_files(spark, src).select("file_name", "block").distinct().count() > (4 if split_bytes < 100 else 1)
        ingest_folder(spark, src, tables).collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    store = TableStore(spark, tables)
    rows = {(r.StationID, r.DateTime[-5:]): (r.MobileNumber, r.WaterLevel) for r in store.read("readings").collect()}
    assert rows == {("&5604C1D8", "06:00"): ('first\nsecond, "third"', "1.5"), ("&5604C1D8", "06:15"): ("a\n\n\nb", "2.5"),
                    ("&5604C1D8", "06:30"): ('5" x', "3"), ("&5604C1D8", "07:00"): ("7", "5"), ("&5604C1D9", "06:00"): (None, "1")}
    bad = store.read("quarantine").collect()
    assert [(r.file_name, r.line_no, r.kind) for r in bad] == [("m.csv", 9, "tokenize")]


@pytest.mark.parametrize("change", ["remove", "truncate"])
def test_a_neighbour_that_changes_between_steps_moves_no_line(spark, tmp_path, monkeypatch, change):
    """Files of one task: what happens to one of them after the scan loses no line of the others."""
    src, tables = str(tmp_path / "src"), str(tmp_path / "t")
    head = "StationID,DateTime,WL\n"
    write(src, "a.csv", head + "".join(f"&0000000A,22/05/25 06:0{k},{k}\n" for k in range(3)))
    write(src, "b.csv", head + "".join(f"&0000000B,22/05/25 06:0{k},{k}\n" for k in range(6)))
    real = ingest.parse_lines

    def late(*args, **kwargs):
        if change == "remove":
            os.remove(os.path.join(src, "a.csv"))
        else:
            write(src, "a.csv", head)
        return real(*args, **kwargs)

    monkeypatch.setattr(ingest, "parse_lines", late)
    ingest_folder(spark, src, tables).collect()
    store = TableStore(spark, tables)
    stored = sorted((r.StationID, r.WaterLevel) for r in store.read("readings").collect())
    assert stored == [("&0000000A", str(k)) for k in range(3)] + [("&0000000B", str(k)) for k in range(6)]
    assert store.read("quarantine").count() == 0
    assert {r.file_name: r.success_count for r in store.read("audit").collect()} == {"a.csv": 3, "b.csv": 6}
