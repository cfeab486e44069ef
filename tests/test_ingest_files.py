"""Folder ingest on small CSV golden files (FIXTURES section 4)."""

import datetime as dt
import os
import struct
import uuid as pyuuid
import zlib

import pytest
from pyspark.sql import functions as F

from telemetra.operators.store import TableStore
from telemetra.plans import ingest
from telemetra.plans.ingest import ingest_folder

ROW = "&5604C1D8,22/05/25 12:00,9876543210,12.1,3.5"
NOW = dt.datetime(2025, 6, 1, 12, 0, 0)


def _write(d, name, text, mode="w"):
    p = os.path.join(d, name)
    if isinstance(text, bytes):
        with open(p, "wb") as f:
            f.write(text)
    else:
        with open(p, mode) as f:
            f.write(text)
    return p


@pytest.fixture(scope="module")
def run(spark, tmp_path_factory):
    src = str(tmp_path_factory.mktemp("src"))
    tables = str(tmp_path_factory.mktemp("tables"))
    _write(src, "named.csv", "Station ID,Date & Time,Mobile,Batt,WL\n"
           "&5604C1D8,22/05/25 12:00,9876543210,12.1,3.5\n&5604C1D8,22/05/25 12:15,9876543210,12.1,3.6\n"
           "&5604C1D9,22/05/25 12:00,9876543211,12.2,4.0\n")
    _write(src, "bare.CSV", ROW.replace("12:00", "13:00") + "\n" + ROW.replace("12:00", "13:15") + "\n")
    _write(src, "split.csv", "StationID,Date,Time,WL\n&5604C1D8, 23/05/25 ,10:00,1.5\n")
    _write(src, "long.csv", ROW.replace("12:00", "14:00") + "\n" + ROW + ",extra\n" + ROW.replace("12:00", "14:15") + "\n")
    _write(src, "short.csv", ROW.replace("12:00", "15:00") + "\n&5604C1D8,22/05/25 15:15,98\n")
    _write(src, "nul.csv", b"&5604C1D8,22/05/25 16:00,98\x0076,1\xff2.1,3.5\n")
    _write(src, "bad.csv", "5604C1D8,22/05/25 12:00\n&5604C1D,22/05/25 12:00\n22/05/25,bad\n&5604C1D8,2025-05-22\n")
    _write(src, "sentinel.csv", "&5604C1D8,00/00/00 00:00,1\n&5604C1D8,22/05/25 12:82,1\n")
    _write(src, "dup.csv", ROW.replace("12:00", "17:00") + "\n" + ROW.replace("12:00", "17:00") + "\n")
    _write(src, "dup2.csv", ROW.replace("12:00", "17:00") + "\n")
    _write(src, "blank.csv", "StationID,DateTime,WL\n,,\n,,\n")
    _write(src, "wide.csv", ",".join(["&5604C1D8", "22/05/25 18:00"] + ["1"] * 14) + "\n")
    _write(src, "missing_a.csv", "StationID,DateTime,WL,RH\n&5604C1D8,22/05/25 19:00,,5\n")
    _write(src, "missing_b.csv", "StationID,DateTime,RH\n&5604C1D8,22/05/25 19:00,5\n")
    _write(src, "notes.txt", ROW + "\n")
    summary = ingest_folder(spark, src, tables, mode="strict", now=NOW).collect()[0]
    store = TableStore(spark, tables)
    return dict(src=src, tables=tables, summary=summary, store=store)


def _readings(run):
    return run["store"].read("readings")


def _audit(run):
    return {r.file_name: r for r in run["store"].read("audit").collect()}


def test_named_header_aliases(run):
    r = _readings(run).filter("MobileNumber = '9876543211'").collect()
    assert len(r) == 1 and r[0].StationID == "&5604C1D9" and r[0].WaterLevel == "4.0" and r[0].Battery == "12.2"


def test_bare_upper_suffix_positional(run):
    r = _readings(run).filter("DateTime LIKE '22/05/25 13:%'").collect()
    assert len(r) == 2 and all(x.WaterLevel == "3.5" for x in r)


def test_split_date_time(run):
    r = _readings(run).filter("DateTime = '23/05/25 10:00'").collect()
    assert len(r) == 1 and r[0].WaterLevel == "1.5" and r[0].ts == dt.datetime(2025, 5, 23, 10, 0)


def test_long_row_quarantined(run):
    a = _audit(run)["long.csv"]
    assert (a.record_count, a.success_count, a.fail_count) == (3, 2, 1)
    q = run["store"].read("quarantine").filter("file_name = 'long.csv'").collect()
    assert len(q) == 1 and q[0].kind == "tokenize" and '"error":"tokenize"' in q[0].record


def test_short_row_padded_and_keyed_with_none(run):
    r = _readings(run).filter("DateTime = '22/05/25 15:15'").collect()
    assert len(r) == 1 and r[0].MobileNumber == "98" and r[0].Battery is None
    tokens = ["&5604C1D8", "22/05/25 15:15", "98"] + ["None"] * 12
    assert r[0].uuid == str(pyuuid.uuid5(pyuuid.NAMESPACE_DNS, "|".join(tokens)))


def test_nul_and_bad_bytes_dropped(run):
    r = _readings(run).filter("DateTime = '22/05/25 16:00'").collect()
    assert len(r) == 1 and r[0].MobileNumber == "9876" and r[0].Battery == "12.1"


def test_all_invalid_file(run):
    a = _audit(run)["bad.csv"]
    assert (a.record_count, a.success_count, a.fail_count, a.error) == (4, 0, 4, "all_invalid")
    ledger = {r.file_name for r in run["store"].ledger().collect()}
    assert "bad.csv" in ledger


def test_sentinels_inserted_with_null_ts(run):
    r = _readings(run).filter("DateTime IN ('00/00/00 00:00', '22/05/25 12:82')").collect()
    assert len(r) == 2 and all(x.ts is None and x.obs_date is None for x in r)


def test_duplicates_stored_once_but_counted(run):
    assert _readings(run).filter("DateTime = '22/05/25 17:00'").count() == 1
    a = _audit(run)
    assert a["dup.csv"].success_count == 2 and a["dup2.csv"].success_count == 1


def test_blank_file_not_audited_or_ledgered(run):
    assert "blank.csv" not in _audit(run)
    assert "blank.csv" not in {r.file_name for r in run["store"].ledger().collect()}


def test_wide_headerless_file_is_error(run):
    assert "wide.csv" not in _audit(run)
    assert "wide.csv" not in {r.file_name for r in run["store"].ledger().collect()}
    assert _readings(run).filter("DateTime = '22/05/25 18:00'").count() == 0


def test_missing_cell_vs_missing_column_keys_differ(run):
    r = _readings(run).filter("DateTime = '22/05/25 19:00'").collect()
    assert len(r) == 2 and r[0].uuid != r[1].uuid and all(x.WaterLevel is None for x in r)


def test_non_csv_ignored(run):
    files = {r.file_name for r in run["store"].ledger().collect()}
    assert "notes.txt" not in files


def test_summary(run):
    s = run["summary"]
    # wide.csv errors, bad.csv is all_invalid; blank.csv is neither
    assert s.files_with_error == 2
    assert s.inserted == 2 + 3 + 1 + 2 + 2 + 1 + 2 + 2 + 1 + 1 + 1
    assert s.skipped == 1 + 4


def test_second_run_is_noop(spark, run):
    before = _readings(run).count()
    s = ingest_folder(spark, run["src"], run["tables"], mode="strict", now=NOW).collect()[0]
    assert s.files == 2  # blank.csv and wide.csv are retried
    assert _readings(run).count() == before


def test_lenient_mode(spark, tmp_path):
    src, tables = str(tmp_path / "src"), str(tmp_path / "t")
    os.makedirs(src)
    lines = ["123,22/05/25 12:00", "123456,22/05/25 12:00", "12:30,22/05/25 12:00", ",22/05/25 12:00"]
    lines += [f"01-01-2024,{i}" for i in range(250)]
    _write(src, "len.csv", "\n".join(lines) + "\n")
    ingest_folder(spark, src, tables, mode="lenient", now=NOW).collect()
    store = TableStore(spark, tables)
    ids = sorted(r.StationID or "<null>" for r in store.read("readings").collect())
    assert ids == ["123456", "<null>"]
    a = store.read("audit").collect()[0]
    assert (a.success_count, a.fail_count, a.record_count) == (2, 252, 254)
    assert store.read("quarantine").count() == 252
    assert sum(r.n_records for r in store.read("failures").collect()) == 252


def test_quoted_cells_end_to_end(spark, tmp_path):
    src, tables = str(tmp_path / "src"), str(tmp_path / "t")
    os.makedirs(src)
    wide = ",".join(['"a""b"'] * 20_000)
    _write(src, "q.csv", '&5604C1D8,22/05/25 06:00,5" x,3" y,7\n"&5604C1D8","22/05/25 06:15","1,5","a""b",8\n'
           + wide + '\n"&5604C1D8,22/05/25 06:30,1,2,3\n')
    ingest_folder(spark, src, tables, now=NOW).collect()
    store = TableStore(spark, tables)
    rows = {r.DateTime: (r.MobileNumber, r.Battery, r.WaterLevel, r.WaterLevel_value) for r in store.read("readings").collect()}
    assert rows == {"22/05/25 06:00": ('5" x', '3" y', "7", 7.0), "22/05/25 06:15": ("1,5", 'a"b', "8", 8.0)}
    assert [r.kind for r in store.read("quarantine").collect()] == ["tokenize", "tokenize"]


def test_every_file_name_is_ingested_once(spark, tmp_path):
    src, tables = str(tmp_path / "src"), str(tmp_path / "t")
    os.makedirs(src)
    names = ["site 12.csv", "pct%20x.csv", "a[1].csv", "plus+1.csv", "é.csv"]
    for k, name in enumerate(names):
        _write(src, name, f"&0000000{k},22/05/25 12:00,1\n")
    _write(src, "_u.csv", "&00000009,22/05/25 12:00,1\n")
    os.utime(os.path.join(src, names[0]), (0, 0))  # a logger whose clock was reset
    first = ingest_folder(spark, src, tables, now=NOW).collect()[0]
    assert (first.files, first.inserted, first.files_with_error) == (6, 5, 1)  # _u.csv is reported
    second = ingest_folder(spark, src, tables, now=NOW).collect()[0]
    assert (second.files, second.inserted) == (1, 0)
    store = TableStore(spark, tables)
    assert sorted(r.file_name for r in store.read("audit").collect()) == sorted(names)
    assert sorted(r.file_name for r in store.ledger().collect()) == sorted(names)
    assert store.read("readings").count() == 5


@pytest.mark.parametrize("sink", ["append_readings", "append_run_table", "append_ledger"])
def test_crash_before_each_sink_leaves_no_trace(spark, tmp_path, monkeypatch, sink):
    src, tables = str(tmp_path / "src"), str(tmp_path / "t")
    os.makedirs(src)
    _write(src, "a.csv", ROW + "\n" + ROW + "\nbad,row,x\n")
    calls = []
    real = getattr(TableStore, sink)

    def failing(self, *args, **kwargs):
        calls.append(args)
        if len(calls) == (3 if sink == "append_run_table" else 1):
            raise RuntimeError("executor gone")
        return real(self, *args, **kwargs)

    with monkeypatch.context() as m:
        m.setattr(TableStore, sink, failing)
        with pytest.raises(RuntimeError):
            ingest_folder(spark, src, tables, now=NOW).collect()
    store = TableStore(spark, tables)
    assert [store.read(t).count() for t in ("quarantine", "failures", "audit")] == [0, 0, 0]
    _write(src, "b.csv", ROW.replace("12:00", "13:00") + "\n")  # the next run finds one more file
    ingest_folder(spark, src, tables, now=NOW).collect()
    assert [store.read(t).count() for t in ("readings", "quarantine", "failures", "audit", "ledger")] == [2, 1, 1, 2, 2]


def test_tables_are_empty_before_the_first_run(spark, tmp_path):
    store = TableStore(spark, str(tmp_path / "none"))
    for name in ("readings", "quarantine", "failures", "audit", "ledger", "stations"):
        assert store.read(name).count() == 0 and store.read(name).columns
    from telemetra.plans.stations import latest_readings, station_readings
    assert station_readings(store.read("readings"), store.read("stations")).count() == 0
    assert latest_readings(store.read("readings"), store.read("stations")).count() == 0


def test_unreadable_ledger_is_an_error(spark, tmp_path):
    src, tables = str(tmp_path / "src"), str(tmp_path / "t")
    os.makedirs(src)
    _write(src, "a.csv", ROW + "\n")
    os.makedirs(os.path.join(tables, "ledger"))
    _write(os.path.join(tables, "ledger"), "part-0.parquet", b"not parquet")
    with pytest.raises(Exception):
        ingest_folder(spark, src, tables, now=NOW).collect()


def test_staged_tables_are_removed(spark, tmp_path):
    src, tables = str(tmp_path / "src"), str(tmp_path / "t")
    os.makedirs(src)
    _write(src, "a.csv", ROW + "\n")
    shared = spark.conf.get("spark.checkpoint.dir")
    before = set(os.listdir(shared))
    ingest_folder(spark, src, tables, now=NOW).collect()
    assert {n.split("-")[0] for n in set(os.listdir(shared)) - before if not n[:8].isalnum() or "-" not in n} <= {"per"}
    assert not [n for n in set(os.listdir(shared)) - before if n.startswith(("headers", "parsed", "todo"))]


def test_only_new_files_are_opened(spark, tmp_path):
    from telemetra.sources.files import scan_logger_files
    src = str(tmp_path / "src")
    os.makedirs(src)
    for k in range(6):
        _write(src, f"f {k}.csv", ROW + "\n")
    os.utime(os.path.join(src, "f 3.csv"), (0, 0))  # a late file with an old time
    lines = scan_logger_files(spark, src, modified_from="1970-01-01 00:00:00", names=["f 3.csv", "f 5.csv"])
    assert {r.file_name for r in lines.collect()} == {"f 3.csv", "f 5.csv"}
    plan = lines._jdf.queryExecution().executedPlan()
    scan = plan.collectLeaves().apply(0)
    assert scan.metrics().apply("numFiles").value() == 2


def _checksums(path, wrong=None):
    """Put a checksum file beside ``path``, as Hadoop's local file system reads it, with the ``wrong`` chunk's sum spoilt."""
    folder, name = os.path.split(path)
    with open(path, "rb") as f:
        data = f.read()
    sums = [zlib.crc32(data[i:i + 512]) for i in range(0, len(data), 512)]
    if wrong is not None:
        sums[wrong] ^= 1
    with open(os.path.join(folder, f".{name}.crc"), "wb") as f:
        f.write(b"crc\0" + struct.pack(">i", 512) + b"".join(struct.pack(">I", c) for c in sums))


def test_a_file_that_cannot_be_read_is_its_own_trouble(spark, tmp_path):
    src, tables = str(tmp_path / "src"), str(tmp_path / "tables")
    os.mkdir(src)
    _write(src, "good.csv", ROW + "\n")
    _write(src, "bom.csv", b"\xef\xbb\xbf" + ROW.replace("12:00", "12:30").encode())
    _write(src, "crlf+more.csv", ROW.replace("12:00", "12:45") + "\r\n")
    _write(src, "empty.csv", "\n")
    first = _write(src, "first chunk 100%.csv", ROW.replace("12:00", "13:00") + "\n")
    # The last chunk is spoilt, long after the first lines have been read.
    last = _write(src, "last.csv", "".join(ROW.replace("12:00", f"{h % 24:02}:{h % 60:02}").replace("12.1", f"{h}.5") + "\n"
                                           for h in range(9000)))
    _checksums(first, 0)
    _checksums(last, -1)
    summary = ingest_folder(spark, src, tables, now=NOW).first()
    store = TableStore(spark, tables)
    assert store.read("readings").count() == summary.inserted == 3
    assert {r.file_name for r in store.ledger().collect()} == {"good.csv", "bom.csv", "crlf+more.csv"}
    assert (summary.files, summary.files_with_error) == (6, 3)
    # Nothing of them was kept, so the next run takes them whole.
    _checksums(first)
    _checksums(last)
    again = ingest_folder(spark, src, tables, now=NOW).first()
    assert again.inserted == 9001 and {r.file_name for r in store.ledger().collect()} >= {"last.csv", "first chunk 100%.csv"}


def test_an_error_of_no_file_is_raised(spark, tmp_path, monkeypatch):
    src = str(tmp_path / "src")
    os.mkdir(src)
    _write(src, "good.csv", ROW + "\n")

    def fails(lines, stage):
        return stage(lines.withColumn("x", F.raise_error(F.lit("no file's own"))), "lines")

    monkeypatch.setattr(ingest, "records", fails)
    with pytest.raises(Exception, match="no file's own"):
        ingest_folder(spark, src, str(tmp_path / "tables"))
