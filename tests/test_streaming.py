"""Incremental ingest with Structured Streaming."""

import os

import pytest

from telemetra.operators.store import TableStore
from telemetra.plans.ingest import ingest_folder, ingest_stream


def _write(d, name, text):
    with open(os.path.join(d, name), "w") as f:
        f.write(text)


def test_stream_ingests_each_file_once(spark, tmp_path):
    src, tables, ckpt = str(tmp_path / "src"), str(tmp_path / "t"), str(tmp_path / "ckpt")
    os.makedirs(src)
    _write(src, "a.csv", "StationID,DateTime,WL\n&5604C1D8,22/05/25 12:00,1\n&5604C1D8,22/05/25 12:15,2\n")
    _write(src, "b.csv", "&5604C1D9,22/05/25 12:00,3\nbad,row,x\n")
    q = ingest_stream(spark, src, tables, ckpt)
    q.awaitTermination(120)
    store = TableStore(spark, tables)
    assert store.read("readings").count() == 3
    assert {r.file_name for r in store.ledger().collect()} == {"a.csv", "b.csv"}

    # a new file arrives; the restarted query resumes from its checkpoint
    _write(src, "c.csv", "&5604C1DA,23/05/25 08:00,4\n")
    q = ingest_stream(spark, src, tables, ckpt)
    q.awaitTermination(120)
    assert store.read("readings").count() == 4
    audit = {r.file_name: r for r in store.read("audit").collect()}
    assert audit["b.csv"].fail_count == 1 and audit["c.csv"].success_count == 1

    # a batch run afterwards finds nothing new: the ledger is shared
    s = ingest_folder(spark, src, tables).collect()[0]
    assert s.files == 0 and store.read("readings").count() == 4


def test_stream_skips_files_ledgered_by_batch_runs(spark, tmp_path):
    src, tables, ckpt = str(tmp_path / "src"), str(tmp_path / "t"), str(tmp_path / "ckpt")
    os.makedirs(src)
    _write(src, "a.csv", "&5604C1D8,22/05/25 12:00,1\n")
    ingest_folder(spark, src, tables).collect()
    _write(src, "b.csv", "&5604C1D8,22/05/25 13:00,1\n")
    q = ingest_stream(spark, src, tables, ckpt)
    q.awaitTermination(120)
    store = TableStore(spark, tables)
    assert store.read("readings").count() == 2
    assert store.read("audit").count() == 2


@pytest.mark.parametrize("sink", ["append_readings", "append_run_table", "append_ledger"])
def test_stream_restarts_cleanly_after_a_crash(spark, tmp_path, monkeypatch, sink):
    src, tables, ckpt = str(tmp_path / "src"), str(tmp_path / "t"), str(tmp_path / "ckpt")
    os.makedirs(src)
    _write(src, "a b.csv", "&5604C1D8,22/05/25 12:00,1\nbad,row,x\n")
    with monkeypatch.context() as m:
        def crash(self, *args, **kwargs):
            raise RuntimeError("executor gone")

        m.setattr(TableStore, sink, crash)
        with pytest.raises(Exception):
            ingest_stream(spark, src, tables, ckpt).awaitTermination(120)
    ingest_stream(spark, src, tables, ckpt).awaitTermination(120)
    store = TableStore(spark, tables)
    assert [store.read(t).count() for t in ("readings", "quarantine", "failures", "audit", "ledger")] == [1, 1, 1, 1, 1]
