"""Incremental ingest with Structured Streaming."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from telemetra.operators.store import TableStore
from telemetra.sources.files import CSV_GLOB, as_lines, literal_path
from telemetra.sources.records import records

# A hundred thousand years: no file is too old, whatever clock its logger had. The ledger prevents repeats.
NO_AGE_LIMIT = "36500000d"


def ingest_stream(spark: SparkSession, src_dir: str, table_dir: str, checkpoint: str, *, mode: str = "strict",
                  max_files_per_trigger: int = 1000, available_now: bool = True):
    """Incremental ingest with Structured Streaming.

    The file source's checkpoint remembers processed base names
    (``fileNameOnly``); files of any age are picked up. Each micro-batch runs
    the batch ingest after dropping files the ledger already holds (from batch
    runs, or from this batch before a crash). Files whose names hide them from
    Spark's readers are seen, and reported, by ``ingest_folder`` only. Returns
    the started query.
    """
    store = TableStore(spark, table_dir)
    stream = (spark.readStream.format("text")
              .option("pathGlobFilter", CSV_GLOB)
              .option("fileNameOnly", "true")
              .option("maxFileAge", NO_AGE_LIMIT)
              .option("maxFilesPerTrigger", max_files_per_trigger)
              .load(literal_path(src_dir)))

    def _batch(df: DataFrame, batch_id: int) -> None:
        from telemetra.plans.ingest import Stages, ingest_lines

        stages = Stages(spark)
        new = as_lines(df).join(store.ledger().select("file_name"), "file_name", "left_anti")
        lines = records(new, stages.write)  # the batch's files are read here, once
        ingest_lines(spark, lines, store, mode=mode, candidates=lines.select("file_path", "file_name").distinct())
        stages.clear()

    writer = (stream.select("value", "_metadata").writeStream.foreachBatch(_batch)
              .option("checkpointLocation", checkpoint))
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="1 minute")
    return writer.start()
