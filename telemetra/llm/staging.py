"""Staged tables in the shared checkpoint folder: each cuts the lineage, so work done before it is
not repeated when an executor is lost, and a table used twice is computed once."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from telemetra.session import scratch_path


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet under ``spark.checkpoint.dir`` and read it back."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def publish(spark: SparkSession, name: str, payload: bytes) -> str:
    """Store a bounded file in the shared folder and register it for every executor; a task finds
    its own local copy with ``SparkFiles.get(<returned name>)`` and may memory-map it."""
    path = scratch_path(spark, name)
    jvm = spark.sparkContext._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    out = target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).create(target, True)
    for at in range(0, len(payload), 1 << 20):
        out.write(bytearray(payload[at:at + (1 << 20)]))
    out.close()
    spark.sparkContext.addFile(target.toString())
    return target.getName()
