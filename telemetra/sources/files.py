"""Logger CSV folders -> line DataFrames (S1, S2, C14); ``sources.records`` numbers and joins them.

A file has one identity, taken from Spark's file metadata and decoded: its path, and its base name for the ledger.
Folders are read as folders, never as a list of paths, so no character of a file name has a meaning.
"""

from __future__ import annotations

from urllib.parse import unquote

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from telemetra.functions.text import clean_bytes

CSV_GLOB = "*.[cC][sS][vV]"
HIDDEN_FILE_ERROR = "name starts with _ or . and is hidden from the reader"
UNREAD_FILE_ERROR = "file could not be read"
BOM_BYTES = 3


def decoded(uri: Column) -> Column:
    """Percent-encoded metadata text as the name stands in the file system (a plus sign is itself)."""
    return F.url_decode(F.replace(uri, F.lit("+"), F.lit("%2B")))


def literal_path(path: str) -> str:
    """A folder path whose glob characters stand for themselves."""
    return "".join("\\" + c if c in "*?[]{}\\" else c for c in path)


def list_logger_files(spark: SparkSession, src_dir: str, glob: str = CSV_GLOB) -> DataFrame:
    """Candidate files of one folder level, suffix ``.csv`` in any case.

    The listing is a DataFrame (path, base name, size, modification time);
    file contents are not read.
    """
    files = (spark.read.format("binaryFile").option("pathGlobFilter", glob)
             .option("recursiveFileLookup", "false").load(literal_path(src_dir)))
    return files.select(
        decoded(F.col("_metadata.file_path")).alias("file_path"),
        decoded(F.col("_metadata.file_name")).alias("file_name"),
        F.col("length").alias("size"),
        F.col("modificationTime").alias("modified"),
    )


def hidden_logger_files(spark: SparkSession, src_dir: str) -> list[str]:
    """Base names of the CSV files of the folder that Spark's readers never show (``_x.csv``, ``.x.csv``)."""
    jvm = spark.sparkContext._jvm
    folder = jvm.org.apache.hadoop.fs.Path(src_dir)
    files = folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    pattern = jvm.org.apache.hadoop.fs.Path(literal_path(src_dir).rstrip("/") + "/{_,.}" + CSV_GLOB)
    return sorted(f.getPath().getName() for f in files.globStatus(pattern) or [])


def as_lines(text: DataFrame) -> DataFrame:
    """(file_path, file_name, block, rid, line) of a text scan, batch or micro-batch, with bytes cleaned.

    ``block`` is the first byte of the line's split; ``rid`` counts the rows of a task, so it counts the lines of a split
    from some first value on. Both hold for one scan only: see ``sources.records``.
    """
    return text.select(
        decoded(F.col("_metadata.file_path")).alias("file_path"),
        decoded(F.col("_metadata.file_name")).alias("file_name"),
        F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("rid"),
        clean_bytes(F.col("value")).alias("line"))


def _text(spark: SparkSession, src_dir: str, glob: str, modified_from: str | None, names: list[str] | None,
          without: set[str], **options: str) -> DataFrame:
    """Text scan of the folder's CSV files; the reader prunes files by these filters from its listing."""
    text = (spark.read.options(pathGlobFilter=glob, ignoreMissingFiles="true", **options).text(literal_path(src_dir)))
    if modified_from is not None:
        text = text.filter(F.col("_metadata.file_modification_time") >= F.lit(modified_from).cast("timestamp"))
    if names is not None:
        text = text.filter(decoded(F.col("_metadata.file_name")).isin(*names))
    if without:
        text = text.filter(~decoded(F.col("_metadata.file_name")).isin(*sorted(without)))
    return text


def scan_logger_files(spark: SparkSession, src_dir: str, glob: str = CSV_GLOB, modified_from: str | None = None,
                      names: list[str] | None = None, without: set[str] = frozenset()) -> DataFrame:
    """Lines of the folder's CSV files, see ``as_lines``.

    ``modified_from`` leaves out files last changed before that time, ``names`` all files of other base names,
    ``without`` the files of these base names; they are not opened.
    """
    return as_lines(_text(spark, src_dir, glob, modified_from, names, without))


def partly_read_files(spark: SparkSession, src_dir: str, files: DataFrame, glob: str = CSV_GLOB,
                      modified_from: str | None = None, names: list[str] | None = None,
                      without: set[str] = frozenset()) -> DataFrame:
    """Base names of those of ``files`` (file_path, file_name, size) that give fewer bytes than their size.

    The scan skips what it cannot read and counts what it can; no text leaves a task. The reader drops a byte order mark
    and the last line may lack its line feed.
    """
    text = _text(spark, src_dir, glob, modified_from, names, without, lineSep="\n", ignoreCorruptFiles="true")
    read = text.groupBy(decoded(F.col("_metadata.file_path")).alias("file_path")).agg(
        F.sum(F.octet_length("value") + 1).alias("bytes"))
    missing = F.col("size") - F.coalesce("bytes", F.lit(0))
    found = files.join(read, "file_path", "left").filter((F.col("size") > 0) & ~missing.isin(0, -1, BOM_BYTES, BOM_BYTES - 1))
    if without:
        found = found.filter(~F.col("file_name").isin(*sorted(without)))
    return found.select("file_name")


def file_of_error(error: Exception) -> set[str]:
    """Base name of the file that a failed scan names, if it names one."""
    cause = getattr(error, "java_exception", None)
    while cause is not None:
        text = cause.getMessage() or ""
        if text.startswith("[FAILED_READ_FILE."):
            return {unquote(cause.getMessageParameters().get("path")).rsplit("/", 1)[-1]}
        cause = cause.getCause()
    return set()


def unreadable_files(error: Exception, partly_read: DataFrame, most: int) -> set[str]:
    """Base names of files that a scan failed with ``error`` for: the named one, and up to ``most`` that are cut short."""
    found = file_of_error(error)
    try:
        return found | {r["file_name"] for r in partly_read.limit(most).collect()}
    except (Py4JJavaError, PySparkException) as other:  # no access, for one, is never skipped
        return found | file_of_error(other)
