"""Document files and landing listings."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter

from ledgerleaf.functions import paths
from ledgerleaf.schemas import SUPPORTED_FORMATS

BINARY_FILE_SCHEMA = "path string, modificationTime timestamp, length bigint, content binary"


def scan_documents(spark: SparkSession, directory: str, glob: str = "*", tolerant: bool = True) -> DataFrame:
    """Every file below a directory: ``path, modificationTime, length, content``.

    ``content`` is read only where a plan uses it. With ``tolerant`` an unreadable file is left out
    instead of failing the scan.
    """
    return (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", "true")
        .option("pathGlobFilter", glob)
        .option("ignoreCorruptFiles", str(tolerant).lower())
        .load(directory)
    )


def relative_path(path: Column, root: str) -> Column:
    """Path below ``root``; works for ``file:/x`` and plain spellings of the same root."""
    tail = root.split("://", 1)[-1].removeprefix("file:").strip("/")
    return F.substring_index(path, f"{tail}/", -1)


def fingerprint(files: DataFrame, root: str, keep: tuple[str, ...] = ()) -> DataFrame:
    """One narrow row per file: relative path, size and SHA-256, and the columns to keep.

    The hash is taken next to the scan, so document bytes never enter a shuffle. Files whose format is not
    supported are not read for hashing.
    """
    supported = paths.file_extension(paths.file_name(F.col("path"))).isin(*SUPPORTED_FORMATS)
    return files.select(
        relative_path(F.col("path"), root).alias("path"),
        F.col("length").alias("file_size"),
        F.when(supported, F.sha2("content", 256)).alias("actual_hash"),
        *keep,
    )


def landing_rows(files: DataFrame, root: str, as_of: Column, keep: tuple[str, ...] = ()) -> DataFrame:
    """Landing listing: one row per file with its true length; the bytes are read only if kept."""
    return files.select(
        relative_path(F.col("path"), root).alias("relative_path"),
        F.col("length").alias("file_size"),
        F.col("modificationTime").cast("timestamp_ntz").alias("last_modified"),
        as_of.cast("timestamp_ntz").alias("loaded_ts"),
        *keep,
    )


def landing_stream(
    spark: SparkSession, directory: str, max_files_per_trigger: int | None = None, content: bool = False
) -> DataFrame:
    """The same listing as an append-only stream: each new file appears once per checkpoint."""
    reader = (
        spark.readStream.format("binaryFile")
        .schema(BINARY_FILE_SCHEMA)
        .option("recursiveFileLookup", "true")
        .option("ignoreCorruptFiles", "true")
    )
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    keep = ("content",) if content else ()
    return landing_rows(reader.load(directory), directory, F.current_timestamp(), keep)


def start_landing(stream: DataFrame, out: str, checkpoint: str, once: bool = True) -> DataStreamWriter:
    """Writer that appends landing rows; ``once`` drains what is there, else it polls every minute."""
    writer = stream.writeStream.format("parquet").option("path", out).option("checkpointLocation", checkpoint)
    return writer.trigger(availableNow=True) if once else writer.trigger(processingTime="1 minute")
