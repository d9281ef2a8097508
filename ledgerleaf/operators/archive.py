"""Retention: which documents leave, where they go, what is reported."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerleaf.functions import paths
from ledgerleaf.functions.times import older_than, ts_literal
from ledgerleaf.operators import sizing, state

RETENTION_DAYS = 730


def is_expired(as_of, retention_days: int = RETENTION_DAYS, status: str = "AVAILABLE") -> Column:
    """Both tests are plain comparisons with literals, so they reach the scan."""
    return (F.col("processing_status") == status) & older_than(F.col("created_ts"), as_of, days=retention_days)


def candidates(
    registry: DataFrame, as_of, retention_days: int = RETENTION_DAYS, status: str = "AVAILABLE", ordered: bool = True
) -> DataFrame:
    """Documents to archive, oldest first."""
    due = registry.where(is_expired(as_of, retention_days, status)).select(
        "file_id", "file_name", "account_id", "current_location", "created_ts"
    )
    return due.orderBy("created_ts", "file_id") if ordered else due


def payload(due: DataFrame, files: DataFrame) -> DataFrame:
    """(account_id, archive_path, content) rows for the archive sink; ``files`` holds (location, content)."""
    narrow = due.select("account_id", "file_id", "file_name", F.col("current_location").alias("location"))
    return files.select("location", "content").join(sizing.broadcast_if_small(narrow, shuffled=True), "location").select(
        "account_id",
        "file_id",
        paths.archive_key(F.col("account_id"), F.col("file_id"), F.col("file_name")).alias("archive_path"),
        "content",
    )


def outcomes(due: DataFrame, moved: DataFrame | None = None) -> DataFrame:
    """(file_id, account_id, file_name, new_location, error) per candidate.

    ``moved`` reports (file_id, error) of the copy; without it every copy counts as done. A candidate the copy did
    not report failed.
    """
    located = due.withColumn(
        "new_location", paths.archive_key(F.col("account_id"), F.col("file_id").cast("string"), F.col("file_name"))
    )
    if moved is None:
        located = located.withColumn("error", F.lit(None).cast("string"))
    else:
        reported = moved.select("file_id", "error", F.lit(True).alias("__seen"))
        located = located.join(reported, "file_id", "left").withColumn(
            "error", F.when(F.col("__seen").isNull(), F.lit("not copied")).otherwise(F.col("error"))
        )
    return located.select("file_id", "account_id", "file_name", "new_location", "error")


def registry_delta(registry: DataFrame, done: DataFrame, as_of) -> DataFrame:
    """Changed rows: ARCHIVED with the new location, or FAILED in place. Rows archived already stay out."""
    side = done.select("file_id", F.col("new_location").alias("current_location"), "error")
    return state.transition(registry.where(F.col("processing_status") != "ARCHIVED"), side, "ARCHIVED", as_of)


def audit(done: DataFrame, as_of) -> DataFrame:
    """An ARCHIVING and an ARCHIVED row per document; a failed copy ends in FAILED instead."""
    now = ts_literal(as_of)
    failed = F.col("error").isNotNull()
    steps = F.array(F.lit("ARCHIVING"), F.when(failed, F.lit("FAILED")).otherwise(F.lit("ARCHIVED")))
    rows = done.select("file_id", "error", F.explode(steps).alias("status"))
    return rows.select(
        "file_id",
        F.lit("ARCHIVE").alias("step_name"),
        "status",
        now.alias("start_ts"),
        now.alias("end_ts"),
        F.when(F.col("status") == "FAILED", F.col("error")).alias("error_message"),
    )


def alerts(done: DataFrame, subject_prefix: str = "Document") -> DataFrame:
    """(subject, file_id, message): one row per failure, plus one summary even when nothing was due.

    The summary carries the count; the ids are the rows of the candidate table, however many there are.
    """
    failures = done.where(F.col("error").isNotNull()).select(
        F.lit(f"{subject_prefix} archive failed").alias("subject"),
        F.col("file_id").cast("string").alias("file_id"),
        F.format_string("File ID: %s\nError: %s", F.col("file_id").cast("string"), F.col("error")).alias("message"),
    )
    summary = done.agg(F.count(F.lit(1)).alias("n")).select(
        F.lit(f"{subject_prefix} archive run complete").alias("subject"),
        F.lit(None).cast("string").alias("file_id"),
        F.concat(F.lit("Documents processed: "), F.col("n").cast("string")).alias("message"),
    )
    rows = failures.unionByName(summary)
    return rows


def workflow_alert(df: DataFrame, subject_prefix: str = "Document") -> DataFrame:
    """Alert rows for runs that failed as a whole: ``df`` holds (error)."""
    return df.select(
        F.lit(f"{subject_prefix} archive workflow FAILED").alias("subject"),
        F.lit(None).cast("string").alias("file_id"),
        F.concat(F.lit("Error: "), "error").alias("message"),
    )
