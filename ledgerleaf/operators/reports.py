"""Monitoring reports. Look-back windows and "stuck for" are relative to ``as_of``."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerleaf.functions import lookups, paths
from ledgerleaf.functions.times import boundary_diff, older_than, ts_literal, within_last
from ledgerleaf.operators import state
from ledgerleaf.schemas import SETTLED

STUCK_MINUTES = 30
LOOK_BACK_HOURS = 24


def most_recent(df: DataFrame, ts: str, n: int, *ties: str) -> DataFrame:
    """Newest n rows: a top-k per task and one merge, never a full sort."""
    return df.orderBy(F.desc_nulls_last(ts), *ties).limit(n)


def landing_newest(landing: DataFrame, n: int = 20) -> DataFrame:
    return most_recent(landing.select("relative_path", "file_size", "last_modified", "loaded_ts"), "loaded_ts", n, "relative_path")


def load_history(loads: DataFrame, as_of, hours: int = LOOK_BACK_HOURS, n: int = 10) -> DataFrame:
    """Latest loads in the window: (file_name, status, row_count, first_error_message, last_load_time)."""
    recent = loads.where(within_last(F.col("last_load_time"), as_of, hours=hours))
    columns = ("file_name", "status", "row_count", "first_error_message", "last_load_time")
    return most_recent(recent.select(*columns), "last_load_time", n, "file_name")


def with_duration(runs: DataFrame) -> DataFrame:
    return runs.withColumn("duration_secs", boundary_diff("second", F.col("scheduled_time"), F.col("completed_time")))


def run_history(runs: DataFrame, as_of, hours: int = LOOK_BACK_HOURS, task: str | None = None, n: int = 20) -> DataFrame:
    """Latest runs in the window with their duration in seconds."""
    recent = runs.where(within_last(F.col("scheduled_time"), as_of, hours=hours))
    if task is not None:
        recent = recent.where(F.col("name") == task)
    return most_recent(with_duration(recent), "scheduled_time", n, "name")


def last_run_per_task(runs: DataFrame, as_of, hours: int = LOOK_BACK_HOURS) -> DataFrame:
    """The latest run of each known task, in chain order."""
    recent = runs.where(
        within_last(F.col("scheduled_time"), as_of, hours=hours) & F.col("name").isin(*lookups.TASK_ORDER)
    )
    latest = state.pick_per_key(recent, ["name"], "scheduled_time")
    return with_duration(latest).orderBy(lookups.task_rank(F.col("name")))


def failed_runs(runs: DataFrame, as_of, hours: int = LOOK_BACK_HOURS) -> DataFrame:
    failed = runs.where(within_last(F.col("scheduled_time"), as_of, hours=hours) & (F.col("state") == "FAILED"))
    return failed.orderBy(F.desc("scheduled_time"), "name")


def status_summary(registry: DataFrame) -> DataFrame:
    """Documents per status and format, in lifecycle order."""
    counted = registry.groupBy("processing_status", "file_format").agg(
        F.count(F.lit(1)).alias("file_count"),
        F.min("created_ts").alias("earliest"),
        F.max("updated_ts").alias("latest_update"),
    )
    return counted.orderBy(lookups.status_rank(F.col("processing_status")), "processing_status", "file_format")


def audit_trail(audit: DataFrame, registry: DataFrame) -> DataFrame:
    """Every step of every document with its duration."""
    documents = registry.select("file_id", "file_name", "file_format", "processing_status")
    return (
        audit.join(documents, "file_id")
        .select(
            "file_id",
            "file_name",
            "file_format",
            "processing_status",
            "step_name",
            "status",
            "start_ts",
            "end_ts",
            boundary_diff("second", F.col("start_ts"), F.col("end_ts")).alias("duration_secs"),
            "error_message",
        )
        .orderBy("file_id", "start_ts", "step_name")
    )


def is_stuck(as_of, minutes: int = STUCK_MINUTES) -> Column:
    return ~F.col("processing_status").isin(*SETTLED) & older_than(F.col("updated_ts"), as_of, minutes=minutes)


def stuck_files(registry: DataFrame, as_of, minutes: int = STUCK_MINUTES) -> DataFrame:
    """Documents in progress that have not moved for a while, longest first."""
    stuck = registry.where(is_stuck(as_of, minutes)).select(
        "file_id",
        "file_name",
        "processing_status",
        "updated_ts",
        boundary_diff("minute", F.col("updated_ts"), ts_literal(as_of)).alias("mins_stuck"),
    )
    return stuck.orderBy(F.desc("mins_stuck"), "file_id")


def failed_steps(audit: DataFrame, registry: DataFrame, n: int | None = None) -> DataFrame:
    """Failed steps, newest first; ``n`` keeps the latest n."""
    failed = audit.where(F.col("status") == "FAILED").select("file_id", "step_name", "error_message", "start_ts")
    documents = registry.select("file_id", "file_name", "processing_status")
    joined = failed.join(documents, "file_id").orderBy(F.desc("start_ts"), "file_id", "step_name")
    return joined if n is None else joined.limit(n)


def classification_mix(classifications: DataFrame) -> DataFrame:
    counted = classifications.groupBy("document_type", "classification_confidence", "model_name").agg(
        F.count(F.lit(1)).alias("file_count")
    )
    return counted.orderBy(F.desc("file_count"), "document_type", "classification_confidence", "model_name")


def classification_detail(classifications: DataFrame, registry: DataFrame) -> DataFrame:
    named = classifications.drop("file_name").join(registry.select("file_id", "file_name"), "file_id")
    return named.select(
        "file_id",
        "file_name",
        "document_type",
        "classification_confidence",
        "doc_summary",
        "key_indicators",
        "classified_ts",
    ).orderBy(F.desc("classified_ts"), "file_id")


def chunk_stats(chunks: DataFrame, registry: DataFrame) -> DataFrame:
    """Chunks and token spread per file name and format.

    Chunks are reduced to one row per document before they meet the registry.
    """
    per_document = chunks.groupBy("file_id").agg(
        F.count(F.lit(1)).alias("n"),
        F.min("token_count").alias("low"),
        F.sum("token_count").alias("total"),
        F.max("token_count").alias("high"),
    )
    return (
        per_document.join(registry.select("file_id", "file_name", "file_format"), "file_id")
        .groupBy("file_name", "file_format")
        .agg(
            F.sum("n").alias("total_chunks"),
            F.min("low").alias("min_tokens"),
            F.round(F.sum("total") / F.sum("n")).cast("bigint").alias("avg_tokens"),
            F.max("high").alias("max_tokens"),
        )
        .orderBy(F.desc("total_chunks"), "file_name", "file_format")
    )


def searchable_files(registry: DataFrame, classifications: DataFrame, chunks: DataFrame) -> DataFrame:
    """AVAILABLE documents that are classified and have chunks, newest first."""
    counted = chunks.groupBy("file_id").agg(F.count(F.lit(1)).alias("chunks"))
    types = classifications.select("file_id", "document_type", "classification_confidence")
    available = registry.where(F.col("processing_status") == "AVAILABLE").select(
        "file_id", "file_name", "file_format", "client_account_id", F.col("updated_ts").alias("available_since")
    )
    return (
        available.join(types, "file_id").join(counted, "file_id").orderBy(F.desc("available_since"), "file_id")
    )


def recent_searches(searches: DataFrame, as_of=None, hours: int | None = None, n: int = 20) -> DataFrame:
    """Latest searches, optionally inside a look-back window."""
    if hours is not None:
        searches = searches.where(within_last(F.col("search_ts"), as_of, hours=hours))
    return most_recent(searches, "search_ts", n, "client_account_id", "search_term")


def search_latency(searches: DataFrame) -> DataFrame:
    return searches.groupBy("search_confidence").agg(
        F.count(F.lit(1)).alias("total_searches"),
        F.round(F.avg("execution_time_ms")).cast("bigint").alias("avg_ms"),
        F.max("execution_time_ms").alias("max_ms"),
    )


def pending_landing(landing: DataFrame, processed: DataFrame) -> DataFrame:
    """One row: how many landed paths are not processed yet, and whether there are any."""
    waiting = state.missing_from(landing.select("relative_path").distinct(), processed, ["relative_path"])
    counted = waiting.agg(F.count(F.lit(1)).alias("pending_rows"))
    return counted.withColumn("has_data", F.col("pending_rows") > 0)


def pipe_state(status_json: DataFrame, column: str = "value", keep: tuple[str, ...] = ()) -> DataFrame:
    """Run state and backlog out of a pipe status document."""
    body = F.col(column)
    return status_json.select(
        *keep,
        F.coalesce(F.get_json_object(body, "$.executionState"), F.lit("UNKNOWN")).alias("pipe_state"),
        F.coalesce(F.get_json_object(body, "$.pendingFileCount").try_cast("bigint"), F.lit(0)).alias(
            "pipe_pending_files"
        ),
    )


def dashboard(
    registry: DataFrame,
    searches: DataFrame,
    as_of,
    hours: int = LOOK_BACK_HOURS,
    run_state: str = "RUNNING",
    pipe_pending: int = 0,
    pending: DataFrame | None = None,
) -> DataFrame:
    """One row: counts of available, failed and stuck documents, recent searches, overall health.

    One pass per table; the one-row results are put side by side.
    """
    counts = registry.agg(
        F.count_if(F.col("processing_status") == "AVAILABLE").alias("files_available"),
        F.count_if(F.col("processing_status") == "FAILED").alias("files_failed"),
        F.count_if(is_stuck(as_of)).alias("files_stuck"),
    )
    recent = searches.where(within_last(F.col("search_ts"), as_of, hours=hours)).agg(F.count(F.lit(1)).alias("searches"))
    parts = [recent] if pending is None else [recent, pending.select("has_data", "pending_rows")]
    row = counts.withColumn("__one", F.lit(1))
    for part in parts:  # each side is the single row of a global aggregate
        row = row.join(part.withColumn("__one", F.lit(1)), "__one")
    return (
        row.drop("__one")
        .withColumn("pipe_state", F.lit(run_state))
        .withColumn("pipe_pending_files", F.lit(pipe_pending).cast("bigint"))
        .withColumn("health", lookups.health(F.col("files_failed"), F.col("files_stuck"), F.col("pipe_state")))
    )


def prefix_counts(objects: DataFrame, column: str = "path") -> DataFrame:
    """Objects per top folder; anything in quarantine is a warning."""
    counted = objects.groupBy(paths.part(F.col(column), 1).alias("prefix")).agg(F.count(F.lit(1)).alias("objects"))
    level = F.when((F.col("prefix") == "quarantine") & (F.col("objects") > 0), F.lit("WARN")).otherwise(F.lit("OK"))
    return counted.withColumn("level", level)


# Labels and the text they count (fixed values).
LOG_PATTERNS = {"errors": "ERROR", "successes": "Validated", "quarantined": "quarantine"}


def log_pattern_counts(logs: DataFrame, as_of, hours: int = LOOK_BACK_HOURS) -> DataFrame:
    """One row: log lines in the window that contain each pattern. ``logs`` holds (ts, message)."""
    recent = logs.where(within_last(F.col("ts"), as_of, hours=hours))
    return recent.agg(
        *[F.count_if(F.contains("message", F.lit(text))).alias(label) for label, text in LOG_PATTERNS.items()]
    )
