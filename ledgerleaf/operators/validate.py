"""Validation of landed files against sidecars and the collection registry."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerleaf.functions import paths
from ledgerleaf.functions.times import ts_literal
from ledgerleaf.operators import state
from ledgerleaf.schemas import SUPPORTED_FORMATS

# Checks in order; a file gets the first one that fails (fixed values).
REASONS = (
    "bad_format",
    "no_metadata",
    "hash_mismatch",
    "bad_metadata",
    "unknown_collection",
    "destination_mismatch",
    "inactive_collection",
    "format_not_allowed",
)


def first_sidecar(sidecars: DataFrame, match_on: Iterable[str] = ("file_name",)) -> DataFrame:
    """One sidecar per match key: the one with the smallest file id."""
    return state.pick_per_key(sidecars, match_on, "file_id", latest=False)


def _blank(value: Column) -> Column:
    return F.coalesce(value, F.lit("")) == ""


def _reason_text(reason: Column) -> Column:
    """Message per reason (fixed message formats)."""
    ext = F.col("ext")
    return (
        F.when(reason == "bad_format", F.concat(F.lit("Unsupported format: "), ext))
        .when(reason == "no_metadata", F.lit("Metadata JSON not found in S3"))
        .when(
            reason == "hash_mismatch",
            F.format_string(
                "SHA-256 mismatch: expected %s..., got %s...",
                F.substring(F.coalesce("file_hash", F.lit("")), 1, 16),
                F.substring("actual_hash", 1, 16),
            ),
        )
        .when(reason == "bad_metadata", F.lit("Missing custody_country or legal_entity_id in metadata"))
        .when(
            reason == "unknown_collection",
            F.format_string(
                "Not found in CustodyCollectionRegistry: country=%s, legal_entity_id=%s",
                "custody_country",
                "legal_entity_id",
            ),
        )
        .when(
            reason == "destination_mismatch",
            F.format_string(
                "Destination mismatch: metadata=%s, registry=%s", F.col("destination"), F.col("reg_destination")
            ),
        )
        .when(
            reason == "inactive_collection",
            F.format_string(
                "CustodyCollectionRegistry entry inactive: %s/%s", F.col("custody_country"), F.col("legal_entity_id")
            ),
        )
        .when(
            reason == "format_not_allowed",
            F.format_string(
                "Format %s not in allowed_formats [%s] for %s",
                ext,
                F.array_join(
                    F.transform(F.sort_array("reg_formats"), lambda f: F.concat(F.lit("'"), f, F.lit("'"))), ", "
                ),
                F.col("legal_entity_id"),
            ),
        )
        .otherwise(F.lit("OK"))
    )


def validate(
    files: DataFrame, sidecars: DataFrame, collections: DataFrame, match_on: Iterable[str] = ("file_name",)
) -> DataFrame:
    """One row per file with the first failed check, or OK.

    ``files`` holds (path, file_size, actual_hash), see :func:`ledgerleaf.sources.files.fingerprint`. Sidecars are
    matched by file name; pass ``("account_id", "file_name")`` to match inside the account folder as well.
    """
    match_on = list(match_on)
    name = paths.file_name(F.col("path"))
    landed = files.select(
        "path",
        F.col("file_size").alias("landed_size"),
        "actual_hash",
        name.alias("file_name"),
        paths.file_extension(name).alias("ext"),
        *([paths.account_folder(F.col("path")).alias("account_id")] if "account_id" in match_on else []),
    )
    meta = first_sidecar(sidecars, match_on)
    registry = collections.select(
        "custody_country",
        "legal_entity_id",
        F.col("destination").alias("reg_destination"),
        F.col("active_flag").alias("reg_active"),
        F.coalesce("allowed_formats", F.array().cast("array<string>")).alias("reg_formats"),
        F.lit(True).alias("reg_found"),
    )
    joined = landed.join(meta, match_on, "left").join(registry, ["custody_country", "legal_entity_id"], "left")

    destinations_differ = (
        ~_blank(F.col("destination"))
        & ~_blank(F.col("reg_destination"))
        & (F.lower("destination") != F.lower("reg_destination"))
    )
    checks = (
        ~F.col("ext").isin(*SUPPORTED_FORMATS),
        F.col("file_id").isNull(),
        ~F.col("actual_hash").eqNullSafe(F.coalesce("file_hash", F.lit(""))),
        _blank(F.col("custody_country")) | _blank(F.col("legal_entity_id")),
        F.col("reg_found").isNull(),
        destinations_differ,
        ~F.coalesce("reg_active", F.lit(False)),
        ~F.array_contains("reg_formats", F.col("ext")),
    )
    reason = F.coalesce(*[F.when(failed, F.lit(r)) for failed, r in zip(checks, REASONS)], F.lit("OK"))
    valid = F.col("reason") == "OK"
    return (
        joined.withColumn("reason", reason)
        .withColumn("success", valid)
        .withColumn("reason_text", _reason_text(F.col("reason")))
        .withColumn(
            "dst_key",
            F.when(
                valid, paths.validated_key(F.coalesce("account_id", "legal_entity_id"), F.col("file_name"))
            ).otherwise(paths.quarantine_key(F.col("reason"), F.col("file_name"))),
        )
        # A file refused by the format gate is never looked up, so its id stays unknown.
        .withColumn("file_id", F.when(F.col("reason") != "bad_format", F.col("file_id")))
        .select(
            "path", "file_name", "ext", "file_id", "success", "reason", "reason_text", "dst_key", "file_format",
            F.coalesce("account_id", F.lit("")).alias("account_id"),
            F.coalesce("branch_id", F.lit("")).alias("branch_id"),
            F.coalesce("file_hash", F.lit("")).alias("file_hash"),
            F.coalesce("file_size", F.lit(0)).alias("file_size"),
            F.coalesce("source_system", F.lit("S3")).alias("source_system"),
        )
    )


def registry_delta(results: DataFrame) -> DataFrame:
    """Registry rows of the valid files, one per file id; the client is set later, by routing."""
    valid = results.where("success").select(
        "file_id",
        "file_name",
        "file_format",
        "account_id",
        "branch_id",
        "file_hash",
        "file_size",
        F.col("dst_key").alias("current_location"),
        F.lit("VALIDATED").alias("processing_status"),
        "source_system",
    )
    return state.pick_per_key(valid, ["file_id"], "current_location")


def audit(results: DataFrame, registry: DataFrame, as_of) -> DataFrame:
    """VALIDATE audit rows. Valid files whose document is final already leave none; so do files without an id."""
    known = results.where(F.col("file_id").isNotNull())
    final = registry.where(F.col("processing_status").isin(*state.VALIDATION_FINAL)).select("file_id")
    passed = known.where("success").join(final, "file_id", "left_anti")
    failed = known.where("not success")
    now = ts_literal(as_of)

    def rows(df: DataFrame, status: str, message: Column) -> DataFrame:
        return df.select(
            "file_id",
            F.lit("VALIDATE").alias("step_name"),
            F.lit(status).alias("status"),
            now.alias("start_ts"),
            now.alias("end_ts"),
            message.alias("error_message"),
        )

    return rows(passed, "VALIDATED", F.lit(None).cast("string")).unionByName(
        rows(failed, "FAILED", F.col("reason_text"))
    )


def alerts(results: DataFrame) -> DataFrame:
    """One alert row per quarantined file."""
    return results.where("not success").select(
        F.concat(F.lit("Quarantine: "), "reason").alias("subject"),
        F.format_string(
            "File: %s\nReason: %s\nFile ID: %s", F.col("path"), F.col("reason_text"), F.coalesce("file_id", F.lit("unknown"))
        ).alias("message"),
    )


def dispositions(results: DataFrame) -> DataFrame:
    """Rows for the split sink, to be written with ``partitionBy("disposition", "reason")``."""
    return results.select(
        "path",
        "dst_key",
        "file_id",
        "reason_text",
        F.when(F.col("success"), F.lit("validated")).otherwise(F.lit("quarantine")).alias("disposition"),
        "reason",
    )


def run_metrics() -> dict[str, Column]:
    """processed / successes / failures of one run, to observe while its ``dispositions`` are written."""
    valid = F.col("disposition") == "validated"
    return {"processed": F.count(F.lit(1)), "successes": F.count_if(valid), "failures": F.count_if(~valid)}


def run_counters(envelopes: DataFrame, results: DataFrame) -> DataFrame:
    """processed / successes / failures of one run; malformed envelopes fail, skipped keys are not counted."""
    seen = envelopes.where(F.col("outcome") == "malformed").select(F.lit(False).alias("success"))
    seen = seen.unionByName(results.select("success"))
    counts = seen.agg(
        F.count(F.lit(1)).alias("processed"),
        F.count_if("success").alias("successes"),
        F.count_if(~F.col("success")).alias("failures"),
    )
    return counts.withColumn("result_json", F.to_json(F.struct("processed", "successes", "failures")))
