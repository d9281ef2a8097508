"""Routing of landed files to the client that owns the account and branch."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerleaf.functions import paths
from ledgerleaf.functions.times import ts_literal
from ledgerleaf.operators import state
from ledgerleaf.schemas import PAST_STAGING


def match_landing(landing: DataFrame, registry: DataFrame, mapping: DataFrame) -> DataFrame:
    """Landed paths with their document and active client.

    Path and document meet on (account folder, file name), both taken from the end of the path, so equal names in
    two accounts stay apart. Landing duplicates are removed before the join.
    """
    landed = landing.select(
        "relative_path",
        paths.account_folder(F.col("relative_path")).alias("account_id"),
        paths.part(F.col("relative_path"), -1).alias("file_name"),
    ).distinct()
    documents = registry.select("file_id", "file_name", "account_id", "branch_id", "processing_status")
    clients = mapping.where("active_flag").select("account_id", "branch_id", "client_account_id", "client_stage_name")
    return landed.join(documents, ["account_id", "file_name"]).join(clients, ["account_id", "branch_id"])


def route(landing: DataFrame, registry: DataFrame, mapping: DataFrame) -> DataFrame:
    """One row per matched path: outcome ``routed`` or ``skipped`` and the location in the client's stage."""
    skipped = F.col("processing_status").isin(*PAST_STAGING)
    return match_landing(landing, registry, mapping).select(
        "relative_path",
        "file_id",
        "account_id",
        "branch_id",
        "client_account_id",
        "client_stage_name",
        F.when(skipped, F.lit("skipped")).otherwise(F.lit("routed")).alias("outcome"),
        F.when(~skipped, paths.stage_key(F.col("client_stage_name"), F.col("relative_path"))).alias("new_location"),
        F.lit(None).cast("string").alias("error"),
    )


def routed_documents(routed: DataFrame) -> DataFrame:
    """One row per routed document (a document may have landed under several paths)."""
    rows = routed.where(F.col("outcome") == "routed").select("file_id", "client_account_id", "new_location", "error")
    return state.pick_per_key(rows, ["file_id"], "new_location", latest=False)


def registry_delta(registry: DataFrame, routed: DataFrame, as_of) -> DataFrame:
    """Changed registry rows: STAGED, new location, client filled in where it was missing."""
    side = routed_documents(routed).select("file_id", F.col("client_account_id").alias("__client"), "new_location")
    changed = {
        "client_account_id": F.coalesce("client_account_id", "__client"),
        "current_location": F.col("new_location"),
        "processing_status": F.lit("STAGED"),
        "updated_ts": ts_literal(as_of),
    }
    return registry.join(side, "file_id").select(*[changed.get(c, F.col(c)).alias(c) for c in registry.columns])


def audit(routed: DataFrame, start, end) -> DataFrame:
    return state.audit_rows(routed_documents(routed), "ROUTE", start, end)


NAMES = ("routed", "skipped", "failed")


def outcome_name() -> Column:
    return F.when(F.col("error").isNotNull(), F.lit("failed")).otherwise(F.col("outcome"))


def counters(routed: DataFrame) -> DataFrame:
    return state.counters(routed.withColumn("outcome", outcome_name()), "outcome", NAMES)
