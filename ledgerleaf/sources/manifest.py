"""Upload manifest: one sidecar row per listed file."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerleaf.functions import lookups, paths

MANIFEST_SCHEMA = "path string, type string, client string, format string"


def scan_manifest(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(MANIFEST_SCHEMA).option("multiLine", "true").json(path)


def manifest_metadata(entries: DataFrame, clients: DataFrame) -> DataFrame:
    """Sidecar fields derived from manifest entries.

    ``clients`` maps client -> (custody_country, legal_entity_id, branch_id); a client it does not list gets
    US / UNKNOWN. Both slash and backslash paths are accepted.
    """
    name = paths.file_name(F.replace(F.col("path"), F.lit("\\"), F.lit("/")))
    entity = F.coalesce("legal_entity_id", F.lit("UNKNOWN"))
    return (
        entries.join(clients, "client", "left")
        .select(
            name.alias("file_name"),
            paths.file_extension(name).alias("file_format"),
            F.coalesce("custody_country", F.lit("US")).alias("custody_country"),
            entity.alias("legal_entity_id"),
            entity.alias("account_id"),
            F.coalesce("branch_id", F.lit("UNKNOWN")).alias("branch_id"),
            F.coalesce("type", F.lit("UNKNOWN")).alias("document_type_hint"),
            lookups.content_type(paths.file_extension(name)).alias("content_type"),
            F.upper(F.coalesce("format", F.lit("PDF"))).alias("listed_format"),
        )
        .withColumn("incoming_key", F.concat_ws("/", F.lit("incoming"), "account_id", "file_name"))
    )


def uploads_by_format(metadata: DataFrame) -> DataFrame:
    """Files per format plus a TOTAL row, in one aggregation."""
    return (
        metadata.rollup("listed_format")
        .agg(F.count(F.lit(1)).alias("files"), F.grouping("listed_format").alias("is_total"))
        .select(
            F.when(F.col("is_total") == 1, F.lit("TOTAL")).otherwise(F.col("listed_format")).alias("file_format"),
            "files",
        )
    )
