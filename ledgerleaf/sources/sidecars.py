"""Sidecar metadata, collection registry and client mapping."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerleaf.schemas import CLIENT_MAPPING, COLLECTION_REGISTRY, SIDECAR

# Column -> JSON keys, in order of preference (fixed values). JSON keys are case-sensitive.
SIDECAR_KEYS = {
    "file_id": ("file_id",),
    "file_name": ("file_name",),
    "file_format": ("file_format",),
    "custody_country": ("custody_country",),
    "legal_entity_id": ("legal_entity_id",),
    "source": ("Source", "source"),
    "destination": ("Destination", "destination"),
    "account_id": ("Accountid",),
    "branch_id": ("branch_id",),
    "file_hash": ("filehash", "file_hash"),
    "file_size": ("file_size",),
    "source_system": ("source_system",),
    "document_type_hint": ("document_type_hint",),
    "upload_ts": ("upload_ts",),
    "period": ("period",),
    "client_name": ("client_name",),
}


# The same for the collection registry (fixed values).
COLLECTION_KEYS = {
    "custody_country": ("custody_country",),
    "legal_entity_id": ("legal_entity_id",),
    "allowed_formats": ("allowed_formats",),
    "source": ("source", "Source"),
    "destination": ("destination", "Destination"),
    "active_flag": ("active_flag",),
}


def _by_key(raw: DataFrame, column: str, keys: dict[str, tuple[str, ...]], schema: T.StructType) -> DataFrame:
    """The columns of ``schema`` from JSON objects, each from the first of its keys that the object has.

    A key whose value is null is there: its null counts, and no later key is looked at. The text is parsed once. Text that
    is no JSON, or that repeats a key within an object, gives nulls.
    """
    parsed = raw.select(F.try_parse_json(column).alias("body"))
    # absent keys give no variant at all, null values give a variant that holds null
    found = parsed.select(*[F.coalesce(*[F.try_variant_get("body", f"$.{k}", "variant") for k in keys[f.name]]).alias(f.name) for f in schema.fields])

    def typed(field: T.StructField) -> Column:
        if isinstance(field.dataType, T.ArrayType):
            return F.try_variant_get(field.name, "$", field.dataType.simpleString())
        # by way of text, so that numbers in quotes are numbers too
        return F.try_variant_get(field.name, "$", "string").try_cast(field.dataType.simpleString())

    return found.select([typed(f).alias(f.name) for f in schema.fields])


def parse_sidecars(raw: DataFrame, column: str = "value") -> DataFrame:
    """JSON text, one object per row, to the sidecar schema. Objects without a file id are dropped."""
    rows = _by_key(raw, column, {**SIDECAR_KEYS, "allowed_formats": ("allowed_formats",)}, SIDECAR)
    return rows.where(F.col("file_id").isNotNull() & F.col("file_name").isNotNull())


def parse_collections(raw: DataFrame, column: str = "value") -> DataFrame:
    """JSON text, one object per row, to the collection registry. Objects without both key columns are dropped."""
    rows = _by_key(raw, column, COLLECTION_KEYS, COLLECTION_REGISTRY)
    return rows.where(F.col("custody_country").isNotNull() & F.col("legal_entity_id").isNotNull())


def scan_sidecars(spark: SparkSession, directory: str) -> DataFrame:
    """One JSON object per ``*.json`` file."""
    raw = spark.read.text(directory, wholetext=True, recursiveFileLookup=True, pathGlobFilter="*.json")
    return parse_sidecars(raw)


def scan_collections(spark: SparkSession, path: str, fmt: str = "json") -> DataFrame:
    """Collection registry, keyed by (custody_country, legal_entity_id); JSON with one object per line."""
    if fmt == "json":
        return parse_collections(spark.read.text(path))
    return spark.read.schema(COLLECTION_REGISTRY).format(fmt).load(path)


def scan_client_mapping(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    """Client mapping, keyed by (account_id, branch_id); one client may own many rows."""
    return spark.read.schema(CLIENT_MAPPING).format(fmt).load(path)
