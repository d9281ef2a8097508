"""Queue envelopes that announce new objects."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def explode_records(envelopes: DataFrame, column: str = "value") -> DataFrame:
    """``{"Records": [{"body": ...}]}`` text to one ``body`` row per record."""
    records = F.from_json(F.col(column), "struct<Records: array<struct<body: string>>>")["Records"]
    return envelopes.select(F.explode(records).alias("record")).select("record.body")


def parse_bodies(bodies: DataFrame, column: str = "body") -> DataFrame:
    """Adds ``object_key`` and ``outcome``: malformed, skipped (outside incoming/) or accepted.

    The key sits under ``detail`` when the body has one, else directly under the body.
    """
    body = F.col(column)
    has_detail = F.get_json_object(body, "$.detail").isNotNull()
    key = F.when(has_detail, F.get_json_object(body, "$.detail.object.key")).otherwise(
        F.get_json_object(body, "$.object.key")
    )
    return bodies.withColumn("object_key", key).withColumn(
        "outcome",
        F.when(F.col("object_key").isNull(), F.lit("malformed"))
        .when(~F.startswith("object_key", F.lit("incoming/")), F.lit("skipped"))
        .otherwise(F.lit("accepted")),
    )
