"""Custody report files with typed amounts and dates."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerleaf.functions.money import amount, rate
from ledgerleaf.schemas import CUSTODY_REPORTS


def scan_report_text(spark: SparkSession, path: str, report: str) -> DataFrame:
    """All cells as text, in file order of columns."""
    schema = T.StructType([T.StructField(c, T.StringType(), True) for c in CUSTODY_REPORTS[report]])
    return (
        spark.read.schema(schema)
        .option("header", "true")
        .option("quote", '"')
        .option("escape", '"')
        .option("multiLine", "true")
        .csv(path)
    )


def typed_report(text: DataFrame) -> DataFrame:
    """Lower-case names; ``*_usd`` and quantities become decimals, ``*_date`` dates, the rest stays text.

    A surcharge rate keeps its text and gains ``rate_pct``, null for ``flat``.
    """
    out = []
    for name in text.columns:
        low, cell = name.lower(), F.col(name)
        if low.endswith("_usd") or low == "quantity":
            out.append(amount(cell).alias(low))
        elif low.endswith("_date"):
            out.append(cell.try_cast("date").alias(low))
        else:
            out.append(cell.alias(low))
        if low == "surcharge_rate":
            out.append(rate(cell).alias("rate_pct"))
    return text.select(out)


def scan_report(spark: SparkSession, path: str, report: str) -> DataFrame:
    return typed_report(scan_report_text(spark, path, report))
