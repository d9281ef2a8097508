"""Registry of queries and their SQL counterparts."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerleaf.plans.adapters import Tables

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def portable(df: DataFrame) -> DataFrame:
    """Column types that compare equal across engines: decimals as doubles, times as text, counts as bigint."""
    out = []
    for field in df.schema.fields:
        column, kind = F.col(f"`{field.name}`"), field.dataType
        if isinstance(kind, T.DecimalType):
            column = column.cast("double")
        elif isinstance(kind, (T.TimestampType, T.TimestampNTZType)):
            column = F.date_format(column, "yyyy-MM-dd HH:mm:ss.SSSSSS")
        elif isinstance(kind, T.DateType):
            column = F.date_format(column, "yyyy-MM-dd")
        elif isinstance(kind, (T.IntegerType, T.ShortType)):
            column = column.cast("bigint")
        elif isinstance(kind, T.ArrayType):
            column = F.array_join(column.cast("array<string>"), ",")
        out.append(column.alias(field.name))
    return df.select(out)


def query(name: str, sql: str | None = None):
    """Registers ``fn(tables) -> DataFrame`` under ``name``; ``sql`` is what DuckDB runs on the same tables."""

    def add(fn: Callable[[Tables], DataFrame]):
        QUERIES[name] = lambda spark, sf_dir: portable(fn(Tables(spark, sf_dir)))
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return add
