"""Measured decisions: broadcast only what has been counted."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BROADCAST_ROWS = 200_000
BROADCAST_BYTES = 32 << 20


def is_small(df: DataFrame, max_rows: int = BROADCAST_ROWS, max_bytes: int = BROADCAST_BYTES) -> bool:
    """Counts at most ``max_rows + 1`` rows and the bytes of their values, nested ones as text."""
    sizes = [F.coalesce(F.octet_length(F.col(f"`{c}`").cast("string")), F.lit(0)) + 16 for c in df.columns]
    seen = df.limit(max_rows + 1).select(sum(sizes, F.lit(0)).alias("size")).agg(F.count(F.lit(1)).alias("n"), F.sum("size").alias("bytes"))
    found = seen.first()
    return found.n <= max_rows and (found.bytes or 0) <= max_bytes


def broadcast_if_small(narrow: DataFrame, max_rows: int = BROADCAST_ROWS, shuffled: bool = False) -> DataFrame:
    """Marks a narrow side for broadcast after counting its rows and bytes; above the bound the join stays a shuffle join.

    Worth its count where the other side carries payloads (document bytes, vectors) that must not be shuffled for
    the sake of a few keys. Elsewhere joins carry no hint: Spark compares measured sizes with its threshold.
    ``shuffled`` holds Spark to the shuffle join: it guesses the size of payloads that Python makes, or that lie
    compressed, and would take them for small enough to be broadcast themselves.
    """
    if is_small(narrow, max_rows):
        return F.broadcast(narrow)
    return narrow.hint("merge") if shuffled else narrow
