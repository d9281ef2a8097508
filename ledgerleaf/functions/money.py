"""Amounts and rates: text to exact decimals."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

AMOUNT = "decimal(18,2)"
RATE = "decimal(18,6)"


def amount(text: Column) -> Column:
    """``"$92,600.00"`` -> 92600.00; null when the text is no number."""
    return F.regexp_replace(text.cast("string"), "[$,%]", "").try_cast(AMOUNT)


def rate(text: Column) -> Column:
    """``"0.25%"`` -> 0.25; null for words such as ``flat``."""
    return F.regexp_replace(text.cast("string"), "[$,%]", "").try_cast(RATE)


def cents(value: Column) -> Column:
    """Round half up to two places and keep an exact type."""
    return F.round(value, 2).cast(AMOUNT)
