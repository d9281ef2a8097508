"""Small fixed lookups expressed as columns."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

from ledgerleaf.functions.text import js_trim
from ledgerleaf.schemas import (
    CONTENT_TYPES,
    DEFAULT_CONTENT_TYPE,
    DOCUMENT_TYPES,
    STATUS_ORDER,
    TASK_ORDER,
    TYPE_HINT_PREFIXES,
)


def ordinal(value: Column, order: Iterable[str]) -> Column:
    """1-based position in a fixed order, one past the end for anything else."""
    names = list(order)
    position = F.array_position(F.array(*[F.lit(n) for n in names]), value)
    return F.when(position > 0, position).otherwise(F.lit(len(names) + 1)).cast("int")


def status_rank(status: Column) -> Column:
    return ordinal(status, STATUS_ORDER)


def task_rank(task: Column) -> Column:
    return ordinal(task, TASK_ORDER)


def controlled_type(document_type: Column) -> Column:
    """Upper-cased, trimmed and checked against the vocabulary; else UNKNOWN."""
    known = F.upper(js_trim(document_type))
    return F.when(known.isin(*DOCUMENT_TYPES), known).otherwise(F.lit("UNKNOWN"))


def type_hint(file_name: Column) -> Column:
    """Document type from the file-name prefix; the first matching prefix wins."""
    stem = F.lower(file_name)
    matches = [F.when(F.startswith(stem, F.lit(p)), F.lit(t)) for p, t in TYPE_HINT_PREFIXES]
    return F.coalesce(*matches, F.lit("UNKNOWN"))


def content_type(suffix: Column) -> Column:
    table = F.create_map(*[F.lit(x) for pair in CONTENT_TYPES.items() for x in pair])
    return F.coalesce(F.try_element_at(table, F.upper(suffix)), F.lit(DEFAULT_CONTENT_TYPE))


def clamp_index(one_based: Column, count: Column) -> Column:
    """1-based choice to a 0-based index inside [0, count)."""
    return F.greatest(F.lit(0), F.least(one_based - 1, count - 1)).cast("int")


def health(failed: Column, stuck: Column, run_state: Column) -> Column:
    return (
        F.when((failed == 0) & (stuck == 0) & (run_state == "RUNNING"), F.lit("HEALTHY"))
        .when((failed > 0) | (stuck > 0), F.lit("NEEDS ATTENTION"))
        .otherwise(F.lit("WARNING"))
    )
