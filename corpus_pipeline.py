"""From raw documents to packed training sequences: five stages, each one operator over all that the one before kept.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame; ``run`` writes each to the shared folder and reads it
back for the next. The first four return the columns of documents; the last returns the pieces with their places.

Defined cases are those of the operators: null texts count as empty; empty tables pass through every stage; null ids,
repeated rows and further columns are carried along by the first four stages. A document that the mix repeats is packed
as often as it comes.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from ledgerleaf.llm import exact_dedup, mixing, packing, quality, simhash
from ledgerleaf.llm.common import table
from ledgerleaf.session import materialise

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def quality_filter(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality network does not reject."""
    return quality.keep_good(docs, quality.train(docs, table(spark, sf_dir, "labels")))


def exact_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each set of equal texts."""
    return exact_dedup.deduplicate(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies: three-word shingles, fingerprints at two bits or less."""
    return simhash.representatives(docs)


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix of sources takes them."""
    return mixing.mixed(docs)


def sequence_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents in sequences of 2048 tokens."""
    return packing.pack(docs)


STAGES: list[tuple[str, Stage]] = [
    ("quality filter", quality_filter),
    ("exact dedup", exact_dedup_stage),
    ("near dedup", near_dedup),
    ("source mix", source_mix),
    ("sequence packing", sequence_packing),
]

#: The quality network, fingerprints and token ids are beyond SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages, applied to documents."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialise(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
