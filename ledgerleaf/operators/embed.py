"""Chunk embedding."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerleaf.functions.times import ts_literal
from ledgerleaf.operators import chunk, models, state
from ledgerleaf.schemas import DOCUMENT_CHUNKS


def embed(df: DataFrame, text: str, model: models.EmbeddingModel, into: str = "embedding") -> DataFrame:
    """Adds the embedding of a text column."""
    return df.withColumn(into, model.encode(F.col(text)))


def chunk_and_embed(todo: DataFrame, model: models.EmbeddingModel, as_of) -> DataFrame:
    """Chunk rows of the pending documents (file_id, client_account_id, extracted_text)."""
    rows = embed(chunk.chunk(todo), "chunk_text", model)
    rows = rows.withColumn("model_name", F.lit(model.name)).withColumn("created_ts", ts_literal(as_of))
    return rows.select(*DOCUMENT_CHUNKS.names)


def outcomes(todo: DataFrame) -> DataFrame:
    """(file_id, error): a document whose text is blank is embedded too, with no chunks."""
    return todo.select("file_id", F.lit(None).cast("string").alias("error"))


def registry_delta(registry: DataFrame, done: DataFrame, as_of) -> DataFrame:
    return state.transition(registry, done, "EMBEDDED", as_of)


NAMES = ("embedded", "failed")


def outcome_name() -> Column:
    return F.when(F.col("error").isNull(), F.lit("embedded")).otherwise(F.lit("failed"))


def counters(done: DataFrame) -> DataFrame:
    return state.counters(done.select(outcome_name().alias("outcome")), "outcome", NAMES)
