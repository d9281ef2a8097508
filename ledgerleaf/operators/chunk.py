"""Overlapping chunks for embedding.

A text is a list of pieces: its paragraphs, or the sentences of the first paragraph when that one alone exceeds the
target. Every piece but the first carries the joiner that sets it off. Where chunks begin depends on lengths alone, so
a fold over integers finds the cuts and each chunk's text is put together once. Everything runs inside the JVM as
higher-order functions over one row: documents are neither shuffled nor moved to Python.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerleaf.functions.text import JS_SPACE, js_trim, token_estimate, token_estimate_collapsed

# 500 and 50 tokens at four characters each (fixed values).
TARGET_CHARS = 2000
OVERLAP_CHARS = 200

PARAGRAPH_JOINER = "\n\n"
SENTENCE_JOINER = " "
_TEXTS = "array<string>"


def _pieces(paragraphs: Column, target: int) -> Column:
    def joined(texts: Column, joiner: str) -> Column:
        return F.transform(texts, lambda text, i: F.when(i == 0, text).otherwise(F.concat(F.lit(joiner), text)))

    head = F.get(paragraphs, F.lit(0))
    sentences = joined(F.split(head, f"(?<=[.!?])[{JS_SPACE}]+"), SENTENCE_JOINER)
    rest = F.slice(joined(paragraphs, PARAGRAPH_JOINER), 2, F.greatest(F.size(paragraphs) - 1, F.lit(0)))
    return F.when(F.length(head) + 1 > target, F.concat(sentences, rest)).otherwise(
        joined(paragraphs, PARAGRAPH_JOINER)
    )


def _cuts(pieces: Column, target: int, overlap: int) -> Column:
    """1-based positions of the pieces that open a chunk.

    A piece fits while open text, piece and one character stay within the target: the joiner of a sentence is that
    character, the joiner of a paragraph is one longer. A chunk opens with the overlap of the one before it.
    """

    def state(cuts: Column, n: Column, i: Column) -> Column:
        return F.struct(cuts.alias("cuts"), n.alias("n"), i.alias("i"))

    def step(acc: Column, piece: Column) -> Column:
        at = acc["i"] + 1
        allowed = F.when(F.startswith(piece, F.lit(PARAGRAPH_JOINER)), F.lit(target + 1)).otherwise(F.lit(target))
        return (
            F.when(acc["i"] == 0, state(F.array(at), F.length(piece), at))
            .when(acc["n"] + F.length(piece) <= allowed, state(acc["cuts"], acc["n"] + F.length(piece), at))
            .otherwise(
                state(
                    F.concat(acc["cuts"], F.array(at)),
                    F.least(acc["n"], F.lit(overlap)) + F.length(piece),
                    at,
                )
            )
        )

    start = state(F.array().cast("array<int>"), F.lit(0), F.lit(0))
    return F.aggregate(pieces, start, step, lambda acc: acc["cuts"])


def _texts(pieces: Column, cuts: Column, overlap: int) -> Column:
    def body(cut: Column, k: Column) -> Column:
        end = F.coalesce(F.get(cuts, k + 1), F.size(pieces) + 1)
        return F.array_join(F.slice(pieces, cut, end - cut), "")

    def append(done: Column, text: Column) -> Column:
        before = F.coalesce(F.right(F.try_element_at(done, F.lit(-1)), F.lit(overlap)), F.lit(""))
        return F.concat(done, F.array(F.concat(before, text)))

    def trim_last(done: Column) -> Column:
        return F.transform(done, lambda text, k: F.when(k == F.size(done) - 1, js_trim(text)).otherwise(text))

    return F.aggregate(F.transform(cuts, body), F.array().cast(_TEXTS), append, trim_last)


def with_chunks(
    df: DataFrame, text: str = "extracted_text", target: int = TARGET_CHARS, overlap: int = OVERLAP_CHARS
) -> DataFrame:
    """Adds ``chunks``, the array of chunk texts; empty for blank or missing text."""
    trimmed = F.transform(F.split(F.coalesce(text, F.lit("")), "\n{2,}"), js_trim)
    return (
        df.withColumn("__paragraphs", F.filter(trimmed, lambda p: p != ""))
        .withColumn(
            "__pieces",
            F.when(F.size("__paragraphs") == 0, F.array().cast(_TEXTS)).otherwise(
                _pieces(F.col("__paragraphs"), target)
            ),
        )
        .withColumn("__cuts", _cuts(F.col("__pieces"), target, overlap))
        .withColumn("chunks", _texts(F.col("__pieces"), F.col("__cuts"), overlap))
        .drop("__paragraphs", "__pieces", "__cuts")
    )


def chunk(df: DataFrame, text: str = "extracted_text", target: int = TARGET_CHARS, overlap: int = OVERLAP_CHARS) -> DataFrame:
    """One row per chunk: the other columns of ``df``, ``chunk_index`` from 0, ``chunk_text``, ``token_count``."""
    keep = [c for c in df.columns if c != text]
    # The outer form keeps Spark from testing the array for emptiness first, which would fold every text again.
    exploded = with_chunks(df, text, target, overlap).select(
        *keep, F.posexplode_outer("chunks").alias("chunk_index", "chunk_text")
    )
    rows = exploded.where(F.col("chunk_text").isNotNull())
    return rows.withColumn("token_count", token_estimate(F.col("chunk_text")))


def paragraphs(df: DataFrame, text: str = "extracted_text") -> DataFrame:
    """One row per line of text with its 0-based index inside the document and a token estimate."""
    keep = [c for c in df.columns if c != text]
    lines = df.select(*keep, F.posexplode(F.split(text, "\n")).alias("chunk_index", "chunk_text"))
    estimate = F.round(token_estimate_collapsed(F.col("chunk_text"))).cast("bigint")
    return lines.withColumn("token_count", estimate)


def pending(registry: DataFrame, texts: DataFrame) -> DataFrame:
    """TEXT_EXTRACTED documents with their text."""
    ready = registry.where(F.col("processing_status") == "TEXT_EXTRACTED").select("file_id", "client_account_id")
    return ready.join(texts.select("file_id", "extracted_text"), "file_id")
