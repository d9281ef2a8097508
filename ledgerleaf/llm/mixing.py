"""Mixing sources to target weights: capped water-filling, then seeded whole and fractional repetitions.

Each source asks for its share of the total by weight. A source that would need more than ``max_epochs`` passes over its
documents is clamped there, and what it cannot take is shared among the others by weight, until none is above its cap.
A source is then repeated ``floor(target / size)`` times whole, and the fraction that is left is taken from the front of
a seeded order of its documents. The order is cut by weight: the documents of a source fall into ``BUCKETS`` buckets by
a seeded hash of id and text, sizes are summed per bucket, and buckets are taken up to the one whose end lies closest to
the wanted size. So a source misses its target by half of its largest bucket at most: half a document of a small source and
about 1/100,000 of a large one, whether ids are distinct, repeated or null. Only rows that repeat id and text are one
bucket whatever their number.

Nothing but one row per source and bucket is ever gathered, with partial sums before the shuffle.

Defined cases. A null text has size 0; a null source is a source of its own and comes last in order. Documents without
words are taken as often as their bucket. Rows of one id and text share a bucket and are taken alike. An empty table, or one
without words, takes nothing. Other columns are carried along by ``mixed`` and may have any names.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerleaf.llm.common import ranked, text_of, whole_rows
from ledgerleaf.session import materialise

WEIGHTS = (5, 2, 1)
MAX_EPOCHS = 3
SEED = 42
BUCKETS = 1 << 16


def size_of(text: Column) -> Column:
    """Number of `[^\\x20\\x09-\\x0D]+` in the text."""
    return F.regexp_count(text_of(text), F.lit("[^\\x20\\x09-\\x0D]+")).cast("long")


def bucket_of(doc_id: Column, text: Column, seed: int = SEED) -> Column:
    """Sixteen bits of the md5 of seed, id and text: the same in every engine and run."""
    digest = F.md5(F.concat(F.lit(f"{seed}|"), F.coalesce(doc_id.cast("string"), F.lit("")), F.lit("|"), text_of(text)).cast("binary"))
    return F.conv(F.substring(digest, 1, 4), 16, 10).cast("int")


def water_fill(sources: DataFrame, max_epochs: int = MAX_EPOCHS) -> DataFrame:
    """Adds ``target`` to rows of (source, weight, source_size). Each round clamps every source above its cap."""
    sources = sources.withColumn("cap", F.col("source_size") * max_epochs)
    total = sources.agg(F.sum("source_size")).first()[0] or 0
    weight, cap = F.col("weight").cast("decimal(38,0)"), F.col("cap").cast("decimal(38,0)")
    clamped, before = F.lit(False), -1
    while True:
        now = sources.agg(
            F.coalesce(F.sum(F.when(~clamped, F.col("weight"))), F.lit(0)).alias("weight"),
            F.coalesce(F.sum(F.when(clamped, F.col("cap"))), F.lit(0)).alias("given"),
            F.count(F.when(clamped, 1)).alias("many"),
        ).first()
        if now.many == before or not now.weight:
            break
        before = now.many
        # in whole numbers; what is clamped stays so, as the level only rises
        clamped = weight * F.lit(total - now.given) >= cap * F.lit(now.weight)
    share = (F.col("weight") * F.lit(total - now.given)).cast("double") / F.lit(float(now.weight or 1))
    return sources.withColumn("target", F.when(clamped, F.col("cap").cast("double")).otherwise(share)).drop("cap")


def plan(sized: DataFrame, weights: Sequence[int] = WEIGHTS, max_epochs: int = MAX_EPOCHS) -> DataFrame:
    """(source, source_size, target, whole, last_bucket) from rows of (source, bucket, size)."""
    cells = materialise(sized.groupBy("source", "bucket").agg(F.sum("size").alias("size")), "mix-cells")
    sources = cells.groupBy("source").agg(F.sum("size").alias("source_size"))
    order = ranked(sources, F.asc_nulls_last("source"))
    weight = F.element_at(F.array([F.lit(w) for w in weights]), (F.col("rank") % len(weights) + 1).cast("int"))
    targets = water_fill(materialise(order.withColumn("weight", weight.cast("long")), "mix-sources"), max_epochs)
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    targets = targets.withColumn("whole", F.floor(rate).cast("long"))
    targets = targets.withColumn("rest", F.col("target") - F.col("whole") * F.col("source_size"))
    # at most BUCKETS rows a source
    upto = F.sum("size").over(Window.partitionBy("source").orderBy("bucket"))
    ends = cells.select("source", "bucket", upto.alias("end"))
    wanted = targets.select(F.col("source").alias("of"), "rest")
    closest = (
        ends.join(wanted, F.col("source").eqNullSafe(F.col("of")))
        .filter(F.abs(F.col("end") - F.col("rest")) < F.col("rest"))  # else taking none is closer
        .groupBy("source")
        .agg(F.min(F.struct(F.abs(F.col("end") - F.col("rest")).alias("off"), "bucket")).alias("best"))
        .select(F.col("source").alias("of"), F.col("best.bucket").alias("last_bucket"))
    )
    return (
        targets.join(closest, F.col("source").eqNullSafe(F.col("of")), "left")
        .select("source", "source_size", "target", "whole", F.coalesce("last_bucket", F.lit(-1)).alias("last_bucket"))
    )


def _times() -> Column:
    return F.col("whole") + F.when(F.col("bucket") <= F.col("last_bucket"), 1).otherwise(0)


def mixture(
    documents: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", weights: Sequence[int] = WEIGHTS, max_epochs: int = MAX_EPOCHS, seed: int = SEED
) -> DataFrame:
    """One row per document: doc_id, size, source_size, target, taken."""
    sized = materialise(
        documents.select(
            F.col(id_col).alias("doc_id"),
            F.col(source_col).alias("source"),
            size_of(F.col(text_col)).alias("size"),
            bucket_of(F.col(id_col), F.col(text_col), seed).alias("bucket"),
        ),
        "mix-sizes",
    )
    per_source = materialise(plan(sized, weights, max_epochs), "mix-plan").withColumnRenamed("source", "of")
    return sized.join(per_source, F.col("source").eqNullSafe(F.col("of"))).select(
        "doc_id", "size", "source_size", "target", (F.col("size") * _times()).cast("long").alias("taken")
    )


def mixed(
    documents: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", weights: Sequence[int] = WEIGHTS, max_epochs: int = MAX_EPOCHS, seed: int = SEED
) -> DataFrame:
    """The mix itself: every row as often as it is taken, with the columns it came with."""
    row = whole_rows(documents)
    doc_id, text, source = F.col(f"row.`{id_col}`"), F.col(f"row.`{text_col}`"), F.col(f"row.`{source_col}`")
    sized = row.select(source.alias("source"), size_of(text).alias("size"), bucket_of(doc_id, text, seed).alias("bucket"))
    per_source = materialise(plan(sized, weights, max_epochs), "mix-plan").withColumnRenamed("source", "of")
    times = _times().cast("int")
    return (
        row.withColumn("bucket", bucket_of(doc_id, text, seed))
        .join(per_source, source.eqNullSafe(F.col("of")))
        .filter(times > 0)
        .select("row", F.explode(F.array_repeat(F.lit(0), times)))
        .select("row.*")
    )
