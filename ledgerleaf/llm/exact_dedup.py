"""Exact deduplication: two Bloom passes find possibly repeated hashes, and only those rows are grouped.

Texts are equal when they are identical after deleting white space. Pass one counts the Bloom masks of all hashes and
keeps, as a second filter, the bits of every mask that was set more than once. Pass two probes that filter where the
rows lie: what it does not hold is unique and passes straight through, the rest is grouped by SHA-256, so that false
positives of the filter cost a little work and never a result.

Defined cases. A null text counts as empty; empty texts are copies of each other. Of equal texts the one with the most
code points stays, then the smallest id, a null id last; of rows that agree in all of that exactly one stays. An empty
table gives an empty result. Other columns are carried along and may have any names.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerleaf.llm.common import text_of, whole_rows, without_white_space
from ledgerleaf.session import materialise

#: The second filter has a 64-bit block for every ``ROWS_PER_BLOCK`` rows, and MAX_BLOCKS at most: sixteen bytes a
#: block make the 32 MB that a broadcast may take. A fuller filter passes more rows on to the grouping, nothing else.
ROWS_PER_BLOCK = 8
MAX_BLOCKS = 1 << 21
PROBES = 4


def signatures(text: Column) -> tuple[Column, Column]:
    """SHA-256 of the text without white space, and the code points of the text as it is."""
    return F.unhex(F.sha2(without_white_space(text).cast("binary"), 256)), F.char_length(text).cast("long")


def _block(sha: Column, blocks: int) -> Column:
    return F.xxhash64(sha).bitwiseAND(blocks - 1)


def _mask(sha: Column) -> Column:
    """``PROBES`` bits of a 64-bit word, from a part of the hash that the block number does not use."""
    bits, one = F.xxhash64(sha, F.lit(1)), F.lit(1).cast("long")
    places = [F.shiftright(bits, 6 * i).bitwiseAND(63).cast("int") for i in range(PROBES)]
    return reduce(Column.bitwiseOR, [F.call_function("shiftleft", one, place) for place in places])


def repeat_filter(hashes: DataFrame, rows: int) -> tuple[DataFrame, int]:
    """The filter of possibly repeated hashes (block, word) and its number of blocks. ``hashes`` has the column sha."""
    blocks = min(MAX_BLOCKS, 1 << max(6, (rows // ROWS_PER_BLOCK).bit_length()))
    seen = hashes.groupBy(_block(F.col("sha"), blocks).alias("block"), _mask(F.col("sha")).alias("mask")).count()
    return seen.filter("count > 1").groupBy("block").agg(F.bit_or("mask").alias("word")), blocks


def probe(df: DataFrame, repeated: DataFrame, blocks: int) -> DataFrame:
    """Adds ``candidate``: whether the filter holds the row's sha. No row moves; the filter's size is bounded."""
    sha = F.col("sha")
    marked = df.withColumn("block", _block(sha, blocks)).join(F.broadcast(repeated), "block", "left")
    mask = _mask(sha)
    return marked.withColumn("candidate", F.coalesce(F.col("word").bitwiseAND(mask) == mask, F.lit(False))).drop("block", "word")


def _winners(candidates: DataFrame, *ties: str) -> DataFrame:
    best = F.min(F.struct((-F.col("n_code_points")).alias("n"), F.col("doc_id").isNull().alias("no_id"), "doc_id", *ties))
    return candidates.groupBy("sha").agg(best.alias("best"), F.count(F.lit(1)).alias("group_size"))


def duplicates(documents: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: doc_id, keep_id, group_size, kept, text_sha256. Texts are read once and never move."""
    sha, length = signatures(text_of(F.col(text_col)))
    narrow = materialise(
        documents.select(F.col(id_col).alias("doc_id"), sha.alias("sha"), length.alias("n_code_points"))
        .withColumn("row_no", F.monotonically_increasing_id()),
        "signatures",
    )
    repeated, blocks = repeat_filter(narrow, narrow.count())
    marked = probe(narrow, repeated, blocks)
    columns = ["doc_id", "keep_id", "group_size", "kept", F.lower(F.hex("sha")).alias("text_sha256")]
    unique = marked.filter("not candidate").select(
        "*", F.col("doc_id").alias("keep_id"), F.lit(1).cast("long").alias("group_size"), F.lit(True).alias("kept")
    )
    candidates = marked.filter("candidate")
    grouped = candidates.join(_winners(candidates, "row_no"), "sha").select(
        candidates["*"], F.col("best.doc_id").alias("keep_id"), "group_size", (F.col("best.row_no") == F.col("row_no")).alias("kept")
    )
    return unique.select(columns).unionByName(grouped.select(columns))


def deduplicate(documents: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows that stay, with the columns they came with."""
    row = whole_rows(documents)
    sha, length = signatures(text_of(F.col(f"row.`{text_col}`")))
    signed = row.select("row", F.col(f"row.`{id_col}`").alias("doc_id"), sha.alias("sha"), length.alias("n_code_points"))
    narrow = materialise(signed.drop("row"), "signatures")
    repeated, blocks = repeat_filter(narrow, narrow.count())
    repeated = materialise(repeated, "repeats")
    possible = probe(narrow, repeated, blocks).filter("candidate")
    # a winner that several rows match in length and id needs the rows themselves to choose one
    alike = possible.groupBy("sha", "n_code_points", "doc_id").agg(F.count(F.lit(1)).alias("alike"))
    winners = materialise(
        alike.groupBy("sha")
        .agg(F.min(F.struct((-F.col("n_code_points")).alias("n"), F.col("doc_id").isNull().alias("no_id"), "doc_id", "alike")).alias("best"))
        .select("sha", "best.*"),
        "winners",
    )
    marked = probe(signed, repeated, blocks)
    unique = marked.filter("not candidate").select("row.*")
    matched = (
        marked.filter("candidate")
        .join(winners.withColumnRenamed("doc_id", "keep_id"), "sha")
        .filter((F.col("n_code_points") == -F.col("n")) & F.col("doc_id").eqNullSafe(F.col("keep_id")))
    )
    if winners.filter("alike > 1").isEmpty():
        return unique.unionByName(matched.select("row.*"))
    single = matched.filter("alike = 1").select("row.*")
    tied = matched.filter("alike > 1").groupBy("sha").agg(F.min_by("row", F.xxhash64("row")).alias("row")).select("row.*")
    return unique.unionByName(single).unionByName(tied)
