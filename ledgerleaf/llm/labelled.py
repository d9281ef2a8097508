"""Bounded samples of labelled documents for the learners, drawn from the rows that are not held out."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerleaf.llm.common import held_out, text_of


def sample(
    documents: DataFrame, labels: DataFrame, label: str, rows: int, max_bytes: int, id_col: str = "doc_id", text_col: str = "text"
) -> list[tuple[str, int]]:
    """Texts and labels, at most ``rows`` of each class and ``max_bytes`` a text, in the order of a hash of the id.

    Four times the ids are drawn, as some have no document or a longer text. Null ids and labels are left out; a document
    with several labels counts with the smallest. What reaches the driver is bounded by the two parameters.
    """
    given = labels.select(F.col(id_col).alias("of"), F.col(label).cast("int").alias("label")).filter("of is not null and label in (0, 1)")
    given = given.filter(~held_out(F.col("of"))).groupBy("of").agg(F.min("label").alias("label"))
    order = (F.xxhash64("of", F.lit("sample")), F.col("of"))
    drawn = [given.filter(F.col("label") == k).orderBy(*order).limit(4 * rows) for k in (0, 1)]
    ids = F.broadcast(drawn[0].unionByName(drawn[1]))  # 8 x rows pairs of an id and a label
    texts = documents.select(F.col(id_col).alias("of"), text_of(F.col(text_col)).alias("text")).filter(F.octet_length("text") <= max_bytes).join(ids, "of")
    out: list[tuple[str, int]] = []
    for k in (0, 1):
        picked = texts.filter(F.col("label") == k).orderBy(*order, F.xxhash64("text")).limit(rows)
        out += [(r.text, k) for r in picked.select("text").collect()]
    return out
