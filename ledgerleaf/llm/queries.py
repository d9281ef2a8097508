"""Registered queries of the operators: thin, over whole tables, with the SQL they must agree with where there is one."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerleaf.llm import (
    exact_dedup,
    graph_index,
    imatch,
    licenses,
    mixing,
    packing,
    page_text,
    periodic_runs,
    quality,
    simhash,
    token_alignment,
    token_files,
    toxicity,
)
from ledgerleaf.llm.common import WHITE_SPACE, table, text_of

Query = Callable[[SparkSession, str], DataFrame]


def op1_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.duplicates(table(spark, sf_dir, "documents"))


def op2_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder, manifest = token_files.write(table(spark, sf_dir, "documents"))
    return token_files.read_digests(spark, folder, manifest)


def op3_quality_network(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents")
    return quality.scored(documents, quality.train(documents, table(spark, sf_dir, "labels")))


def op4_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan(table(spark, sf_dir, "documents"))


def op5_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"))


def op6_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents"))


def op7_imatch_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return imatch.fingerprints(table(spark, sf_dir, "documents"))


def op8_site_style_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    return page_text.extract(table(spark, sf_dir, "pages"))


def op9_toxicity_distance(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents")
    return toxicity.scored(documents, toxicity.train(documents, table(spark, sf_dir, "labels")))


def op10_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mixture(table(spark, sf_dir, "documents"))


def op11_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_alignment.alignment(table(spark, sf_dir, "documents"))


def op12_graph_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return graph_index.neighbours(table(spark, sf_dir, "embeddings"), every=50)


def with_planted_run(documents: DataFrame) -> DataFrame:
    """(doc_id, text): the words of a tenth of the documents repeat from a place on, as the contract says."""
    spaced = F.trim(F.translate(text_of(F.col("text")), WHITE_SPACE, " " * len(WHITE_SPACE)))
    rows = documents.select("doc_id", "text", F.crc32(F.col("doc_id").cast("string").cast("binary")).alias("h"), spaced.alias("spaced"))

    def changed(words: Column) -> Column:
        n, g = F.size(words).cast("long"), F.floor(F.col("h") / 10)
        a = g % n
        p = 1 + F.floor((n - a) / (3 + g % 8))
        repeated = F.transform(F.sequence(a, n - 1), lambda i: F.get(words, (a + (i - a) % p).cast("int")))
        return F.array_join(F.concat(F.slice(words, F.lit(1), a.cast("int")), repeated), " ")

    # an array of one array, so that a text is split once and not once for each of its words
    changed_text = F.transform(F.array(F.split("spaced", " +")), changed)[0]
    return rows.select("doc_id", F.when((F.col("h") % 10 == 0) & (F.col("spaced") != ""), changed_text).otherwise(F.col("text")).alias("text"))


def op13_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = periodic_runs.periodic_runs(with_planted_run(table(spark, sf_dir, "documents")))
    lines = F.array_join(F.transform("runs", lambda r: F.format_string("%d,%d,%d\n", r["start"], r["length"], r["period"])), "")
    # by start, then period: only a greater exponent replaces the one before, compared without division
    greater = lambda best, r: best.isNull() | (r["length"] * best["period"] > best["length"] * r["period"])
    none = F.lit(None).cast("struct<start:long,length:long,period:long>")
    best = F.reduce("runs", none, lambda best, r: F.when(greater(best, r), r).otherwise(best))
    rows = found.select("doc_id", "runs", best.alias("best"), lines.alias("lines"), "collapsed")
    return rows.select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        "best.start",
        "best.length",
        "best.period",
        F.floor(1000 * F.col("best.length") / F.col("best.period")).alias("exponent_milli"),
        F.sha2("lines", 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )


QUERIES: dict[str, Query] = {
    f.__name__: f
    for f in (
        op1_exact_dedup,
        op2_token_files,
        op3_quality_network,
        op4_license_scan,
        op5_best_fit_packing,
        op6_simhash_near_dedup,
        op7_imatch_fingerprints,
        op8_site_style_tree,
        op9_toxicity_distance,
        op10_source_mixing,
        op11_token_alignment,
        op12_graph_neighbours,
        op13_periodic_runs,
    )
}

OP1_SQL = r"""
WITH d AS (
  SELECT doc_id, coalesce(text, '') AS t, rowid_ AS r FROM (SELECT *, row_number() OVER () AS rowid_ FROM documents)
), s AS (
  SELECT doc_id, r, length(t) AS n, sha256(regexp_replace(t, '[\x20\x09-\x0D]', '', 'g')) AS text_sha256 FROM d
), g AS (
  SELECT *, count(*) OVER (PARTITION BY text_sha256) AS group_size,
    first_value(doc_id) OVER w AS keep_id, first_value(r) OVER w AS keep_r
  FROM s WINDOW w AS (PARTITION BY text_sha256 ORDER BY n DESC, doc_id ASC NULLS LAST, r)
)
SELECT doc_id, keep_id, group_size, r = keep_r AS kept, text_sha256 FROM g
"""

OP10_SQL = r"""
WITH d AS (
  SELECT doc_id, source, CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS size,
    CAST('0x' || substr(md5('42|' || coalesce(CAST(doc_id AS VARCHAR), '') || '|' || coalesce(text, '')), 1, 4) AS INTEGER) AS bucket
  FROM documents
), s AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM d GROUP BY source
), w AS (
  SELECT *, [5, 2, 1][CAST((row_number() OVER (ORDER BY source ASC NULLS LAST) - 1) % 3 AS INTEGER) + 1] AS weight FROM s
), o AS (
  SELECT *, 3 * source_size AS cap, sum(source_size) OVER () AS total,
    coalesce(sum(3 * source_size) OVER below, 0) AS given, sum(weight) OVER onward AS open_weight
  FROM w WINDOW below AS (ORDER BY 3.0 * source_size / weight, source ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING),
    onward AS (ORDER BY 3.0 * source_size / weight, source ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)
), c AS (
  SELECT *, weight * (total - given) >= cap * open_weight AS clamped FROM o
), l AS (
  SELECT coalesce(sum(weight) FILTER (NOT clamped), 1) AS w, coalesce(sum(cap) FILTER (clamped), 0) AS given FROM c
), t AS (
  SELECT c.source, source_size,
    CASE WHEN clamped THEN CAST(cap AS DOUBLE) ELSE CAST(weight * (total - l.given) AS DOUBLE) / CAST(l.w AS DOUBLE) END AS target
  FROM c, l
), r AS (
  SELECT *, CAST(CASE WHEN source_size > 0 THEN floor(target / source_size) ELSE 0 END AS BIGINT) AS whole FROM t
), q AS (
  SELECT *, target - whole * source_size AS rest FROM r
), b AS (
  SELECT source, bucket, sum(sum(size)) OVER (PARTITION BY source ORDER BY bucket) AS ends FROM d GROUP BY source, bucket
), f AS (
  SELECT b.source, min(struct_pack(off := abs(ends - rest), bucket := bucket)).bucket AS last_bucket
  FROM b JOIN q ON b.source IS NOT DISTINCT FROM q.source WHERE abs(ends - rest) < rest GROUP BY b.source
)
SELECT d.doc_id, d.size, q.source_size, q.target,
  CAST(d.size * (q.whole + CASE WHEN d.bucket <= coalesce(f.last_bucket, -1) THEN 1 ELSE 0 END) AS BIGINT) AS taken
FROM d JOIN q ON d.source IS NOT DISTINCT FROM q.source LEFT JOIN f ON d.source IS NOT DISTINCT FROM f.source
"""

ORACLES: dict[str, str] = {"op1_exact_dedup": OP1_SQL, "op4_license_scan": licenses.duckdb_sql(), "op10_source_mixing": OP10_SQL}
