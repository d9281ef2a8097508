"""Exact tenant-scoped similarity search.

Only chunks of AVAILABLE documents are scored: the ids of those documents, a narrow column whose bytes are counted, are
broadcast into the scan while they are small and joined by shuffle beyond that. So every search reads the vectors once.

One query vector: a scored scan with Spark's own top-k. A few thousand queries: the queries, counted first, travel to
the chunks; every task scans its share, keeps the best rows per query and hands on those alone, so vectors are never
shuffled. More queries than that: the chunks of a tenant are cut into blocks of bounded size, and the queries are copied
to the blocks; only a tenant with more than ``QUERIES_PER_BLOCK`` queries has its vectors copied, once per that many. A
tenant with a third of all chunks just has more tasks or more blocks. Work is one matrix product per block and a few
hundred queries, and pairs are never materialised.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerleaf.operators import sizing

TOP_K = 5
#: Places of a score as it is shown. Ranks go by the score itself, but for the noise of its last digits: equal texts tie.
SCORE_PLACES = 6
RANK_PLACES = 12
CHUNK_KEYS = ("file_id", "chunk_index")

CHUNKS_PER_BLOCK = 20_000
QUERIES_PER_BLOCK = 8192
QUERIES_TO_BROADCAST = 2048
# Queries of one matrix product, which bounds its memory.
QUERIES_AT_ONCE = 256
# Vectors that are scaled at a time, in place.
ROWS_AT_ONCE = 1024


def score(embedding: Column, vector: Sequence[float]) -> Column:
    """Cosine similarity with a fixed vector, to the places that decide ranks.

    Null for null and zero vectors and for vectors of another width. One matrix product per Arrow batch: at 1024
    numbers per vector about ten times faster than higher-order functions, which box every number.
    """
    unit = np.asarray(vector, dtype=np.float64)
    length = np.linalg.norm(unit)
    unit = unit / length if length else unit

    @F.arrow_udf("double")
    def cosine(vectors: pa.Array) -> pa.Array:
        usable = pc.fill_null(pc.equal(pc.list_value_length(vectors), len(unit)), False)
        rows = vectors.filter(usable).flatten().to_numpy(zero_copy_only=False).reshape(-1, len(unit)).astype(np.float64)
        lengths = np.sqrt(np.einsum("ij,ij->i", rows, rows))
        out = np.full(len(vectors), np.nan)
        out[usable.to_numpy(zero_copy_only=False)] = np.divide(
            rows @ unit, lengths, out=np.full_like(lengths, np.nan), where=lengths > 0
        )
        return pa.array(out, mask=np.isnan(out))

    return F.round(cosine(embedding), RANK_PLACES)


def fitting(embedding: Column, width: int) -> Column:
    """The vector, null for none; another width means another model and is refused."""
    refused = F.raise_error(F.lit(f"chunk vector is not {width} wide"))
    return F.when(embedding.isNull() | (F.size(embedding) == width), embedding).otherwise(refused)


def top_k(
    chunks: DataFrame, vector: Sequence[float], k: int = TOP_K, keys: Sequence[str] = CHUNK_KEYS
) -> DataFrame:
    """The k best rows for one vector; equal scores are ordered by key. Other columns of ``chunks`` are kept.

    Rows without a score sort last and are dropped behind the limit: a test before it would score every row twice.
    """
    scored = chunks.withColumn("score", score(fitting(F.col("embedding"), len(vector)), vector)).drop("embedding")
    best = scored.orderBy(F.desc_nulls_last("score"), *keys).limit(k).where(F.col("score").isNotNull())
    return best.withColumn("score", F.round("score", SCORE_PLACES))


def available_chunks(chunks: DataFrame, registry: DataFrame) -> DataFrame:
    """Chunks of AVAILABLE documents. The ids travel to the vectors while their bytes are few."""
    available = registry.where(F.col("processing_status") == "AVAILABLE").select("file_id")
    return chunks.join(sizing.broadcast_if_small(available), "file_id", "left_semi")


def colocated_chunks(chunks: DataFrame, registry: DataFrame, buckets: int) -> DataFrame:
    """Chunks of AVAILABLE documents from a table that ``sinks.save_bucketed_chunks`` made with ``buckets``.

    For more ids than can be broadcast: the ids are dealt like the table and meet its vectors where they lie, so only ids
    go through a shuffle.
    """
    available = registry.where(F.col("processing_status") == "AVAILABLE").select("file_id")
    return chunks.join(available.repartition(buckets, "file_id").hint("merge"), "file_id", "left_semi")


def tenant_top_k(
    chunks: DataFrame, registry: DataFrame, client: str, vector: Sequence[float], k: int = TOP_K
) -> DataFrame:
    """Top-k of one tenant's available chunks; on a table partitioned by client only that partition is read."""
    mine = chunks.where(F.col("client_account_id") == client)
    return top_k(available_chunks(mine, registry), vector, k)


def available_top_k(
    chunks: DataFrame, registry: DataFrame, queries: DataFrame, width: int, k: int = TOP_K, **blocks: int
) -> DataFrame:
    """(query_id, client_account_id, file_id, chunk_index, score, rank): k best available chunks per query."""
    best = batch_top_k(available_chunks(chunks, registry), queries, width, k, **blocks)
    return best.select("query_id", "client_account_id", *CHUNK_KEYS, "score", "rank")


def _blocks(df: DataFrame, tenant: str, size: int, name: str) -> DataFrame:
    return df.groupBy(tenant).agg(F.ceil(F.count(F.lit(1)) / F.lit(size)).alias(name))


def _unit_rows(table: pa.Table, column: str) -> np.ndarray:
    flat = table.column(column).combine_chunks().flatten().to_numpy(zero_copy_only=False)
    rows = flat.reshape(table.num_rows, -1).astype(np.float64)
    for start in range(0, len(rows), ROWS_AT_ONCE):
        some = rows[start : start + ROWS_AT_ONCE]
        lengths = np.sqrt((some * some).sum(axis=1, keepdims=True))
        np.divide(some, lengths, out=some, where=lengths > 0)
        some[~(lengths[:, 0] > 0)] = np.nan
    return rows


def _best_per_query(corpus: pa.Table, asked: pa.Table, query_id: str, keep: Sequence[str], keys: Sequence[str], k: int) -> pa.Table:
    """The k best corpus rows for every query, a bounded number of queries at a time."""
    corpus = corpus.sort_by([(c, "ascending") for c in keys])
    starts = range(0, max(1, asked.num_rows), QUERIES_AT_ONCE)
    return pa.concat_tables([_best_of_some(corpus, asked.slice(s, QUERIES_AT_ONCE), query_id, keep, k) for s in starts])


def _best_of_some(corpus: pa.Table, asked: pa.Table, query_id: str, keep: Sequence[str], k: int) -> pa.Table:
    """One matrix product, then a cut per query. The corpus is in key order."""
    fields = [asked.schema.field(query_id), *[corpus.schema.field(c) for c in keep]]
    schema = pa.schema([*fields, pa.field("score", pa.float64())])
    if corpus.num_rows == 0 or asked.num_rows == 0:
        return schema.empty_table()
    scores = _unit_rows(asked, "query_embedding") @ _unit_rows(corpus, "embedding").T
    # in place: there is one matrix of scores at a time
    np.round(scores, RANK_PLACES, out=scores)
    scores[np.isnan(scores)] = -np.inf
    at = max(corpus.num_rows - k, 0)
    bars = [np.partition(row, at)[at] for row in scores]
    query_rows, chunk_rows = [], []
    for i, (row, bar) in enumerate(zip(scores, bars)):
        # Everything at or above the bar, in key order; a stable sort keeps that order among equals.
        near = np.flatnonzero((row >= bar) & (row > -np.inf))
        near = near[np.argsort(-row[near], kind="stable")][:k]
        query_rows.append(np.full(len(near), i))
        chunk_rows.append(near)
    qi, ci = np.concatenate(query_rows), np.concatenate(chunk_rows)
    picked = corpus.take(pa.array(ci))
    columns = [asked.column(query_id).take(pa.array(qi)), *[picked.column(c) for c in keep]]
    return pa.Table.from_arrays([*columns, pa.array(scores[qi, ci])], schema=schema)


def batch_top_k(
    chunks: DataFrame,
    queries: DataFrame,
    width: int,
    k: int = TOP_K,
    tenant: str = "client_account_id",
    query_id: str = "query_id",
    keys: Sequence[str] = CHUNK_KEYS,
    chunks_per_block: int = CHUNKS_PER_BLOCK,
    queries_per_block: int = QUERIES_PER_BLOCK,
    queries_to_broadcast: int = QUERIES_TO_BROADCAST,
) -> DataFrame:
    """(query_id, tenant, *keys, score, rank): the k best chunks per query within the query's tenant.

    ``queries`` holds (query_id, tenant, query_embedding). Chunks without a vector are left out; a vector of another
    width, which belongs to another model, is refused on either side, as a search that skips it would be incomplete.
    """
    keys = list(keys)
    keep = [tenant, *keys]
    usable = chunks.where(F.col("embedding").isNotNull()).select(*keep, fitting(F.col("embedding"), width).alias("embedding"))
    checked = queries.select(
        query_id,
        tenant,
        F.when(F.size("query_embedding") == width, F.col("query_embedding"))
        .otherwise(F.raise_error(F.lit(f"query vector is not {width} wide")))
        .alias("query_embedding"),
    )
    types = {f.name: f.dataType.simpleString() for f in [*chunks.schema.fields, *queries.schema.fields]}
    out_schema = ", ".join(f"`{c}` {types[c]}" for c in [query_id, *keep]) + ", score double"

    if sizing.is_small(queries, queries_to_broadcast):
        partial = _scan(usable, checked, k, tenant, query_id, keys, chunks_per_block, out_schema)
    else:
        grid = _blocks(chunks, tenant, chunks_per_block, "__c").join(
            _blocks(queries, tenant, queries_per_block, "__q"), tenant
        )
        grid = sizing.broadcast_if_small(grid)  # a row per tenant
        left = usable.join(grid, tenant).select(
            *keep,
            "embedding",
            F.pmod(F.xxhash64(*keys), "__c").alias("cblock"),
            F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("__q") - 1)).alias("qblock"),
        )
        right = checked.join(grid, tenant).select(
            tenant,
            query_id,
            "query_embedding",
            F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("__c") - 1)).alias("cblock"),
            F.pmod(F.xxhash64(query_id), "__q").alias("qblock"),
        )

        def best_of_block(corpus: pa.Table, asked: pa.Table) -> pa.Table:
            return _best_per_query(corpus, asked, query_id, keep, keys, k)

        group = [tenant, "cblock", "qblock"]
        partial = left.groupBy(*group).cogroup(right.groupBy(*group)).applyInArrow(best_of_block, out_schema)
    order = Window.partitionBy(query_id).orderBy(F.desc("score"), *keys)
    ranked = partial.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.withColumn("score", F.round("score", SCORE_PLACES))


def _scan(
    usable: DataFrame,
    queries: DataFrame,
    k: int,
    tenant: str,
    query_id: str,
    keys: list[str],
    rows_at_once: int,
    out_schema: str,
) -> DataFrame:
    """Scans the chunks once with a bounded set of queries in every task; each task keeps k rows per query."""
    asked = queries.toArrow()
    tenants = asked.column(tenant).unique().to_pylist()
    by_tenant = {t: asked.filter(pc.equal(asked.column(tenant), t)) for t in tenants}
    keep = [tenant, *keys]

    def best_so_far(best: pa.Table | None, held: list[pa.RecordBatch]) -> pa.Table:
        corpus = pa.Table.from_batches(held)
        found = [
            _best_per_query(corpus.filter(pc.equal(corpus.column(tenant), t)), some, query_id, keep, keys, k)
            for t, some in by_tenant.items()
        ]
        merged = pa.concat_tables(found if best is None else [best, *found]).to_pandas()
        merged = merged.sort_values(["score", *keys], ascending=[False, *[True] * len(keys)], kind="stable")
        return pa.Table.from_pandas(merged.groupby(query_id, sort=False).head(k), found[0].schema, preserve_index=False)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best, held, rows = None, [], 0
        for batch in batches:
            held.append(batch)
            rows += batch.num_rows
            if rows >= rows_at_once:
                best, held, rows = best_so_far(best, held), [], 0
        if rows:
            best = best_so_far(best, held)
        if best is not None:
            yield from best.to_batches()

    return usable.where(F.col(tenant).isin(tenants)).mapInArrow(run, out_schema)
