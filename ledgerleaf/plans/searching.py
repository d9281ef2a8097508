"""Similarity search and the search job over the driver's tables."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerleaf.operators import chunk, embed, models, search, similarity, views
from ledgerleaf.plans.adapters import Tables, ts_text, with_tables
from ledgerleaf.plans.catalog import query
from ledgerleaf.plans.texts import sql_chunks, sql_vectors
from ledgerleaf.session import materialise, spread

CLIENT = "CLIENT_1"
# A fixed query vector of the embeddings' width.
QUERY_VECTOR = [round(math.sin(i + 1), 6) for i in range(64)]
WIDTH = len(QUERY_VECTOR)

_AVAILABLE = "file_id IN (SELECT file_id FROM docs WHERE processing_status = 'AVAILABLE')"


@query(
    "vector_topk",
    with_tables("docs", "chunks")
    + f"""SELECT file_id, chunk_index, chunk_text, round(s, 6) AS score
FROM (SELECT *, round(list_cosine_similarity(embedding, {QUERY_VECTOR}::DOUBLE[]), 12) AS s FROM chunks)
WHERE client_account_id = '{CLIENT}' AND {_AVAILABLE}
ORDER BY s DESC, file_id, chunk_index LIMIT 5""",
)
def vector_topk(t: Tables) -> DataFrame:
    top = similarity.tenant_top_k(t.chunks, t.registry, CLIENT, QUERY_VECTOR)
    return top.select("file_id", "chunk_index", "chunk_text", "score")


_BATCH_SQL = (
    with_tables(
        "docs",
        "chunks",
        also=f"""pairs AS (
  SELECT q.vec_id AS query_id, c.client_account_id, c.file_id, c.chunk_index,
    round(list_cosine_similarity(q.embedding, c.embedding), 12) AS score
  FROM chunks q JOIN chunks c ON q.client_account_id = c.client_account_id WHERE c.{_AVAILABLE}),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, file_id, chunk_index) AS rank FROM pairs)""",
    )
    + "SELECT * REPLACE (round(score, 6) AS score) FROM ranked WHERE rank <= 5"
)


def _every_vector(t: Tables) -> DataFrame:
    return t.raw("embeddings").select(
        F.col("vec_id").alias("query_id"),
        F.concat(F.lit("CLIENT_"), (F.col("label") % 3).cast("string")).alias("client_account_id"),
        F.col("embedding").alias("query_embedding"),
    )


@query("vector_topk_batch", _BATCH_SQL)
def vector_topk_batch(t: Tables) -> DataFrame:
    """Every vector asks its own tenant's available chunks."""
    return similarity.available_top_k(spread(t.chunks, "file_id"), t.registry, _every_vector(t), WIDTH)


@query("vector_topk_blocks", _BATCH_SQL)
def vector_topk_blocks(t: Tables) -> DataFrame:
    """The same question by blocks, as for more queries than a task should hold."""
    small = {"queries_to_broadcast": 0, "chunks_per_block": 500, "queries_per_block": 100}
    return similarity.available_top_k(t.chunks, t.registry, _every_vector(t), WIDTH, **small)


EMBED_WIDTH = 256

_SEARCH = f"""{with_tables("docs", "classifications")},
corpus AS (SELECT file_id, client, text FROM docs),
{sql_chunks("corpus", "file_id, client", "text")},
chunk_rows AS (
  SELECT file_id, client, i - 1 AS chunk_index, chunks[i] AS chunk_text
  FROM (SELECT file_id, client, chunks, unnest(range(1, len(chunks) + 1)) AS i FROM chunk_lists)),
asked AS (SELECT item_id, 'CLIENT_' || item_id % 4 AS client, text AS query FROM benchmark),
chunk_vectors AS ({sql_vectors("chunk_rows", "file_id, chunk_index, client", "chunk_text", EMBED_WIDTH)}),
query_vectors AS ({sql_vectors("asked", "item_id, client", "query", EMBED_WIDTH)}),
chunk_lengths AS (SELECT file_id, chunk_index, sqrt(sum(v::DOUBLE * v::DOUBLE)) AS len FROM chunk_vectors GROUP BY ALL),
query_lengths AS (SELECT item_id, sqrt(sum(v::DOUBLE * v::DOUBLE)) AS len FROM query_vectors GROUP BY ALL),
products AS (
  SELECT item_id, client, file_id, chunk_index, sum(q.v::DOUBLE * c.v::DOUBLE) AS product
  FROM query_vectors q JOIN chunk_vectors c USING (client, bucket)
  WHERE {_AVAILABLE} GROUP BY ALL),
scored AS (
  SELECT item_id, client, file_id, chunk_index, round(product / (ql.len * cl.len), 12) AS score
  FROM products JOIN query_lengths ql USING (item_id) JOIN chunk_lengths cl USING (file_id, chunk_index)),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, file_id, chunk_index) AS rank FROM scored),
words AS (
  SELECT item_id, client, query, list_distinct(regexp_extract_all(lower(query), '[\\p{{L}}\\p{{N}}]+')) AS w FROM asked),
candidates AS (
  SELECT r.item_id, r.rank, r.file_id, r.score, len(list_intersect(w.w,
    list_distinct(regexp_extract_all(lower(c.chunk_text), '[\\p{{L}}\\p{{N}}]+')))) AS shared, len(w.w) AS n
  FROM ranked r JOIN chunk_rows c USING (file_id, chunk_index) JOIN words w USING (item_id) WHERE rank <= 5),
chosen AS (
  SELECT item_id, arg_max(file_id, shared * 10 - rank) AS file_id, max(shared) AS shared, any_value(n) AS n,
    count(*) AS result_count,
    list(CAST(round(CAST(round(score, 6) AS DECIMAL(10,6)), 4) AS DOUBLE) ORDER BY rank) AS top_scores
  FROM candidates GROUP BY item_id)
"""


def _corpus(t: Tables) -> DataFrame:
    rows = chunk.chunk(t.heavy_docs.select("file_id", F.col("client").alias("client_account_id"), F.col("text").alias("extracted_text")))
    model = models.hashing_embedder(EMBED_WIDTH)
    embedded = embed.embed(rows, "chunk_text", model).withColumn("model_name", F.lit(model.name))
    return materialise(embedded, "search-corpus")


def _asked(t: Tables) -> DataFrame:
    """One query per benchmark passage; a fourth of them come from a client that owns nothing."""
    i = F.col("item_id")
    return t.raw("benchmark").select(
        i.alias("query_id"),
        F.col("text").alias("query"),
        F.concat(F.lit("CLIENT_"), (i % 4).cast("string")).alias("client_account_id"),
    )


def _results(t: Tables) -> DataFrame:
    model = models.hashing_embedder(EMBED_WIDTH)
    return search.client_search(_asked(t), _corpus(t), t.registry, t.classifications, model)


@query(
    "client_search",
    _SEARCH
    + f"""SELECT a.item_id AS query_id, CASE WHEN ch.item_id IS NULL THEN '{search.NO_DOCUMENTS}' END AS error, ch.file_id,
  d.file_name, d.file_format, a.client AS client_account_id,
  CASE WHEN ch.item_id IS NULL THEN NULL WHEN shared * 2 >= ch.n THEN 'high' WHEN shared > 0 THEN 'medium' ELSE 'low' END
    AS confidence,
  'shares ' || shared || ' query words' AS reason, cl.doc_summary AS summary,
  CASE WHEN ch.file_id IS NOT NULL THEN 'validated/' || d.account_id || '/' || d.file_name END AS stage_path,
  coalesce(result_count, 0) AS result_count
FROM asked a LEFT JOIN chosen ch USING (item_id) LEFT JOIN docs d ON ch.file_id = d.file_id
LEFT JOIN classifications cl ON ch.file_id = cl.file_id""",
)
def client_search(t: Tables) -> DataFrame:
    return _results(t).drop("query", "document_type", "top_scores", "execution_ms")


@query(
    "search_audit_rows",
    _SEARCH
    + """SELECT a.client AS client_account_id, a.query AS search_term, ch.file_id AS result_file_id,
  CASE WHEN shared * 2 >= n THEN 'high' WHEN shared > 0 THEN 'medium' ELSE 'low' END AS search_confidence, result_count
FROM asked a JOIN chosen ch USING (item_id)""",
)
def search_audit_rows(t: Tables) -> DataFrame:
    rows = search.audit_rows(_results(t), "2024-02-01")
    return rows.drop("execution_time_ms", "search_ts")


@query(
    "search_result_json",
    _SEARCH
    + f"""SELECT a.item_id AS query_id, CASE WHEN ch.item_id IS NULL
    THEN to_json({{'error': '{search.NO_DOCUMENTS}', 'file_id': NULL, 'query': a.query}})::VARCHAR
  ELSE to_json({{'file_id': ch.file_id, 'file_name': d.file_name, 'file_format': d.file_format, 'document_type': NULL,
    'client_account_id': a.client, 'confidence': CASE WHEN shared * 2 >= ch.n THEN 'high' WHEN shared > 0 THEN 'medium'
    ELSE 'low' END, 'reason': 'shares ' || shared || ' query words', 'summary': cl.doc_summary,
    'stage_path': 'validated/' || d.account_id || '/' || d.file_name, 'result_count': result_count,
    'top_scores': top_scores, 'execution_ms': NULL}})::VARCHAR END AS result
FROM asked a LEFT JOIN chosen ch USING (item_id) LEFT JOIN docs d ON ch.file_id = d.file_id
LEFT JOIN classifications cl ON ch.file_id = cl.file_id""",
)
def search_result_json(t: Tables) -> DataFrame:
    return search.result_json(_results(t))


@query(
    "my_documents",
    with_tables("registry", "mapping")
    + f"""SELECT file_id, file_name, file_format, document_type, processing_status, file_size,
  {ts_text("created_ts")} AS created_ts, {ts_text("updated_ts")} AS updated_ts
FROM registry r WHERE processing_status IN ('AVAILABLE', 'ARCHIVED') AND EXISTS (SELECT 1 FROM mapping m
  WHERE m.account_id = r.account_id AND m.branch_id = r.branch_id AND m.client_account_id = '{CLIENT}' AND m.active_flag)""",
)
def my_documents(t: Tables) -> DataFrame:
    return views.my_documents(t.registry, t.mapping, CLIENT)


@query(
    "my_classifications",
    with_tables("registry", "mapping", "classifications")
    + f"""SELECT file_id, file_name, c.document_type, classification_confidence, doc_summary, key_indicators,
  {ts_text("classified_ts")} AS classified_ts
FROM registry r JOIN classifications c USING (file_id)
WHERE processing_status IN ('AVAILABLE', 'ARCHIVED') AND EXISTS (SELECT 1 FROM mapping m
  WHERE m.account_id = r.account_id AND m.branch_id = r.branch_id AND m.client_account_id = '{CLIENT}' AND m.active_flag)""",
)
def my_classifications(t: Tables) -> DataFrame:
    return views.my_document_classifications(t.registry, t.classifications, t.mapping, CLIENT)


@query(
    "my_search_history",
    with_tables("searches")
    + f"""SELECT search_term, result_file_id, search_confidence, result_count, execution_time_ms,
  {ts_text("search_ts")} AS search_ts FROM searches WHERE client_account_id = '{CLIENT}'""",
)
def my_search_history(t: Tables) -> DataFrame:
    return views.my_search_history(t.searches, CLIENT)


@query(
    "my_chunks",
    with_tables("docs", "mapping", "chunks")
    + f"""SELECT file_id, chunk_index, chunk_text, token_count, {ts_text("created_ts")} AS created_ts FROM chunks c
WHERE client_account_id = '{CLIENT}' AND EXISTS (SELECT 1 FROM mapping m WHERE m.client_account_id = c.client_account_id
  AND m.active_flag)""",
)
def my_chunks(t: Tables) -> DataFrame:
    return views.my_document_chunks(t.chunks, t.mapping, CLIENT)
