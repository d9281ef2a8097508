"""Search: embed the queries, retrieve inside the tenant, re-rank, look up the winner, report."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerleaf.functions import lookups
from ledgerleaf.functions import text as tx
from ledgerleaf.functions.times import ts_literal
from ledgerleaf.measured import Pass, timed
from ledgerleaf.operators import embed, models, similarity
from ledgerleaf.session import materialise

# Of a candidate's text, for the prompt of a language model; rules see all of it.
EXCERPT_CHARS = 800

# Messages that callers match on (fixed values).
NO_DOCUMENTS = "No documents found for this account."
PARSE_FAILED = "LLM rerank parse failed — returning top vector result."
UNAVAILABLE = "LLM rerank unavailable (%s); returning top vector result."

# Keys of one result document (fixed values).
RESULT_KEYS = (
    "file_id", "file_name", "file_format", "document_type", "client_account_id", "confidence", "reason", "summary",
    "stage_path", "result_count", "top_scores", "execution_ms",
)


def rerank_prompt(query: Column, candidates: Column) -> Column:
    """Numbered candidates with their file id and the first 800 characters of text."""
    listed = F.array_join(
        F.transform(
            candidates,
            lambda c, i: F.format_string("[Candidate %d] FILE_ID=%s\n%s", i + 1, c["file_id"].cast("string"), c["excerpt"]),
        ),
        "\n\n",
    )
    ask = (
        'Which single candidate answers this query best? Answer with one JSON object and nothing else: '
        '{"best_candidate_index": number from 1, "confidence": "high", "medium" or "low", "reason": one sentence}'
    )
    return F.concat(F.lit('Query: "'), query, F.lit('"\n\n'), listed, F.lit(f"\n\n{ask}"))


RERANK_FIELDS = ("best_candidate_index", "confidence", "reason")


def with_parsed_rerank(df: DataFrame, reply: str, count: str) -> DataFrame:
    """Adds choice (0-based), confidence, reason and fallback from a re-rank reply; ``count`` is the list length.

    The choice is clamped; a missing one means the first candidate. Whole-number text and fractions (cut off) are
    accepted. Anything else, and replies that are no JSON object, fall back to candidate 0 with confidence low. The
    reply is parsed once: every later step only looks at columns of the one before.
    """
    body = df.withColumn("__body", F.try_parse_json(tx.strip_fences(F.col(reply), ignore_case=False)))
    picked = body.withColumns({f"__{n}": F.try_variant_get("__body", f"$.{n}", "variant") for n in RERANK_FIELDS})
    typed = picked.withColumns(
        {
            "__shape": F.schema_of_variant("__body"),
            **{f"__{n}_kind": F.schema_of_variant(f"__{n}") for n in RERANK_FIELDS},
            **{f"__{n}_text": F.try_variant_get(f"__{n}", "$", "string") for n in RERANK_FIELDS},
        }
    )
    kind, raw = F.col("__best_candidate_index_kind"), F.col("__best_candidate_index_text")
    number = (
        F.when(kind.isNull(), F.lit(1.0))
        .when((kind == "STRING") & F.rlike(raw, F.lit(r"^\s*[+-]?\d+\s*$")), F.trim(raw).try_cast("double"))
        .when(kind == "BOOLEAN", (raw == "true").cast("double"))
        .when(kind.isin("BIGINT", "DOUBLE") | F.startswith(kind, F.lit("DECIMAL")), raw.try_cast("double"))
    )
    numbered = typed.withColumn(
        "__number", F.when(F.startswith("__shape", F.lit("OBJECT")), number)
    ).withColumn("fallback", F.col("__number").isNull())
    fallback, n = F.col("fallback"), F.col("__number")
    whole = F.when(n < 0, F.ceil(n)).otherwise(F.floor(n)).cast("double")
    reason = (
        F.when(F.col("__reason_kind").isNull(), F.lit(""))
        .when(F.col("__reason_kind") == "VOID", F.lit("None"))
        .otherwise(F.col("__reason_text"))
    )
    return numbered.withColumns(
        {
            "choice": F.when(fallback, F.lit(0)).otherwise(lookups.clamp_index(whole, F.col(count).cast("double"))),
            "confidence": F.when(fallback, F.lit("low"))
            .when(F.col("__confidence_kind").isNull(), F.lit("medium"))
            .otherwise(F.col("__confidence_text")),
            "reason": F.when(fallback, F.lit(PARSE_FAILED)).otherwise(reason),
        }
    ).select(*df.columns, "choice", "confidence", "reason", "fallback")


def candidate_lists(top: DataFrame, chunks: DataFrame, query_id: str = "query_id") -> DataFrame:
    """(query_id, candidates): at most k structs per query in rank order, with excerpts for a prompt and whole texts.

    Text is fetched for the winners only; it takes no part in the similarity search.
    """
    excerpts = chunks.select(
        "client_account_id",
        "file_id",
        "chunk_index",
        tx.truncate(F.col("chunk_text"), EXCERPT_CHARS).alias("excerpt"),
        F.col("chunk_text").alias("text"),
    )
    found = top.join(excerpts, ["client_account_id", "file_id", "chunk_index"])
    listed = F.sort_array(F.collect_list(F.struct("rank", "file_id", "score", "excerpt", "text")))
    return found.groupBy(query_id).agg(listed.alias("candidates"))


def client_search(
    queries: DataFrame,
    chunks: DataFrame,
    registry: DataFrame,
    classifications: DataFrame,
    embedder: models.EmbeddingModel,
    reranker: models.CompletionModel | None = None,
    k: int = similarity.TOP_K,
    execution_ms: int | None = None,
) -> DataFrame:
    """One row per query with the twelve result columns, plus ``query_id``, ``query`` and ``error``.

    ``queries`` holds (query_id, query, client_account_id). A query without any candidate gets ``error`` and nulls.
    ``execution_ms`` is what the caller measured, if anything. The candidates and the choices, a few rows per query,
    are written to the shared folder as they become known: the chunk table is searched once, and the joins that fetch
    text and metadata see exact sizes and can leave the big tables where they are.
    """
    reranker = reranker or models.overlap_reranker()
    if "model_name" in chunks.columns:
        refused = F.raise_error(F.concat(F.lit(f"chunk vectors are not of model {embedder.name} but "), F.coalesce("model_name", F.lit("unknown"))))
        same = F.col("model_name").eqNullSafe(F.lit(embedder.name)) | F.col("embedding").isNull()
        chunks = chunks.withColumn("embedding", F.when(same, F.col("embedding")).otherwise(refused))
    asked = embed.embed(queries, "query", embedder, into="query_embedding")
    top = similarity.available_top_k(chunks, registry, asked, embedder.width, k)
    lists = candidate_lists(top, chunks)
    listed = queries.select("query_id", "query", "client_account_id").join(lists, "query_id", "left")

    has_any = F.col("candidates").isNotNull()
    listed = materialise(listed, "search-candidates")
    # a query without candidates has nothing to ask the model
    prompted = listed.where(has_any).withColumn("prompt", rerank_prompt(F.col("query"), F.col("candidates")))
    prompted = prompted.withColumn("__raw", reranker.complete(F.col("prompt"), F.struct("query", "candidates")))
    reply = models.as_reply(F.col("__raw"), prompted.schema["__raw"].dataType)
    replied = prompted.select(
        "query_id",
        "query",
        "client_account_id",
        "candidates",
        F.size("candidates").alias("n"),
        F.coalesce(reply["reply"], F.lit("")).alias("reply"),
        reply["error"].alias("model_error"),
    )
    nothing = {"n": F.lit(-1), "reply": F.lit(""), "model_error": F.lit(None).cast("string")}
    replied = replied.unionByName(listed.where(~has_any).withColumns(nothing))
    failed = F.col("model_error").isNotNull()
    choice = F.when(failed, F.lit(0)).otherwise(F.col("choice"))
    unavailable = F.format_string(UNAVAILABLE, "model_error")
    chosen = with_parsed_rerank(replied, "reply", "n").select(
        "query_id",
        "query",
        "client_account_id",
        "candidates",
        F.when(has_any, F.get("candidates", choice)["file_id"]).alias("file_id"),
        F.when(has_any, F.when(failed, F.lit("low")).otherwise(F.col("confidence"))).alias("confidence"),
        F.when(has_any, F.when(failed, unavailable).otherwise(F.col("reason"))).alias("reason"),
    )
    chosen = materialise(chosen, "search-choices")
    # The big tables are cut down to the winners before the outer joins, so those stay small.
    winners = chosen.select("file_id").where(F.col("file_id").isNotNull()).distinct()
    documents = registry.join(winners, "file_id").select(
        "file_id", "file_name", "file_format", "document_type", F.col("current_location").alias("stage_path")
    )
    summaries = classifications.join(winners, "file_id").select("file_id", F.col("doc_summary").alias("summary"))
    meta = documents.join(summaries, "file_id", "left")
    return chosen.join(meta, "file_id", "left").select(
        "query_id",
        "query",
        F.when(F.col("candidates").isNull(), F.lit(NO_DOCUMENTS)).alias("error"),
        "file_id",
        "file_name",
        "file_format",
        "document_type",
        "client_account_id",
        "confidence",
        "reason",
        "summary",
        "stage_path",
        F.coalesce(F.size("candidates"), F.lit(0)).cast("bigint").alias("result_count"),
        F.transform("candidates", lambda c: F.round(c["score"], 4)).alias("top_scores"),
        F.lit(execution_ms).cast("bigint").alias("execution_ms"),
    )


def measured_search(
    queries: DataFrame,
    chunks: DataFrame,
    registry: DataFrame,
    classifications: DataFrame,
    embedder: models.EmbeddingModel,
    reranker: models.CompletionModel | None = None,
    k: int = similarity.TOP_K,
) -> Pass:
    """``client_search`` run to its end: the stored results with ``execution_ms`` as measured, and what was counted.

    The time runs from the call until every result is stored. The queries of a batch are answered together, so each of
    them took what the batch took. The counters (queries, answered, unanswered, candidates) are observed while the results
    are written; nothing is read again for them.
    """
    found = timed(
        lambda: client_search(queries, chunks, registry, classifications, embedder, reranker, k),
        lambda results: materialise(results, "search-results"),
        {
            "queries": F.count(F.lit(1)),
            "answered": F.count_if(F.col("error").isNull()),
            "unanswered": F.count_if(F.col("error").isNotNull()),
            "candidates": F.coalesce(F.sum("result_count"), F.lit(0)),
        },
    )
    results = found.result.withColumn("execution_ms", F.lit(found.elapsed_ms).cast("bigint"))
    return Pass(results, found.elapsed_ms, found.metrics)


def result_json(results: DataFrame) -> DataFrame:
    """(query_id, result): one JSON document per query, or the short error form. Null keys are written out."""
    full = F.to_json(F.struct(*RESULT_KEYS), {"ignoreNullFields": "false"})
    short = F.to_json(F.struct("error", "file_id", "query"), {"ignoreNullFields": "false"})
    return results.select("query_id", F.when(F.col("error").isNull(), full).otherwise(short).alias("result"))


def audit_rows(results: DataFrame, as_of) -> DataFrame:
    """Search audit rows; a query that found nothing leaves none."""
    return results.where(F.col("error").isNull()).select(
        "client_account_id",
        F.col("query").alias("search_term"),
        F.col("file_id").alias("result_file_id"),
        F.col("confidence").alias("search_confidence"),
        "result_count",
        F.col("execution_ms").alias("execution_time_ms"),
        ts_literal(as_of).alias("search_ts"),
    )
