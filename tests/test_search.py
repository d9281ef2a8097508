import json
import tracemalloc

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from ledgerleaf import schemas, sinks
from ledgerleaf.operators import models, search, similarity, views

WIDTH = 8


@pytest.fixture(scope="module")
def corpus(spark):
    """400 chunks; one tenant owns most of them, some vectors are equal, null, zero or of another width."""
    rng = np.random.default_rng(7)
    rows = []
    for i in range(400):
        client = "hot" if i % 8 else f"cold{i % 3}"
        vector = [float(x) for x in rng.integers(-3, 4, WIDTH)]
        if i % 50 == 3:
            vector = None
        elif i % 50 == 4:
            vector = [0.0] * WIDTH
        rows.append((f"f{i % 90}", client, i // 90, f"text {i}", vector))
    chunks = spark.createDataFrame(
        rows, "file_id string, client_account_id string, chunk_index int, chunk_text string, embedding array<float>"
    )
    status = [(f"f{i}", "AVAILABLE" if i % 4 else "EMBEDDED") for i in range(90)]
    registry = spark.createDataFrame(status, "file_id string, processing_status string")
    return rows, chunks, registry


def brute_force(rows, client, query, k):
    query = np.asarray(query, dtype=float)
    scored = []
    for file_id, owner, index, _, vector in rows:
        if owner != client or vector is None or len(vector) != len(query) or int(file_id[1:]) % 4 == 0:
            continue
        v = np.asarray(vector, dtype=np.float32).astype(float)
        if not v.any():
            continue
        score = round(float(v @ query / np.linalg.norm(v) / np.linalg.norm(query)), 6)
        scored.append((-score, file_id, index))
    return [(f, i, -s) for s, f, i in sorted(scored)[:k]]


def test_single_query(spark, corpus):
    rows, chunks, registry = corpus
    query = [1.0, -2.0, 0.5, 3.0, 0.0, 1.0, 2.0, -1.0]
    for client in ("hot", "cold0", "nobody"):
        got = similarity.tenant_top_k(chunks, registry, client, query).collect()
        assert [(r.file_id, r.chunk_index, r.score) for r in got] == brute_force(rows, client, query, 5)


@pytest.mark.parametrize("chunk_block, query_block, scan", [(10_000, 1000, 0), (13, 4, 0), (10_000, 0, 100), (17, 0, 100)])
def test_batch_equals_brute_force(spark, corpus, chunk_block, query_block, scan):
    rows, chunks, registry = corpus
    rng = np.random.default_rng(11)
    asked = [(i, ("hot", "cold0", "cold1", "nobody")[i % 4], [float(x) for x in rng.integers(-2, 3, WIDTH)]) for i in range(24)]
    queries = spark.createDataFrame(asked, "query_id int, client_account_id string, query_embedding array<float>")
    top = similarity.available_top_k(
        chunks, registry, queries, WIDTH, 7,
        chunks_per_block=chunk_block, queries_per_block=query_block, queries_to_broadcast=scan,
    )
    got = {}
    for r in top.orderBy("query_id", "rank").collect():
        got.setdefault(r.query_id, []).append((r.file_id, r.chunk_index, r.score))
    want = {i: brute_force(rows, c, q, 7) for i, c, q in asked if any(q)}
    assert got == {i: w for i, w in want.items() if w}


def test_wrong_width_is_refused(spark, corpus):
    _, chunks, registry = corpus
    queries = spark.createDataFrame([(1, "hot", [1.0, 2.0])], "query_id int, client_account_id string, query_embedding array<float>")
    with pytest.raises(Exception, match="not 8 wide"):
        similarity.batch_top_k(chunks, queries, WIDTH).collect()
    odd = chunks.withColumn("embedding", F.when(F.col("chunk_index") == 1, F.array(F.lit(1.0).cast("float"))).otherwise(F.col("embedding")))
    with pytest.raises(Exception, match="chunk vector is not 8 wide"):
        similarity.tenant_top_k(odd, registry, "hot", [1.0] * WIDTH).collect()


def test_a_tenant_without_available_documents_is_scanned_once(spark, corpus):
    _, chunks, registry = corpus
    archived = registry.withColumn("processing_status", F.lit("ARCHIVED"))
    assert similarity.tenant_top_k(chunks, archived, "hot", [1.0] * WIDTH).count() == 0
    queries = spark.createDataFrame([(1, "hot", [1.0] * WIDTH)], "query_id int, client_account_id string, query_embedding array<float>")
    assert similarity.available_top_k(chunks, archived, queries, WIDTH).count() == 0


@pytest.mark.parametrize(
    "reply, want",
    [
        ('{"best_candidate_index": 2, "confidence": "high", "reason": "fits"}', (1, "high", "fits", False)),
        ('```json\n{"best_candidate_index": 1, "confidence": "high", "reason": "ok"}\n```', (0, "high", "ok", False)),
        ('{"best_candidate_index": 999, "confidence": "high"}', (4, "high", "", False)),
        ('{"best_candidate_index": 0}', (0, "medium", "", False)),
        ('{"best_candidate_index": " 3 "}', (2, "medium", "", False)),
        ('{"best_candidate_index": "2.7"}', (0, "low", search.PARSE_FAILED, True)),
        ('{"best_candidate_index": 2.7}', (1, "medium", "", False)),
        ('{"best_candidate_index": true, "reason": null}', (0, "medium", "None", False)),
        ('{"best_candidate_index": null}', (0, "low", search.PARSE_FAILED, True)),
        ('{"confidence": null, "reason": 5}', (0, None, "5", False)),
        ('{"reason": "%s"}' % ("r" * 1000), (0, "medium", "r" * 1000, False)),
        ("I think the first one.", (0, "low", search.PARSE_FAILED, True)),
        ("[2]", (0, "low", search.PARSE_FAILED, True)),
        ("", (0, "low", search.PARSE_FAILED, True)),
    ],
)
def test_rerank_replies(spark, reply, want):
    df = spark.createDataFrame([(reply, 5)], "reply string, n int")
    row = search.with_parsed_rerank(df, "reply", "n").first()
    assert (row.choice, row.confidence, row.reason, row.fallback) == want


TEXTS = {
    "1": ("C1", "custody billing invoice for the first quarter"),
    "2": ("C1", "portfolio valuation of all holdings"),
    "3": ("C2", "custody billing invoice for another client"),
    "4": ("C1", "custody billing invoice not yet available"),
}


def search_tables(spark, embedder):
    chunks = spark.createDataFrame([(f, c, 0, t) for f, (c, t) in TEXTS.items()], "file_id string, client_account_id string, chunk_index int, chunk_text string")
    chunks = chunks.withColumn("embedding", embedder.encode(F.col("chunk_text"))).withColumn("model_name", F.lit(embedder.name))
    registry = spark.createDataFrame(
        [(f, f"doc{f}.pdf", "PDF", "CUSTODY_BILLING_INVOICE", f"@S/doc{f}.pdf", "STAGED" if f == "4" else "AVAILABLE") for f in TEXTS],
        "file_id string, file_name string, file_format string, document_type string, current_location string, processing_status string",
    )
    classes = spark.createDataFrame([("1", "an invoice")], "file_id string, doc_summary string")
    queries = spark.createDataFrame(
        [(1, "the billing invoice", "C1"), (2, "invoice", "C2"), (3, "anything", "C3")], "query_id int, query string, client_account_id string"
    )
    return queries, chunks, registry, classes


def test_search_end_to_end(spark, tmp_path):
    embedder = models.hashing_embedder(64)
    results = search.client_search(*search_tables(spark, embedder), embedder, execution_ms=12)
    got = {r.query_id: r for r in results.collect()}
    assert set(search.RESULT_KEYS) <= set(results.columns)
    assert (got[1].file_id, got[1].file_name, got[1].summary, got[1].stage_path) == ("1", "doc1.pdf", "an invoice", "@S/doc1.pdf")
    assert got[1].result_count == 2 and got[1].top_scores == sorted(got[1].top_scores, reverse=True)
    assert got[1].confidence in ("high", "medium", "low")
    assert (got[2].file_id, got[2].client_account_id, got[2].summary) == ("3", "C2", None)
    assert (got[3].error, got[3].file_id, got[3].result_count) == (search.NO_DOCUMENTS, None, 0)
    documents = {r.query_id: json.loads(r.result) for r in search.result_json(results).collect()}
    assert set(documents[1]) == set(search.RESULT_KEYS) and documents[1]["execution_ms"] == 12
    assert documents[3] == {"error": search.NO_DOCUMENTS, "file_id": None, "query": "anything"}
    audit = search.audit_rows(results, "2024-01-01")
    assert {r.client_account_id for r in audit.collect()} == {"C1", "C2"}
    assert sinks.append_search_audit(audit, str(tmp_path / "audit"))
    assert spark.read.parquet(str(tmp_path / "audit")).count() == 2
    assert not sinks.append_search_audit(audit.withColumnRenamed("search_ts", "x"), str(tmp_path / "audit"))


def test_search_survives_its_model(spark):
    embedder = models.hashing_embedder(64)

    def down(prompt):
        assert "[Candidate 1] FILE_ID=" in prompt
        raise RuntimeError("no capacity")

    def second(prompt):
        return '{"best_candidate_index": 2, "confidence": "medium", "reason": "asked for it"}'

    for fn, want in ((down, ("low", search.UNAVAILABLE % "no capacity")), (second, ("medium", "asked for it"))):
        model = models.CompletionModel("m", models.guarded(fn))
        rows = search.client_search(*search_tables(spark, embedder), embedder, model).where("query_id = 1").collect()
        assert (rows[0].confidence, rows[0].reason) == want
        assert rows[0].file_id == ("1" if fn is down else "2")


def test_other_models_vectors_are_refused(spark):
    queries, chunks, registry, classes = search_tables(spark, models.hashing_embedder(64))
    with pytest.raises(Exception, match="not of model hashing-64 but older"):
        search.client_search(queries, chunks.withColumn("model_name", F.lit("older")), registry, classes, models.hashing_embedder(64)).collect()


def test_views_show_own_rows_once(spark):
    registry = spark.createDataFrame(
        [("1", "A1", "B1", "AVAILABLE"), ("2", "A2", "B1", "ARCHIVED"), ("3", "A1", "B2", "AVAILABLE"), ("4", "A1", "B1", "STAGED"), ("5", "A3", "B1", "AVAILABLE")],
        "file_id string, account_id string, branch_id string, processing_status string",
    ).withColumns({c: F.lit(None).cast("string") for c in ("file_name", "file_format", "document_type")})
    registry = registry.withColumns({"file_size": F.lit(1), "created_ts": F.lit("2024-01-01").cast("timestamp_ntz"), "updated_ts": F.lit("2024-01-01").cast("timestamp_ntz")})
    mapping = spark.createDataFrame(
        [("A1", "B1", "", "C1", "S", True), ("A2", "B1", "", "C1", "S", True), ("A1", "B2", "", "C1", "S", False), ("A3", "B1", "", "C2", "S", True)],
        schemas.CLIENT_MAPPING,
    )
    assert sorted(r.file_id for r in views.my_documents(registry, mapping, "C1").collect()) == ["1", "2"]
    chunks = spark.createDataFrame([("1", "C1", 0, "t", [1.0], 3), ("5", "C2", 0, "t", [1.0], 3)], "file_id string, client_account_id string, chunk_index int, chunk_text string, embedding array<float>, token_count int").withColumn("created_ts", F.lit("x"))
    mine = views.my_document_chunks(chunks, mapping, "C1")
    assert [r.file_id for r in mine.collect()] == ["1"] and "embedding" not in mine.columns
    classes = spark.createDataFrame([("1", "T", "high", "s", "[]", "x"), ("5", "T", "high", "s", "[]", "x")], "file_id string, document_type string, classification_confidence string, doc_summary string, key_indicators string, classified_ts string")
    assert [r.file_id for r in views.my_document_classifications(registry, classes, mapping, "C1").collect()] == ["1"]


def test_embedder_holds_few_texts_at_a_time(spark):
    """Of an Arrow batch of any size the model, and Python, see ``at_once`` texts at a time."""
    seen = spark.sparkContext.accumulator(0)

    def setup():
        def vectors(texts):
            seen.add(len(texts) > 3)
            return np.array([[len(t), 1.0] for t in texts])

        return vectors

    model = models.batched_embedder("lengths", 2, setup, at_once=3)
    df = spark.range(0, 10, numPartitions=1).select("id", F.when(F.col("id") != 4, F.repeat(F.lit("x"), F.col("id").cast("int"))).alias("t"))
    got = {r.id: list(r.e) for r in df.select("id", model.encode(F.col("t")).alias("e")).collect()}
    assert got == {i: [0.0 if i == 4 else float(i), 1.0] for i in range(10)} and seen.value == 0


def test_scaling_and_scoring_hold_one_copy():
    """Scaling many vectors makes the copy that it gives and no other of that size."""
    table = pa.table({"v": pa.FixedSizeListArray.from_arrays(pa.array(np.ones(40_000 * 64)), 64)})
    tracemalloc.start()
    similarity._unit_rows(table, "v")
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 1.5 * 40_000 * 64 * 8
