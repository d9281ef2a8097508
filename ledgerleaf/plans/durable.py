"""Jobs that measure themselves, repeat safely and resume: over the driver's tables, through their stored state."""

from __future__ import annotations

from collections.abc import Callable
from typing import TypeVar

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerleaf import schemas, sinks
from ledgerleaf.functions.times import utc_now
from ledgerleaf.measured import Pass
from ledgerleaf.operators import archive, classify, models, reports, search, similarity, validate, views
from ledgerleaf.plans import intake, lifecycle, searching, streams
from ledgerleaf.plans.adapters import Tables, ts_text, with_tables
from ledgerleaf.plans.catalog import ORACLES, query
from ledgerleaf.session import new_path
from ledgerleaf.streaming import pipeline
from ledgerleaf.streaming.archiving import ArchiveRuns

AS_OF = "2024-02-01 00:00:00"
Result = TypeVar("Result")


def _row(t: Tables, values: dict[str, object]) -> DataFrame:
    """Counters of a finished job as one row."""
    return t.spark.range(1).select(*[F.lit(v).cast("bigint").alias(n) for n, v in values.items()])


# -- searches that measure themselves ------------------------------------------------------------------------------------
def _once(make: Callable[[Tables], Result]) -> Callable[[Tables], Result]:
    """Several reports of one run: it is made once for a folder of tables, and what it stored is read by each."""
    made: dict[tuple[str, str], Result] = {}

    def get(t: Tables) -> Result:
        # the folder that what is stored lies in and goes with
        key = (new_path(t.spark, "run").rpartition("/")[0], t.sf_dir)
        if key not in made:
            made[key] = make(t)
        return made[key]

    return get


@_once
def _measured(t: Tables) -> Pass:
    return search.measured_search(searching._asked(t), searching._corpus(t), t.registry, t.classifications, models.hashing_embedder(searching.EMBED_WIDTH))


def _search_audit(t: Tables) -> DataFrame:
    """Audit rows of a measured search, delivered twice and read back."""
    path = new_path(t.spark, "search-audit")
    rows = search.audit_rows(_measured(t).result, "2024-02-01")
    for _ in range(2):
        sinks.append_search_audit(rows, path, batch=0)
    return sinks.BatchTable(t.spark, path, schemas.SEARCH_AUDIT).read()


@query(
    "search_run_audit",
    searching._SEARCH
    + """SELECT a.client AS client_account_id, a.query AS search_term, ch.file_id AS result_file_id,
  CASE WHEN shared * 2 >= n THEN 'high' WHEN shared > 0 THEN 'medium' ELSE 'low' END AS search_confidence, result_count,
  true AS measured
FROM asked a JOIN chosen ch USING (item_id)""",
)
def search_run_audit(t: Tables) -> DataFrame:
    """Audit rows carry the time the search took."""
    stored = _search_audit(t)
    return stored.select(
        "client_account_id", "search_term", "result_file_id", "search_confidence", "result_count", (F.col("execution_time_ms") > 0).alias("measured")
    )


@query(
    "search_run_latency",
    searching._SEARCH
    + """, found AS (SELECT CASE WHEN shared * 2 >= n THEN 'high' WHEN shared > 0 THEN 'medium' ELSE 'low' END AS c FROM chosen)
SELECT c AS search_confidence, count(*) AS total_searches, true AS measured FROM found GROUP BY c""",
)
def search_run_latency(t: Tables) -> DataFrame:
    """The latency report over what a search has recorded of itself."""
    found = reports.search_latency(_search_audit(t))
    return found.select("search_confidence", "total_searches", (F.col("avg_ms") > 0).alias("measured"))


@query(
    "search_run_counters",
    searching._SEARCH
    + """SELECT count(*) AS queries, count(ch.item_id) AS answered, count(*) - count(ch.item_id) AS unanswered,
  coalesce(sum(ch.result_count), 0)::BIGINT AS candidates
FROM asked a LEFT JOIN chosen ch USING (item_id)""",
)
def search_run_counters(t: Tables) -> DataFrame:
    """What was observed while the results were written."""
    return _row(t, _measured(t).metrics)


# -- batches that are delivered again -----------------------------------------------------------------------------------------
@query(
    "dispositions_redelivered",
    intake._CHECKED
    + """SELECT length(path) % 3 AS batch, CASE WHEN success THEN 'validated' ELSE 'quarantine' END AS disposition, reason,
  count(*) AS files
FROM validated GROUP BY ALL""",
)
def dispositions_redelivered(t: Tables) -> DataFrame:
    """Three batches: one delivered twice, one after a delivery that broke off before its commit."""
    path = new_path(t.spark, "dispositions")
    rows = validate.dispositions(intake._validated(t))
    batches = [rows.where(F.length("path") % 3 == k) for k in range(3)]
    sinks.write_dispositions(batches[0], path, batch=0)
    for _ in range(2):
        sinks.write_dispositions(batches[1], path, batch=1)
    table = sinks.BatchTable(t.spark, path, rows.schema, ("disposition", "reason"))
    table.attempt(batches[2].where("disposition = 'validated'"), 2)
    sinks.write_dispositions(batches[2], path, batch=2)
    table.clean()
    return table.read().groupBy("batch", "disposition", "reason").agg(F.count(F.lit(1)).alias("files"))


@query(
    "clients_redelivered",
    with_tables("docs", "chunks") + "SELECT client_account_id, file_id, chunk_index, chunk_text, chunk_index AS batch FROM chunks",
)
def clients_redelivered(t: Tables) -> DataFrame:
    """First and second chunks as two batches, each delivered twice."""
    path = new_path(t.spark, "by-client")
    rows = t.chunks.select("client_account_id", "file_id", "chunk_index", "chunk_text")
    for batch in (0, 1, 1, 0):
        sinks.write_by_client(rows.where(F.col("chunk_index") == batch), path, batch=batch)
    return sinks.BatchTable(t.spark, path, rows.schema).read()


@query("alerts_redelivered", ORACLES["archive_alerts"])
def alerts_redelivered(t: Tables) -> DataFrame:
    path = new_path(t.spark, "alerts")
    rows = archive.alerts(lifecycle._archived(t))
    for _ in range(2):
        sinks.write_alerts(rows, path, batch=7)
    return sinks.BatchTable(t.spark, path, rows.schema).read().drop("batch")


@query("audit_redelivered", ORACLES["archive_audit"])
def audit_redelivered(t: Tables) -> DataFrame:
    path = new_path(t.spark, "audit")
    rows = archive.audit(lifecycle._archived(t), AS_OF)
    for _ in range(2):
        sinks.append_audit(rows, path, batch=0)
    return sinks.BatchTable(t.spark, path, schemas.PROCESSING_AUDIT).read().drop("batch")


@query(
    "batch_replaced",
    with_tables("docs") + "SELECT file_id, file_name, 0 AS batch FROM docs WHERE doc_id % 2 = 0",
)
def batch_replaced(t: Tables) -> DataFrame:
    """A batch that is computed anew on purpose takes the place of the first one; what it held is cleared away."""
    rows = t.docs.select("file_id", "file_name")
    table = sinks.BatchTable(t.spark, new_path(t.spark, "replaced"), rows.schema)
    table.write(rows, 0)
    table.write(rows.where(F.col("file_id").cast("bigint") % 2 == 0), 0, replace=True)
    table.clean()
    return table.read()


@query(
    "validation_counted",
    intake._CHECKED + "SELECT count(*) AS processed, count(*) FILTER (success) AS successes, count(*) FILTER (NOT success) AS failures FROM validated",
)
def validation_counted(t: Tables) -> DataFrame:
    """Counters of a validation run, observed while its dispositions are written: the results are not read again."""
    rows = validate.dispositions(intake._validated(t))
    table = sinks.BatchTable(t.spark, new_path(t.spark, "counted"), rows.schema, ("disposition", "reason"))
    found = table.write(rows, 0, metrics=validate.run_metrics())
    return _row(t, {n: found[n] for n in ("processed", "successes", "failures")})


# -- the chain in several micro-batches ----------------------------------------------------------------------------------------
BATCHES = 2


def _files(t: Tables) -> DataFrame:
    i = F.col("doc_id")
    return t.docs.where(i % 5 != 0).select(
        F.concat_ws("/", F.lit("validated"), "account_id", "file_name").alias("relative_path"),
        F.octet_length("text").cast("bigint").alias("file_size"),
        F.col("created_ts").alias("last_modified"),
        F.col("updated_ts").alias("loaded_ts"),
        F.encode("text", "utf-8").alias("content"),
    )


@_once
def _chain(t: Tables) -> pipeline.Pipeline:
    """The chain over two deliveries of files, with a fold between them, then a start without news."""
    run = pipeline.Pipeline(
        t.spark, new_path(t.spark, "chain"), t.mapping, models.hashing_embedder(64), extractors={"TXT": bytes.decode}, clock=utc_now, fold_every=1
    )
    run.registry.write(t.registry, 0)
    landed, checkpoint = new_path(t.spark, "landed"), new_path(t.spark, "chain-checkpoint")
    rows = _files(t)
    delivery = F.pmod(F.hash("relative_path"), F.lit(BATCHES))
    for number in range(BATCHES + 1):
        # each delivery is as many files as its rows have partitions; the last is none
        if number < BATCHES:
            rows.where(delivery == number).write.mode("append").parquet(landed)
        stream = t.spark.readStream.schema(rows.schema).parquet(landed)
        pipeline.start(run, stream, checkpoint, lambda batch: AS_OF).awaitTermination()
    return run


@query("chain_batches", ORACLES["chain_stream"])
def chain_batches(t: Tables) -> DataFrame:
    """Registry after two micro-batches with a fold between them, and an empty start."""
    return _chain(t).registry.current().select("file_id", "processing_status", "client_account_id", "updated_ts")


@query(
    "chain_runs",
    streams._CHAIN
    + """, counted AS (
  SELECT count(*) FILTER (moves) AS routed, count(*) FILTER (NOT moves) AS skipped,
    count(*) FILTER (moves AND file_format NOT IN ('PDF', 'XLSX')) AS good,
    count(*) FILTER (moves AND file_format IN ('PDF', 'XLSX')) AS bad
  FROM routed)
SELECT unnest(['ROUTING_TASK', 'EXTRACT_TASK', 'EMBED_TASK', 'CLASSIFY_TASK']) AS name, 'SUCCEEDED' AS state,
  unnest([routed, good, good, good]) AS done, unnest([skipped, 0, 0, 0]) AS skipped, unnest([0, bad, 0, 0]) AS failed, true AS timed
FROM counted""",
)
def chain_runs(t: Tables) -> DataFrame:
    """Runs of the steps: counters as observed while the steps wrote, and times off the clock."""
    runs = reports.with_duration(_chain(t).runs.changes())
    value = F.from_json("return_value", "map<string,bigint>")
    count = lambda *names: F.sum(sum((F.coalesce(value[n], F.lit(0)) for n in names), F.lit(0))).cast("bigint")
    return runs.groupBy("name", "state").agg(
        count("routed", "extracted", "embedded", "classified").alias("done"),
        count("skipped").alias("skipped"),
        count("failed").alias("failed"),
        F.every((F.col("scheduled_time") < F.col("completed_time")) & (F.col("duration_secs") >= 0)).alias("timed"),
    )


@query(
    "chain_step_times",
    streams._CHAIN
    + """, moved AS (SELECT count(*) FILTER (moves) AS n, count(*) FILTER (moves AND file_format NOT IN ('PDF', 'XLSX')) AS good FROM routed)
SELECT unnest(['ROUTE', 'EXTRACT', 'EMBED', 'CLASSIFY']) AS step_name, unnest([n, n, good, good]) AS attempts, true AS timed FROM moved""",
)
def chain_step_times(t: Tables) -> DataFrame:
    """Audit rows of the chain under a clock: every step has a start and a later end."""
    run = _chain(t)
    trail = reports.audit_trail(run.audit.changes().drop("seq"), run.registry.current())
    return trail.groupBy("step_name").agg(
        F.count(F.lit(1)).alias("attempts"), F.every((F.col("start_ts") < F.col("end_ts")) & (F.col("duration_secs") >= 0)).alias("timed")
    )


@query(
    "chain_clients",
    with_tables("docs", "mapping", "chunks")
    + """SELECT c.file_id, chunk_index, CASE WHEN d.doc_id % 4 = 0 THEN 'NEW' ELSE c.client_account_id END AS client_account_id
FROM chunks c LEFT JOIN docs d ON c.file_id = d.file_id""",
)
def chain_clients(t: Tables) -> DataFrame:
    """Chunks that a document had before go along when it is routed to another client."""
    run = pipeline.Pipeline(t.spark, new_path(t.spark, "clients"), t.mapping, models.hashing_embedder(64))
    run.chunks.write(t.chunks.withColumn("model_name", F.lit("given")), pipeline.EMBED)
    run.embedded.write(t.chunks.select("file_id").distinct().withColumn("error", F.lit(None).cast("string")), pipeline.EMBED)
    moved = t.docs.where(F.col("doc_id") % 4 == 0).select(
        F.col("file_name").alias("relative_path"), "file_id", F.lit("NEW").alias("client_account_id"), F.lit("routed").alias("outcome")
    )
    run.routes.write(moved, pipeline.STEPS_PER_BATCH + pipeline.ROUTE)
    return run.current_chunks().select("file_id", "chunk_index", "client_account_id")


# -- archive runs that are interrupted --------------------------------------------------------------------------------------------
# Times of three runs; each finds what became due since the one before.
RUN_TIMES = ("2024-01-03 00:00:00", "2024-01-06 00:00:00", AS_OF)
RECOVERED_AT = "2024-02-02 00:00:00"

_DUE = ", ".join(f"created_ts < TIMESTAMP '{at}' - INTERVAL 730 DAY" for at in RUN_TIMES)
_ARCHIVE = with_tables(
    "registry",
    also=f"""due AS (
  SELECT *, 'archive/' || account_id || '/' || file_id || '/' || file_name AS new_location,
    CASE WHEN processing_status = 'AVAILABLE' THEN list_position([{_DUE}], true) END AS run, doc_id % 11 = 0 AS absent
  FROM registry)""",
)


@_once
def _archive_runs(t: Tables) -> ArchiveRuns:
    """The first run breaks off after marking, the second after storing; both are resumed. The third is abandoned once in
    either place, for documents of even and odd number, and cleared up. A file that is not there cannot be copied."""
    root = new_path(t.spark, "archive")
    log = sinks.ChangeLog(t.spark, f"{root}/registry", schemas.DOCUMENT_REGISTRY, ("file_id",))
    log.write(t.registry, 0)
    runs = ArchiveRuns(t.spark, root, log)
    stored = t.docs.where(F.col("doc_id") % 11 != 0).select(
        F.col("doc_id"), F.concat_ws("/", F.lit("validated"), "account_id", "file_name").alias("location"), F.encode("text", "utf-8").alias("content")
    )
    location = stored.drop("doc_id")
    runs.run(1, location, RUN_TIMES[0], until="mark")
    runs.run(1, location, RUN_TIMES[0])
    runs.run(2, location, RUN_TIMES[1], until="store")
    runs.run(2, location, RUN_TIMES[1])
    runs.run(2, location, RUN_TIMES[1])
    runs.run(3, stored.where("doc_id % 2 = 0").drop("doc_id"), RUN_TIMES[2], until="store")
    runs.recover(4, RECOVERED_AT)
    return runs


_SETTLED = """CASE WHEN run IS NULL THEN processing_status WHEN run < 3 AND absent THEN 'FAILED' WHEN run < 3 THEN 'ARCHIVED'
    WHEN absent OR doc_id % 2 = 1 THEN 'AVAILABLE' ELSE 'ARCHIVED' END"""


@query(
    "archive_phases",
    _ARCHIVE
    + f""", settled AS (SELECT *, {_SETTLED} AS after FROM due)
SELECT file_id, after AS processing_status, CASE WHEN run IS NOT NULL AND after = 'ARCHIVED' THEN new_location ELSE current_location END
    AS current_location,
  CASE WHEN run IS NULL THEN {ts_text("updated_ts")} ELSE ['{RUN_TIMES[0]}', '{RUN_TIMES[1]}', '{RECOVERED_AT}'][run] || '.000000' END AS updated_ts
FROM settled""",
)
def archive_phases(t: Tables) -> DataFrame:
    """One state, wherever the runs broke off."""
    return _archive_runs(t).registry.current().select("file_id", "processing_status", "current_location", "updated_ts")


@query(
    "archive_phases_audit",
    _ARCHIVE
    + f""", settled AS (SELECT *, {_SETTLED} AS after FROM due WHERE run IS NOT NULL),
rows AS (SELECT file_id, 'ARCHIVING' AS status, NULL AS error_message FROM settled
  UNION ALL SELECT file_id, CASE after WHEN 'AVAILABLE' THEN 'ROLLED_BACK' ELSE after END, CASE WHEN after = 'FAILED' THEN 'not copied' END FROM settled)
SELECT file_id, 'ARCHIVE' AS step_name, status, error_message FROM rows""",
)
def archive_phases_audit(t: Tables) -> DataFrame:
    return _archive_runs(t).audit.current().select("file_id", "step_name", "status", "error_message")


@query(
    "archive_phases_stored",
    _ARCHIVE
    + """SELECT account_id, file_id, new_location AS archive_path, file_size AS bytes, run AS batch
FROM due WHERE run IS NOT NULL AND NOT absent AND (run < 3 OR doc_id % 2 = 0)""",
)
def archive_phases_stored(t: Tables) -> DataFrame:
    rows = _archive_runs(t).stored.read()
    return rows.select("account_id", "file_id", "archive_path", F.octet_length("content").cast("bigint").alias("bytes"), "batch")


# -- models that are set up once ---------------------------------------------------------------------------------------------------
_UNIT = "\x1f"


def _keyword_setup() -> Callable[[list[str]], list[str]]:
    """The keyword rules as a function of many texts, ``file name, lower-case text``."""
    import json

    rules = [(name, description, keywords) for name, (description, keywords) in schemas.DOCUMENT_TYPES.items()]

    def answer(texts: list[str]) -> list[str]:
        out = []
        for text in texts:
            name, haystack = text.split(_UNIT, 1)
            best: tuple[list[str], str, str] = ([], "UNKNOWN", schemas.DOCUMENT_TYPES["UNKNOWN"][0])
            for kind, description, keywords in rules:
                hits = [k for k in keywords if k in haystack]
                if len(hits) > len(best[0]):
                    best = (hits, kind, description)
            hits, kind, description = best
            level = "high" if len(hits) >= 2 else "medium" if hits else "low"
            out.append(json.dumps({"document_type": kind, "confidence": level, "key_indicators": hits, "summary": f"{name}: {description}"}))
        return out

    return answer


@query("classify_batched", ORACLES["classify_rules"])
def classify_batched(t: Tables) -> DataFrame:
    """The classification job with a model that lives in the workers and answers batches."""
    given = lambda prompt, facts: F.concat_ws(_UNIT, facts["file_name"], facts["haystack"])
    model = models.CompletionModel("keyword-rules", models.batched(_keyword_setup, of=given))
    todo = t.heavy_docs.select("file_id", "file_name", F.col("text").alias("extracted_text"))
    return classify.classify(todo, model).drop("error")


def _overlap_setup() -> Callable[[list[str]], list[str]]:
    """The word-overlap rules as a function of many JSON texts of query and candidates."""
    import json
    import re

    words = re.compile(r"[^\W_]+").findall

    def answer(texts: list[str]) -> list[str]:
        out = []
        for facts in map(json.loads, texts):
            wanted = set(words(facts["query"].lower()))
            shared = [len(wanted.intersection(words(c["text"].lower()))) for c in facts["candidates"]]
            best = max(shared)
            level = "high" if best * 2 >= len(wanted) else "medium" if best else "low"
            out.append(json.dumps({"best_candidate_index": shared.index(best) + 1, "confidence": level, "reason": f"shares {best} query words"}))
        return out

    return answer


@query("rerank_batched", ORACLES["client_search"])
def rerank_batched(t: Tables) -> DataFrame:
    """The search with a re-ranking model that lives in the workers and answers batches."""
    reranker = models.CompletionModel("word-overlap", models.batched(_overlap_setup, of=lambda prompt, facts: F.to_json(facts)))
    model = models.hashing_embedder(searching.EMBED_WIDTH)
    found = search.client_search(searching._asked(t), searching._corpus(t), t.registry, t.classifications, model, reranker)
    return found.drop("query", "document_type", "top_scores", "execution_ms")


def _failing_setup() -> Callable[[list[str]], list[str]]:
    """A model that is down for queries of an odd number of characters."""
    import json

    answer = _overlap_setup()

    def sometimes(texts: list[str]) -> list[str]:
        if any(len(json.loads(t)["query"]) % 2 for t in texts):
            raise TimeoutError("no answer in time")
        return answer(texts)

    return sometimes


@query(
    "search_fallback",
    searching._SEARCH
    + f""", first AS (SELECT item_id, file_id FROM candidates WHERE rank = 1)
SELECT a.item_id AS query_id, CASE WHEN length(a.query) % 2 = 1 THEN f.file_id ELSE ch.file_id END AS file_id,
  CASE WHEN ch.item_id IS NULL THEN NULL WHEN length(a.query) % 2 = 1 THEN 'low' WHEN shared * 2 >= ch.n THEN 'high'
    WHEN shared > 0 THEN 'medium' ELSE 'low' END AS confidence,
  CASE WHEN ch.item_id IS NULL THEN NULL WHEN length(a.query) % 2 = 1 THEN '{search.UNAVAILABLE % "no answer in time"}'
    ELSE 'shares ' || shared || ' query words' END AS reason
FROM asked a LEFT JOIN chosen ch USING (item_id) LEFT JOIN first f USING (item_id)""",
)
def search_fallback(t: Tables) -> DataFrame:
    """Where the re-ranking model fails, the best vector result is the answer, and the reason says why."""
    reranker = models.CompletionModel("word-overlap", models.batched(_failing_setup, of=lambda prompt, facts: F.to_json(facts)))
    model = models.hashing_embedder(searching.EMBED_WIDTH)
    found = search.client_search(searching._asked(t), searching._corpus(t), t.registry, t.classifications, model, reranker)
    return found.select("query_id", "file_id", "confidence", "reason")


# -- search where the vectors lie ---------------------------------------------------------------------------------------------------
TABLE_BUCKETS = 16


def _colocated(t: Tables) -> DataFrame:
    name = new_path(t.spark, "chunks").rpartition("/")[2].replace("-", "_")
    sinks.save_bucketed_chunks(t.chunks, name, TABLE_BUCKETS, path=new_path(t.spark, "bucketed"))
    return similarity.colocated_chunks(t.spark.table(name), t.registry, TABLE_BUCKETS)


@query("vector_topk_colocated", searching._BATCH_SQL)
def vector_topk_colocated(t: Tables) -> DataFrame:
    """Every vector asks its tenant's available chunks, which are found by a join that moves ids and no vectors."""
    best = similarity.batch_top_k(_colocated(t), searching._every_vector(t), searching.WIDTH)
    return best.select("query_id", "client_account_id", "file_id", "chunk_index", "score", "rank")


# -- tenant views in SQL ---------------------------------------------------------------------------------------------------------------
def _view(t: Tables, name: str) -> DataFrame:
    """``SELECT * FROM <name>('CLIENT_1')`` over temporary views of the tables."""
    tables = ("registry", "mapping", "classifications", "searches", "chunks")
    for table in tables:
        getattr(t, table).createOrReplaceTempView(f"tenant_{table}")
    views.create_functions(t.spark, **{table: f"tenant_{table}" for table in tables})
    return t.spark.sql(f"SELECT * FROM {name}(?)", args=[searching.CLIENT])


@query("my_documents_sql", ORACLES["my_documents"])
def my_documents_sql(t: Tables) -> DataFrame:
    return _view(t, "my_documents")


@query("my_classifications_sql", ORACLES["my_classifications"])
def my_classifications_sql(t: Tables) -> DataFrame:
    return _view(t, "my_classifications")


@query("my_search_history_sql", ORACLES["my_search_history"])
def my_search_history_sql(t: Tables) -> DataFrame:
    return _view(t, "my_search_history")


@query("my_chunks_sql", ORACLES["my_chunks"])
def my_chunks_sql(t: Tables) -> DataFrame:
    return _view(t, "my_chunks")
