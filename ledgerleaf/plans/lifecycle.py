"""Keyed writes, state transitions and retention over the driver's tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerleaf.operators import archive, chunk, classify, embed, extract, state
from ledgerleaf.plans.adapters import Tables, ts_text, with_tables
from ledgerleaf.plans.catalog import query
from ledgerleaf.schemas import DOCUMENT_CLASSIFICATION

AS_OF = "2024-02-01 00:00:00"
_EXPIRED = f"processing_status = 'AVAILABLE' AND created_ts < TIMESTAMP '{AS_OF}' - INTERVAL 730 DAY"


def _ids(t: Tables) -> DataFrame:
    return t.docs.select("file_id", "doc_id")


@query(
    "registry_upsert",
    with_tables("docs")
    + f"""SELECT file_id, CASE WHEN doc_id % 4 = 1 OR (doc_id % 3 = 0
    AND processing_status NOT IN ('AVAILABLE', 'CLASSIFIED', 'ARCHIVED')) THEN 'VALIDATED' ELSE processing_status END
    AS processing_status,
  CASE WHEN doc_id % 4 = 1 OR (doc_id % 3 = 0 AND processing_status NOT IN ('AVAILABLE', 'CLASSIFIED', 'ARCHIVED'))
    THEN 'validated/new/' || file_name ELSE 'validated/' || account_id || '/' || file_name END AS current_location,
  CASE WHEN doc_id % 4 = 1 THEN '{AS_OF}.000000' ELSE {ts_text("created_ts")} END AS created_ts
FROM docs""",
)
def registry_upsert(t: Tables) -> DataFrame:
    """A fourth of the documents is new to the registry, a third of the known ones arrives again."""
    known = t.registry.where(F.col("file_id").cast("bigint") % 4 != 1)
    i = F.col("file_id").cast("bigint")
    arrived = t.registry.where((i % 4 == 1) | (i % 3 == 0)).select(
        "file_id",
        "file_name",
        F.concat(F.lit("validated/new/"), "file_name").alias("current_location"),
        F.lit("VALIDATED").alias("processing_status"),
    )
    after = state.register(known, arrived, AS_OF)
    return after.select("file_id", "processing_status", "current_location", "created_ts")


@query(
    "classification_merge",
    with_tables("docs", "classifications")
    + f"""SELECT d.file_id, CASE WHEN doc_id % 2 = 0 THEN 'TAX_PROFILE' ELSE document_type END AS document_type,
  CASE WHEN doc_id % 2 = 0 THEN 'rules-2' ELSE model_name END AS model_name,
  CASE WHEN doc_id % 2 = 0 THEN '{AS_OF}.000000' ELSE {ts_text("classified_ts")} END AS classified_ts
FROM docs d LEFT JOIN classifications c USING (file_id) WHERE doc_id % 2 = 0 OR c.file_id IS NOT NULL""",
)
def classification_merge(t: Tables) -> DataFrame:
    """Every even document is classified again."""
    delta = _ids(t).where(F.col("doc_id") % 2 == 0).select(
        "file_id",
        F.lit("TAX_PROFILE").alias("document_type"),
        F.lit("high").alias("classification_confidence"),
        F.lit("[]").alias("key_indicators"),
        F.lit("again").alias("doc_summary"),
        F.lit("rules-2").alias("model_name"),
        F.lit(AS_OF).cast("timestamp_ntz").alias("classified_ts"),
    )
    after = state.merge_classification(t.classifications.select(*DOCUMENT_CLASSIFICATION.names), delta)
    return after.select("file_id", "document_type", "model_name", "classified_ts")


@query(
    "replace_chunks",
    with_tables("chunks")
    + """SELECT file_id, chunk_index, chunk_text FROM chunks WHERE vec_id // 2 % 3 <> 0
UNION ALL SELECT file_id, CAST(0 AS BIGINT), 'replaced ' || file_id FROM chunks
  WHERE vec_id // 2 % 3 = 0 AND vec_id // 2 % 2 = 0 GROUP BY file_id""",
)
def replace_chunks(t: Tables) -> DataFrame:
    """Every third document is chunked again; half of those end up without chunks."""
    base = t.chunks.select("file_id", "chunk_index", "chunk_text")
    again = base.where(F.col("file_id").cast("bigint") % 3 == 0).select("file_id").distinct()
    fresh = again.where(F.col("file_id").cast("bigint") % 2 == 0).select(
        "file_id", F.lit(0).alias("chunk_index"), F.concat(F.lit("replaced "), "file_id").alias("chunk_text")
    )
    return state.replace_by_key(base, fresh, ["file_id"], replaced=again)


@query(
    "propagate_client",
    with_tables("docs", "chunks")
    + """SELECT k.file_id, chunk_index, CASE WHEN doc_id % 2 = 0 THEN d.client ELSE k.client_account_id END
  AS client_account_id FROM chunks k LEFT JOIN docs d USING (file_id)""",
)
def propagate_client(t: Tables) -> DataFrame:
    routed = t.docs.where(F.col("doc_id") % 2 == 0).select("file_id", F.col("client").alias("client_account_id"))
    return state.propagate_client(t.chunks, routed).select("file_id", "chunk_index", "client_account_id")


_REQUESTS = """requests AS (
  SELECT CASE WHEN doc_id % 10 = 0 THEN 'x' || file_id ELSE file_id END AS file_id, 'ARCHIVING' AS new_status,
    CASE WHEN doc_id % 4 = 0 THEN 'archive/' || file_name END AS location FROM docs WHERE doc_id % 2 = 0)"""


def _requests(t: Tables) -> DataFrame:
    i = F.col("doc_id")
    return t.docs.where(i % 2 == 0).select(
        F.when(i % 10 == 0, F.concat(F.lit("x"), "file_id")).otherwise(F.col("file_id")).alias("file_id"),
        F.lit("ARCHIVING").alias("new_status"),
        F.when(i % 4 == 0, F.concat(F.lit("archive/"), "file_name")).alias("location"),
    )


@query(
    "archive_transition",
    with_tables("registry", also=_REQUESTS)
    + f"""SELECT r.file_id, CASE WHEN q.file_id IS NOT NULL AND r.processing_status <> 'ARCHIVED' THEN q.new_status
    ELSE r.processing_status END AS processing_status,
  CASE WHEN q.file_id IS NOT NULL AND r.processing_status <> 'ARCHIVED' THEN coalesce(q.location, r.current_location)
    ELSE r.current_location END AS current_location,
  CASE WHEN q.file_id IS NOT NULL AND r.processing_status <> 'ARCHIVED' THEN '{AS_OF}.000000'
    ELSE {ts_text("r.updated_ts")} END AS updated_ts
FROM registry r LEFT JOIN requests q ON r.file_id = q.file_id""",
)
def archive_transition(t: Tables) -> DataFrame:
    after, _ = state.archive_transition(t.registry, _requests(t), AS_OF)
    return after.select("file_id", "processing_status", "current_location", "updated_ts")


@query(
    "archive_transition_report",
    with_tables("registry", also=_REQUESTS)
    + """SELECT q.file_id, q.new_status, CASE WHEN r.file_id IS NULL THEN 'missing'
  WHEN r.processing_status = 'ARCHIVED' THEN 'skipped' ELSE 'applied' END AS outcome
FROM requests q LEFT JOIN registry r ON r.file_id = q.file_id""",
)
def archive_transition_report(t: Tables) -> DataFrame:
    return state.archive_transition(t.registry, _requests(t), AS_OF)[1]


@query(
    "archive_candidates",
    with_tables("registry")
    + f"""SELECT file_id, file_name, account_id, current_location, {ts_text("registry.created_ts")} AS created_ts
FROM registry WHERE {_EXPIRED.replace("created_ts", "registry.created_ts")}""",
)
def archive_candidates(t: Tables) -> DataFrame:
    return archive.candidates(t.registry, AS_OF)


def _archived(t: Tables) -> DataFrame:
    """The copy of every seventh document fails, every eleventh is not reported at all."""
    i = F.col("doc_id")
    moved = _ids(t).where(i % 11 != 0).select("file_id", F.when(i % 7 == 0, F.lit("copy refused")).alias("error"))
    return archive.outcomes(archive.candidates(t.registry, AS_OF, ordered=False), moved)


_ARCHIVED = with_tables(
    "registry",
    also=f"""done AS (
  SELECT *, 'archive/' || account_id || '/' || file_id || '/' || file_name AS new_location,
    CASE WHEN doc_id % 11 = 0 THEN 'not copied' WHEN doc_id % 7 = 0 THEN 'copy refused' END AS error
  FROM registry WHERE {_EXPIRED})""",
)


@query(
    "archive_run",
    _ARCHIVED
    + f"""SELECT file_id, CASE WHEN error IS NULL THEN 'ARCHIVED' ELSE 'FAILED' END AS processing_status,
  CASE WHEN error IS NULL THEN new_location ELSE current_location END AS current_location,
  '{AS_OF}.000000' AS updated_ts FROM done""",
)
def archive_run(t: Tables) -> DataFrame:
    delta = archive.registry_delta(t.registry, _archived(t), AS_OF)
    return delta.select("file_id", "processing_status", "current_location", "updated_ts")


@query(
    "archive_alerts",
    _ARCHIVED
    + """SELECT 'Document archive failed' AS subject, file_id, 'File ID: ' || file_id || chr(10) || 'Error: ' || error
  AS message FROM done WHERE error IS NOT NULL
UNION ALL SELECT 'Document archive run complete', NULL, 'Documents processed: ' || count(*) FROM done""",
)
def archive_alerts(t: Tables) -> DataFrame:
    return archive.alerts(_archived(t))


@query(
    "archive_audit",
    _ARCHIVED
    + f"""SELECT file_id, 'ARCHIVE' AS step_name, s AS status, '{AS_OF}.000000' AS start_ts, '{AS_OF}.000000' AS end_ts,
  CASE WHEN s = 'FAILED' THEN error END AS error_message
FROM (SELECT *, unnest(['ARCHIVING', CASE WHEN error IS NULL THEN 'ARCHIVED' ELSE 'FAILED' END]) AS s FROM done)""",
)
def archive_audit(t: Tables) -> DataFrame:
    return archive.audit(_archived(t), AS_OF)


@query(
    "archive_payload",
    _ARCHIVED + "SELECT account_id, file_id, new_location AS archive_path, file_size AS bytes FROM done",
)
def archive_payload(t: Tables) -> DataFrame:
    files = t.docs.select(
        F.concat_ws("/", F.lit("validated"), "account_id", "file_name").alias("location"),
        F.encode("text", "utf-8").alias("content"),
    )
    rows = archive.payload(archive.candidates(t.registry, AS_OF, ordered=False), files)
    return rows.select("account_id", "file_id", "archive_path", F.octet_length("content").cast("bigint").alias("bytes"))


@query(
    "extract_transition",
    with_tables("registry")
    + f"""SELECT file_id, CASE WHEN file_format IN ('PDF', 'TXT') THEN 'FAILED' ELSE 'TEXT_EXTRACTED' END AS processing_status,
  '{AS_OF}.000000' AS updated_ts FROM registry WHERE processing_status = 'STAGED'""",
)
def extract_transition(t: Tables) -> DataFrame:
    failed = F.col("file_format").isin("PDF", "TXT")
    outcomes = t.registry.where(F.col("processing_status") == "STAGED").select(
        "file_id", F.when(failed, F.lit("cannot read")).alias("error")
    )
    delta = extract.registry_delta(t.registry, outcomes, AS_OF)
    return delta.select("file_id", "processing_status", "updated_ts")


@query(
    "step_audit",
    with_tables("registry")
    + f"""SELECT file_id, 'EXTRACT' AS step_name, CASE WHEN file_format = 'TXT' THEN 'FAILED' ELSE 'COMPLETED' END AS status,
  '{AS_OF}.000000' AS start_ts, '{AS_OF}.000000' AS end_ts,
  CASE WHEN file_format = 'TXT' THEN repeat('no text ', 600) END AS error_message FROM registry""",
)
def step_audit(t: Tables) -> DataFrame:
    outcomes = t.registry.select(
        "file_id", F.when(F.col("file_format") == "TXT", F.repeat(F.lit("no text "), F.lit(600))).alias("error")
    )
    return state.audit_rows(outcomes, "EXTRACT", AS_OF, AS_OF)


@query(
    "step_counters",
    with_tables("registry", "texts")
    + """, todo AS (SELECT count(*) AS n FROM registry JOIN texts USING (file_id) WHERE processing_status = 'TEXT_EXTRACTED')
SELECT n AS embedded, CAST(0 AS BIGINT) AS failed, '{"embedded":' || n || ',"failed":0}' AS result_json FROM todo""",
)
def step_counters(t: Tables) -> DataFrame:
    return embed.counters(embed.outcomes(chunk.pending(t.registry, t.texts)))


@query(
    "classify_job",
    with_tables("registry", "texts", "classifications")
    + f"""SELECT file_id, 'AVAILABLE' AS processing_status, '{AS_OF}.000000' AS updated_ts
FROM registry r JOIN texts USING (file_id) WHERE processing_status = 'EMBEDDED'
  AND NOT EXISTS (SELECT 1 FROM classifications c WHERE c.file_id = r.file_id)""",
)
def classify_job(t: Tables) -> DataFrame:
    outcomes = classify.classify(classify.pending(t.registry, t.texts, t.classifications))
    delta = classify.registry_delta(t.registry, outcomes, AS_OF)
    return delta.select("file_id", "processing_status", "updated_ts")


@query(
    "reprocess",
    with_tables("docs", "texts", "chunks", "classifications")
    + """SELECT d.file_id, CASE WHEN doc_id % 5 = 0 THEN 'STAGED' ELSE processing_status END AS processing_status,
  CASE WHEN doc_id % 5 <> 0 THEN (SELECT count(*) FROM texts x WHERE x.file_id = d.file_id) ELSE 0 END AS texts,
  CASE WHEN doc_id % 5 <> 0 THEN (SELECT count(*) FROM chunks x WHERE x.file_id = d.file_id) ELSE 0 END AS chunks,
  CASE WHEN doc_id % 5 <> 0 THEN (SELECT count(*) FROM classifications x WHERE x.file_id = d.file_id) ELSE 0 END
    AS classifications
FROM docs d""",
)
def reprocess(t: Tables) -> DataFrame:
    wanted = _ids(t).where(F.col("doc_id") % 5 == 0)
    registry, texts, chunks, classes = state.reprocess(t.registry, t.texts, t.chunks, t.classifications, wanted, AS_OF)
    out = registry.select("file_id", "processing_status")
    for name, table in (("texts", texts), ("chunks", chunks), ("classifications", classes)):
        counted = table.groupBy("file_id").agg(F.count(F.lit(1)).alias(name))
        out = out.join(counted, "file_id", "left").withColumn(name, F.coalesce(name, F.lit(0)))
    return out
