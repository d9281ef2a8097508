"""Monitoring reports over the driver's tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerleaf.functions import lookups, times
from ledgerleaf.operators import reports
from ledgerleaf.plans.adapters import Tables, ts_text, with_tables
from ledgerleaf.plans.catalog import query
from ledgerleaf.schemas import SETTLED, STATUS_ORDER, TASK_ORDER

AS_OF = "2024-01-20 12:00:30"
STUCK_AS_OF = "2022-01-05 00:20:15"
HOURS = 100
_RECENT = f"TIMESTAMP '{AS_OF}' - INTERVAL {HOURS} HOUR"
_STUCK = f"processing_status NOT IN {SETTLED} AND updated_ts < TIMESTAMP '{STUCK_AS_OF}' - INTERVAL 30 MINUTE"
_RUN = f"""name, state, {ts_text("scheduled_time")} AS scheduled_time, {ts_text("completed_time")} AS completed_time,
  return_value, error_message, date_diff('second', scheduled_time, completed_time) AS duration_secs"""


@query(
    "landing_newest",
    with_tables("landing")
    + f"""SELECT relative_path, file_size, {ts_text("last_modified")} AS last_modified, {ts_text("loaded_ts")} AS loaded_ts
FROM landing ORDER BY landing.loaded_ts DESC, relative_path LIMIT 20""",
)
def landing_newest(t: Tables) -> DataFrame:
    return reports.landing_newest(t.landing)


@query(
    "load_history",
    with_tables("loads")
    + f"""SELECT file_name, status, row_count, first_error_message, {ts_text("last_load_time")} AS last_load_time
FROM loads WHERE loads.last_load_time > {_RECENT} ORDER BY loads.last_load_time DESC, file_name LIMIT 10""",
)
def load_history(t: Tables) -> DataFrame:
    return reports.load_history(t.loads, AS_OF, HOURS)


@query(
    "run_history",
    with_tables("runs")
    + f"""SELECT {_RUN} FROM runs WHERE runs.scheduled_time > {_RECENT} AND name = 'ROUTING_TASK'
ORDER BY runs.scheduled_time DESC LIMIT 20""",
)
def run_history(t: Tables) -> DataFrame:
    return reports.run_history(t.runs, AS_OF, HOURS, task="ROUTING_TASK")


@query(
    "last_run_per_step",
    with_tables("runs")
    + f"""SELECT {_RUN} FROM runs WHERE runs.scheduled_time > {_RECENT} AND name IN {TASK_ORDER}
QUALIFY row_number() OVER (PARTITION BY name ORDER BY runs.scheduled_time DESC) = 1""",
)
def last_run_per_step(t: Tables) -> DataFrame:
    return reports.last_run_per_task(t.runs, AS_OF, HOURS)


@query(
    "failed_runs",
    with_tables("runs")
    + f"""SELECT name, state, {ts_text("scheduled_time")} AS scheduled_time, error_message
FROM runs WHERE runs.scheduled_time > {_RECENT} AND state = 'FAILED'""",
)
def failed_runs(t: Tables) -> DataFrame:
    return reports.failed_runs(t.runs, AS_OF, HOURS).select("name", "state", "scheduled_time", "error_message")


@query(
    "status_summary",
    with_tables("registry")
    + f"""SELECT processing_status, file_format, count(*) AS file_count, {ts_text("min(created_ts)")} AS earliest,
  {ts_text("max(updated_ts)")} AS latest_update FROM registry GROUP BY processing_status, file_format""",
)
def status_summary(t: Tables) -> DataFrame:
    return reports.status_summary(t.registry)


@query(
    "status_rank",
    with_tables("docs")
    + "SELECT file_id, CAST(CASE processing_status "
    + " ".join(f"WHEN '{s}' THEN {i}" for i, s in enumerate(STATUS_ORDER, 1))
    + " ELSE 9 END AS BIGINT) AS sort_rank FROM docs",
)
def status_rank(t: Tables) -> DataFrame:
    return t.docs.select("file_id", lookups.status_rank(F.col("processing_status")).alias("sort_rank"))


@query(
    "audit_trail",
    with_tables("docs", "audit")
    + f"""SELECT a.file_id, file_name, file_format, processing_status, step_name, status, {ts_text("start_ts")} AS start_ts,
  {ts_text("end_ts")} AS end_ts, date_diff('second', a.start_ts, a.end_ts) AS duration_secs, error_message
FROM audit a JOIN docs d ON a.file_id = d.file_id""",
)
def audit_trail(t: Tables) -> DataFrame:
    return reports.audit_trail(t.audit, t.registry)


@query(
    "boundary_diffs",
    with_tables("steps")
    + "SELECT event_id, "
    + ", ".join(f"date_diff('{u}', start_ts, end_ts) AS {u}s" for u in times.UNIT_SECONDS)
    + " FROM steps",
)
def boundary_diffs(t: Tables) -> DataFrame:
    diffs = [times.boundary_diff(u, F.col("start_ts"), F.col("end_ts")).alias(f"{u}s") for u in times.UNIT_SECONDS]
    return t.steps.select("event_id", *diffs)


@query(
    "stuck_files",
    with_tables("registry")
    + f"""SELECT file_id, file_name, processing_status, {ts_text("registry.updated_ts")} AS updated_ts,
  date_diff('minute', registry.updated_ts, TIMESTAMP '{STUCK_AS_OF}') AS mins_stuck FROM registry WHERE {_STUCK}""",
)
def stuck_files(t: Tables) -> DataFrame:
    return reports.stuck_files(t.registry, STUCK_AS_OF)


@query(
    "failed_steps",
    with_tables("docs", "audit")
    + f"""SELECT a.file_id, step_name, error_message, {ts_text("start_ts")} AS start_ts, file_name, processing_status
FROM audit a JOIN docs d ON a.file_id = d.file_id WHERE status = 'FAILED'""",
)
def failed_steps(t: Tables) -> DataFrame:
    return reports.failed_steps(t.audit, t.registry)


@query(
    "classification_detail",
    with_tables("classifications", "registry")
    + f"""SELECT file_id, file_name, c.document_type, classification_confidence, doc_summary, key_indicators,
  {ts_text("c.classified_ts")} AS classified_ts FROM classifications c JOIN registry USING (file_id)""",
)
def classification_detail(t: Tables) -> DataFrame:
    return reports.classification_detail(t.classifications, t.registry)


@query(
    "chunk_token_stats",
    with_tables("docs", "chunks")
    + """SELECT file_name, file_format, count(*) AS total_chunks, min(token_count) AS min_tokens,
  CAST(round(avg(token_count)) AS BIGINT) AS avg_tokens, max(token_count) AS max_tokens
FROM docs JOIN chunks USING (file_id) GROUP BY file_name, file_format""",
)
def chunk_token_stats(t: Tables) -> DataFrame:
    return reports.chunk_stats(t.chunks, t.registry)


@query(
    "searchable_files",
    with_tables("registry", "classifications", "chunks")
    + f"""SELECT file_id, file_name, file_format, r.client_account_id, c.document_type, classification_confidence,
  count(*) AS chunks, {ts_text("updated_ts")} AS available_since
FROM registry r JOIN classifications c USING (file_id) JOIN chunks k USING (file_id)
WHERE processing_status = 'AVAILABLE' GROUP BY ALL""",
)
def searchable_files(t: Tables) -> DataFrame:
    return reports.searchable_files(t.registry, t.classifications, t.chunks)


@query(
    "recent_searches",
    with_tables("searches")
    + f"""SELECT client_account_id, search_term, result_file_id, search_confidence, result_count, execution_time_ms,
  {ts_text("searches.search_ts")} AS search_ts FROM searches ORDER BY searches.search_ts DESC LIMIT 20""",
)
def recent_searches(t: Tables) -> DataFrame:
    return reports.recent_searches(t.searches)


@query(
    "recent_searches_window",
    with_tables("searches")
    + f"""SELECT client_account_id, search_term, result_file_id, search_confidence, result_count, execution_time_ms,
  {ts_text("searches.search_ts")} AS search_ts FROM searches WHERE searches.search_ts > {_RECENT}
ORDER BY searches.search_ts DESC LIMIT 10""",
)
def recent_searches_window(t: Tables) -> DataFrame:
    return reports.recent_searches(t.searches, AS_OF, HOURS, n=10)


@query(
    "search_latency",
    with_tables("searches")
    + """SELECT search_confidence, count(*) AS total_searches, CAST(round(avg(execution_time_ms)) AS BIGINT) AS avg_ms,
  max(execution_time_ms) AS max_ms FROM searches GROUP BY search_confidence""",
)
def search_latency(t: Tables) -> DataFrame:
    return reports.search_latency(t.searches)


@query(
    "pending_landing",
    with_tables("landing", "registry")
    + """, processed AS (SELECT current_location AS relative_path FROM registry WHERE processing_status = 'AVAILABLE'),
waiting AS (SELECT DISTINCT relative_path FROM landing WHERE relative_path NOT IN (SELECT relative_path FROM processed))
SELECT count(*) AS pending_rows, count(*) > 0 AS has_data FROM waiting""",
)
def pending_landing(t: Tables) -> DataFrame:
    return reports.pending_landing(t.landing, _processed(t))


def _processed(t: Tables) -> DataFrame:
    done = t.registry.where(F.col("processing_status") == "AVAILABLE")
    return done.select(F.col("current_location").alias("relative_path"))


@query(
    "dashboard",
    with_tables("registry", "searches", "landing")
    + f""", counts AS (
  SELECT count(*) FILTER (processing_status = 'AVAILABLE') AS files_available,
    count(*) FILTER (processing_status = 'FAILED') AS files_failed, count(*) FILTER ({_STUCK}) AS files_stuck
  FROM registry),
recent AS (SELECT count(*) AS searches FROM searches WHERE search_ts > TIMESTAMP '{STUCK_AS_OF}' - INTERVAL 24 HOUR),
waiting AS (
  SELECT count(DISTINCT relative_path) AS pending_rows FROM landing WHERE relative_path NOT IN
    (SELECT current_location FROM registry WHERE processing_status = 'AVAILABLE'))
SELECT *, pending_rows > 0 AS has_data, 'RUNNING' AS pipe_state, CAST(0 AS BIGINT) AS pipe_pending_files,
  CASE WHEN files_failed = 0 AND files_stuck = 0 THEN 'HEALTHY' ELSE 'NEEDS ATTENTION' END AS health
FROM counts, recent, waiting""",
)
def dashboard(t: Tables) -> DataFrame:
    pending = reports.pending_landing(t.landing, _processed(t))
    return reports.dashboard(t.registry, t.searches, STUCK_AS_OF, pending=pending)


@query(
    "log_pattern_counts",
    with_tables("logs")
    + f"""SELECT count(*) FILTER (contains(message, 'ERROR')) AS errors,
  count(*) FILTER (contains(message, 'Validated')) AS successes,
  count(*) FILTER (contains(message, 'quarantine')) AS quarantined FROM logs WHERE ts > {_RECENT}""",
)
def log_pattern_counts(t: Tables) -> DataFrame:
    return reports.log_pattern_counts(t.logs, AS_OF, HOURS)


@query(
    "pipe_state",
    """SELECT event_id, CASE WHEN event_id % 3 = 0 THEN 'UNKNOWN' ELSE upper(event_type) END AS pipe_state,
  CASE WHEN event_id % 5 = 0 THEN 0 ELSE user_id END AS pipe_pending_files FROM events""",
)
def pipe_state(t: Tables) -> DataFrame:
    i = F.col("event_id")
    status = F.to_json(
        F.struct(
            F.when(i % 3 != 0, F.upper("event_type")).alias("executionState"),
            F.when(i % 5 != 0, F.col("user_id")).alias("pendingFileCount"),
        )
    )
    return reports.pipe_state(t.raw("events").select(i, status.alias("value")), keep=("event_id",))
