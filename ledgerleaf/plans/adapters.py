"""The driver's tables seen as the tables of :mod:`ledgerleaf.schemas`, in Spark and in SQL.

Every adapter is a projection, filter or small aggregate of a driver table, so its size follows that table. Remainders
of ids decide states, names and gaps, so that every branch of every job meets rows; no table is cut down for cost.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerleaf.functions import paths
from ledgerleaf.schemas import SUPPORTED_FORMATS, TASK_ORDER, TYPE_HINT_PREFIXES
from ledgerleaf.session import spread

NAME_STEMS = (*[prefix for prefix, _ in TYPE_HINT_PREFIXES], "misc")
EXTENSIONS = ("pdf", "csv", "xlsx", "txt")
STATUSES = (
    "VALIDATED", "STAGED", "TEXT_EXTRACTED", "EMBEDDED", "AVAILABLE", "ARCHIVED", "FAILED", "RECEIVED", "AVAILABLE",
)
STEPS = ("VALIDATE", "ROUTE", "EXTRACT", "EMBED", "CLASSIFY")
TASKS = (*TASK_ORDER, "OTHER_TASK")
CONFIDENCES = ("high", "medium", "low")


def pick(values: tuple[str, ...], index: Column) -> Column:
    return F.element_at(F.array(*[F.lit(v) for v in values]), (index % len(values)).cast("int") + 1)


def sql_pick(values: tuple[str, ...], index: str) -> str:
    listed = ", ".join(f"'{v}'" for v in values)
    return f"[{listed}][({index}) % {len(values)} + 1]"


class Tables:
    """Lazily built tables over one data folder."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir

    def raw(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")

    def heavy(self, name: str, key: str) -> DataFrame:
        """A table as input of costly per-row work."""
        return spread(self.raw(name), key)

    @cached_property
    def heavy_docs(self) -> DataFrame:
        return spread(self.docs, "doc_id")

    @cached_property
    def docs(self) -> DataFrame:
        """Documents with the derived names every adapter shares."""
        i, n = F.col("doc_id"), F.substring("source", 4, 10).cast("bigint")
        ext = pick(EXTENSIONS, i)
        created = F.timestamp_seconds(F.lit(1640995200) + i * 3600)
        d = self.raw("documents").select(
            i,
            F.col("text"),
            F.col("source").alias("account_id"),
            n.alias("n"),
            F.concat(F.lit("B"), (F.floor(i / 3) % 2).cast("string")).alias("branch_id"),
            F.concat(pick(NAME_STEMS, i), F.lit("_"), i.cast("string"), F.lit("."), ext).alias("file_name"),
            F.upper(ext).alias("file_format"),
            pick(STATUSES, i).alias("processing_status"),
            F.concat(F.lit("CLIENT_"), (n % 3).cast("string")).alias("client"),
            created.cast("timestamp_ntz").alias("created_ts"),
            F.timestamp_seconds(F.unix_seconds(created) + (i % 120) * 60).cast("timestamp_ntz").alias("updated_ts"),
        )
        return d.withColumn("file_id", i.cast("string"))

    @cached_property
    def registry(self) -> DataFrame:
        return self.docs.select(
            "file_id",
            "file_name",
            "file_format",
            F.when(F.col("doc_id") % 6 != 0, F.col("client")).alias("client_account_id"),
            "account_id",
            "branch_id",
            F.lit(None).cast("string").alias("document_type"),
            F.sha2("text", 256).alias("file_hash"),
            F.octet_length("text").cast("bigint").alias("file_size"),
            F.concat_ws("/", F.lit("validated"), "account_id", "file_name").alias("current_location"),
            "processing_status",
            F.lit("S3").alias("source_system"),
            "created_ts",
            "updated_ts",
        )

    @cached_property
    def mapping(self) -> DataFrame:
        owners = self.docs.select("account_id", "branch_id", "n").distinct()
        c = (F.col("n") % 3).cast("string")
        return owners.select(
            "account_id",
            "branch_id",
            F.concat(F.lit("Client "), c).alias("client_name"),
            F.concat(F.lit("CLIENT_"), c).alias("client_account_id"),
            F.concat(F.lit("STAGE_"), c).alias("client_stage_name"),
            (F.col("n") % 5 != 0).alias("active_flag"),
        )

    @cached_property
    def collections(self) -> DataFrame:
        n = F.col("n")
        entities = self.docs.select("account_id", "n").distinct().where(n % 7 != 3)
        every = F.array(*[F.lit(f) for f in SUPPORTED_FORMATS])
        return entities.select(
            F.concat(F.lit("C"), (n % 4).cast("string")).alias("custody_country"),
            F.col("account_id").alias("legal_entity_id"),
            F.when(n % 5 == 1, F.array(F.lit("PDF"))).otherwise(every).alias("allowed_formats"),
            F.lit("S3").alias("source"),
            F.when(n % 6 != 5, F.lit("Warehouse")).alias("destination"),
            (n % 8 != 4).alias("active_flag"),
        )

    @cached_property
    def sidecars(self) -> DataFrame:
        i = F.col("doc_id")
        first = self.docs.where(i % 13 != 0).select(
            "file_id",
            "file_name",
            "file_format",
            F.when(i % 17 != 0, F.concat(F.lit("C"), (F.col("n") % 4).cast("string"))).alias("custody_country"),
            F.col("account_id").alias("legal_entity_id"),
            F.when(i % 19 == 0, F.lit("Elsewhere")).otherwise(F.lit("warehouse")).alias("destination"),
            "account_id",
            "branch_id",
            F.when(i % 50 == 0, F.lit("0" * 64)).otherwise(F.sha2("text", 256)).alias("file_hash"),
            F.octet_length("text").cast("bigint").alias("file_size"),
            F.lit("S3").alias("source_system"),
            i,
        )
        later = (
            first.where(i % 11 == 0)
            .withColumn("file_id", F.concat(F.lit("z"), "file_id"))
            .withColumn("file_hash", F.lit("f" * 64))
        )
        return first.unionByName(later).drop("doc_id")

    @cached_property
    def files(self) -> DataFrame:
        supported = paths.file_extension(F.col("file_name")).isin(*SUPPORTED_FORMATS)
        return self.docs.select(
            F.concat_ws("/", F.lit("incoming"), "account_id", "file_name").alias("path"),
            F.octet_length("text").cast("bigint").alias("file_size"),
            F.when(supported, F.sha2("text", 256)).alias("actual_hash"),
        )

    @cached_property
    def landing(self) -> DataFrame:
        i = F.col("doc_id")
        rows = self.docs.where(i % 5 != 0).select(
            F.concat_ws("/", F.lit("validated"), "account_id", "file_name").alias("relative_path"),
            F.octet_length("text").cast("bigint").alias("file_size"),
            F.col("created_ts").alias("last_modified"),
            F.col("updated_ts").alias("loaded_ts"),
            i,
        )
        return rows.unionByName(rows.where(i % 7 == 0)).drop("doc_id")

    @cached_property
    def texts(self) -> DataFrame:
        i = F.col("doc_id")
        return self.docs.where((i % 9).isin(2, 3, 4, 5, 8) | (i % 18 == 1)).select(
            "file_id",
            F.col("text").alias("extracted_text"),
            F.length("text").cast("bigint").alias("char_count"),
            F.col("updated_ts").alias("extracted_ts"),
        )

    @cached_property
    def classifications(self) -> DataFrame:
        i = F.col("doc_id")
        return self.docs.where((i % 9).isin(4, 5, 8) | (i % 27 == 3)).select(
            "file_id",
            pick(tuple(t for _, t in TYPE_HINT_PREFIXES) + ("UNKNOWN",), i).alias("document_type"),
            pick(CONFIDENCES, i).alias("classification_confidence"),
            F.lit("[]").alias("key_indicators"),
            F.concat(F.lit("document "), "file_id").alias("doc_summary"),
            F.lit("keyword-rules").alias("model_name"),
            F.col("updated_ts").alias("classified_ts"),
        )

    @cached_property
    def chunks(self) -> DataFrame:
        """Embeddings as chunks, two per document."""
        i = F.col("vec_id")
        return self.raw("embeddings").select(
            F.floor(i / 2).cast("string").alias("file_id"),
            F.concat(F.lit("CLIENT_"), (F.col("label") % 3).cast("string")).alias("client_account_id"),
            (i % 2).cast("int").alias("chunk_index"),
            F.concat(F.lit("chunk "), i.cast("string")).alias("chunk_text"),
            "embedding",
            (i * 37 % 500).alias("token_count"),
            F.timestamp_seconds(F.lit(1640995200) + i * 60).cast("timestamp_ntz").alias("created_ts"),
        )

    @cached_property
    def steps(self) -> DataFrame:
        """Events as timed steps: the common source of audit, runs and logs."""
        took = F.round(F.col("value") * 1000000).cast("bigint")
        return self.raw("events").select(
            "event_id",
            "user_id",
            "event_type",
            "value",
            "props",
            F.col("ts").cast("timestamp_ntz").alias("start_ts"),
            F.timestamp_micros(F.unix_micros(F.col("ts").cast("timestamp")) + took)
            .cast("timestamp_ntz")
            .alias("end_ts"),
            F.when(F.col("event_type") == "error", F.concat(F.lit("failed with "), "props")).alias("error_message"),
        )

    @cached_property
    def audit(self) -> DataFrame:
        return self.steps.select(
            F.col("user_id").cast("string").alias("file_id"),
            pick(STEPS, F.col("event_id")).alias("step_name"),
            F.when(F.col("event_type") == "error", F.lit("FAILED")).otherwise(F.lit("COMPLETED")).alias("status"),
            "start_ts",
            "end_ts",
            "error_message",
        )

    @cached_property
    def runs(self) -> DataFrame:
        kind = F.col("event_type")
        return self.steps.select(
            pick(TASKS, F.col("event_id")).alias("name"),
            F.when(kind == "error", F.lit("FAILED"))
            .when(kind == "signup", F.lit("SKIPPED"))
            .otherwise(F.lit("SUCCEEDED"))
            .alias("state"),
            F.col("start_ts").alias("scheduled_time"),
            F.col("end_ts").alias("completed_time"),
            F.col("props").alias("return_value"),
            "error_message",
        )

    @cached_property
    def loads(self) -> DataFrame:
        return self.steps.select(
            F.concat(F.lit("file_"), F.col("event_id").cast("string"), F.lit(".csv")).alias("file_name"),
            F.when(F.col("event_type") == "error", F.lit("LOAD_FAILED")).otherwise(F.lit("LOADED")).alias("status"),
            (F.col("event_id") % 1000).alias("row_count"),
            F.col("error_message").alias("first_error_message"),
            F.col("start_ts").alias("last_load_time"),
        )

    @cached_property
    def logs(self) -> DataFrame:
        kind = F.col("event_type")
        return self.steps.select(
            F.col("start_ts").alias("ts"),
            F.when(kind == "error", F.concat(F.lit("ERROR "), "props"))
            .when(kind == "click", F.lit("Validated: incoming file"))
            .when(kind == "view", F.lit("moved to quarantine"))
            .otherwise(kind)
            .alias("message"),
        )

    @cached_property
    def searches(self) -> DataFrame:
        value = F.col("value")
        return self.raw("events").select(
            F.concat(F.lit("CLIENT_"), (F.col("user_id") % 3).cast("string")).alias("client_account_id"),
            F.concat_ws(" ", "event_type", F.col("event_id").cast("string")).alias("search_term"),
            F.col("user_id").cast("string").alias("result_file_id"),
            F.when(value > 60, F.lit("high"))
            .when(value > 20, F.lit("medium"))
            .otherwise(F.lit("low"))
            .alias("search_confidence"),
            (F.col("event_id") % 6).alias("result_count"),
            F.round(value * 10).cast("bigint").alias("execution_time_ms"),
            F.col("ts").cast("timestamp_ntz").alias("search_ts"),
        )

    @cached_property
    def envelopes(self) -> DataFrame:
        """Events as queue envelopes: some malformed, some outside incoming/, some without a detail object."""
        i = F.col("event_id")
        key = F.format_string("incoming/src%d/doc_%d.csv", F.col("user_id") % 20, i)
        inner = F.to_json(F.struct(F.struct(key.alias("key")).alias("object")))
        body = (
            F.when(i % 10 == 0, F.lit("{not json"))
            .when(i % 10 == 1, F.replace(inner, F.lit("incoming/"), F.lit("metadata/")))
            .when(i % 10 == 2, inner)
            .otherwise(F.concat(F.lit('{"detail": '), inner, F.lit("}")))
        )
        return self.heavy("events", "event_id").select(
            F.to_json(F.struct(F.array(F.struct(body.alias("body"))).alias("Records"))).alias("value")
        )

    @cached_property
    def trades(self) -> DataFrame:
        """Line items as trades of the ordering customer, money as exact decimals."""
        lines = self.raw("lineitem").select(
            "l_orderkey",
            "l_linenumber",
            "l_partkey",
            "l_suppkey",
            F.col("l_quantity").cast("decimal(18,2)").alias("quantity"),
            F.col("l_extendedprice").cast("decimal(18,2)").alias("gross"),
            F.round(F.col("l_discount") * 100).cast("decimal(18,2)").alias("rate_pct"),
            F.col("l_shipdate").cast("date").alias("trade_date"),
            "l_returnflag",
        )
        side = F.when(F.col("l_linenumber") % 2 == 1, F.lit("BUY")).otherwise(F.lit("SELL"))
        return lines.withColumn("side", side)

    @cached_property
    def heavy_trades(self) -> DataFrame:
        return spread(self.trades, "l_orderkey")


# The same tables as DuckDB common table expressions.
_DOCS = f"""docs AS (
  SELECT doc_id, text, source AS account_id, CAST(substr(source, 4) AS BIGINT) AS n,
    'B' || CAST((doc_id // 3) % 2 AS VARCHAR) AS branch_id,
    {sql_pick(NAME_STEMS, "doc_id")} || '_' || doc_id || '.' || {sql_pick(EXTENSIONS, "doc_id")} AS file_name,
    upper({sql_pick(EXTENSIONS, "doc_id")}) AS file_format,
    {sql_pick(STATUSES, "doc_id")} AS processing_status,
    'CLIENT_' || CAST(substr(source, 4) AS BIGINT) % 3 AS client,
    TIMESTAMP '2022-01-01 00:00:00' + to_hours(doc_id) AS created_ts,
    TIMESTAMP '2022-01-01 00:00:00' + to_hours(doc_id) + to_minutes(doc_id % 120) AS updated_ts,
    CAST(doc_id AS VARCHAR) AS file_id
  FROM documents)"""

_CTE = {
    "docs": _DOCS,
    "registry": """registry AS (
  SELECT file_id, file_name, file_format, CASE WHEN doc_id % 6 <> 0 THEN client END AS client_account_id, account_id,
    branch_id, CAST(NULL AS VARCHAR) AS document_type, sha256(text) AS file_hash, strlen(text) AS file_size,
    'validated/' || account_id || '/' || file_name AS current_location, processing_status, 'S3' AS source_system,
    created_ts, updated_ts, doc_id
  FROM docs)""",
    "mapping": """mapping AS (
  SELECT DISTINCT account_id, branch_id, 'Client ' || n % 3 AS client_name, 'CLIENT_' || n % 3 AS client_account_id,
    'STAGE_' || n % 3 AS client_stage_name, n % 5 <> 0 AS active_flag
  FROM docs)""",
    "collections": """collections AS (
  SELECT DISTINCT 'C' || n % 4 AS custody_country, account_id AS legal_entity_id,
    CASE WHEN n % 5 = 1 THEN ['PDF'] ELSE ['PDF', 'XLSX', 'CSV'] END AS allowed_formats,
    CASE WHEN n % 6 <> 5 THEN 'Warehouse' END AS destination, n % 8 <> 4 AS active_flag
  FROM docs WHERE n % 7 <> 3)""",
    "sidecars": """sidecars AS (
  SELECT file_id, file_name, file_format, CASE WHEN doc_id % 17 <> 0 THEN 'C' || n % 4 END AS custody_country,
    account_id AS legal_entity_id, CASE WHEN doc_id % 19 = 0 THEN 'Elsewhere' ELSE 'warehouse' END AS destination,
    account_id, branch_id, CASE WHEN doc_id % 50 = 0 THEN repeat('0', 64) ELSE sha256(text) END AS file_hash,
    strlen(text) AS file_size
  FROM docs WHERE doc_id % 13 <> 0
  UNION ALL
  SELECT 'z' || file_id, file_name, file_format, CASE WHEN doc_id % 17 <> 0 THEN 'C' || n % 4 END, account_id,
    CASE WHEN doc_id % 19 = 0 THEN 'Elsewhere' ELSE 'warehouse' END, account_id, branch_id, repeat('f', 64),
    strlen(text)
  FROM docs WHERE doc_id % 13 <> 0 AND doc_id % 11 = 0)""",
    "landing": """landing AS (
  SELECT 'validated/' || account_id || '/' || file_name AS relative_path, strlen(text) AS file_size,
    created_ts AS last_modified, updated_ts AS loaded_ts
  FROM docs, (VALUES (1), (2)) AS copies(c) WHERE doc_id % 5 <> 0 AND (c = 1 OR doc_id % 7 = 0))""",
    "texts": """texts AS (
  SELECT file_id, text AS extracted_text FROM docs
  WHERE doc_id % 9 IN (2, 3, 4, 5, 8) OR doc_id % 18 = 1)""",
    "classifications": f"""classifications AS (
  SELECT file_id, {sql_pick(tuple(t for _, t in TYPE_HINT_PREFIXES) + ("UNKNOWN",), "doc_id")} AS document_type,
    {sql_pick(CONFIDENCES, "doc_id")} AS classification_confidence, '[]' AS key_indicators,
    'document ' || file_id AS doc_summary, 'keyword-rules' AS model_name, updated_ts AS classified_ts
  FROM docs WHERE doc_id % 9 IN (4, 5, 8) OR doc_id % 27 = 3)""",
    "chunks": """chunks AS (
  SELECT CAST(vec_id // 2 AS VARCHAR) AS file_id, 'CLIENT_' || label % 3 AS client_account_id,
    vec_id % 2 AS chunk_index, 'chunk ' || vec_id AS chunk_text, CAST(embedding AS DOUBLE[]) AS embedding,
    vec_id * 37 % 500 AS token_count, TIMESTAMP '2022-01-01 00:00:00' + to_minutes(vec_id) AS created_ts, vec_id
  FROM embeddings)""",
    "steps": """steps AS (
  SELECT event_id, user_id, event_type, value, props, ts AS start_ts,
    ts + to_microseconds(CAST(round(value * 1000000) AS BIGINT)) AS end_ts,
    CASE WHEN event_type = 'error' THEN 'failed with ' || props END AS error_message
  FROM events)""",
    "audit": f"""audit AS (
  SELECT CAST(user_id AS VARCHAR) AS file_id, {sql_pick(STEPS, "event_id")} AS step_name,
    CASE WHEN event_type = 'error' THEN 'FAILED' ELSE 'COMPLETED' END AS status, start_ts, end_ts, error_message
  FROM steps)""",
    "runs": f"""runs AS (
  SELECT {sql_pick(TASKS, "event_id")} AS name,
    CASE event_type WHEN 'error' THEN 'FAILED' WHEN 'signup' THEN 'SKIPPED' ELSE 'SUCCEEDED' END AS state,
    start_ts AS scheduled_time, end_ts AS completed_time, props AS return_value, error_message
  FROM steps)""",
    "loads": """loads AS (
  SELECT 'file_' || event_id || '.csv' AS file_name,
    CASE WHEN event_type = 'error' THEN 'LOAD_FAILED' ELSE 'LOADED' END AS status, event_id % 1000 AS row_count,
    error_message AS first_error_message, start_ts AS last_load_time
  FROM steps)""",
    "logs": """logs AS (
  SELECT start_ts AS ts, CASE event_type WHEN 'error' THEN 'ERROR ' || props WHEN 'click' THEN
    'Validated: incoming file' WHEN 'view' THEN 'moved to quarantine' ELSE event_type END AS message
  FROM steps)""",
    "searches": """searches AS (
  SELECT 'CLIENT_' || user_id % 3 AS client_account_id, event_type || ' ' || event_id AS search_term,
    CAST(user_id AS VARCHAR) AS result_file_id,
    CASE WHEN value > 60 THEN 'high' WHEN value > 20 THEN 'medium' ELSE 'low' END AS search_confidence,
    event_id % 6 AS result_count, CAST(round(value * 10) AS BIGINT) AS execution_time_ms, ts AS search_ts
  FROM events)""",
    "envelopes": """envelopes AS (
  SELECT CASE WHEN event_id % 10 = 0 THEN NULL
    WHEN event_id % 10 = 1 THEN 'metadata/src' || user_id % 20 || '/doc_' || event_id || '.csv'
    ELSE 'incoming/src' || user_id % 20 || '/doc_' || event_id || '.csv' END AS object_key
  FROM events)""",
    "trades": """trades AS (
  SELECT l_orderkey, CAST(l_linenumber AS BIGINT) AS l_linenumber, l_partkey, l_suppkey, CAST(l_quantity AS DECIMAL(18,2)) AS quantity,
    CAST(l_extendedprice AS DECIMAL(18,2)) AS gross, CAST(round(l_discount * 100) AS DECIMAL(18,2)) AS rate_pct,
    CAST(l_shipdate AS DATE) AS trade_date, l_returnflag,
    CASE WHEN l_linenumber % 2 = 1 THEN 'BUY' ELSE 'SELL' END AS side
  FROM lineitem)""",
}
_NEEDS = {
    **{name: ("docs",) for name in ("registry", "mapping", "collections", "sidecars", "landing", "texts", "classifications")},
    **{name: ("steps",) for name in ("audit", "runs", "loads", "logs")},
}


def with_tables(*names: str, also: str = "") -> str:
    """``WITH`` clause that defines the named adapters, plus extra expressions given as text."""
    order: list[str] = []
    for name in names:
        for needed in (*_NEEDS.get(name, ()), name):
            if needed not in order:
                order.append(needed)
    parts = [_CTE[name] for name in order] + ([also] if also else [])
    return "WITH " + ",\n".join(parts) + "\n"


def ts_text(expression: str) -> str:
    return f"strftime({expression}, '%Y-%m-%d %H:%M:%S.%f')"
