"""Streams over the driver's tables; each drains what is there and hands back what it wrote."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerleaf.operators import models, reports
from ledgerleaf.plans.adapters import Tables, ts_text, with_tables
from ledgerleaf.plans.catalog import query
from ledgerleaf.plans.texts import sql_classified
from ledgerleaf.schemas import PAST_STAGING
from ledgerleaf.session import new_path
from ledgerleaf.streaming import pipeline

AS_OF = "2024-02-01 00:00:00"


def _stream(t: Tables) -> Tables:
    """The same adapters over a stream of the documents."""
    schema = t.raw("documents").schema

    class Streamed(Tables):
        def raw(self, name: str) -> DataFrame:
            if name != "documents":
                return super().raw(name)
            # a pattern, since a stream refuses the plain path of a file; it finds a table of one file or a folder of them
            return self.spark.readStream.schema(schema).parquet(f"{self.sf_dir}/documents.parque[t]")

    return Streamed(t.spark, t.sf_dir)


@query(
    "landing_stream",
    with_tables("landing")
    + f"""SELECT relative_path, file_size, {ts_text("last_modified")} AS last_modified, {ts_text("loaded_ts")} AS loaded_ts
FROM landing""",
)
def landing_stream(t: Tables) -> DataFrame:
    """Append-only capture of the landing rows."""
    out, checkpoint = new_path(t.spark, "landing"), new_path(t.spark, "landing-checkpoint")
    rows = _stream(t).landing
    writer = rows.writeStream.format("parquet").option("path", out).option("checkpointLocation", checkpoint)
    writer.trigger(availableNow=True).start().awaitTermination()
    return t.spark.read.schema(rows.schema).parquet(out)


_CHAIN = with_tables(
    "registry",
    "mapping",
    also=f"""routed AS (
  SELECT r.*, r.client_account_id AS old_client, m.client_account_id AS new_client,
    processing_status NOT IN {PAST_STAGING} AS moves
  FROM registry r JOIN mapping m USING (account_id, branch_id) WHERE m.active_flag AND r.doc_id % 5 <> 0)""",
)


def _chain(t: Tables) -> pipeline.Pipeline:
    """Runs the chain over all landed documents; text files and CSVs hold their text, the rest cannot be read."""
    run = pipeline.Pipeline(
        t.spark, new_path(t.spark, "chain"), t.mapping, models.hashing_embedder(64), extractors={"TXT": bytes.decode}
    )
    run.registry.write(t.registry, 0)
    i = F.col("doc_id")
    files = _stream(t).docs.where(i % 5 != 0).select(
        F.concat_ws("/", F.lit("validated"), "account_id", "file_name").alias("relative_path"),
        F.octet_length("text").cast("bigint").alias("file_size"),
        F.col("created_ts").alias("last_modified"),
        F.col("updated_ts").alias("loaded_ts"),
        F.encode("text", "utf-8").alias("content"),
    )
    pipeline.start(run, files, new_path(t.spark, "chain-checkpoint"), lambda batch: AS_OF).awaitTermination()
    return run


@query(
    "chain_stream",
    _CHAIN
    + f"""SELECT r.file_id, CASE WHEN NOT coalesce(x.moves, false) THEN r.processing_status
    WHEN r.file_format IN ('PDF', 'XLSX') THEN 'FAILED' ELSE 'AVAILABLE' END AS processing_status,
  CASE WHEN coalesce(x.moves, false) THEN coalesce(x.old_client, x.new_client) ELSE r.client_account_id END
    AS client_account_id,
  CASE WHEN coalesce(x.moves, false) THEN '{AS_OF}.000000' ELSE {ts_text("r.updated_ts")} END AS updated_ts
FROM registry r LEFT JOIN routed x ON r.file_id = x.file_id""",
)
def chain_stream(t: Tables) -> DataFrame:
    """Registry after the chain."""
    after = _chain(t).registry.current()
    return after.select("file_id", "processing_status", "client_account_id", "updated_ts")


@query(
    "chain_stream_audit",
    _CHAIN
    + """, steps AS (
  SELECT 'ROUTE' AS step_name, 'COMPLETED' AS status, count(*) AS n FROM routed WHERE moves
  UNION ALL SELECT 'EXTRACT', CASE WHEN file_format IN ('PDF', 'XLSX') THEN 'FAILED' ELSE 'COMPLETED' END, count(*)
    FROM routed WHERE moves GROUP BY ALL
  UNION ALL SELECT s, 'COMPLETED', count(*) FROM routed, (VALUES ('EMBED'), ('CLASSIFY')) AS v(s)
    WHERE moves AND file_format NOT IN ('PDF', 'XLSX') GROUP BY ALL)
SELECT step_name, status, n AS attempts FROM steps""",
)
def chain_stream_audit(t: Tables) -> DataFrame:
    audit = _chain(t).audit.changes()
    return audit.groupBy("step_name", "status").agg(F.count(F.lit(1)).alias("attempts"))


@query(
    "chain_stream_mix",
    _CHAIN
    + f""", texts AS (SELECT file_id, file_name, text FROM routed JOIN documents USING (doc_id)
  WHERE moves AND file_format = 'TXT'),
scored AS ({sql_classified("texts", "file_name", "text")})
SELECT best.type AS document_type, CASE WHEN len(best.hits) >= 2 THEN 'high' WHEN len(best.hits) = 1 THEN 'medium'
    ELSE 'low' END AS classification_confidence, 'keyword-rules' AS model_name, count(*) AS file_count
FROM scored GROUP BY ALL""",
)
def chain_stream_mix(t: Tables) -> DataFrame:
    """Classification mix of the text files that went through the chain."""
    run = _chain(t)
    names = run.registry.current().where(F.col("file_format") == "TXT").select("file_id")
    return reports.classification_mix(run.classifications().join(names, "file_id", "left_semi"))
