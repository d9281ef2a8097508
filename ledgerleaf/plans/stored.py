"""Writers and readers: rows derived from the driver's tables go through a sink into the shared folder and come back."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerleaf import sinks
from ledgerleaf.operators import archive, classify, measures, search, validate
from ledgerleaf.plans import intake, lifecycle
from ledgerleaf.plans.adapters import Tables, with_tables
from ledgerleaf.plans.catalog import ORACLES, query
from ledgerleaf.session import new_path
from ledgerleaf.sources import sidecars


def _path(t: Tables, label: str) -> str:
    return new_path(t.spark, label)


@query("dispositions_written", ORACLES["disposition_split"])
def dispositions_written(t: Tables) -> DataFrame:
    """Validated and quarantined files, stored side by side and counted by folder."""
    path = _path(t, "dispositions")
    sinks.write_dispositions(validate.dispositions(intake._validated(t)), path)
    return t.spark.read.parquet(path).groupBy("disposition", "reason").agg(F.count(F.lit(1)).alias("files"))


@query(
    "clients_written",
    with_tables("docs", "chunks") + "SELECT client_account_id, file_id, chunk_index, chunk_text FROM chunks",
)
def clients_written(t: Tables) -> DataFrame:
    path = _path(t, "by-client")
    sinks.write_by_client(t.chunks.select("client_account_id", "file_id", "chunk_index", "chunk_text"), path)
    return t.spark.read.parquet(path).select("client_account_id", "file_id", "chunk_index", "chunk_text")


@query("archive_written", ORACLES["archive_payload"])
def archive_written(t: Tables) -> DataFrame:
    files = t.docs.select(
        F.concat_ws("/", F.lit("validated"), "account_id", "file_name").alias("location"), F.encode("text", "utf-8").alias("content")
    )
    path = _path(t, "archive")
    sinks.write_archive(archive.payload(archive.candidates(t.registry, lifecycle.AS_OF, ordered=False), files), path)
    stored = t.spark.read.parquet(path)
    return stored.select("account_id", "file_id", "archive_path", F.octet_length("content").cast("bigint").alias("bytes"))


@query("alerts_written", ORACLES["archive_alerts"])
def alerts_written(t: Tables) -> DataFrame:
    path = _path(t, "alerts")
    sinks.write_alerts(archive.alerts(lifecycle._archived(t)), path)
    return t.spark.read.parquet(path)


@query(
    "workflow_alerts",
    with_tables("docs")
    + """SELECT 'Document archive workflow FAILED' AS subject, NULL::VARCHAR AS file_id, 'Error: ' || file_name AS message
FROM docs""",
)
def workflow_alerts(t: Tables) -> DataFrame:
    return archive.workflow_alert(t.docs.select(F.col("file_name").alias("error")))


@query(
    "collections_scanned",
    with_tables("docs", "collections")
    + "SELECT custody_country, legal_entity_id, array_to_string(allowed_formats, ',') AS allowed_formats, destination, active_flag FROM collections",
)
def collections_scanned(t: Tables) -> DataFrame:
    path = _path(t, "collections")
    t.collections.write.json(path)
    return sidecars.scan_collections(t.spark, path).select("custody_country", "legal_entity_id", "allowed_formats", "destination", "active_flag")


@query(
    "client_mapping_scanned",
    with_tables("docs", "mapping") + "SELECT account_id, branch_id, client_name, client_account_id, active_flag FROM mapping",
)
def client_mapping_scanned(t: Tables) -> DataFrame:
    path = _path(t, "mapping")
    t.mapping.write.parquet(path)
    return sidecars.scan_client_mapping(t.spark, path).select("account_id", "branch_id", "client_name", "client_account_id", "active_flag")


@query(
    "reconcile_surcharges",
    """SELECT l_orderkey, l_linenumber, 'surcharge' AS failed_checks FROM lineitem
WHERE l_linenumber = 2""",
)
def reconcile_surcharges(t: Tables) -> DataFrame:
    """Surcharges of every line item, a cent and a half off on one line number; flat ones on another are not checked."""
    base = F.col("l_extendedprice").cast("decimal(18,2)")
    right = F.round(base * F.lit("0.0025").cast("decimal(6,4)"), 2).cast("decimal(18,2)")
    rows = t.raw("lineitem").select(
        "l_orderkey",
        "l_linenumber",
        base.alias("base_amount_usd"),
        F.when(F.col("l_linenumber") != 3, F.lit("0.25").cast("decimal(9,4)")).alias("rate_pct"),
        (right + F.when(F.col("l_linenumber").isin(2, 3), F.lit("0.02")).otherwise(F.lit("0.00")).cast("decimal(4,2)")).alias("surcharge_amount_usd"),
    )
    return measures.reconcile_surcharges(rows).select("l_orderkey", "l_linenumber", "failed_checks")


@query(
    "reconcile_income",
    """SELECT l_orderkey, l_linenumber, CASE l_linenumber WHEN 4 THEN 'net' WHEN 5 THEN 'processing_fee' ELSE 'net,processing_fee' END AS failed_checks
FROM lineitem WHERE l_linenumber IN (4, 5, 6)""",
)
def reconcile_income(t: Tables) -> DataFrame:
    """Income rows of every line item: the net is off on 4, the fee on 5, and on 6 the fee is missing and the net off."""
    gross = F.col("l_extendedprice").cast("decimal(18,2)")
    off = lambda *lines: F.when(F.col("l_linenumber").isin(*lines), F.lit("0.02")).otherwise(F.lit("0.00")).cast("decimal(4,2)")
    withheld = measures.withheld(gross, F.lit("15").cast("decimal(6,2)"))
    rows = t.raw("lineitem").select(
        "l_orderkey",
        "l_linenumber",
        gross.alias("gross_amount_usd"),
        withheld.alias("tax_withheld_usd"),
        (measures.income_net(gross, withheld) + off(4, 6)).alias("net_amount_usd"),
        F.when(F.col("l_linenumber") != 6, measures.processing_fee(gross) + off(5)).alias("processing_fee_usd"),
    )
    return measures.reconcile_income(rows).select("l_orderkey", "l_linenumber", "failed_checks")


@query(
    "classification_prompts",
    with_tables("docs")
    + """SELECT file_id, length(file_name) + length(substr(text, 1, 1500)) AS filled, true AS has_name, true AS has_start FROM docs""",
)
def classification_prompts(t: Tables) -> DataFrame:
    """What a prompt adds for a document: its name and the start of its text, and nothing else."""
    excerpt = F.substring("text", 1, classify.EXCERPT_CHARS)
    made, bare = classify.prompt(F.col("file_name"), excerpt), classify.prompt(F.lit(""), F.lit(""))
    return t.heavy_docs.select(
        "file_id",
        (F.char_length(made) - F.char_length(bare)).cast("bigint").alias("filled"),
        F.contains(made, F.col("file_name")).alias("has_name"),
        F.contains(made, excerpt).alias("has_start"),
    )


@query(
    "rerank_prompts",
    with_tables("docs")
    + """SELECT file_id, '[Candidate 1] FILE_ID=' || file_id || chr(10) || substr(text, 1, 800) AS first_lines FROM docs""",
)
def rerank_prompts(t: Tables) -> DataFrame:
    """The candidate's part of a prompt with one candidate."""
    excerpt = F.substring("text", 1, search.EXCERPT_CHARS)
    asked = search.rerank_prompt(F.lit("q"), F.array(F.struct("file_id", excerpt.alias("excerpt"))))
    head = "[Candidate 1] FILE_ID="
    size = F.char_length(F.concat(F.lit(head), F.col("file_id"), F.lit("\n"), excerpt))
    return t.heavy_docs.select("file_id", F.substr(asked, F.instr(asked, head), size).alias("first_lines"))
