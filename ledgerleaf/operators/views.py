"""Tenant views: what one client may list.

The client is an argument. These are filters, not a security boundary: enforce access where the tables live.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerleaf.schemas import TENANT_VISIBLE


def _own_documents(registry: DataFrame, mapping: DataFrame, client: str) -> DataFrame:
    mine = mapping.where((F.col("client_account_id") == client) & F.col("active_flag")).select("account_id", "branch_id")
    visible = registry.where(F.col("processing_status").isin(*TENANT_VISIBLE))
    return visible.join(mine, ["account_id", "branch_id"], "left_semi")


def my_documents(registry: DataFrame, mapping: DataFrame, client: str) -> DataFrame:
    return _own_documents(registry, mapping, client).select(
        "file_id",
        "file_name",
        "file_format",
        "document_type",
        "processing_status",
        "file_size",
        "created_ts",
        "updated_ts",
    )


def my_document_classifications(
    registry: DataFrame, classifications: DataFrame, mapping: DataFrame, client: str
) -> DataFrame:
    own = _own_documents(registry, mapping, client).select("file_id", "file_name")
    return own.join(classifications, "file_id").select(
        "file_id",
        "file_name",
        "document_type",
        "classification_confidence",
        "doc_summary",
        "key_indicators",
        "classified_ts",
    )


def my_search_history(searches: DataFrame, client: str) -> DataFrame:
    """Newest first."""
    return (
        searches.where(F.col("client_account_id") == client)
        .drop("client_account_id")
        .orderBy(F.desc("search_ts"), "search_term")
    )


def my_document_chunks(chunks: DataFrame, mapping: DataFrame, client: str) -> DataFrame:
    """The embedding stays behind; the scan does not even read it."""
    active = mapping.where((F.col("client_account_id") == client) & F.col("active_flag")).select("client_account_id")
    own = chunks.where(F.col("client_account_id") == client)
    return own.join(active, "client_account_id", "left_semi").select(
        "file_id", "chunk_index", "chunk_text", "token_count", "created_ts"
    )


# The views as SQL table functions of the client; TENANT_VISIBLE stands for the statuses a tenant may see.
# A function's argument can be used one query deep, so the client's accounts are a joined query and no EXISTS.
_OWN = """FROM {registry} AS r JOIN (SELECT DISTINCT m.account_id, m.branch_id FROM {mapping} AS m WHERE m.client_account_id = client AND m.active_flag) AS a
  ON r.account_id = a.account_id AND r.branch_id = a.branch_id WHERE r.processing_status IN {visible}"""
FUNCTIONS = {
    "my_documents": (
        "file_id STRING, file_name STRING, file_format STRING, document_type STRING, processing_status STRING, file_size BIGINT, "
        "created_ts TIMESTAMP_NTZ, updated_ts TIMESTAMP_NTZ",
        f"""SELECT r.file_id, r.file_name, r.file_format, r.document_type, r.processing_status, r.file_size, r.created_ts, r.updated_ts
{_OWN}""",
    ),
    "my_classifications": (
        "file_id STRING, file_name STRING, document_type STRING, classification_confidence STRING, doc_summary STRING, "
        "key_indicators STRING, classified_ts TIMESTAMP_NTZ",
        f"""SELECT c.file_id, o.file_name, c.document_type, c.classification_confidence, c.doc_summary, c.key_indicators, c.classified_ts
FROM {{classifications}} AS c JOIN (SELECT r.file_id, r.file_name {_OWN}) AS o ON c.file_id = o.file_id""",
    ),
    "my_search_history": (
        "search_term STRING, result_file_id STRING, search_confidence STRING, result_count BIGINT, execution_time_ms BIGINT, search_ts TIMESTAMP_NTZ",
        """SELECT s.search_term, s.result_file_id, s.search_confidence, s.result_count, s.execution_time_ms, s.search_ts
FROM {searches} AS s WHERE s.client_account_id = client""",
    ),
    "my_chunks": (
        "file_id STRING, chunk_index INT, chunk_text STRING, token_count BIGINT, created_ts TIMESTAMP_NTZ",
        """SELECT k.file_id, k.chunk_index, k.chunk_text, k.token_count, k.created_ts
FROM {chunks} AS k JOIN (SELECT DISTINCT m.client_account_id FROM {mapping} AS m WHERE m.client_account_id = client AND m.active_flag) AS a
  ON k.client_account_id = a.client_account_id WHERE k.client_account_id = client""",
    ),
}


def create_functions(spark: SparkSession, temporary: bool = True, **tables: str) -> None:
    """Makes the views callable as ``SELECT * FROM my_documents('CLIENT_1')``.

    ``tables`` names the tables or views that they read: registry, mapping, classifications, searches, chunks. A function
    whose tables are not all named is left out. Functions that are not temporary need tables of the catalog. An argument
    is a value, never text of the query.
    """
    given = {**tables, "visible": "('" + "', '".join(TENANT_VISIBLE) + "')"}
    for name, (columns, body) in FUNCTIONS.items():
        try:
            query = body.format(**given)
        except KeyError:
            continue
        kind = "TEMPORARY FUNCTION" if temporary else "FUNCTION"
        spark.sql(f"CREATE OR REPLACE {kind} {name}(client STRING) RETURNS TABLE ({columns}) RETURN {query}")
