"""Validation, envelopes, routing and manifest over the driver's tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerleaf.operators import reports, route, state, validate
from ledgerleaf.plans.adapters import Tables, pick, sql_pick, ts_text, with_tables
from ledgerleaf.plans.catalog import query
from ledgerleaf.schemas import MANIFEST_CLIENTS, PAST_STAGING, VALIDATION_FINAL, manifest_clients
from ledgerleaf.sources import envelopes, manifest

AS_OF = "2024-02-01 00:00:00"

_CHECKED = with_tables(
    "sidecars",
    "collections",
    also="""first_sidecar AS (
  SELECT * FROM sidecars s WHERE NOT EXISTS (
    SELECT 1 FROM sidecars o WHERE o.file_name = s.file_name AND o.file_id < s.file_id)),
landed AS (
  SELECT 'incoming/' || account_id || '/' || file_name AS path, file_name, file_format AS ext, sha256(text) AS actual_hash
  FROM docs),
checked AS (
  SELECT l.path, l.file_name, l.ext, l.actual_hash, s.file_id, s.custody_country, s.legal_entity_id,
    s.file_hash, s.destination, s.account_id, c.destination AS reg_destination, c.allowed_formats,
    CASE WHEN l.ext NOT IN ('PDF', 'XLSX', 'CSV') THEN 'bad_format'
      WHEN s.file_id IS NULL THEN 'no_metadata'
      WHEN l.actual_hash <> s.file_hash THEN 'hash_mismatch'
      WHEN coalesce(s.custody_country, '') = '' OR coalesce(s.legal_entity_id, '') = '' THEN 'bad_metadata'
      WHEN c.legal_entity_id IS NULL THEN 'unknown_collection'
      WHEN coalesce(s.destination, '') <> '' AND coalesce(c.destination, '') <> ''
        AND lower(s.destination) <> lower(c.destination) THEN 'destination_mismatch'
      WHEN NOT coalesce(c.active_flag, false) THEN 'inactive_collection'
      WHEN NOT list_contains(c.allowed_formats, l.ext) THEN 'format_not_allowed'
      ELSE 'OK' END AS reason
  FROM landed l LEFT JOIN first_sidecar s ON l.file_name = s.file_name
  LEFT JOIN collections c ON s.custody_country = c.custody_country AND s.legal_entity_id = c.legal_entity_id),
validated AS (
  SELECT path, file_name, ext, reason, reason = 'OK' AS success, account_id,
    CASE WHEN reason <> 'bad_format' THEN file_id END AS file_id,
    CASE WHEN reason = 'OK' THEN 'validated/' || account_id || '/' || file_name
      ELSE 'quarantine/' || reason || '/' || file_name END AS dst_key,
    CASE reason WHEN 'bad_format' THEN 'Unsupported format: ' || ext
      WHEN 'no_metadata' THEN 'Metadata JSON not found in S3'
      WHEN 'hash_mismatch' THEN 'SHA-256 mismatch: expected ' || file_hash[1:16] || '..., got ' || actual_hash[1:16] || '...'
      WHEN 'bad_metadata' THEN 'Missing custody_country or legal_entity_id in metadata'
      WHEN 'unknown_collection' THEN 'Not found in CustodyCollectionRegistry: country=' || custody_country
        || ', legal_entity_id=' || legal_entity_id
      WHEN 'destination_mismatch' THEN 'Destination mismatch: metadata=' || destination || ', registry=' || reg_destination
      WHEN 'inactive_collection' THEN 'CustodyCollectionRegistry entry inactive: ' || custody_country || '/' || legal_entity_id
      WHEN 'format_not_allowed' THEN 'Format ' || ext || ' not in allowed_formats ['
        || list_aggregate(list_transform(list_sort(allowed_formats), lambda f: '''' || f || ''''), 'string_agg', ', ')
        || '] for ' || legal_entity_id
      ELSE 'OK' END AS reason_text
  FROM checked)""",
)


def _validated(t: Tables) -> DataFrame:
    return validate.validate(t.files, t.sidecars, t.collections)


@query(
    "validate_documents",
    _CHECKED + "SELECT path, file_id, success, reason, reason_text, dst_key FROM validated",
)
def validate_documents(t: Tables) -> DataFrame:
    return _validated(t).select("path", "file_id", "success", "reason", "reason_text", "dst_key")


@query(
    "validate_in_account",
    # File names are unique per account here, so the account-aware match must give the same answer.
    _CHECKED + "SELECT path, file_id, success, reason, dst_key FROM validated",
)
def validate_in_account(t: Tables) -> DataFrame:
    results = validate.validate(t.files, t.sidecars, t.collections, match_on=("account_id", "file_name"))
    return results.select("path", "file_id", "success", "reason", "dst_key")


@query(
    "quarantine_counts",
    _CHECKED
    + """SELECT split_part(dst_key, '/', 1) AS prefix, count(*) AS objects,
  CASE WHEN split_part(dst_key, '/', 1) = 'quarantine' THEN 'WARN' ELSE 'OK' END AS level
FROM validated GROUP BY 1, 3""",
)
def quarantine_counts(t: Tables) -> DataFrame:
    return reports.prefix_counts(validate.dispositions(_validated(t)), "dst_key")


@query(
    "disposition_split",
    _CHECKED
    + """SELECT CASE WHEN success THEN 'validated' ELSE 'quarantine' END AS disposition, reason, count(*) AS files
FROM validated GROUP BY 1, 2""",
)
def disposition_split(t: Tables) -> DataFrame:
    split = validate.dispositions(_validated(t))
    return split.groupBy("disposition", "reason").agg(F.count(F.lit(1)).alias("files"))


@query(
    "validation_audit",
    _CHECKED
    + f"""SELECT v.file_id, 'VALIDATE' AS step_name, CASE WHEN v.success THEN 'VALIDATED' ELSE 'FAILED' END AS status,
  '{AS_OF}.000000' AS start_ts, '{AS_OF}.000000' AS end_ts,
  CASE WHEN NOT v.success THEN v.reason_text END AS error_message
FROM validated v LEFT JOIN docs d ON v.file_id = d.file_id
WHERE v.file_id IS NOT NULL AND NOT (v.success AND d.processing_status IN {VALIDATION_FINAL})""",
)
def validation_audit(t: Tables) -> DataFrame:
    return validate.audit(_validated(t), t.registry, AS_OF)


@query(
    "validation_alerts",
    _CHECKED
    + """SELECT 'Quarantine: ' || reason AS subject, 'File: ' || path || chr(10) || 'Reason: ' || reason_text || chr(10)
  || 'File ID: ' || coalesce(file_id, 'unknown') AS message FROM validated WHERE NOT success""",
)
def validation_alerts(t: Tables) -> DataFrame:
    return validate.alerts(_validated(t))


@query(
    "register_validated",
    _CHECKED
    + f"""SELECT d.file_id, CASE WHEN v.file_id IS NOT NULL AND d.processing_status NOT IN {VALIDATION_FINAL}
    THEN 'VALIDATED' ELSE d.processing_status END AS processing_status,
  CASE WHEN v.file_id IS NOT NULL AND d.processing_status NOT IN {VALIDATION_FINAL}
    THEN v.dst_key ELSE 'validated/' || d.account_id || '/' || d.file_name END AS current_location,
  CASE WHEN v.file_id IS NOT NULL AND d.processing_status NOT IN {VALIDATION_FINAL}
    THEN '{AS_OF}.000000' ELSE {ts_text("d.updated_ts")} END AS updated_ts
FROM docs d LEFT JOIN validated v ON d.file_id = v.file_id AND v.success WHERE d.doc_id % 4 <> 1
UNION ALL
SELECT v.file_id, 'VALIDATED', v.dst_key, '{AS_OF}.000000'
FROM validated v JOIN docs d ON d.file_id = v.file_id WHERE v.success AND d.doc_id % 4 = 1""",
)
def register_validated(t: Tables) -> DataFrame:
    """A registry that does not know the CSV files yet: those are inserted, the others updated or left."""
    known = t.registry.where(F.col("file_id").cast("bigint") % 4 != 1)
    after = state.register(known, validate.registry_delta(_validated(t)), AS_OF)
    return after.select("file_id", "processing_status", "current_location", "updated_ts")


@query(
    "event_envelope_parse",
    with_tables("envelopes")
    + """SELECT object_key, CASE WHEN object_key IS NULL THEN 'malformed'
  WHEN object_key NOT LIKE 'incoming/%' THEN 'skipped' ELSE 'accepted' END AS outcome FROM envelopes""",
)
def event_envelope_parse(t: Tables) -> DataFrame:
    return envelopes.parse_bodies(envelopes.explode_records(t.envelopes)).select("object_key", "outcome")


@query(
    "envelope_counters",
    with_tables("envelopes")
    + """, counted AS (
  SELECT count(*) FILTER (object_key IS NULL OR object_key LIKE 'incoming/%') AS processed,
    count(*) FILTER (object_key LIKE 'incoming/%') AS successes, count(*) FILTER (object_key IS NULL) AS failures
  FROM envelopes)
SELECT *, '{"processed":' || processed || ',"successes":' || successes || ',"failures":' || failures || '}' AS result_json
FROM counted""",
)
def envelope_counters(t: Tables) -> DataFrame:
    """Counters of a run in which every announced file is valid."""
    parsed = envelopes.parse_bodies(envelopes.explode_records(t.envelopes))
    accepted = parsed.where(F.col("outcome") == "accepted").select(F.lit(True).alias("success"))
    return validate.run_counters(parsed, accepted)


_ROUTED = with_tables(
    "registry",
    "mapping",
    "landing",
    also=f"""landed AS (
  SELECT DISTINCT relative_path, split_part(relative_path, '/', -2) AS account_id,
    split_part(relative_path, '/', -1) AS file_name FROM landing),
routed AS (
  SELECT l.relative_path, r.file_id, m.client_account_id, r.client_account_id AS old_client, r.doc_id,
    CASE WHEN r.processing_status IN {PAST_STAGING} THEN 'skipped' ELSE 'routed' END AS outcome,
    CASE WHEN r.processing_status NOT IN {PAST_STAGING}
      THEN '@' || m.client_stage_name || '/' || l.file_name END AS new_location
  FROM landed l JOIN registry r ON l.account_id = r.account_id AND l.file_name = r.file_name
  JOIN mapping m ON r.account_id = m.account_id AND r.branch_id = m.branch_id AND m.active_flag)""",
)


def _routed(t: Tables) -> DataFrame:
    return route.route(t.landing, t.registry, t.mapping)


@query(
    "route_documents",
    _ROUTED + "SELECT relative_path, file_id, client_account_id, outcome, new_location FROM routed",
)
def route_documents(t: Tables) -> DataFrame:
    return _routed(t).select("relative_path", "file_id", "client_account_id", "outcome", "new_location")


@query(
    "route_counters",
    _ROUTED
    + """, counted AS (
  SELECT count(*) FILTER (outcome = 'routed') AS routed, count(*) FILTER (outcome = 'skipped') AS skipped,
    CAST(0 AS BIGINT) AS failed FROM routed)
SELECT *, '{"routed":' || routed || ',"skipped":' || skipped || ',"failed":' || failed || '}' AS result_json FROM counted""",
)
def route_counters(t: Tables) -> DataFrame:
    return route.counters(_routed(t))


@query(
    "route_registry_delta",
    _ROUTED
    + f"""SELECT file_id, coalesce(old_client, client_account_id) AS client_account_id, new_location AS current_location,
  'STAGED' AS processing_status, '{AS_OF}.000000' AS updated_ts FROM routed WHERE outcome = 'routed'""",
)
def route_registry_delta(t: Tables) -> DataFrame:
    delta = route.registry_delta(t.registry, _routed(t), AS_OF)
    return delta.select("file_id", "client_account_id", "current_location", "processing_status", "updated_ts")


@query(
    "route_audit",
    _ROUTED
    + f"""SELECT DISTINCT file_id, 'ROUTE' AS step_name, 'COMPLETED' AS status, '{AS_OF}.000000' AS start_ts,
  '{AS_OF}.000000' AS end_ts, CAST(NULL AS VARCHAR) AS error_message FROM routed WHERE outcome = 'routed'""",
)
def route_audit(t: Tables) -> DataFrame:
    return route.audit(_routed(t), AS_OF, AS_OF)


@query(
    "set_client_if_null",
    _ROUTED
    + """SELECT r.file_id, coalesce(r.client_account_id, o.client_account_id) AS client_account_id
FROM registry r LEFT JOIN (SELECT * FROM routed WHERE outcome = 'routed') o ON r.file_id = o.file_id""",
)
def set_client_if_null(t: Tables) -> DataFrame:
    after = state.set_client_if_null(t.registry, route.routed_documents(_routed(t)))
    return after.select("file_id", "client_account_id")


_CLIENTS = (*dict.fromkeys(c for c, *_ in MANIFEST_CLIENTS), "NOBODY")
_MANIFEST = with_tables(
    "docs",
    also=f"""clients(client, country, entity, branch) AS (VALUES {", ".join(map(str, MANIFEST_CLIENTS))}),
entries AS (
  SELECT file_name, file_format, {sql_pick(_CLIENTS, "doc_id")} AS client,
    CASE WHEN doc_id % 12 <> 0 THEN 'REPORT_' || doc_id % 9 END AS type FROM docs),
metadata AS (
  SELECT file_name, file_format, coalesce(country, 'US') AS custody_country, coalesce(entity, 'UNKNOWN') AS legal_entity_id,
    coalesce(entity, 'UNKNOWN') AS account_id, coalesce(branch, 'UNKNOWN') AS branch_id,
    coalesce(type, 'UNKNOWN') AS document_type_hint,
    CASE file_format WHEN 'PDF' THEN 'application/pdf' WHEN 'CSV' THEN 'text/csv'
      WHEN 'XLSX' THEN 'application/vnd.openxmlformats-officedocument.spreadsheetml.sheet'
      ELSE 'application/octet-stream' END AS content_type,
    file_format AS listed_format, 'incoming/' || coalesce(entity, 'UNKNOWN') || '/' || file_name AS incoming_key
  FROM entries LEFT JOIN clients USING (client))""",
)


def _manifest(t: Tables) -> DataFrame:
    i = F.col("doc_id")
    entries = t.docs.select(
        F.concat(F.lit("c:\\samples\\"), "file_name").alias("path"),
        F.when(i % 12 != 0, F.concat(F.lit("REPORT_"), (i % 9).cast("string"))).alias("type"),
        pick(_CLIENTS, i).alias("client"),
        F.lower("file_format").alias("format"),
    )
    return manifest.manifest_metadata(entries, manifest_clients(t.spark))


@query("manifest_metadata", _MANIFEST + "SELECT * FROM metadata")
def manifest_metadata(t: Tables) -> DataFrame:
    return _manifest(t)


@query(
    "uploads_by_format",
    _MANIFEST
    + """SELECT coalesce(listed_format, 'TOTAL') AS file_format, count(*) AS files
FROM metadata GROUP BY ROLLUP (listed_format)""",
)
def uploads_by_format(t: Tables) -> DataFrame:
    return manifest.uploads_by_format(_manifest(t))
