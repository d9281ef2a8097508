import hashlib
import json

import pytest
from pyspark.sql import functions as F

from ledgerleaf import schemas
from ledgerleaf.operators import route, state, validate
from ledgerleaf.sources import custody, envelopes, files, manifest, sidecars

AS_OF = "2024-03-01 12:00:00"
ALL = ["PDF", "XLSX", "CSV"]
COLLECTIONS = [
    ("US", "E-1", ALL, "S3", "Warehouse", True),
    ("US", "E-2", ALL, "S3", "warehouse", True),
    ("GB", "E-3", ALL, "S3", "Warehouse", False),
    ("US", "E-PDF", ["PDF"], "S3", "Warehouse", True),
]


def digest(data):
    return hashlib.sha256(data).hexdigest()


@pytest.fixture()
def landing_zone(tmp_path):
    """Files and sidecars on disk, one per case."""
    cases = {
        "good.pdf": {},
        "good.csv": {"Destination": "WAREHOUSE"},
        "tampered.pdf": {"filehash": "0" * 64},
        "stranger.pdf": {"legal_entity_id": "E-404"},
        "sleeping.pdf": {"custody_country": "GB", "legal_entity_id": "E-3"},
        "elsewhere.pdf": {"Destination": "Other"},
        "notes.txt": {},
        "sheet.csv": {"legal_entity_id": "E-PDF"},
        "nowhere.pdf": {"custody_country": None},
        "alone.pdf": None,
    }
    for number, (name, changes) in enumerate(cases.items()):
        data = f"content of {name}".encode()
        place = tmp_path / "incoming" / "ACC-1" / name
        place.parent.mkdir(parents=True, exist_ok=True)
        place.write_bytes(data)
        if changes is None:
            continue
        meta = {
            "file_id": f"id-{number}",
            "file_name": name,
            "file_format": name.split(".")[-1].upper(),
            "custody_country": "US",
            "legal_entity_id": "E-1",
            "allowed_formats": ALL,
            "Source": "S3",
            "Destination": "Warehouse",
            "Accountid": "ACC-1",
            "branch_id": "B-1",
            "filehash": digest(data),
            "file_size": len(data),
            "source_system": "TEST",
            **changes,
        }
        meta = {k: v for k, v in meta.items() if v is not None}
        side = tmp_path / "metadata" / f"id-{number}.json"
        side.parent.mkdir(exist_ok=True)
        side.write_text(json.dumps(meta, indent=2))
    (tmp_path / "metadata" / "broken.json").write_text("{not json")
    return tmp_path


def validated(spark, zone, **kw):
    landed = files.fingerprint(files.scan_documents(spark, f"{zone}/incoming"), str(zone))
    collections = spark.createDataFrame(COLLECTIONS, schemas.COLLECTION_REGISTRY)
    return validate.validate(landed, sidecars.scan_sidecars(spark, f"{zone}/metadata"), collections, **kw)


@pytest.mark.parametrize("match_on", [("file_name",), ("account_id", "file_name")])
def test_each_reason(spark, landing_zone, match_on):
    got = {r.file_name: r for r in validated(spark, landing_zone, match_on=match_on).collect()}
    assert {n: r.reason for n, r in got.items()} == {
        "good.pdf": "OK",
        "good.csv": "OK",
        "tampered.pdf": "hash_mismatch",
        "stranger.pdf": "unknown_collection",
        "sleeping.pdf": "inactive_collection",
        "elsewhere.pdf": "destination_mismatch",
        "notes.txt": "bad_format",
        "sheet.csv": "format_not_allowed",
        "nowhere.pdf": "bad_metadata",
        "alone.pdf": "no_metadata",
    }
    assert got["good.pdf"].dst_key == "validated/ACC-1/good.pdf"
    assert got["notes.txt"].dst_key == "quarantine/bad_format/notes.txt"
    assert got["notes.txt"].file_id is None and got["alone.pdf"].file_id is None
    assert got["sheet.csv"].reason_text == "Format CSV not in allowed_formats ['PDF'] for E-PDF"
    assert got["tampered.pdf"].reason_text.startswith("SHA-256 mismatch: expected 0000000000000000..., got ")


def test_first_sidecar_wins(spark):
    rows = [("b", "x.pdf", "h2"), ("a", "x.pdf", "h1"), ("c", "y.pdf", "h3")]
    side = spark.createDataFrame(rows, "file_id string, file_name string, file_hash string")
    got = {r.file_name: (r.file_id, r.file_hash) for r in validate.first_sidecar(side).collect()}
    assert got == {"x.pdf": ("a", "h1"), "y.pdf": ("c", "h3")}


def test_registering_twice_changes_nothing_but_time(spark, landing_zone):
    delta = validate.registry_delta(validated(spark, landing_zone))
    once = state.register(schemas.empty(spark, schemas.DOCUMENT_REGISTRY), delta, AS_OF)
    twice = state.register(once, delta, AS_OF)
    assert once.count() == 2
    assert sorted(map(tuple, once.collect())) == sorted(map(tuple, twice.collect()))


def test_final_documents_are_left_alone(spark, landing_zone):
    delta = validate.registry_delta(validated(spark, landing_zone))
    known = state.register(schemas.empty(spark, schemas.DOCUMENT_REGISTRY), delta, AS_OF).withColumn(
        "processing_status", F.lit("AVAILABLE")
    )
    after = state.register(known, delta, "2025-01-01")
    assert {r.processing_status for r in after.collect()} == {"AVAILABLE"}
    audit = validate.audit(validated(spark, landing_zone), known, AS_OF)
    assert {r.status for r in audit.collect()} == {"FAILED"}


def test_quarantine_alerts(spark, landing_zone):
    rows = validate.alerts(validated(spark, landing_zone)).collect()
    assert len(rows) == 8 and all(len(r.subject) <= 100 for r in rows)
    assert any("File ID: unknown" in r.message for r in rows)


def test_envelopes(spark):
    inner = json.dumps({"object": {"key": "incoming/a.pdf"}})
    bodies = [
        json.dumps({"detail": {"object": {"key": "incoming/b.pdf"}}}),
        inner,
        json.dumps({"detail": {"object": {"key": "metadata/c.json"}}}),
        "{oops",
        json.dumps({"detail": {}}),
    ]
    text = json.dumps({"Records": [{"body": b} for b in bodies]})
    parsed = envelopes.parse_bodies(envelopes.explode_records(spark.createDataFrame([(text,)], "value string")))
    got = [(r.object_key, r.outcome) for r in parsed.collect()]
    assert got == [
        ("incoming/b.pdf", "accepted"),
        ("incoming/a.pdf", "accepted"),
        ("metadata/c.json", "skipped"),
        (None, "malformed"),
        (None, "malformed"),
    ]
    results = spark.createDataFrame([(True,), (False,)], "success boolean")
    row = validate.run_counters(parsed, results).first()
    assert (row.processed, row.successes, row.failures) == (4, 1, 3)


def test_landing_rows_are_per_file(spark, landing_zone):
    rows = files.landing_rows(files.scan_documents(spark, f"{landing_zone}/incoming"), str(landing_zone), F.current_timestamp())
    assert rows.count() == 10
    row = rows.where("relative_path = 'incoming/ACC-1/good.pdf'").first()
    assert row.file_size == len("content of good.pdf")


REGISTRY = [
    ("1", "a.csv", "ACC-1", "B-1", "VALIDATED", None),
    ("2", "a.csv", "ACC-2", "B-1", "VALIDATED", None),
    ("3", "b.csv", "ACC-1", "B-1", "AVAILABLE", "C1"),
    ("4", "c.csv", "ACC-3", "B-1", "VALIDATED", None),
]
MAPPING = [
    ("ACC-1", "B-1", "One", "C1", "S1", True),
    ("ACC-2", "B-1", "Two", "C2", "S2", True),
    ("ACC-3", "B-1", "Three", "C3", "S3", False),
]


def routing_tables(spark):
    registry = spark.createDataFrame(
        REGISTRY,
        "file_id string, file_name string, account_id string, branch_id string, processing_status string, client_account_id string",
    ).withColumns({"current_location": F.lit("validated/x"), "updated_ts": F.lit("2020-01-01").cast("timestamp_ntz")})
    paths = [("validated/ACC-1/a.csv",)] * 2 + [("validated/ACC-1/b.csv",), ("validated/ACC-3/c.csv",), ("validated/ACC-9/z.csv",)]
    landing = spark.createDataFrame(paths, "relative_path string")
    return landing, registry, spark.createDataFrame(MAPPING, schemas.CLIENT_MAPPING)


def test_routing(spark):
    landing, registry, mapping = routing_tables(spark)
    routed = route.route(landing, registry, mapping)
    assert sorted((r.file_id, r.outcome, r.new_location) for r in routed.collect()) == [
        ("1", "routed", "@S1/a.csv"),
        ("3", "skipped", None),
    ]
    row = route.counters(routed).first()
    assert json.loads(row.result_json) == {"routed": 1, "skipped": 1, "failed": 0}
    delta = route.registry_delta(registry, routed, AS_OF).collect()
    assert [(r.file_id, r.client_account_id, r.processing_status) for r in delta] == [("1", "C1", "STAGED")]


def test_custody_reports(spark, tmp_path):
    (tmp_path / "t.csv").write_text(
        "Txn_ID,Account_No,Trade_Date,Settlement_Date,Security_Name,CUSIP,Txn_Type,Quantity,Price_USD,Gross_Value_USD,"
        "Commission_USD,Settlement_Fee_USD,Net_Value_USD\n"
        'T-1,ACC,2024-01-08,2024-01-10,Some Co.,037833100,BUY,"1,000",185.20,"185,200.00",185.20,15.00,"185,400.20"\n'
    )
    row = custody.scan_report(spark, str(tmp_path / "t.csv"), "transactions").first()
    assert (row.cusip, float(row.quantity), float(row.net_value_usd)) == ("037833100", 1000.0, 185400.20)
    assert str(row.settlement_date) == "2024-01-10"
    (tmp_path / "s.csv").write_text(
        "Surcharge_ID,Account_No,Invoice_Ref,Surcharge_Type,Description,Applied_Date,Base_Amount_USD,Surcharge_Rate,"
        "Surcharge_Amount_USD\nS-1,A,I,Fx,\"fee, fx\",2024-02-15,\"4,420.00\",0.25%,11.05\nS-2,A,I,Min,m,2024-02-29,0.00,flat,150.00\n"
    )
    rows = custody.scan_report(spark, str(tmp_path / "s.csv"), "surcharges").collect()
    assert [None if r.rate_pct is None else float(r.rate_pct) for r in rows] == [0.25, None]


def test_manifest(spark, tmp_path):
    entries = [
        {"path": "c:\\samples\\one_report.pdf", "type": "INVOICE", "client": "CLIENT_APEX", "format": "PDF"},
        {"path": "/samples/two.csv", "client": "SOMEONE", "format": "csv"},
    ]
    (tmp_path / "manifest.json").write_text(json.dumps(entries, indent=1))
    scanned = manifest.scan_manifest(spark, str(tmp_path / "manifest.json"))
    rows = {r.file_name: r for r in manifest.manifest_metadata(scanned, schemas.manifest_clients(spark)).collect()}
    assert rows["one_report.pdf"].incoming_key == "incoming/GB-CUST-00421/one_report.pdf"
    assert (rows["two.csv"].legal_entity_id, rows["two.csv"].document_type_hint) == ("UNKNOWN", "UNKNOWN")
    totals = {r.file_format: r.files for r in manifest.uploads_by_format(manifest.manifest_metadata(scanned, schemas.manifest_clients(spark))).collect()}
    assert totals == {"PDF": 1, "CSV": 1, "TOTAL": 2}
