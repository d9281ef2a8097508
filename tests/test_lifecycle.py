from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from ledgerleaf import schemas, sinks
from ledgerleaf.operators import archive, measures, models, reports, sizing, state
from ledgerleaf.sources import files
from ledgerleaf.streaming import pipeline

AS_OF = "2024-03-01 12:00:00"


def registry_rows(spark, rows):
    """(file_id, status, created, updated) to a full registry."""
    base = spark.createDataFrame(rows, "file_id string, processing_status string, created string, updated string")
    filled = {f.name: F.lit(None).cast(f.dataType) for f in schemas.DOCUMENT_REGISTRY.fields if f.name not in ("file_id", "processing_status")}
    filled |= {
        "file_name": F.concat("file_id", F.lit(".csv")),
        "file_format": F.lit("CSV"),
        "account_id": F.lit("A"),
        "current_location": F.concat(F.lit("validated/A/"), "file_id"),
        "created_ts": F.col("created").cast("timestamp_ntz"),
        "updated_ts": F.col("updated").cast("timestamp_ntz"),
    }
    return base.withColumns(filled).select(*schemas.DOCUMENT_REGISTRY.names)


def as_set(df):
    return sorted(map(str, df.collect()))


def test_pick_per_key_with_a_hot_key(spark):
    df = spark.range(20_000).select(
        F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(F.col("id").cast("string")).alias("k"), (F.col("id") * 7 % 20_011).alias("o"), "id"
    )
    picked = state.pick_per_key(df, ["k"], "o")
    assert picked.where("k = 'hot'").first().o == df.where("k = 'hot'").agg(F.max("o")).first()[0]
    assert picked.count() == df.select("k").distinct().count()
    earliest = state.pick_per_key(df, ["k"], "o", latest=False).where("k = 'hot'").first()
    assert earliest.o == df.where("k = 'hot'").agg(F.min("o")).first()[0]


def test_upsert_guard_and_columns(spark):
    base = spark.createDataFrame([("a", 1, "x"), ("b", 2, "y")], "k string, v int, s string")
    delta = spark.createDataFrame([("a", 10), ("b", 20), ("c", 30)], "k string, v int")
    got = state.upsert(base, delta, ["k"], guard=F.col("v") < 2)
    assert sorted(map(tuple, got.collect())) == [("a", 10, "x"), ("b", 2, "y"), ("c", 30, None)]
    assert as_set(state.upsert(got, delta, ["k"], guard=F.col("v") < 2)) == as_set(got)


def test_archive_transition(spark):
    registry = registry_rows(spark, [("1", "AVAILABLE", "2020-01-01", "2020-01-01"), ("2", "ARCHIVED", "2020-01-01", "2020-01-01")])
    requests = spark.createDataFrame([("1", "ARCHIVING", None), ("2", "ARCHIVING", "x"), ("9", "ARCHIVING", None)], "file_id string, new_status string, location string")
    after, report = state.archive_transition(registry, requests, AS_OF)
    got = {r.file_id: (r.processing_status, r.current_location) for r in after.collect()}
    assert got == {"1": ("ARCHIVING", "validated/A/1"), "2": ("ARCHIVED", "validated/A/2")}
    assert {r.file_id: r.outcome for r in report.collect()} == {"1": "applied", "2": "skipped", "9": "missing"}


def test_archive_run_is_repeatable(spark):
    registry = registry_rows(
        spark,
        [("old", "AVAILABLE", "2020-01-01", "2020-01-01"), ("bad", "AVAILABLE", "2020-01-02", "2020-01-02"), ("new", "AVAILABLE", "2024-02-01", "2024-02-01"), ("done", "ARCHIVED", "2019-01-01", "2019-01-01")],
    )
    due = archive.candidates(registry, AS_OF)
    assert [r.file_id for r in due.collect()] == ["old", "bad"]
    moved = spark.createDataFrame([("old", None), ("bad", "refused")], "file_id string, error string")
    done = archive.outcomes(due, moved)
    after = state.upsert(registry, archive.registry_delta(registry, done, AS_OF), ["file_id"])
    got = {r.file_id: (r.processing_status, r.current_location) for r in after.collect()}
    assert got["old"] == ("ARCHIVED", "archive/A/old/old.csv") and got["bad"] == ("FAILED", "validated/A/bad")
    assert {r.status for r in archive.audit(done, AS_OF).collect()} == {"ARCHIVING", "ARCHIVED", "FAILED"}
    alerts = archive.alerts(done).collect()
    assert sorted(r.message for r in alerts) == ["Documents processed: 2", "File ID: bad\nError: refused"]
    again = archive.outcomes(archive.candidates(after, AS_OF))
    assert again.count() == 0
    assert [r.message for r in archive.alerts(again).collect()] == ["Documents processed: 0"]


def test_payload_moves_bytes_once(spark):
    due = spark.createDataFrame([("A", "1", "n.pdf", "loc/1")], "account_id string, file_id string, file_name string, current_location string")
    stored = spark.createDataFrame([("loc/1", b"bytes"), ("loc/2", b"other")], "location string, content binary")
    rows = archive.payload(due, stored).collect()
    assert [(r.archive_path, bytes(r.content)) for r in rows] == [("archive/A/1/n.pdf", b"bytes")]


def test_small_is_measured(spark):
    assert sizing.is_small(spark.range(10), 10) and not sizing.is_small(spark.range(11), 10)


def test_reprocess_drops_what_was_derived(spark):
    registry = registry_rows(spark, [("1", "AVAILABLE", "2020-01-01", "2020-01-01"), ("2", "AVAILABLE", "2020-01-01", "2020-01-01")])
    derived = spark.createDataFrame([("1",), ("2",)], "file_id string")
    after, *tables = state.reprocess(registry, derived, derived, derived, spark.createDataFrame([("1",)], "file_id string"), AS_OF)
    assert {r.file_id: r.processing_status for r in after.collect()} == {"1": "STAGED", "2": "AVAILABLE"}
    assert [[r.file_id for r in t.collect()] for t in tables] == [["2"]] * 3


def test_stuck_and_dashboard(spark):
    registry = registry_rows(
        spark,
        [("1", "STAGED", "2024-01-01", "2024-03-01 11:00:59"), ("2", "STAGED", "2024-01-01", "2024-03-01 11:45:00"), ("3", "FAILED", "2024-01-01", "2024-01-01"), ("4", "AVAILABLE", "2024-01-01", "2024-01-01"), ("5", "ARCHIVING", "2024-01-01", "2024-03-01 11:30:00")],
    )
    stuck = reports.stuck_files(registry, AS_OF)
    assert [(r.file_id, r.mins_stuck) for r in stuck.collect()] == [("1", 60)]
    searches = spark.createDataFrame([("2024-03-01 11:59:00",), ("2024-02-01 00:00:00",)], "t string").select(F.col("t").cast("timestamp_ntz").alias("search_ts"))
    row = reports.dashboard(registry, searches, AS_OF).first()
    assert (row.files_available, row.files_failed, row.files_stuck, row.searches, row.health) == (1, 1, 1, 1, "NEEDS ATTENTION")
    order = [r.processing_status for r in reports.status_summary(registry).collect()]
    assert order == ["STAGED", "AVAILABLE", "FAILED", "ARCHIVING"]


def test_trade_arithmetic(spark):
    df = spark.createDataFrame([("BUY", Decimal("92600.00")), ("SELL", Decimal("83100.00"))], "side string, gross decimal(18,2)")
    rows = measures.with_trade_measures(df, "side", "gross").collect()
    assert [(str(r.commission), str(r.net)) for r in rows] == [("92.60", "92707.60"), ("83.10", "83001.90")]


def test_other_arithmetic(spark):
    d = lambda v: F.lit(v).cast("decimal(18,2)")
    row = spark.range(1).select(
        measures.surcharge(d("4420.00"), F.lit("0.25").cast("decimal(18,6)"), d("0")),
        measures.surcharge(d("0"), F.lit(None).cast("decimal(18,6)"), d("150")),
        measures.reclaimable(d("1000"), d("26.375")),
        measures.reclaimable(d("1000"), d("10")),
        measures.market_value(F.lit("BOND"), d("100000"), d("98.75")),
        measures.market_value(F.lit("EQUITY"), d("10"), d("98.75")),
        measures.processing_fee(d("5200")),
        measures.income_net(d("5200"), d("780")),
    )
    assert [str(v) for v in row.first()] == ["11.05", "150.00", "113.80", "0.00", "98750.00", "987.50", "52.00", "4420.00"]


def test_valuation_with_a_hot_portfolio(spark):
    df = spark.range(300).select(F.when(F.col("id") < 200, F.lit("hot")).otherwise(F.col("id").cast("string")).alias("p"), F.lit("2.00").cast("decimal(18,2)").alias("v"))
    rows = measures.valuation(df, "p", "v").where("p = 'hot'").collect()
    assert len(rows) == 200 and {(str(r.nav), str(r.pct_of_nav)) for r in rows} == {("400.00", "0.5")}


def test_reconciliation_of_bonds_and_errors(spark):
    rows = [
        ("1", "EQUITY", "BUY", 500, 185.20, 92600.00, 92.60, 15.00, 92707.60, "2024-01-08", "2024-01-10"),
        ("2", "BOND", "BUY", 100000, 98.75, 98750.00, 49.38, 15.00, 98814.38, "2024-01-15", "2024-01-17"),
        ("3", "EQUITY", "SELL", 200, 415.50, 83100.00, 83.10, 15.00, 83201.90, "2024-02-05", "2024-02-08"),
    ]
    names = ["txn_id", "asset_class", "txn_type", "quantity", "price_usd", "gross_value_usd", "commission_usd", "settlement_fee_usd", "net_value_usd", "trade_date", "settlement_date"]
    df = spark.createDataFrame(rows, names)
    df = df.select(*[F.col(c).cast("decimal(18,2)").alias(c) if c.endswith("usd") or c == "quantity" else F.col(c).cast("date").alias(c) if c.endswith("date") else c for c in names])
    assert [(r.txn_id, r.failed_checks) for r in measures.reconcile_trades(df).collect()] == [("3", "net,settlement_date")]


def test_change_log(spark, tmp_path):
    log = sinks.ChangeLog(spark, str(tmp_path / "log"), schemas.CLIENT_MAPPING, ("account_id", "branch_id"))
    assert log.current().count() == 0
    row = lambda name: spark.createDataFrame([("A", "B", name, "C", "S", True)], schemas.CLIENT_MAPPING)
    log.write(row("first"), 1)
    log.write(row("second"), 2)
    log.write(row("again"), 2)
    assert [r.client_name for r in log.current().collect()] == ["again"]
    assert [r.client_name for r in log.current(before=2).collect()] == ["first"]
    none = spark.createDataFrame([("Z",)], "account_id string")
    assert log.current(within=none, on=["account_id"]).count() == 0
    log.compact(2)
    folded = sinks.ChangeLog(spark, str(tmp_path / "log-2"), schemas.CLIENT_MAPPING, log.keys)
    assert [r.client_name for r in folded.current().collect()] == ["again"]


def test_chunk_layout_prunes(spark, tmp_path):
    chunks = spark.range(200).select(F.col("id").cast("string").alias("file_id"), F.concat(F.lit("C"), (F.col("id") % 3).cast("string")).alias("client_account_id"), F.lit("t").alias("chunk_text"))
    sinks.write_chunks(chunks, str(tmp_path / "chunks"), buckets=4)
    read = spark.read.parquet(str(tmp_path / "chunks")).where("client_account_id = 'C1'")
    assert read.count() == 67
    assert "PartitionFilters: [isnotnull(client_account_id" in read._jdf.queryExecution().toString()


@pytest.fixture()
def incoming(tmp_path):
    place = tmp_path / "validated" / "A"
    place.mkdir(parents=True)

    def drop(name, text):
        (place / name).write_text(text)

    return tmp_path, drop


def test_landing_stream_sees_each_file_once(spark, incoming):
    root, drop = incoming
    out, checkpoint = str(root / "out"), str(root / "cp")

    def drain():
        files.start_landing(files.landing_stream(spark, str(root / "validated")), out, checkpoint).start().awaitTermination()
        return spark.read.parquet(out).count()

    drop("1.csv", "A\n1\n")
    assert drain() == 1
    drop("2.csv", "A\n2\n")
    assert drain() == 2
    assert drain() == 2
    batch = files.landing_rows(files.scan_documents(spark, str(root / "validated")), str(root / "validated"), F.current_timestamp())
    key = lambda df: sorted(tuple(r) for r in df.select("relative_path", "file_size").collect())
    assert key(spark.read.parquet(out)) == key(batch)


def test_chain_over_files_and_replay(spark, incoming):
    root, drop = incoming
    mapping = spark.createDataFrame([("A", "B", "One", "C1", "S1", True)], schemas.CLIENT_MAPPING)
    run = pipeline.Pipeline(spark, str(root / "tables"), mapping, models.hashing_embedder(16))
    registry = registry_rows(spark, [(n, "VALIDATED", "2024-01-01", "2024-01-01") for n in ("1", "2", "3")])
    registry = registry.withColumn("branch_id", F.lit("B")).withColumn("file_format", F.when(F.col("file_id") == "3", F.lit("PDF")).otherwise("CSV"))
    run.registry.write(registry, 0)

    def drain():
        stream = files.landing_stream(spark, str(root), content=True).where("relative_path LIKE 'validated/%'")
        pipeline.start(run, stream, str(root / "cp"), lambda batch: AS_OF).awaitTermination()
        return {r.file_id: r.processing_status for r in run.registry.current().collect()}

    drop("1.csv", "Field,Value\nFATCA_Status,ok\n")
    drop("3.csv", "%PDF")
    assert drain() == {"1": "AVAILABLE", "2": "VALIDATED", "3": "FAILED"}
    drop("2.csv", "Field,Value\n" + "x,y\n" * 900)
    assert drain() == {"1": "AVAILABLE", "2": "AVAILABLE", "3": "FAILED"}
    first = as_set(run.registry.current()), as_set(run.current_chunks()), as_set(run.audit.changes())
    # The same batch again, as after a lost commit: its folders are replaced by equal ones.
    again = files.landing_rows(files.scan_documents(spark, str(root / "validated"), "2.csv"), str(root), F.current_timestamp(), keep=("content",))
    run.run_batch(again, 1, AS_OF)
    assert (as_set(run.registry.current()), as_set(run.current_chunks()), as_set(run.audit.changes())) == first
    assert run.counters(1)["route"].first().routed == 1
    assert run.counters(1)["embed"].first().embedded == 1
    assert {r.client_account_id for r in run.current_chunks().collect()} == {"C1"}
    # A later run that leaves no chunks clears the document's old ones.
    run.embedded.write(spark.createDataFrame([("1", None)], "file_id string, error string"), 99)
    assert {r.file_id for r in run.current_chunks().collect()} == {"2"}
