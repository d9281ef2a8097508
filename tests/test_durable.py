"""Measured jobs, repeated deliveries, folded logs, interrupted runs and models that are set up once."""

import re
import time

import numpy as np
import pytest
from pyspark.sql import functions as F

from ledgerleaf import schemas, session, sinks
from ledgerleaf.functions.times import utc_now
from ledgerleaf.measured import observed, timed
from ledgerleaf.operators import embed, models, search, similarity, views
from ledgerleaf.session import new_path
from ledgerleaf.sources import files, sidecars
from ledgerleaf.streaming import pipeline
from ledgerleaf.streaming.archiving import ArchiveRuns

ROWS = "key string, part string, value long"


def rows_of(spark, *rows):
    return spark.createDataFrame(list(rows), ROWS)


def as_set(df):
    return sorted(map(str, df.collect()))


# -- measured passes ------------------------------------------------------------------------------------------------------
def test_observed_counts_what_is_written(spark, tmp_path):
    rows = spark.range(1000).repartition(7).withColumn("odd", F.col("id") % 2 == 1)
    _, found = observed(rows, {"n": F.count(F.lit(1)), "odd": F.count_if("odd")}, lambda df: df.write.parquet(str(tmp_path / "a")))
    assert found == {"n": 1000, "odd": 500}
    _, nothing = observed(rows.where("id < 0"), {"n": F.count(F.lit(1)), "least": F.min("id")}, lambda df: df.write.parquet(str(tmp_path / "b")))
    assert nothing == {"n": 0, "least": None}
    empty = spark.createDataFrame([], "id long")
    assert observed(empty, {"n": F.count(F.lit(1))}, lambda df: df.write.parquet(str(tmp_path / "c")))[1] == {"n": 0}


def test_timed_covers_making_and_storing(spark):
    def slow():
        time.sleep(0.2)
        return spark.range(3)

    found = timed(slow, lambda df: spark.createDataFrame(df.toPandas()), {"n": F.count(F.lit(1))})
    assert found.elapsed_ms >= 200 and found.metrics == {"n": 3} and found.result.count() == 3


def test_measured_search_and_its_audit(spark, tmp_path):
    model = models.hashing_embedder(32)
    texts = spark.createDataFrame([("1", "red apple pie"), ("2", "blue sea shore")], "file_id string, chunk_text string")
    chunks = embed.embed(texts.withColumns({"client_account_id": F.lit("C"), "chunk_index": F.lit(0)}), "chunk_text", model)
    registry = spark.createDataFrame([(i, "AVAILABLE") for i in "12"], "file_id string, processing_status string")
    registry = registry.withColumns({c: F.lit(None).cast("string") for c in ("file_name", "file_format", "document_type", "current_location")})
    classes = spark.createDataFrame([], "file_id string, doc_summary string")
    queries = spark.createDataFrame([(1, "apple", "C"), (2, "sea", "C"), (3, "sea", "nobody")], "query_id long, query string, client_account_id string")
    found = search.measured_search(queries, chunks, registry, classes, model)
    assert found.metrics == {"queries": 3, "answered": 2, "unanswered": 1, "candidates": 4}
    got = {r.query_id: r for r in found.result.collect()}
    assert {r.execution_ms for r in got.values()} == {found.elapsed_ms} and got[1].file_id == "1" and got[3].error
    path = str(tmp_path / "audit")
    for _ in range(2):
        assert sinks.append_search_audit(search.audit_rows(found.result, "2024-01-01"), path, batch=1)
    audit = sinks.BatchTable(spark, path, schemas.SEARCH_AUDIT).read()
    assert [r.execution_time_ms for r in audit.collect()] == [found.elapsed_ms] * 2
    none = search.measured_search(queries.where("query_id > 9"), chunks, registry, classes, model)
    assert none.metrics == {"queries": 0, "answered": 0, "unanswered": 0, "candidates": 0} and none.result.count() == 0


def test_scratch_folders_go(spark):
    with session.scratch(spark) as folder:
        kept = session.materialise(spark.range(5), "kept")
        with session.scratch(spark) as inner:
            session.materialise(spark.range(3), "inner")
            assert inner.startswith(folder) and session.folders(spark, inner)
        assert kept.count() == 5 and not session.folders(spark, inner) and kept.inputFiles()[0].startswith("file:") and folder in kept.inputFiles()[0]
    assert session.folders(spark, folder) == []
    assert "run-" not in session.new_path(spark, "outside")


# -- batches --------------------------------------------------------------------------------------------------------------------
def test_a_batch_is_in_the_table_once(spark, tmp_path):
    table = sinks.BatchTable(spark, str(tmp_path / "t"), rows_of(spark, ("a", "p", 1)).schema, ("part",))
    assert table.read().count() == 0 and table.commits().count() == 0 and table.clean() == 0
    first = rows_of(spark, ("a", "p", 1), ("b", "q", 2), ("c", None, 3))
    assert table.write(first, 0)["written"] == 3
    assert table.write(first, 0) is None
    assert table.write(rows_of(spark, ("a", "p", 9)), 1, metrics={"most": F.max("value")}) == {"written": 1, "most": 9}
    assert as_set(table.read().where("batch = 0").drop("batch").select("key", "part", "value")) == as_set(first)
    assert table.read().count() == 4


def test_a_delivery_that_broke_off_is_not_seen(spark, tmp_path):
    table = sinks.BatchTable(spark, str(tmp_path / "t"), rows_of(spark, ("a", "p", 1)).schema, ("part",))
    table.attempt(rows_of(spark, ("half", "p", 1)), 3)
    assert table.read().count() == 0 and not table.has(3)
    table.write(rows_of(spark, ("whole", "p", 1), ("whole", "q", 2)), 3)
    assert {r.key for r in table.read().collect()} == {"whole"}
    assert table.clean() == 1 and table.clean() == 0 and table.read().count() == 2
    # new content of a batch has fewer folders than the old
    table.write(rows_of(spark, ("new", "q", 5)), 3, replace=True)
    assert [(r.key, r.part) for r in table.read().collect()] == [("new", "q")]
    assert table.clean() == 1


def test_an_empty_batch_counts_as_delivered(spark, tmp_path):
    table = sinks.BatchTable(spark, str(tmp_path / "t"), rows_of(spark, ("a", "p", 1)).schema, ("part",))
    assert table.write(rows_of(spark, ("a", "p", 1)).where("false"), 0) == {"written": 0}
    assert table.has(0) and table.read().count() == 0


def test_folders_keep_text_as_text(spark, tmp_path):
    table = sinks.BatchTable(spark, str(tmp_path / "t"), rows_of(spark, ("a", "007", 1)).schema, ("part",))
    table.write(rows_of(spark, ("a", "007", 1)), 0)
    assert table.read().first().part == "007"


# -- logs -----------------------------------------------------------------------------------------------------------------------------
def log_of(spark, tmp_path):
    return sinks.ChangeLog(spark, str(tmp_path / "log"), rows_of(spark, ("a", "p", 1)).schema, ("key",))


def test_folds_change_nothing_but_the_folders(spark, tmp_path):
    log, plain = log_of(spark, tmp_path), log_of(spark, tmp_path / "plain")
    for seq in range(9):
        rows = rows_of(spark, *[(f"k{i}", "p", seq * 100 + i) for i in range(seq % 4, 40, 3)])
        log.write(rows, seq)
        plain.write(rows, seq)
        if seq % 3 == 2:
            log.compact(seq)
            log.compact(seq)
        assert as_set(log.current()) == as_set(plain.current())
    some = spark.createDataFrame([("k3",), ("k30",), ("none",)], "key string")
    assert as_set(log.current(within=some)) == as_set(plain.current(within=some)) and log.current(within=some).count() == 2
    assert as_set(log.current(keep_seq=True)) == as_set(plain.current(keep_seq=True))
    # at most the changes since the fold before the last, one base for each of the last two folds
    assert len(list((tmp_path / "log").glob("seq=*"))) == 3 and len(list(tmp_path.glob("log-[0-9]*"))) == 2 and log.folds() == [5, 8]


def test_folded_numbers_are_closed(spark, tmp_path):
    log = log_of(spark, tmp_path)
    log.write(rows_of(spark, ("a", "p", 1)), 1)
    log.compact(5)
    with pytest.raises(ValueError):
        log.write(rows_of(spark, ("a", "p", 2)), 5)
    with pytest.raises(ValueError):
        log.changes(before=3)
    log.write(rows_of(spark, ("a", "p", 3)), 6)
    assert log.current().first().value == 3 and log.current(before=6).first().value == 1


def test_a_fold_without_pointer_is_not_seen(spark, tmp_path):
    log = log_of(spark, tmp_path)
    log.write(rows_of(spark, ("a", "p", 1)), 1)
    rows_of(spark, ("broken", "p", 1)).write.parquet(f"{log.path}-1/seq=1")
    assert log.folds() == [] and log.current().first().key == "a"
    log.compact(1)
    assert as_set(log.current()) == as_set(rows_of(spark, ("a", "p", 1)))


def test_base_is_read_by_bucket(spark, tmp_path):
    log = log_of(spark, tmp_path)
    log.write(spark.range(2000).selectExpr("string(id) key", "'p' part", "id value"), 1)
    log.compact(1)
    one = log.current(within=spark.createDataFrame([("17",)], "key string"))
    assert [r.value for r in one.collect()] == [17]
    filters = re.search(r"PartitionFilters: \[([^\]]*bucket[^\]]*)\]", one._jdf.queryExecution().toString())
    assert filters and "bucket" in filters[1]


# -- the chain ----------------------------------------------------------------------------------------------------------------------------
def registry_rows(spark, names):
    rows = spark.createDataFrame([(n, "CSV" if n != "3" else "PDF") for n in names], "file_id string, file_format string")
    given = {"file_name": F.concat("file_id", F.lit("."), F.lower("file_format")), "account_id": F.lit("A"), "branch_id": F.lit("B"), "processing_status": F.lit("VALIDATED")}
    return rows.withColumns(given)


def chain(spark, root, **kw):
    mapping = spark.createDataFrame([("A", "B", "One", "C1", "S1", True)], schemas.CLIENT_MAPPING)
    return pipeline.Pipeline(spark, str(root / "tables"), mapping, models.hashing_embedder(16), **kw)


def batch_of(spark, name, text, kind="csv"):
    row = spark.createDataFrame([(f"validated/A/{name}.{kind}", len(text), bytearray(text.encode()))], "relative_path string, file_size long, content binary")
    return row.withColumns({"last_modified": F.lit("2024-01-01").cast("timestamp_ntz"), "loaded_ts": F.lit("2024-01-01").cast("timestamp_ntz")})


def test_chain_with_and_without_folds(spark, tmp_path):
    states = []
    for fold_every in (0, 1):
        run = chain(spark, tmp_path / str(fold_every), fold_every=fold_every)
        run.registry.write(registry_rows(spark, "1234"), 0)
        for batch, name in enumerate("13"):
            kind = "pdf" if name == "3" else "csv"
            run.run_batch(batch_of(spark, name, "Field,Value\nx,y\n", kind), batch, "2024-01-02")
        tables = (run.registry.current(), run.current_chunks(), run.audit.changes().drop("seq"), run.classifications(), run.runs.changes().drop("seq"))
        states.append([as_set(x) for x in tables])
    assert states[0] == states[1] and len(states[0][1]) == 1
    assert run.registry.folds() == run.chunks.folds() == run.audit.folds() == [9]
    # the last batch again, as after a lost commit
    run.run_batch(batch_of(spark, "3", "Field,Value\nx,y\n", "pdf"), 1, "2024-01-02")
    assert as_set(run.registry.current()) == states[0][0] and as_set(run.current_chunks()) == states[0][1]


def test_runs_are_timed_and_counted(spark, tmp_path):
    run = chain(spark, tmp_path, clock=utc_now)
    run.registry.write(registry_rows(spark, "13"), 0)
    run.run_batch(batch_of(spark, "1", "Field,Value\nx,y\n").unionByName(batch_of(spark, "3", "%PDF", "pdf")), 0, "2024-01-02")
    got = {r.name: r for r in run.runs.changes().collect()}
    assert {n: r.return_value for n, r in got.items()} == {
        "ROUTING_TASK": '{"routed":2,"skipped":0,"failed":0}', "EXTRACT_TASK": '{"extracted":1,"failed":1}',
        "EMBED_TASK": '{"embedded":1,"failed":0}', "CLASSIFY_TASK": '{"classified":1,"failed":0}',
    }
    assert {n: c.first().result_json for n, c in run.counters(0).items()} == {n.split("_")[0].lower().replace("routing", "route"): r.return_value for n, r in got.items()}
    assert all(r.state == "SUCCEEDED" and r.scheduled_time < r.completed_time for r in got.values())
    order = [got[n].scheduled_time for n in schemas.TASK_ORDER]
    assert order == sorted(order)
    audit = run.audit.changes().collect()
    assert all(r.start_ts < r.end_ts for r in audit) and {r.step_name for r in audit} == {"ROUTE", "EXTRACT", "EMBED", "CLASSIFY"}


def test_a_step_that_breaks_off_is_recorded(spark, tmp_path):
    def refuse(prompt, facts):
        return F.raise_error(F.lit("model gone")).cast("string")

    run = chain(spark, tmp_path, classifier=models.CompletionModel("broken", refuse))
    run.registry.write(registry_rows(spark, "1"), 0)
    with pytest.raises(Exception, match="model gone"):
        run.run_batch(batch_of(spark, "1", "Field,Value\nx,y\n"), 0, "2024-01-02")
    assert {r.name: r.state for r in run.runs.changes().collect()} == {"ROUTING_TASK": "SUCCEEDED", "EXTRACT_TASK": "SUCCEEDED", "EMBED_TASK": "SUCCEEDED", "CLASSIFY_TASK": "FAILED"}
    run.classifier = models.keyword_classifier()
    run.run_batch(batch_of(spark, "1", "Field,Value\nx,y\n"), 0, "2024-01-02")
    assert {r.state for r in run.runs.changes().collect()} == {"SUCCEEDED"} and run.registry.current().first().processing_status == "AVAILABLE"


def test_chunks_follow_a_document_that_cannot_be_read_again(spark, tmp_path):
    run = chain(spark, tmp_path)
    run.registry.write(registry_rows(spark, "3"), 0)
    old = spark.createDataFrame([("3", 0, "text", "OLD")], "file_id string, chunk_index int, chunk_text string, client_account_id string")
    run.chunks.write(old, 0)
    run.run_batch(batch_of(spark, "3", "%PDF", "pdf"), 0, "2024-01-02")
    assert run.registry.current().first().processing_status == "FAILED"
    assert [(r.file_id, r.client_account_id) for r in run.current_chunks().collect()] == [("3", "C1")]


def test_stream_that_polls(spark, tmp_path):
    """Batches on a schedule: nothing runs without new files."""
    source = tmp_path / "in"
    batch_of(spark, "1", "Field,Value\nx,y\n").write.parquet(str(source))
    run = chain(spark, tmp_path)
    run.registry.write(registry_rows(spark, "12"), 0)
    stream = spark.readStream.schema(batch_of(spark, "1", "").schema).parquet(str(source))
    query = pipeline.start(run, stream, str(tmp_path / "cp"), lambda batch: "2024-01-02", once=False, every="1 second")
    try:
        query.processAllAvailable()
        time.sleep(2.5)
        assert run.runs.changes().select("batch_id").distinct().count() == 1
        batch_of(spark, "2", "Field,Value\nx,y\n").write.mode("append").parquet(str(source))
        query.processAllAvailable()
    finally:
        query.stop()
    assert {r.processing_status for r in run.registry.current().collect()} == {"AVAILABLE"}
    assert run.runs.changes().select("batch_id").distinct().count() == 2


# -- archive runs -----------------------------------------------------------------------------------------------------------------------------
def archive_of(spark, tmp_path, size=4):
    log = sinks.ChangeLog(spark, str(tmp_path / "registry"), schemas.DOCUMENT_REGISTRY, ("file_id",))
    rows = registry_rows(spark, "1245").withColumns(
        {"processing_status": F.lit("AVAILABLE"), "created_ts": F.lit("2020-01-01"), "current_location": F.concat(F.lit("v/"), "file_name"), "file_size": F.lit(size)}
    )
    log.write(rows, 0)
    return ArchiveRuns(spark, str(tmp_path), log)


def contents(spark, *names):
    return spark.createDataFrame([(f"v/{n}.csv", bytearray(b"data")) for n in names], "location string, content binary")


@pytest.mark.parametrize("stops", [(), ("mark", "store", "settle"), ("store", "store")])
def test_interrupted_archive_runs_end_alike(spark, tmp_path, stops):
    runs = archive_of(spark, tmp_path)
    for phase in (*stops, "settle"):
        runs.run(1, contents(spark, *"124"), "2024-01-01", until=phase)
    assert {r.file_id: r.processing_status for r in runs.registry.current().collect()} == {"1": "ARCHIVED", "2": "ARCHIVED", "4": "ARCHIVED", "5": "FAILED"}
    assert runs.stored.read().count() == 3 and runs.alerts.read().count() == 2
    assert sorted((r.file_id, r.status) for r in runs.audit.changes().collect()) == sorted([(i, "ARCHIVING") for i in "1245"] + [(i, "ARCHIVED") for i in "124"] + [("5", "FAILED")])


def test_marked_documents_are_seen_and_not_due_twice(spark, tmp_path):
    runs = archive_of(spark, tmp_path)
    runs.run(1, contents(spark, "1"), "2024-01-01", until="mark")
    assert {r.processing_status for r in runs.registry.current().collect()} == {"ARCHIVING"}
    runs.run(2, contents(spark, "1"), "2024-01-01")
    assert {r.processing_status for r in runs.registry.current().collect()} == {"ARCHIVING"}
    runs.recover(3, "2024-01-05")
    runs.recover(3, "2024-01-05")
    assert {(r.processing_status, r.current_location[:2]) for r in runs.registry.current().collect()} == {("AVAILABLE", "v/")}
    assert {r.status for r in runs.audit.changes().where("seq = 33").collect()} == {"ROLLED_BACK"}


def test_archive_runs_rank_few_documents_once(spark, tmp_path, monkeypatch):
    """A task never sorts its share of the registry once per join, nor documents that cannot be due."""
    runs, plans, write = archive_of(spark, tmp_path), {}, sinks.ChangeLog.write

    def watched(log, changes, seq, metrics=None):
        if log is runs.registry:
            plans[seq] = changes._jdf.queryExecution().optimizedPlan().toString()
        return write(log, changes, seq, metrics)

    monkeypatch.setattr(sinks.ChangeLog, "write", watched)
    runs.run(1, contents(spark, "1"), "2024-01-01", until="store")
    runs.run(1, contents(spark, "1"), "2024-01-01")
    runs.run(2, contents(spark, "1"), "2024-01-01")
    runs.recover(3, "2024-01-05")
    ranks = {seq: plan.count("row_number() windowspec") for seq, plan in plans.items()}
    assert set(ranks) == {11, 12, 21, 22, 33} and max(ranks.values()) == 1 and ranks[33] == 0
    for seq in (11, 12, 21, 22):
        below = plans[seq].partition("row_number() windowspec")[2]
        assert "LeftSemi" in below and "strategy=broadcast" in below, plans[seq]


@pytest.mark.parametrize("few", [True, False])
def test_archive_runs_end_alike_however_many_are_due(spark, tmp_path, monkeypatch, few):
    monkeypatch.setattr(sinks.sizing, "is_small", lambda df, *bounds: few)
    runs, plans, write = archive_of(spark, tmp_path), {}, sinks.ChangeLog.write

    def watched(log, changes, seq, metrics=None):
        if log is runs.registry:
            plans[seq] = changes._jdf.queryExecution().optimizedPlan().toString()
        return write(log, changes, seq, metrics)

    monkeypatch.setattr(sinks.ChangeLog, "write", watched)
    runs.run(1, contents(spark, *"12"), "2024-01-01")
    # the rank of a run that settles has no join below it that would sort the log a second time
    below = plans[12].partition("row_number() windowspec")[2]
    assert "strategy=broadcast" in below if few else "LeftSemi" not in below
    assert {r.file_id: r.processing_status for r in runs.registry.current().collect()} == {"1": "ARCHIVED", "2": "ARCHIVED", "4": "FAILED", "5": "FAILED"}
    assert runs.stored.read().count() == 2 and runs.alerts.read().count() == 3


@pytest.mark.parametrize("few", [True, False])
@pytest.mark.parametrize("folded", [True, False])
def test_passing_is_current_with_a_filter(spark, tmp_path, monkeypatch, few, folded):
    monkeypatch.setattr(sinks.sizing, "is_small", lambda df: few)
    log = sinks.ChangeLog(spark, str(tmp_path / "log"), rows_of(spark).schema, ("key", "part"))
    log.write(rows_of(spark, ("a", "x", 1), ("a", None, 1), (None, "x", 1), ("b", "x", 5), ("c", "x", 1), ("d", "x", None)), 1)
    log.write(rows_of(spark, ("a", "x", 7), ("b", "x", 1), (None, None, 1), ("c", "y", 9), ("d", "x", 1)), 2)
    if folded:
        log.compact(2)
    log.write(rows_of(spark, ("a", None, None), ("c", "y", 1), ("e", "x", 1)), 3)
    for test, n in ((F.col("value") == 1, 7), (F.col("value") > 1, 1), (F.col("value").isNull(), 1), (F.col("key") == "c", 2), (F.col("value") > 9, 0)):
        assert as_set(log.passing(test)) == as_set(log.current().where(test)) and log.passing(test).count() == n
    one = F.col("value") == 1
    assert as_set(log.passing(one, before=3)) == as_set(log.current(before=3).where(one))


def test_a_copy_that_is_not_whole_does_not_count(spark, tmp_path):
    runs = archive_of(spark, tmp_path, size=9)
    runs.run(1, contents(spark, *"1245"), "2024-01-01")
    assert {(r.processing_status, r.current_location[:2]) for r in runs.registry.current().collect()} == {("FAILED", "v/")}
    assert {r.error_message for r in runs.audit.changes().where("status = 'FAILED'").collect()} == {"stored 4 of 9 bytes"}
    with pytest.raises(ValueError):
        runs.run(2, contents(spark), "2024-01-01", until="never")


# -- models --------------------------------------------------------------------------------------------------------------------------------------
def test_a_model_is_set_up_once_per_task(spark):
    made, asked = spark.sparkContext.accumulator(0), spark.sparkContext.accumulator(0)

    def setup():
        made.add(1)

        def answer(prompts):
            asked.add(1)
            assert len(prompts) <= 10
            if "p13" in prompts:
                raise RuntimeError("no 13")
            return [p.upper() for p in prompts]

        return answer

    complete = models.batched(setup, at_once=10)
    prompts = spark.range(0, 400, 1, 4).select(F.concat(F.lit("p"), F.col("id").cast("string")).alias("p"))
    before = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "25")
    try:
        got = prompts.withColumn("r", complete(F.col("p"), F.struct("p"))).collect()
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", before)
    assert [r.r.reply for r in got] == [None if r.p == "p13" else r.p.upper() for r in got]
    assert [r.r.error for r in got if r.r.error] == ["no 13"]
    # four tasks of four Arrow batches, each asked in pieces of ten; the piece with the failure again one by one
    assert made.value == 4 and asked.value == 4 * 4 * 3 + 10


def test_models_that_fail(spark):
    def nowhere():
        raise OSError("no such model")

    prompts = spark.createDataFrame([("a",), ("b",)], "p string")
    got = prompts.withColumn("r", models.batched(nowhere)(F.col("p"), F.lit(1))).collect()
    assert [tuple(r.r) for r in got] == [(None, "no such model")] * 2
    got = prompts.withColumn("r", models.batched(lambda: lambda p: p[:1])(F.col("p"), F.lit(1))).collect()
    assert [tuple(r.r) for r in got] == [("a", None), ("b", None)]
    got = prompts.withColumn("r", models.batched(lambda: lambda p: [])(F.col("p"), F.lit(1))).collect()
    assert all(r.r.reply is None and r.r.error == "0 replies to 1 inputs" for r in got)


def test_an_embedder_is_set_up_once_per_task(spark):
    made = spark.sparkContext.accumulator(0)

    def setup():
        made.add(1)
        return lambda texts: np.array([[len(t), 1.0] for t in texts])

    model = models.batched_embedder("length", 2, setup, at_once=3)
    rows = spark.range(0, 40, 1, 2).select(F.repeat(F.lit("x"), F.col("id").cast("int")).alias("t"))
    got = embed.embed(rows, "t", model).collect()
    assert [tuple(r.embedding) for r in got] == [(len(r.t), 1.0) for r in got] and made.value == 2
    wrong = models.batched_embedder("wrong", 3, lambda: lambda texts: np.zeros((len(texts), 2)))
    with pytest.raises(Exception, match="model wrong gave"):
        embed.embed(rows, "t", wrong).collect()


# -- keys, placement, views ----------------------------------------------------------------------------------------------------------------------
def test_null_is_not_absent(spark):
    cases = {
        '{"file_id": "1", "file_name": "a", "filehash": null, "file_hash": "x"}': None,
        '{"file_id": "1", "file_name": "a", "file_hash": "x"}': "x",
        '{"file_id": "1", "file_name": "a", "filehash": "", "file_hash": "x"}': "",
        '{"file_id": "1", "file_name": "a", "filehash": "y", "file_hash": "x"}': "y",
        '{"file_id": 1, "file_name": "a", "filehash": {"b": 1}}': '{"b":1}',
    }
    for text, want in cases.items():
        assert sidecars.parse_sidecars(spark.createDataFrame([(text,)], "value string")).first().file_hash == want
    junk = spark.createDataFrame([(None,), ("",), ("[]",), ("nonsense",), ('{"file_id": null, "file_name": "a"}',), ("3",)], "value string")
    assert sidecars.parse_sidecars(junk).count() == 0 and sidecars.parse_collections(junk).count() == 0


def test_vectors_of_a_bucketed_table_are_not_shuffled(spark):
    rows = spark.range(5000).selectExpr("string(id) file_id", "'C' client_account_id", "0 chunk_index", "array(float(id + 1), 1f) embedding")
    sinks.save_bucketed_chunks(rows, "bucketed_chunks_test", 8, path=new_path(spark, "bucketed"))
    registry = spark.range(5000).selectExpr("string(id) file_id", "if(id % 3 = 0, 'AVAILABLE', 'FAILED') processing_status")
    found = similarity.colocated_chunks(spark.table("bucketed_chunks_test"), registry, 8)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1 and "embedding" not in plan.split("Exchange")[1].split("\n")[0] and "SortMergeJoin" in plan
    assert found.count() == 1667
    spark.sql("DROP TABLE bucketed_chunks_test")


def test_views_take_values_not_text(spark):
    spark.createDataFrame([("C1", "t", "1", "high", 1, 5, None)], schemas.SEARCH_AUDIT).createOrReplaceTempView("searches_of_test")
    views.create_functions(spark, searches="searches_of_test")
    assert spark.sql("SELECT search_term FROM my_search_history('C1')").first().search_term == "t"
    assert spark.sql("SELECT * FROM my_search_history(?)", args=["C1' OR 'x' = 'x"]).count() == 0


def test_landing_stream_over_batches(spark, tmp_path):
    place = tmp_path / "in"
    place.mkdir()
    for n in range(5):
        (place / f"{n}.csv").write_text("x" * (n + 1))
    stream = files.start_landing(files.landing_stream(spark, str(place), 2), str(tmp_path / "out"), str(tmp_path / "cp")).start()
    stream.awaitTermination()
    assert sum(p["numInputRows"] > 0 for p in stream.recentProgress) == 3
    assert sorted(r.file_size for r in spark.read.parquet(str(tmp_path / "out")).collect()) == [1, 2, 3, 4, 5]
