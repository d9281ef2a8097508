"""The four chained steps over a stream of landed files.

Every micro-batch runs route, extract, embed and classify for the documents it brought. State lives in change logs
keyed by batch and step, so a replayed batch writes the same folders again. Each step works on the batch's documents:
the registry log is cut down to them by semi join before the latest rows are picked. Every ``fold_every`` batches the
logs are folded, so a batch reads a base and a bounded number of changes, however many batches went before.

Steps count while they write: the numbers of a run are observed in the job that stores its outcomes and go to the log of
runs, with the times at which the step began and ended.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Mapping
from dataclasses import dataclass, field
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ledgerleaf import schemas
from ledgerleaf.functions import paths
from ledgerleaf.functions.times import as_datetime
from ledgerleaf.operators import chunk, classify, embed, extract, models, route, sizing, state
from ledgerleaf.session import materialise
from ledgerleaf.sinks import ChangeLog

STEPS_PER_BATCH = 10
ROUTE, EXTRACT, EMBED, CLASSIFY, RUNS = 1, 2, 3, 4, 5
#: Batches from one fold of the logs to the next.
FOLD_EVERY = 16

_ROUTES = schemas._table(
    ("relative_path", schemas._S),
    ("file_id", schemas._S),
    ("client_account_id", schemas._S),
    ("outcome", schemas._S),
    ("new_location", schemas._S),
    ("error", schemas._S),
)
_READ = schemas._table(
    ("file_id", schemas._S), ("extracted_text", schemas._S), ("char_count", schemas._L), ("error", schemas._S)
)
_EMBEDDED = schemas._table(("file_id", schemas._S), ("error", schemas._S))
_CLASSIFIED = schemas._table(
    *[(f.name, f.dataType) for f in schemas.DOCUMENT_CLASSIFICATION.fields if f.name != "classified_ts"],
    ("error", schemas._S),
)


@dataclass
class Pipeline:
    """Tables below one folder, plus the mapping and the models.

    ``clock`` gives the times that steps record as their start and end. Without one a step records the batch's time for
    both, so that a replayed batch leaves equal rows.
    """

    spark: SparkSession
    root: str
    mapping: DataFrame
    embedder: models.EmbeddingModel = field(default_factory=models.hashing_embedder)
    classifier: models.CompletionModel = field(default_factory=models.keyword_classifier)
    extractors: Mapping[str, extract.Extractor] | None = None
    clock: Callable[[], datetime] | None = None
    fold_every: int = FOLD_EVERY

    def _log(self, name: str, schema, *keys: str) -> ChangeLog:
        return ChangeLog(self.spark, f"{self.root}/{name}", schema, keys)

    def __post_init__(self) -> None:
        self.registry = self._log("registry", schemas.DOCUMENT_REGISTRY, "file_id")
        self.audit = self._log("audit", schemas.PROCESSING_AUDIT, "file_id", "step_name", "start_ts")
        self.landing = self._log("landing", schemas.LANDING_FILES, "relative_path")
        self.routes = self._log("routes", _ROUTES, "relative_path", "file_id")
        self.read = self._log("read", _READ, "file_id")
        self.chunks = self._log("chunks", schemas.DOCUMENT_CHUNKS, "file_id", "chunk_index")
        self.embedded = self._log("embedded", _EMBEDDED, "file_id")
        self.classified = self._log("classified", _CLASSIFIED, "file_id")
        self.runs = self._log("runs", schemas.STEP_RUNS, "name", "batch_id")

    # -- current tables -------------------------------------------------------------------------------------------
    def texts(self, **kw) -> DataFrame:
        return self.read.current(**kw).where(F.col("error").isNull()).drop("error")

    def classifications(self, **kw) -> DataFrame:
        return self.classified.current(**kw).where(F.col("error").isNull()).drop("error")

    def _latest_chunks(self, before: int | None = None) -> DataFrame:
        """Chunks of each document's latest embedding run, which may have left none, with their ``seq``.

        Documents embedded more than once are few; they are listed first, so the vectors stay where they are.
        """
        runs = self.embedded.changes(before).groupBy("file_id").agg(F.max("seq").alias("latest"), F.min("seq").alias("first"))
        repeated = materialise(runs.where(F.col("latest") > F.col("first")).select("file_id", "latest"), "re-embedded")
        rows = self.chunks.changes(before).join(repeated, "file_id", "left")
        return rows.where(F.col("latest").isNull() | (F.col("seq") == F.col("latest"))).drop("latest")

    def _moved(self) -> DataFrame:
        """(file_id, client_account_id) of documents routed after they were embedded, by their latest route. They are few."""
        routed = self.routes.changes().where(F.col("outcome") == "routed").select("file_id", "client_account_id", F.col("seq").alias("routed"))
        routed = state.pick_per_key(routed, ["file_id"], "routed")
        runs = self.embedded.changes().groupBy("file_id").agg(F.max("seq").alias("embedded"))
        # documents that came with their chunks have no embedding run of their own
        later = routed.join(runs, "file_id", "left").where(F.col("embedded").isNull() | (F.col("routed") > F.col("embedded")))
        return materialise(later.select("file_id", "client_account_id"), "moved")

    def current_chunks(self) -> DataFrame:
        """Chunks of each document's latest embedding run, under the client that the document was routed to last."""
        return state.propagate_client(self._latest_chunks().drop("seq"), sizing.broadcast_if_small(self._moved()))

    # -- one micro-batch --------------------------------------------------------------------------------------------
    def run_batch(self, files: DataFrame, batch_id: int, as_of) -> None:
        """``files`` holds (relative_path, file_size, last_modified, loaded_ts, content)."""
        base = batch_id * STEPS_PER_BATCH
        if self.fold_every and batch_id and batch_id % self.fold_every == 0:
            self.fold(base - 1)
        run = _Run(self, base, as_of)
        run.step("ROUTING_TASK", ROUTE, lambda: self._route(files, run))
        mine = self.routes.changes(only=base + ROUTE).where(F.col("outcome") == "routed").select("file_id").distinct()
        run.step("EXTRACT_TASK", EXTRACT, lambda: self._extract(files, mine, run))
        run.step("EMBED_TASK", EMBED, lambda: self._embed(mine, run))
        run.step("CLASSIFY_TASK", CLASSIFY, lambda: self._classify(mine, run))
        run.finish()

    def fold(self, upto: int) -> None:
        """Folds every log up to a number that no batch will write again.

        Chunks go before the embedding runs that say which of them count. Listings, routes, audit rows and runs keep all
        their rows and are only brought together. Costs one pass over the state each ``fold_every`` batches.
        """
        self.chunks.compact(upto, self._latest_chunks(upto + 1))
        for log in (self.embedded, self.registry, self.read, self.classified):
            log.compact(upto)
        for log in (self.landing, self.routes, self.audit, self.runs):
            log.compact(upto, log.changes(upto + 1))

    def _route(self, files: DataFrame, run: _Run) -> dict[str, object]:
        seq = run.base + ROUTE
        self.landing.write(files.drop("content"), seq)
        landed = self.landing.changes(only=seq)
        keys = landed.select(
            paths.account_folder(F.col("relative_path")).alias("account_id"),
            paths.part(F.col("relative_path"), -1).alias("file_name"),
        ).distinct()
        known = self.registry.current(before=seq, within=keys, on=["account_id", "file_name"])
        counted = self.routes.write(route.route(landed, known, self.mapping), seq, state.counts(route.outcome_name(), route.NAMES))
        routed = self.routes.changes(only=seq)
        self.registry.write(route.registry_delta(known, routed, run.as_of), seq)
        self.audit.write(route.audit(routed, run.started, run.now()), seq)
        return counted

    def _extract(self, files: DataFrame, mine: DataFrame, run: _Run) -> dict[str, object]:
        seq = run.base + EXTRACT
        known = self.registry.current(before=seq, within=mine)
        todo = extract.pending(known, self.texts(before=seq, within=mine))
        # Bytes come from the batch itself; routing renamed the place, so both sides meet on the landed path.
        landed_at = self.routes.changes(only=run.base + ROUTE).where(F.col("outcome") == "routed")
        landed_at = state.pick_per_key(landed_at.select("file_id", "relative_path"), ["file_id"], "relative_path")
        todo = todo.drop("current_location").join(landed_at, "file_id")
        todo = todo.withColumnRenamed("relative_path", "current_location")
        contents = files.select(F.col("relative_path").alias("location"), "content")
        counted = self.read.write(extract.extract_text(todo, contents, self.extractors), seq, state.counts(extract.outcome_name(), extract.NAMES))
        outcomes = self.read.changes(only=seq)
        self.registry.write(extract.registry_delta(known, outcomes, run.as_of), seq)
        self.audit.write(state.audit_rows(outcomes, "EXTRACT", run.started, run.now()), seq)
        return counted

    def _embed(self, mine: DataFrame, run: _Run) -> dict[str, object]:
        seq = run.base + EMBED
        known = self.registry.current(before=seq, within=mine)
        todo = chunk.pending(known, self.texts(before=seq, within=mine))
        self.chunks.write(embed.chunk_and_embed(todo, self.embedder, run.as_of), seq)
        counted = self.embedded.write(embed.outcomes(todo), seq, state.counts(embed.outcome_name(), embed.NAMES))
        outcomes = self.embedded.changes(only=seq)
        self.registry.write(embed.registry_delta(known, outcomes, run.as_of), seq)
        self.audit.write(state.audit_rows(outcomes, "EMBED", run.started, run.now()), seq)
        return counted

    def _classify(self, mine: DataFrame, run: _Run) -> dict[str, object]:
        seq = run.base + CLASSIFY
        known = self.registry.current(before=seq, within=mine)
        texts = self.texts(before=seq, within=mine)
        todo = classify.pending(known, texts, self.classifications(before=seq, within=mine))
        counted = self.classified.write(classify.classify(todo, self.classifier), seq, state.counts(classify.outcome_name(), classify.NAMES))
        outcomes = self.classified.changes(only=seq)
        self.registry.write(classify.registry_delta(known, outcomes, run.as_of), seq)
        self.audit.write(state.audit_rows(outcomes, "CLASSIFY", run.started, run.now()), seq)
        return counted

    def counters(self, batch_id: int) -> dict[str, DataFrame]:
        """One-row counters of a batch, by step."""
        base = batch_id * STEPS_PER_BATCH
        return {
            "route": route.counters(self.routes.changes(only=base + ROUTE)),
            "extract": extract.counters(self.read.changes(only=base + EXTRACT)),
            "embed": embed.counters(self.embedded.changes(only=base + EMBED)),
            "classify": classify.counters(self.classified.changes(only=base + CLASSIFY)),
        }


class _Run:
    """One batch on its way: times of its steps and what they counted."""

    def __init__(self, pipeline: Pipeline, base: int, as_of):
        self.pipeline, self.base, self.as_of = pipeline, base, as_of
        self.rows: list[tuple] = []

    def now(self):
        return self.pipeline.clock() if self.pipeline.clock else self.as_of

    def step(self, name: str, number: int, work: Callable[[], dict[str, object]]) -> None:
        """Runs a step; one that breaks off is recorded as FAILED, with those before it, and breaks off the batch."""
        self.started = self.now()
        try:
            counted = work()
        except Exception as problem:
            self._record(name, "FAILED", None, str(problem) or type(problem).__name__)
            self.finish()
            raise
        self._record(name, "SUCCEEDED", json.dumps(counted, separators=(",", ":")), None)

    def _record(self, name: str, result: str, value: str | None, error: str | None) -> None:
        times = as_datetime(self.started), as_datetime(self.now())
        self.rows.append((name, result, *times, value, error, self.base // STEPS_PER_BATCH))

    def finish(self) -> None:
        """Four rows at most."""
        self.pipeline.runs.write(self.pipeline.spark.createDataFrame(self.rows, schemas.STEP_RUNS).coalesce(1), self.base + RUNS)


def start(
    pipeline: Pipeline,
    files: DataFrame,
    checkpoint: str,
    as_of: Callable[[int], object],
    once: bool = True,
    every: str = "1 minute",
) -> StreamingQuery:
    """Runs the chain for every micro-batch of a file stream.

    ``once`` drains what is there and stops; else a batch is formed every minute. A batch without new files does not
    run at all. ``as_of`` gives the time to record for a batch id.
    """

    def each(batch: DataFrame, batch_id: int) -> None:
        pipeline.run_batch(batch, batch_id, as_of(batch_id))

    writer = files.writeStream.foreachBatch(each).option("checkpointLocation", checkpoint)
    writer = writer.trigger(availableNow=True) if once else writer.trigger(processingTime=every)
    return writer.start()
