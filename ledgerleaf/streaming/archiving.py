"""Archive runs in phases that survive an interruption.

A run first marks what is due as ARCHIVING in the registry, then stores the bytes, then settles each document as ARCHIVED
or FAILED. Each phase is written under numbers of its own run, so a run that broke off is resumed by running it again:
what it has done is found or replaced by equal rows, and nothing becomes due twice, as marked documents are no candidates.
A run that nobody resumes is cleared up by ``recover``: documents whose bytes are stored whole are settled, the others go
back to AVAILABLE where they were.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerleaf import schemas
from ledgerleaf.functions.times import ts_literal
from ledgerleaf.operators import archive, sizing, state
from ledgerleaf.session import materialise
from ledgerleaf.sinks import BatchTable, ChangeLog

STEPS_PER_RUN = 10
MARK, SETTLE, RECOVER = 1, 2, 3
#: Phases that a run can be told to end after, to hand over to another process.
PHASES = ("mark", "store", "settle")

_STORED = schemas._table(("account_id", schemas._S), ("file_id", schemas._S), ("archive_path", schemas._S), ("content", schemas.T.BinaryType()))
_ALERTS = schemas._table(("subject", schemas._S), ("file_id", schemas._S), ("message", schemas._S))


@dataclass
class ArchiveRuns:
    """Runs over a registry log; audit rows, stored bytes and alerts lie below ``root``."""

    spark: SparkSession
    root: str
    registry: ChangeLog
    retention_days: int = archive.RETENTION_DAYS

    def __post_init__(self) -> None:
        self.audit = ChangeLog(self.spark, f"{self.root}/archive-audit", schemas.PROCESSING_AUDIT, ("file_id", "status", "start_ts"))
        self.stored = BatchTable(self.spark, f"{self.root}/archive", _STORED, ("account_id",))
        self.alerts = BatchTable(self.spark, f"{self.root}/archive-alerts", _ALERTS)

    def run(self, number: int, files: DataFrame, as_of, until: str = "settle") -> None:
        """Run ``number``, from the start or from where it broke off. ``files`` holds (location, content).

        Numbers must rise above those already in the registry log. ``as_of`` decides what is due and must be the same
        when a run is resumed.
        """
        if until not in PHASES:
            raise ValueError(f"no phase {until}")
        base = number * STEPS_PER_RUN
        self._mark(base + MARK, as_of)
        if until == "mark":
            return
        marked = self._marked(base + MARK)
        self.stored.write(archive.payload(marked, files), number)
        if until == "store":
            return
        self._settle(marked, number, base + SETTLE, as_of)

    def _marked(self, seq: int) -> DataFrame:
        return self.registry.changes(only=seq).select("file_id", "file_name", "account_id", "current_location", "file_size")

    def _audit_rows(self, rows: DataFrame, status, error, as_of) -> DataFrame:
        now = ts_literal(as_of)
        return rows.select("file_id", F.lit("ARCHIVE").alias("step_name"), status.alias("status"), now.alias("start_ts"), now.alias("end_ts"), error.alias("error_message"))

    def _mark(self, seq: int, as_of) -> None:
        """ARCHIVING, in place. What is due is read from before this run, so repeating the phase finds the same documents."""
        due = self.registry.passing(archive.is_expired(as_of, self.retention_days), before=seq)
        self.registry.write(due.withColumns({"processing_status": F.lit("ARCHIVING"), "updated_ts": ts_literal(as_of)}), seq)
        marked = self.registry.changes(only=seq)
        self.audit.write(self._audit_rows(marked, F.lit("ARCHIVING"), F.lit(None).cast("string"), as_of), seq)

    def _copies(self, rows: DataFrame) -> DataFrame:
        """(file_id, error) of the documents that have stored bytes; an incomplete copy is an error."""
        bytes_of = rows.select("file_id", F.octet_length("content").cast("bigint").alias("bytes"))
        return bytes_of.groupBy("file_id").agg(F.max("bytes").alias("bytes"))

    def _outcomes(self, marked: DataFrame, copies: DataFrame) -> DataFrame:
        short = F.format_string("stored %d of %d bytes", F.col("bytes"), F.col("file_size"))
        moved = copies.join(marked.select("file_id", "file_size"), "file_id").select(
            "file_id", F.when(F.col("bytes") != F.col("file_size"), short).alias("error")
        )
        return archive.outcomes(marked, moved)

    def _settle(self, marked: DataFrame, number: int, seq: int, as_of) -> None:
        # stored, as the registry, the audit and the alerts read it
        done = materialise(self._outcomes(marked, self._copies(self.stored.read().where(F.col("batch") == number))), "archive-outcomes")
        ids = marked.select("file_id")
        # few documents are cut out ahead of the rank; many are met by the join with their outcomes, in the order of the rank
        before = self.registry.current(before=seq, within=F.broadcast(ids) if sizing.is_small(ids) else None)
        self.registry.write(archive.registry_delta(before, done, as_of), seq)
        failed = F.col("error").isNotNull()
        self.audit.write(self._audit_rows(done, F.when(failed, F.lit("FAILED")).otherwise(F.lit("ARCHIVED")), F.col("error"), as_of), seq)
        self.alerts.write(archive.alerts(done), number)

    def recover(self, number: int, as_of) -> None:
        """Settles what abandoned runs left ARCHIVING. Run it only when no run is under way.

        What is left, and how it ended, are stored: several joins read them, and a task would rank its share of the registry for each.
        """
        seq = number * STEPS_PER_RUN + RECOVER
        left = materialise(self.registry.passing(F.col("processing_status") == "ARCHIVING", before=seq), "archive-left")
        done = materialise(self._outcomes(left, self._copies(state.restrict(self.stored.read(), left, ["file_id"]))), "archive-outcomes")
        whole = done.where(F.col("error").isNull())
        settled = archive.registry_delta(left, whole, as_of)
        back = state.missing_from(left, whole, ["file_id"]).withColumns({"processing_status": F.lit("AVAILABLE"), "updated_ts": ts_literal(as_of)})
        self.registry.write(settled.unionByName(back), seq)
        after = self.registry.changes(only=seq)
        status = F.when(F.col("processing_status") == "AVAILABLE", F.lit("ROLLED_BACK")).otherwise(F.col("processing_status"))
        self.audit.write(self._audit_rows(after, status, F.lit(None).cast("string"), as_of), seq)
