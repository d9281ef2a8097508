"""Writers: append-only tables, tables of batches that may be delivered again, and logs keyed by sequence number."""

from __future__ import annotations

import logging
import uuid
from collections.abc import Iterable, Mapping
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerleaf.measured import observed
from ledgerleaf.operators import sizing, state
from ledgerleaf.session import folders, read_if_there, remove

logger = logging.getLogger(__name__)


def within_limits(rows: DataFrame, limits: Mapping[str, int] | None) -> DataFrame:
    """Cuts text columns for a store with limited column widths; without limits the full values are kept."""
    return rows.withColumns({c: F.substring(c, 1, n) for c, n in (limits or {}).items() if c in rows.columns})


@dataclass(frozen=True)
class BatchTable:
    """Rows of numbered batches, each in the table once however often it is delivered.

    Every delivery writes an attempt of its own, ``rows/batch=<n>/attempt=<name>``, and then names it in a commit of one
    row, ``commits/batch=<n>``. Readers see committed attempts only: a delivery that broke off leaves nothing to be seen,
    and one of a batch that is there already does nothing. No file that is read is ever overwritten.
    """

    spark: SparkSession
    path: str
    schema: T.StructType
    partitions: tuple[str, ...] = ()

    def _commits(self) -> DataFrame | None:
        return read_if_there(self.spark, f"{self.path}/commits", "attempt string, written long, batch long")

    def commits(self) -> DataFrame:
        """(batch, attempt, written): one row per batch that is in the table."""
        found = self._commits()
        rows = self.spark.createDataFrame([], "attempt string, written long, batch long") if found is None else found
        return rows.select("batch", "attempt", "written")

    def has(self, batch: int) -> bool:
        return not self.commits().where(F.col("batch") == batch).isEmpty()

    def attempt(self, rows: DataFrame, batch: int, metrics: Mapping[str, Column] | None = None) -> tuple[str, dict[str, object]]:
        """Writes the rows of a batch without committing them; gives the attempt's name and what was counted on the way."""
        name = f"a{uuid.uuid4().hex}"
        typed = rows.select(*[F.col(f.name).cast(f.dataType) for f in self.schema.fields])
        place = f"{self.path}/rows/batch={batch}/attempt={name}"
        counted = {"written": F.count(F.lit(1)), **(metrics or {})}
        _, found = observed(typed, counted, lambda df: df.write.partitionBy(*self.partitions).parquet(place))
        return name, found

    def commit(self, batch: int, attempt: str, written: int) -> None:
        """Makes an attempt the content of its batch."""
        row = self.spark.range(1).select(F.lit(attempt).alias("attempt"), F.lit(written).cast("long").alias("written"))
        row.coalesce(1).write.mode("overwrite").parquet(f"{self.path}/commits/batch={batch}")

    def write(self, rows: DataFrame, batch: int, replace: bool = False, metrics: Mapping[str, Column] | None = None) -> dict[str, object] | None:
        """Delivers a batch. Gives what was counted while the rows were written, or None if the batch is there already.

        ``replace`` puts new content in place of what a batch has, for a batch that is computed anew on purpose.
        """
        if not replace and self.has(batch):
            return None
        name, found = self.attempt(rows, batch, metrics)
        self.commit(batch, name, int(found["written"]))
        return found

    def read(self) -> DataFrame:
        """All rows of committed attempts, with their ``batch``. Folders of other attempts are not opened."""
        schema = T.StructType([*self.schema.fields, T.StructField("batch", T.LongType()), T.StructField("attempt", T.StringType())])
        rows, commits = read_if_there(self.spark, f"{self.path}/rows", schema), self._commits()
        if rows is None or commits is None:
            return self.spark.createDataFrame([], T.StructType(schema.fields[:-1]))
        kept = rows.join(commits.select("batch", "attempt"), ["batch", "attempt"], "left_semi")  # a row per batch
        return kept.select(*self.schema.names, "batch")

    def clean(self) -> int:
        """Deletes attempts that were never committed or were replaced. Not while a delivery is under way."""
        kept = {f"batch={r.batch}/attempt={r.attempt}" for r in self.commits().collect()}  # a row per batch
        places = [f"{b}/{a}" for b in folders(self.spark, f"{self.path}/rows") for a in folders(self.spark, f"{self.path}/rows/{b}")]
        return sum(remove(self.spark, f"{self.path}/rows/{place}") for place in places if place not in kept)


def _deliver(rows: DataFrame, path: str, partitions: tuple[str, ...], batch: int | None, mode: str = "append") -> dict[str, object] | None:
    """One batch into its table of batches; without a batch number the rows are just appended."""
    if batch is None:
        rows.write.mode(mode).partitionBy(*partitions).parquet(path)
        return None
    return BatchTable(rows.sparkSession, path, rows.schema, partitions).write(rows, batch)


def append_audit(
    rows: DataFrame, path: str, ts: str = "start_ts", limits: Mapping[str, int] | None = None, batch: int | None = None
) -> None:
    """Appends audit rows, one folder per day. ``limits`` gives characters by column, for example error_message.

    With ``batch`` a delivery that is repeated leaves the table as it is; read it back through ``BatchTable``.
    """
    _deliver(within_limits(rows, limits).withColumn("audit_date", F.to_date(ts)), path, ("audit_date",), batch)


def append_search_audit(rows: DataFrame, path: str, limits: Mapping[str, int] | None = None, batch: int | None = None) -> bool:
    """Appends search audit rows; a failure is logged and never fails the search."""
    try:
        append_audit(rows, path, "search_ts", limits, batch)
        return True
    except Exception:  # the answer matters more than its record
        logger.exception("search audit not written")
        return False


def write_dispositions(rows: DataFrame, path: str, batch: int | None = None) -> None:
    """Validated and quarantined files side by side, quarantine by reason."""
    _deliver(rows, path, ("disposition", "reason"), batch)


def write_by_client(rows: DataFrame, path: str, mode: str = "append", batch: int | None = None) -> None:
    """One folder per client. Spark splits a client's rows over tasks as they come, so no client is one task."""
    _deliver(rows, path, ("client_account_id",), batch, mode)


def write_chunks(chunks: DataFrame, path: str, buckets: int = 16, mode: str = "append") -> None:
    """Chunk table laid out for search: by client for pruning, sub-divided by document.

    The rebalance brings rows of one folder together to avoid small files and splits folders that are too large.
    """
    placed = chunks.withColumn("bucket", F.pmod(F.xxhash64("file_id"), F.lit(buckets)).cast("int"))
    placed = placed.hint("rebalance", F.col("client_account_id"), F.col("bucket"))
    placed.write.mode(mode).partitionBy("client_account_id", "bucket").parquet(path)


def save_bucketed_chunks(chunks: DataFrame, table: str, buckets: int = 64, path: str | None = None) -> None:
    """Chunk table of the catalog, bucketed and sorted by document: joins by ``file_id`` leave its vectors where they are.

    With ``path`` the files lie there and not in the warehouse.
    """
    writer = chunks.repartition(buckets, "file_id").write.bucketBy(buckets, "file_id").sortBy("file_id")
    (writer.option("path", path) if path else writer).saveAsTable(table)


def write_archive(payload: DataFrame, path: str, batch: int | None = None) -> None:
    """Archived bytes, one folder per account."""
    _deliver(payload, path, ("account_id",), batch)


def write_alerts(alerts: DataFrame, path: str, limits: Mapping[str, int] | None = None, batch: int | None = None) -> None:
    """Appends alert rows; ``limits`` gives characters by column, for example subject."""
    _deliver(within_limits(alerts, limits), path, (), batch)


def _numbers(spark: SparkSession, path: str, name: str) -> list[int]:
    """Numbers of the finished folders ``<name>=<number>`` below a path, in order."""
    found = [f.partition("=")[2] for f in folders(spark, path) if f.startswith(f"{name}=")]
    return sorted(map(int, found))


#: Folders that a folded log is divided into, by hash of its first key.
BUCKETS = 16


@dataclass(frozen=True)
class ChangeLog:
    """A keyed table kept as its changes: one folder per sequence number, later rows win.

    Writing a sequence number again replaces its folder, so a repeated batch leaves the same table. Nothing that is
    read is ever overwritten, because readers look at smaller numbers only.

    ``compact`` folds all changes up to a number into a base next to the log, ``<path>-<number>``, divided by hash of the
    first key and sorted by it; then a pointer, ``<path>-folds/upto=<number>``, switches readers over. A fold that breaks
    off before its pointer is not seen. Folders that the fold before made useless are deleted, so readers that still
    follow the last pointer keep their files. Rows keep the number they were written with.
    """

    spark: SparkSession
    path: str
    schema: T.StructType
    keys: tuple[str, ...]

    def _columns(self, *more: tuple[str, T.DataType]) -> T.StructType:
        return T.StructType([*self.schema.fields, *[T.StructField(n, t) for n, t in more]])

    def folds(self) -> list[int]:
        """The numbers up to which there is a base, in order. Found by listing: no job runs."""
        return _numbers(self.spark, f"{self.path}-folds", "upto")

    def write(self, changes: DataFrame, seq: int, metrics: Mapping[str, Column] | None = None) -> dict[str, object]:
        """Writes the changes of one number; gives what was counted while they were written."""
        if any(seq <= upto for upto in self.folds()):
            raise ValueError(f"{seq} has been folded already")
        columns = [f.name for f in self.schema.fields if f.name in changes.columns]
        typed = changes.select(*[F.col(c).cast(self.schema[c].dataType) for c in columns])
        place = f"{self.path}/seq={seq}"
        return observed(typed, metrics or {}, lambda df: df.write.mode("overwrite").parquet(place))[1]

    def _base(self, upto: int) -> DataFrame:
        """Rows of a fold as they were written, with ``seq`` and the ``bucket`` they lie in."""
        schema = self._columns(("written", T.LongType()), ("bucket", T.IntegerType()))
        rows = read_if_there(self.spark, f"{self.path}-{upto}/seq={upto}", schema)
        rows = self.spark.createDataFrame([], schema) if rows is None else rows
        return rows.withColumnRenamed("written", "seq")

    def changes(self, before: int | None = None, only: int | None = None, buckets: list[int] | None = None) -> DataFrame:
        """All changes with their ``seq``; folders outside the range are not opened.

        ``buckets`` opens only those parts of the base; changes after it are read as a whole.
        """
        schema = self._columns(("written", T.LongType()), ("seq", T.LongType()))
        found = read_if_there(self.spark, self.path, schema)
        rows = self.spark.createDataFrame([], schema) if found is None else found
        every = self.folds()
        folds = [upto for upto in every if before is None or upto < before]
        if every and not folds:
            raise ValueError(f"changes before {before} have been folded already")
        if folds:
            rows = rows.where(F.col("seq") > folds[-1])
        if before is not None:
            rows = rows.where(F.col("seq") < before)
        if only is not None:
            rows = rows.where(F.col("seq") == only)
        # a folded log that is opened by its own path has the number of each row besides that of the fold
        rows = rows.withColumn("seq", F.coalesce("written", "seq")).select(*self.schema.names, "seq")
        if folds and (only is None or only <= folds[-1]):
            base = self._base(folds[-1])
            base = base if buckets is None else base.where(F.col("bucket").isin(buckets))
            base = base if only is None else base.where(F.col("seq") == only)
            rows = rows.unionByName(base.drop("bucket"))
        return rows

    def _bucket(self) -> Column:
        return F.pmod(F.xxhash64(F.col(self.keys[0]).cast("string")), F.lit(BUCKETS)).cast("int")

    def current(
        self, before: int | None = None, within: DataFrame | None = None, on: Iterable[str] | None = None, keep_seq: bool = False
    ) -> DataFrame:
        """Latest row per key. ``within`` cuts the log down first, by columns that never change for a key."""
        on = list(on or self.keys)
        buckets = None
        if within is not None and self.keys[0] in on and self.folds():
            # a row per bucket at most
            buckets = [r[0] for r in within.select(self._bucket()).distinct().collect()]
        rows = self.changes(before, buckets=buckets)
        if within is not None:
            rows = state.restrict(rows, within, on)
        latest = state.pick_per_key(rows, self.keys, "seq")
        return latest if keep_seq else latest.drop("seq")

    def passing(self, test: Column, before: int | None = None) -> DataFrame:
        """Latest rows per key that pass a test.

        The latest row of a key can only pass if some row of it does. If the keys that have one are few, which is counted,
        the other keys are left out ahead of the rank, so that tasks sort what may pass and not their share of the table.
        """
        rows = self.changes(before)
        able = rows.where(test).select(*[F.col(k).alias(f"__{k}") for k in self.keys]).distinct()
        if sizing.is_small(able):
            same = [F.col(k).eqNullSafe(F.col(f"__{k}")) for k in self.keys]
            rows = rows.join(F.broadcast(able), same, "left_semi")
        return state.pick_per_key(rows, self.keys, "seq").drop("seq").where(test)

    def compact(self, upto: int, rows: DataFrame | None = None) -> None:
        """Folds everything up to ``upto`` into a base and switches readers to it.

        Keeps the latest row per key, or ``rows`` (with their ``seq``) if that is not what the table means. Nothing up to
        ``upto`` may be written again. One fold at a time.
        """
        before = self.folds()
        if upto in before:
            return
        kept = self.current(before=upto + 1, keep_seq=True) if rows is None else rows
        placed = kept.withColumnRenamed("seq", "written").withColumn("bucket", self._bucket())
        placed = placed.hint("rebalance", F.col("bucket")).sortWithinPartitions("bucket", self.keys[0])
        placed.write.mode("overwrite").partitionBy("bucket").parquet(f"{self.path}-{upto}/seq={upto}")
        pointer = self.spark.range(1).select(F.lit(upto).cast("long").alias("folded"))
        pointer.coalesce(1).write.mode("overwrite").parquet(f"{self.path}-folds/upto={upto}")
        self._clean(before)

    def _clean(self, folds: list[int]) -> None:
        """Deletes what the last of the earlier folds replaced: its changes, and bases before it."""
        if not folds:
            return
        for seq in _numbers(self.spark, self.path, "seq"):
            if seq <= folds[-1]:
                remove(self.spark, f"{self.path}/seq={seq}")
        for upto in folds[:-1]:
            remove(self.spark, f"{self.path}-folds/upto={upto}")
            remove(self.spark, f"{self.path}-{upto}")
