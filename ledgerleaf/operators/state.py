"""Keyed state: upserts, replace-by-key, guarded transitions, audit rows and counters.

Base tables are large and deltas are small, so nothing here shuffles the base on account of a small delta: the base
is joined to the delta as it lies (Spark broadcasts the delta when it measures it below its threshold and falls
back to a sort-merge join above it), and the second look at the base, for keys that exist already, reads the key
column only.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerleaf.functions.times import ts_literal
from ledgerleaf.schemas import PROCESSING_AUDIT, VALIDATION_FINAL

_NEW = "__new"


def pick_per_key(df: DataFrame, keys: Iterable[str], order_by: str, latest: bool = True) -> DataFrame:
    """One row per key, the latest or earliest by ``order_by``.

    A rank of which only the first is kept: Spark limits each task to one row per key before the shuffle, so a key that
    owns a large share of the table reaches its reducer as one row per task, and every row is carried once.
    """
    keys = list(keys)
    rest = [c for c in df.columns if c not in keys]
    # The order column leads; the remaining sortable columns settle ties the same way on every run.
    sortable = [c for c in rest if c != order_by and not isinstance(df.schema[c].dataType, (T.MapType, T.VariantType))]
    order = [order_by] * (order_by in rest) + sortable
    if not order:
        return df.dropDuplicates(keys)
    by = Window.partitionBy(*keys).orderBy(*[F.desc(c) if latest else F.asc(c) for c in order])
    return df.withColumn("__place", F.row_number().over(by)).where("__place = 1").drop("__place")


def missing_from(df: DataFrame, done: DataFrame, keys: Iterable[str]) -> DataFrame:
    """Rows whose key is not in ``done`` yet (set difference by key)."""
    keys = list(keys)
    return df.join(done.select(*keys), keys, "left_anti")


def restrict(big: DataFrame, small: DataFrame, keys: Iterable[str]) -> DataFrame:
    """Rows of ``big`` whose key occurs in ``small``."""
    keys = list(keys)
    return big.join(small.select(*keys), keys, "left_semi")


def insert_if_absent(base: DataFrame, delta: DataFrame, keys: Iterable[str]) -> DataFrame:
    """Rows of ``delta`` that are new to ``base``; ``base`` is narrowed to the delta's keys first."""
    keys = list(keys)
    known = restrict(base.select(*keys), delta, keys)
    return delta.join(known, keys, "left_anti")


def upsert(
    base: DataFrame,
    delta: DataFrame,
    keys: Iterable[str],
    guard: Column | None = None,
    columns: Iterable[str] | None = None,
) -> DataFrame:
    """Base with the delta applied: matched rows updated, the others inserted.

    ``guard`` is evaluated on the base row; where it is not true the base row stays as it is. ``columns`` limits
    what an update may change (all delta columns by default). The delta must hold one row per key.
    """
    keys = list(keys)
    values = [c for c in base.columns if c not in keys]
    update = [c for c in values if c in (delta.columns if columns is None else list(columns))]
    side = delta.select(*keys, *[F.col(c).alias(_NEW + c) for c in update], F.lit(True).alias(_NEW))
    applies = F.coalesce(F.col(_NEW), F.lit(False))
    if guard is not None:
        applies = applies & F.coalesce(guard, F.lit(False))
    merged = base.join(side, keys, "left").select(
        *keys,
        *[
            (F.when(applies, F.col(_NEW + c)).otherwise(F.col(c)) if c in update else F.col(c)).alias(c)
            for c in values
        ],
    )
    fresh = insert_if_absent(base, delta, keys)
    return merged.unionByName(fresh.select(*[c for c in base.columns if c in delta.columns]), allowMissingColumns=True)


def replace_by_key(base: DataFrame, delta: DataFrame, keys: Iterable[str], replaced: DataFrame | None = None) -> DataFrame:
    """Drop every base row of a replaced key, then add the delta (delete + insert).

    ``replaced`` lists the keys to clear when that is more than the delta holds (a document whose new content gives
    no rows at all).
    """
    keys = list(keys)
    gone = (delta if replaced is None else replaced).select(*keys).distinct()
    return base.join(gone, keys, "left_anti").unionByName(delta)


def merge_classification(base: DataFrame, delta: DataFrame) -> DataFrame:
    """Delta wins on every column, one row per document."""
    return upsert(base, delta, ["file_id"])


def register(registry: DataFrame, validated: DataFrame, as_of) -> DataFrame:
    """Insert validated documents; refresh status and location of known ones unless they are final."""
    now = ts_literal(as_of)
    delta = validated.withColumn("created_ts", now).withColumn("updated_ts", now)
    return upsert(
        registry,
        delta,
        ["file_id"],
        guard=~F.col("processing_status").isin(*VALIDATION_FINAL),
        columns=["processing_status", "current_location", "updated_ts"],
    )


def set_client_if_null(registry: DataFrame, routed: DataFrame) -> DataFrame:
    """Fill a missing client id, never change one."""
    side = routed.select("file_id", F.col("client_account_id").alias("__client"))
    return registry.join(side, "file_id", "left").select(
        *[
            F.coalesce("client_account_id", "__client").alias(c) if c == "client_account_id" else F.col(c)
            for c in registry.columns
        ]
    )


def propagate_client(chunks: DataFrame, routed: DataFrame) -> DataFrame:
    """Give the chunks a document already has the client it was routed to."""
    side = routed.select("file_id", F.col("client_account_id").alias("__client"))
    return chunks.join(side, "file_id", "left").select(
        *[
            F.coalesce("__client", "client_account_id").alias(c) if c == "client_account_id" else F.col(c)
            for c in chunks.columns
        ]
    )


def transition(registry: DataFrame, outcomes: DataFrame, done_status: str, as_of) -> DataFrame:
    """Registry rows after a step: ``outcomes`` holds (file_id, error); an error means FAILED.

    Returns the changed rows only, in registry shape. Extra outcome columns named like registry columns replace
    the registry's values.
    """
    extra = [c for c in outcomes.columns if c in registry.columns and c != "file_id"]
    side = outcomes.select("file_id", "error", *[F.col(c).alias(_NEW + c) for c in extra])
    failed = F.col("error").isNotNull()
    changed = {
        "processing_status": F.when(failed, F.lit("FAILED")).otherwise(F.lit(done_status)),
        "updated_ts": ts_literal(as_of),
        **{c: F.when(failed, F.col(c)).otherwise(F.coalesce(_NEW + c, c)) for c in extra},
    }
    return registry.join(side, "file_id").select(*[changed.get(c, F.col(c)).alias(c) for c in registry.columns])


def audit_rows(outcomes: DataFrame, step: str, start, end) -> DataFrame:
    """One audit row per attempt: COMPLETED, or FAILED with its error."""
    failed = F.col("error").isNotNull()
    return outcomes.select(
        "file_id",
        F.lit(step).alias("step_name"),
        F.when(failed, F.lit("FAILED")).otherwise(F.lit("COMPLETED")).alias("status"),
        ts_literal(start).alias("start_ts"),
        ts_literal(end).alias("end_ts"),
        F.col("error").alias("error_message"),
    ).select(*PROCESSING_AUDIT.names)


def counts(outcome: Column, names: Iterable[str]) -> dict[str, Column]:
    """How often each outcome value occurs, as aggregates to observe or to select."""
    return {n: F.count_if(outcome == n) for n in names}


def counters(outcomes: DataFrame, outcome: str, names: Iterable[str]) -> DataFrame:
    """One row: how often each outcome value occurred, as columns and as one JSON text."""
    names = list(names)
    found = outcomes.agg(*[value.alias(n) for n, value in counts(F.col(outcome), names).items()])
    return found.withColumn("result_json", F.to_json(F.struct(*names)))


def archive_transition(registry: DataFrame, requests: DataFrame, as_of) -> tuple[DataFrame, DataFrame]:
    """Status changes requested for archiving, as ``(registry, report)``.

    ``requests`` holds (file_id, new_status, location). ARCHIVED documents are left alone; a null location keeps the
    old one. The report says per request whether it was applied, skipped or its file id is missing.
    """
    delta = requests.select(
        "file_id",
        F.col("new_status").alias("__status"),
        F.col("location").alias("__location"),
        F.lit(True).alias("__asked"),
    )
    applies = F.col("__asked").isNotNull() & (F.col("processing_status") != "ARCHIVED")
    changed = {
        "processing_status": F.when(applies, F.col("__status")).otherwise(F.col("processing_status")),
        "current_location": F.when(applies, F.coalesce("__location", "current_location")).otherwise(
            F.col("current_location")
        ),
        "updated_ts": F.when(applies, ts_literal(as_of)).otherwise(F.col("updated_ts")),
    }
    after = registry.join(delta, "file_id", "left").select(
        *[changed.get(c, F.col(c)).alias(c) for c in registry.columns]
    )
    found = registry.select("file_id", "processing_status").join(requests.select("file_id"), "file_id")
    report = requests.join(found, "file_id", "left").select(
        "file_id",
        "new_status",
        F.when(F.col("processing_status").isNull(), F.lit("missing"))
        .when(F.col("processing_status") == "ARCHIVED", F.lit("skipped"))
        .otherwise(F.lit("applied"))
        .alias("outcome"),
    )
    return after, report


def reprocess(
    registry: DataFrame, texts: DataFrame, chunks: DataFrame, classifications: DataFrame, file_ids: DataFrame, as_of
) -> tuple[DataFrame, DataFrame, DataFrame, DataFrame]:
    """Reset documents to STAGED and drop what was derived from them, so that every step runs again."""
    side = file_ids.select("file_id").distinct().withColumn("__reset", F.lit(True))
    reset = F.col("__reset").isNotNull()
    changed = {
        "processing_status": F.when(reset, F.lit("STAGED")).otherwise(F.col("processing_status")),
        "updated_ts": F.when(reset, ts_literal(as_of)).otherwise(F.col("updated_ts")),
    }
    after = registry.join(side, "file_id", "left").select(
        *[changed.get(c, F.col(c)).alias(c) for c in registry.columns]
    )
    return after, *(missing_from(t, side, ["file_id"]) for t in (texts, chunks, classifications))
