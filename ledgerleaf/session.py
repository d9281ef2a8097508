"""Session settings and the shared folder for intermediate tables."""

from __future__ import annotations

import re
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar
from functools import lru_cache

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T


def build_session(app: str = "ledgerleaf", master: str | None = None, **settings: str) -> SparkSession:
    """A session with the settings the jobs are written for; keyword arguments override them.

    Shuffle partitions start high and are coalesced at run time by measured size; skewed join partitions are split.
    """
    defaults = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        "spark.sql.execution.arrow.maxRecordsPerBatch": "2000",
        "spark.python.sql.dataFrameDebugging.enabled": "false",
    }
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**defaults, **settings}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """The folder the cluster names in ``spark.checkpoint.dir``; a local session without one gets its own."""
    context = spark.sparkContext
    configured = spark.conf.get("spark.checkpoint.dir", "") or context.getCheckpointDir()
    if configured:
        return configured
    if not re.match(r"local(\[|$)", context.master):
        raise RuntimeError("set spark.checkpoint.dir to a folder that every executor can reach")
    return _own_dir(context.applicationId)


@lru_cache
def _own_dir(application: str) -> str:
    """One folder per application; the session's own checkpoint folder is left alone."""
    return tempfile.mkdtemp(prefix="ledgerleaf-")


#: Folder of the run that is under way, below that of the application.
_RUN: ContextVar[str] = ContextVar("ledgerleaf-run", default="")


def _application_dir(spark: SparkSession) -> str:
    return f"{shared_dir(spark).rstrip('/')}/ledgerleaf-{spark.sparkContext.applicationId}"


def new_path(spark: SparkSession, label: str) -> str:
    """A new place for an intermediate table, below the application's own folder."""
    return "/".join(filter(None, (_application_dir(spark), _RUN.get(), f"{label}-{uuid.uuid4().hex}")))


@contextmanager
def scratch(spark: SparkSession) -> Iterator[str]:
    """Deletes the intermediate tables that were made inside, once their results are stored elsewhere or collected.

    DataFrames that jobs return read those tables when they run: store what is wanted before the end. Runs inside runs are
    deleted with the outer one. What streaming batches make belongs to the application: see ``clean``.
    """
    folder = f"{_RUN.get()}/run-{uuid.uuid4().hex}".lstrip("/")
    token = _RUN.set(folder)
    try:
        yield f"{_application_dir(spark)}/{folder}"
    finally:
        _RUN.reset(token)
        remove(spark, f"{_application_dir(spark)}/{folder}")


def clean(spark: SparkSession) -> bool:
    """Deletes all intermediate tables of this application, at its end."""
    return remove(spark, _application_dir(spark))


def materialise(df: DataFrame, label: str) -> DataFrame:
    """Writes an intermediate result once and reads it back.

    For results that several branches need: it is computed once, survives the loss of executors, and its exact size
    lets Spark decide which joins may broadcast it.
    """
    spark = df.sparkSession
    path = new_path(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def _place(spark: SparkSession, path: str):
    """A path and its store, whatever store it is. Spark's readers list folders too, but cannot ask for one or delete it."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place, place.getFileSystem(spark._jsc.hadoopConfiguration())


def read_if_there(spark: SparkSession, path: str, schema: str | T.StructType) -> DataFrame | None:
    """A stored table, or None if nothing has been written there yet."""
    place, store = _place(spark, path)
    return spark.read.schema(schema).parquet(path) if store.exists(place) else None


def folders(spark: SparkSession, path: str) -> list[str]:
    """Names of the folders right below a path; none if it is not there."""
    place, store = _place(spark, path)
    return [f.getPath().getName() for f in store.listStatus(place) if f.isDirectory()] if store.exists(place) else []


def remove(spark: SparkSession, path: str) -> bool:
    """Deletes a folder that no reader needs any more."""
    place, store = _place(spark, path)
    return store.delete(place, True)


def spread(df: DataFrame, *keys: str, per_core: int = 2) -> DataFrame:
    """Redistributes an input that has too few partitions for the cores at hand, ahead of heavy per-row work.

    A few small or unsplittable files would otherwise keep most cores idle. An input with enough partitions, which is
    every large one, is returned as it is. Meant for scans and projections of scans: counting the partitions of a plan
    with shuffles would run them.
    """
    wanted = per_core * df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(wanted, *keys) if df.rdd.getNumPartitions() < wanted else df
