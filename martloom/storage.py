"""Intermediate tables in the folder that all executors share."""

from __future__ import annotations

import gc
import tempfile
import time
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession

# A lookup side is broadcast only when a count shows no more rows than this. The sides are
# projected to a key and its natural columns first, so this many rows stay near 100 MB.
BROADCAST_ROWS = 500_000

_own_folders: dict[str, str] = {}


def shared_folder(spark: SparkSession) -> str:
    """The checkpoint folder of the session, or a private one when running in local mode."""
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if named:
        return named
    context = spark.sparkContext
    if not context.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that every executor can reach")
    if context.applicationId not in _own_folders:
        _own_folders[context.applicationId] = tempfile.mkdtemp(prefix="martloom-")
    return _own_folders[context.applicationId]


def _located(spark: SparkSession, path: str):
    """The file system that holds `path`, and the path as it knows it."""
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), folder


def exists(spark: SparkSession, path: str) -> bool:
    system, folder = _located(spark, path)
    return system.exists(folder)


def remove(spark: SparkSession, path: str) -> None:
    """Delete `path` with all below it, if it is there."""
    system, folder = _located(spark, path)
    system.delete(folder, True)


_scope: ContextVar[str] = ContextVar("scope", default="")


def _application_folder(spark: SparkSession) -> str:
    return f"{shared_folder(spark)}/{spark.sparkContext.applicationId}{_scope.get()}"


def new_path(spark: SparkSession, label: str) -> str:
    """A path in the shared folder that nothing uses yet.

    What one application writes lies under its id, so a finished application can be cleaned up whole.
    """
    return f"{_application_folder(spark)}/{uuid.uuid4().hex}/{label}"


def store(df: DataFrame, label: str) -> DataFrame:
    """Write `df` once and read it back: short lineage, known size, survives lost executors."""
    path = new_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def release_shuffles(spark: SparkSession) -> None:
    """Let go of the shuffle files of jobs that are done.

    Spark deletes them once the driver finds nothing that refers to them, which a driver with little to do may
    not look for until the disks are full.
    """
    for _ in range(2):  # what the first round frees on this side, the second finds on the other
        gc.collect()
        spark.sparkContext._jvm.System.gc()
        time.sleep(0.2)


@contextmanager
def kept_until_done(spark: SparkSession) -> Iterator[None]:
    """What is stored inside the block is deleted at its end; results must be written elsewhere by then."""
    name = uuid.uuid4().hex
    before = _scope.set(f"{_scope.get()}/{name}")
    try:
        yield
    finally:
        path = _application_folder(spark)
        _scope.reset(before)
        remove(spark, path)


def fits_broadcast(df: DataFrame, rows: int = BROADCAST_ROWS) -> bool:
    """Whether `df` has at most `rows` rows; on a stored table this reads footers or one limit."""
    return df.limit(rows + 1).count() <= rows
