"""Shared scratch space and the output sinks."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar
from urllib.parse import urlsplit

from pyspark import RDD, StorageLevel
from pyspark.sql import DataFrame, SparkSession


# Scratch paths given out in the innermost block of ``passing_tables``, of this thread.
_PASSING: ContextVar[list[str] | None] = ContextVar("passing", default=None)


def shared_folder(spark: SparkSession, fallback: str | None = None) -> str:
    """The folder named in ``spark.checkpoint.dir``, or else ``fallback``.

    Without either, local mode gets a temporary folder; a cluster has none that all executors could reach, and a
    ``fallback`` on a local disk is none either.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if configured:
        return configured
    if fallback is None:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors can reach")
        fallback = tempfile.mkdtemp(prefix="ebbtide-")
    elif not spark.sparkContext.master.startswith("local") and urlsplit(fallback).scheme in ("", "file"):
        raise RuntimeError(f"{fallback} is local to each machine: set spark.checkpoint.dir, or write to a shared store")
    spark.sparkContext.setCheckpointDir(fallback)
    return fallback


@contextmanager
def run_folder(spark: SparkSession, fallback: str) -> Iterator[None]:
    """Checkpoints of one run below ``fallback``, in a folder of its own that is removed at the end.

    Where ``spark.checkpoint.dir`` is set, that folder is used and left to whoever set it.
    """
    if spark.conf.get("spark.checkpoint.dir", None):
        yield
        return
    own = f"{fallback.rstrip('/')}/{uuid.uuid4().hex}"
    context, before = spark.sparkContext, spark.sparkContext.getCheckpointDir()
    if before is None:
        shared_folder(spark, own)
    else:
        context.setCheckpointDir(own)
    try:
        yield
    finally:
        if before is not None:
            context.setCheckpointDir(before)
        remove(spark, own)


def remove(spark: SparkSession, path: str) -> None:
    """Deletes a folder on whatever store it is."""
    jvm = spark.sparkContext._jvm
    place = jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(place, True)


def stamp(spark: SparkSession, path: str) -> tuple[int, int, int]:
    """When a file or folder was changed, its files and their bytes: another stamp, another content."""
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    store = place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    found = store.getContentSummary(place)
    return store.getFileStatus(place).getModificationTime(), found.getFileCount(), found.getLength()


def scratch_path(spark: SparkSession, label: str) -> str:
    """A path in the shared folder that nothing else uses."""
    path = f"{shared_folder(spark).rstrip('/')}/{label}-{uuid.uuid4().hex}"
    if _PASSING.get() is not None:
        _PASSING.get().append(path)
    return path


@contextmanager
def passing_tables(spark: SparkSession) -> Iterator[None]:
    """Tables for the time of the block: what is at the scratch paths asked for in it, by any function, goes at its end.

    A table that outlives the block is written within it to a path that was asked for before.
    """
    paths: list[str] = []
    token = _PASSING.set(paths)
    try:
        yield
    finally:
        _PASSING.reset(token)
        for path in paths:
            remove(spark, path)


def cut_lineage(df: DataFrame) -> DataFrame:
    """Reliable checkpoint: the rows survive the loss of the executors that computed them."""
    spark = df.sparkSession
    folder = shared_folder(spark)
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(folder)
    return df.checkpoint(eager=True)


def checkpointed(spark: SparkSession, rows: RDD, at_once: bool = True) -> RDD:
    """As ``cut_lineage``, of an RDD that is also kept in memory, on disk beyond it; its file is for the caller to remove.

    If not ``at_once``, the next job that reads it brings it there.
    """
    folder = shared_folder(spark)
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(folder)
    kept = rows.persist(StorageLevel.MEMORY_AND_DISK)
    kept.checkpoint()
    if at_once:
        kept.foreach(lambda row: None)
    return kept


def through_table(df: DataFrame, path: str) -> DataFrame:
    """Write once as Parquet and go on from the written rows."""
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.parquet(path)


def write_scores(scores: DataFrame, path: str) -> None:
    scores.write.mode("overwrite").parquet(path)


def write_document(document: DataFrame, path: str) -> None:
    """A one-row metrics document as a JSON file."""
    document.coalesce(1).write.mode("overwrite").json(path)


def write_csv(rows: DataFrame, path: str) -> None:
    rows.write.mode("overwrite").option("header", True).csv(path)
