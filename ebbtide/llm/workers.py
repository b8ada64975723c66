"""Running on a cluster: imports of the Python workers, checked broadcasts, filters that keep every column."""

from __future__ import annotations

import gc
import os
import sys
from collections.abc import Callable, Iterator
from pathlib import Path

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

BROADCAST_ROWS = 1_000_000
ROOT = str(Path(__file__).resolve().parents[2])
# Modules whose codecs remember pieces of texts from one task to the next.
CODECS = ("ebbtide.llm.bpe", "ebbtide.llm.token_counts", "ebbtide.llm.token_store")


def reachable(spark: SparkSession) -> SparkSession:
    """Adds the package's folder to the workers' path; a cluster without a shared folder takes ``--py-files`` instead."""
    environment = spark.sparkContext.environment
    paths = environment.get("PYTHONPATH", "").split(os.pathsep)
    if ROOT not in paths:
        environment["PYTHONPATH"] = os.pathsep.join([ROOT, *filter(None, paths)])
    return spark


def release(*modules: str) -> None:
    """A worker serves one operator after the other: what the codecs of earlier ones remember goes before another fills it."""
    caches = [kept for name in modules for kept in vars(sys.modules.get(name, object)).values() if hasattr(kept, "cache_clear")]
    full = [kept for kept in caches if kept.cache_info().currsize]
    for kept in full:
        kept.cache_clear()
    if full:
        # A codec and its memories refer to each other, so only the collector frees them; Arrow keeps what it had for later.
        gc.collect()
        pa.default_memory_pool().release_unused()


def small(rows: DataFrame, bound: int = BROADCAST_ROWS) -> DataFrame:
    """Narrow rows, broadcast up to a bound that is checked, else left to a shuffle join."""
    return F.broadcast(rows) if rows.count() <= bound else rows


def filtered(docs: DataFrame, column: str, keep: Callable[[pa.Array], list[bool]]) -> DataFrame:
    """The rows, with all their columns, for which ``keep`` of the named column says so."""
    place = docs.columns.index(column)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        release(*CODECS)
        for batch in batches:
            yield batch.filter(pa.array(keep(batch.column(place)), pa.bool_()))

    return docs.mapInArrow(run, docs.schema)
