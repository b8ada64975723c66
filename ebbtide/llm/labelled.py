"""A bounded, reproducible sample of labelled texts for fitting, and the fold that is never fitted on."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

FOLDS = 5


def held_out(key: Column) -> Column:
    """Rows whose crc32 of the id as text is divisible by ``FOLDS``; a null id is never held out."""
    return F.coalesce(F.crc32(key.cast("string")) % FOLDS == 0, F.lit(False))


@dataclass
class Sample:
    texts: list[bytes]
    labels: np.ndarray
    weights: np.ndarray

    @property
    def fits(self) -> bool:
        return len(np.unique(self.labels)) == 2


def sample(
    docs: DataFrame, labels: DataFrame, label: str, per_class: int, max_chars: int, id_column: str = "doc_id",
    text_column: str = "text",
) -> Sample:
    """At most ``per_class`` texts of each label from the fitting folds, first in the order of a hash of the id.

    Texts over ``max_chars`` are left out here (not when scoring). A weight makes the sample stand for all labelled
    rows of its class. Null labels and ids are passed over; of several labels for one id the largest counts.
    """
    known = (
        labels.select(F.col(id_column).alias("_id"), F.col(label).cast("int").alias("_label"))
        .filter(F.col("_id").isNotNull() & F.col("_label").isin(0, 1) & ~held_out(F.col("_id")))
        .groupBy("_id").agg(F.max("_label").alias("_label"))
    )
    totals = {row["_label"]: row["n"] for row in known.groupBy("_label").agg(F.count("*").alias("n")).collect()}
    rank = F.xxhash64("_id")
    chosen = None
    for value in totals:
        part = known.filter(F.col("_label") == value).orderBy(rank, "_id").limit(per_class)
        chosen = part if chosen is None else chosen.unionByName(part)
    if chosen is None:
        return Sample([], np.empty(0, int), np.empty(0))
    text = F.coalesce(F.col(text_column), F.lit(""))
    rows = (
        docs.select(F.col(id_column).alias("_id"), text.alias("_text"))
        # At most 2 * per_class ids: a bound set by parameter, not by the data.
        .join(F.broadcast(chosen), "_id").filter(F.length("_text") <= max_chars)
        .dropDuplicates(["_id"]).orderBy("_id").collect()
    )
    found = np.array([row["_label"] for row in rows], int)
    counts = np.bincount(found, minlength=2)
    weights = np.array([totals[value] / counts[value] for value in found], float)
    return Sample([row["_text"].encode() for row in rows], found, weights / max(weights.mean(), 1e-9) if rows else weights)
