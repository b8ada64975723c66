"""Near-duplicates among embeddings: spherical k-means cells, blocked cosine products, one representative per group.

Equal vectors of a label are first reduced to one, so a vector that a third of the rows share is compared once. Unit
vectors go to the cell of their nearest centroid and also to every cell whose border they are near: two vectors whose
cosine reaches the threshold are at most ``sqrt(2 - 2t)`` apart, so one of them lies within half of that of the border
between their cells. With ``reach`` = 1 no pair is missed; a smaller value copies fewer vectors and gives up recall.
Centroids are fitted on the driver on at most ``SAMPLE`` vectors; every vector is indexed. A cell is cut into blocks,
each pair of blocks is a group of bounded size, and a group returns a count and one spanning link per vector, never the
pairs themselves.

Vectors are compared only with equal labels (not null) and equal lengths. A row whose id, vector or label is null, or
whose vector is zero or has null or non-finite components, links with nothing. Repeated rows count as different
vectors. Empty tables give empty results; other columns are not looked at.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ebbtide.llm.components import connected, local_roots
from ebbtide.sources.storage import scratch_path, through_table

COSINE = 0.98
SAMPLE = 16_384
CELL_ROWS = 4096
MAX_CELLS = 1024
BLOCK = 1024
SEED = 5


def usable(vector: F.Column, label: F.Column, key: F.Column) -> F.Column:
    good = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))
    return F.coalesce(
        key.isNotNull() & label.isNotNull() & F.forall(vector, good) & F.exists(vector, lambda x: x != 0), F.lit(False)
    )


def unit_rows(values: np.ndarray) -> np.ndarray:
    """Rows of length 1; scaled by the largest component first, so that squares cannot overflow."""
    values = values / np.abs(values).max(axis=1, keepdims=True)
    return values / np.sqrt((values * values).sum(axis=1, keepdims=True))


def spherical_kmeans(points: np.ndarray, k: int, rounds: int = 12) -> np.ndarray:
    rng = np.random.default_rng(SEED)
    centres = points[rng.permutation(len(points))[:k]]
    for _ in range(rounds):
        nearest = (points @ centres.T).argmax(axis=1)
        sums = np.zeros_like(centres)
        np.add.at(sums, nearest, points)
        size = np.sqrt((sums * sums).sum(axis=1, keepdims=True))
        centres = np.where(size > 1e-12, sums / np.maximum(size, 1e-12), centres)
    return np.unique(centres, axis=0)


def fit_cells(vectors: DataFrame, rows: int, sample: int, cell_rows: int) -> dict[int, np.ndarray]:
    """Centroids by vector length, from the first ``sample`` vectors in the order of a hash."""
    drawn = vectors.select("id", "vector").orderBy(F.xxhash64("id"), "id").limit(sample).toPandas()["vector"]
    k = max(1, min(MAX_CELLS, -(-rows // cell_rows)))
    by_length: dict[int, list] = {}
    for vector in drawn:
        by_length.setdefault(len(vector), []).append(vector)
    return {n: spherical_kmeans(unit_rows(np.array(v, float)), min(k, len(v))) for n, v in by_length.items()}


def cells_of(points: np.ndarray, centres: np.ndarray, threshold: float, reach: float) -> tuple[np.ndarray, np.ndarray]:
    """Home cell of each point, and which cells it is copied to (points x cells, home included)."""
    near = points @ centres.T
    home = near.argmax(axis=1)
    apart = np.sqrt(np.maximum(0, 2 - 2 * centres @ centres.T))
    half = reach * np.sqrt(2 - 2 * threshold) / 2
    copied = near[np.arange(len(points)), home][:, None] - near <= half * apart[home] + 1e-9
    return home, copied


def compare_blocks(group: pd.DataFrame, threshold: float) -> pd.DataFrame:
    """Links within one pair of blocks of a cell: per vector the copies it links with and a spanning link."""
    group = group.sort_values("id", ignore_index=True)
    points = np.frombuffer(b"".join(group["unit"]), float).reshape(len(group), -1)
    cell, same = group["cell"].iloc[0], group["low"].iloc[0] == group["high"].iloc[0]
    first = np.flatnonzero(group["block"] == group["low"])
    second = first if same else np.flatnonzero(group["block"] == group["high"])
    home, found = group["home"].to_numpy(), []
    homes, home_at = np.unique(home, return_inverse=True)
    visits = np.array([np.isin(homes, c) for c in group["cells"]])
    for start in range(0, len(first), 256):
        rows = first[start : start + 256]
        a, b = np.nonzero(points[rows] @ points[second].T >= threshold)
        a, b = rows[a], second[b]
        if same:
            a, b = a[a < b], b[a < b]
        # A pair can meet in two cells: the home of either, if the other visits it. The smaller of them counts.
        over_a = np.where(visits[b, home_at[a]], home[a], np.iinfo(np.int32).max)
        over_b = np.where(visits[a, home_at[b]], home[b], np.iinfo(np.int32).max)
        own = np.minimum(over_a, over_b) == cell
        found.append((a[own], b[own]))
    x, y = (np.concatenate(part) if found else np.empty(0, int) for part in zip(*found)) if found else ([], [])
    x, y = np.asarray(x, int), np.asarray(y, int)
    copies = group["copies"].to_numpy()
    links = np.bincount(x, copies[y], len(group)) + np.bincount(y, copies[x], len(group))
    root = local_roots(len(group), x, y)
    ids = group["id"].to_numpy()
    linked = links > 0
    return pd.DataFrame({"id": ids[linked], "root": ids[root[linked]], "links": links[linked].astype(np.int64)})


def near_duplicates(
    vectors: DataFrame, threshold: float = COSINE, reach: float = 1.0, sample: int = SAMPLE,
    cell_rows: int = CELL_ROWS, block: int = BLOCK, id_column: str = "vec_id", vector_column: str = "embedding",
    label_column: str = "label",
) -> DataFrame:
    """Per row: id, ``n_links``, ``component_id`` (smallest id reachable), ``kept`` (it is that id)."""
    spark = vectors.sparkSession
    rows = vectors.select(
        F.col(id_column).alias("id"), F.col(vector_column).alias("vector"), F.col(label_column).alias("label")
    )
    key = F.when(
        usable(F.col("vector"), F.col("label"), F.col("id")),
        F.struct(F.xxhash64("label", "vector"), F.xxhash64(F.lit(1), "vector", "label")),
    )
    keyed = rows.withColumn("key", key)
    sets = keyed.filter("key IS NOT NULL").groupBy("key").agg(
        F.min("id").alias("rep"), F.count("*").alias("copies"), F.first("vector").alias("vector"),
        F.first("label").alias("label"),
    )
    sets = through_table(
        sets.select("key", "rep", "copies", "vector", F.col("label").alias("label")), scratch_path(spark, "vectors")
    )
    distinct = sets.select(F.col("rep").alias("id"), "copies", "vector", "label")
    centres = fit_cells(distinct, distinct.count(), sample, cell_rows)

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pd.DataFrame]:
        for frame in batches:
            for length, part in frame.groupby(frame["vector"].map(len), sort=False):
                if length not in centres:  # longer or shorter than any vector of the sample: one cell for all
                    local = np.eye(1, length)
                else:
                    local = centres[length]
                points = unit_rows(np.array(part["vector"].tolist(), float))
                home, copied = cells_of(points, local, threshold, reach)
                yield pd.DataFrame({
                    "id": part["id"], "copies": part["copies"], "label": part["label"].astype(str) + f"/{length}",
                    "home": home.astype(np.int32), "cells": [np.flatnonzero(c).astype(np.int32) for c in copied],
                    "unit": [p.tobytes() for p in points],
                })

    id_type = dict(rows.dtypes)["id"]
    placed = distinct.mapInPandas(
        assign, f"id {id_type}, copies bigint, label string, home int, cells array<int>, unit binary"
    ).withColumn("cell", F.explode("cells"))
    placed = through_table(placed, scratch_path(spark, "cells"))
    # A row per cell; a cell that holds more than one block is compared block by block.
    sizes = placed.groupBy("label", "cell").agg(F.ceil(F.count("*") / block).cast("int").alias("blocks"))
    blocked = placed.join(sizes, ["label", "cell"]).withColumn(
        "block", F.pmod(F.xxhash64("id", "cell"), F.col("blocks")).cast("int")
    )
    paired = blocked.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).select(
        "label", "cell", F.least("block", "other").alias("low"), F.greatest("block", "other").alias("high"), "block",
        "id", "copies", "home", "cells", "unit",
    )
    found = paired.groupBy("label", "cell", "low", "high").applyInPandas(
        lambda group: compare_blocks(group, threshold), f"id {id_type}, root {id_type}, links bigint"
    )
    found = through_table(found, scratch_path(spark, "links"))
    links = found.groupBy("id").agg(F.sum("links").alias("links"))
    groups = connected(found.select(F.col("id").alias("a"), F.col("root").alias("b")))
    facts = (
        sets.select("key", "rep", "copies")
        .join(links.withColumnRenamed("id", "rep"), "rep", "left")
        .join(groups.withColumnRenamed("id", "rep"), "rep", "left")
        .select("key", (F.col("copies") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"),
                F.coalesce("component", "rep").alias("component_id"))
    )
    joined = keyed.select("id", "key").join(facts, "key", "left")
    component = F.coalesce("component_id", "id")
    return joined.select(
        F.col("id").alias(id_column), F.coalesce("n_links", F.lit(0)).cast("bigint").alias("n_links"),
        component.alias("component_id"), F.col("id").eqNullSafe(component).alias("kept"),
    )
