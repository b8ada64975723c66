"""Connected components of a distributed edge list by alternating large and small stars.

Every round hangs the neighbours of a node on the smallest of them; stars flatten in a number of rounds that grows with
the logarithm of the longest path. Minima are combined before the shuffle, a round ends in a written table (so a lost
executor costs no earlier round), and only two counts come to the driver. They say whether the edges are stars already, so
no round is run to see that nothing changes. Up to ``FEW_EDGES`` edges the minima are broadcast, the edges
stay in place, and a round is written by as many tasks as its edges call for.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ebbtide.sources.storage import scratch_path, through_table

MAX_ROUNDS = 60
FEW_EDGES = 250_000
TASK_EDGES = 20_000  # of few edges


def local_roots(n: int, x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Smallest position reachable from each of n positions over the links (x, y)."""
    root = np.arange(n)
    while True:
        old = root.copy()
        low = np.minimum(root[x], root[y])
        np.minimum.at(root, x, low)
        np.minimum.at(root, y, low)
        root = root[root]
        if np.array_equal(old, root):
            return root


def _least(pairs: DataFrame, node: str, other: str) -> DataFrame:
    return pairs.groupBy(node).agg(F.min(other).alias("least"))


def _round(edges: DataFrame, few: bool) -> DataFrame:
    """Edges (hi, lo), hi > lo, to flatter ones with the same components."""
    held = F.broadcast if few else lambda rows: rows
    both = edges.select(F.col("hi").alias("node"), F.col("lo").alias("next")).unionByName(
        edges.select(F.col("lo").alias("node"), F.col("hi").alias("next"))
    )
    nearest = _least(both, "node", "next").select("node", F.least("node", "least").alias("least"))
    large = both.join(held(nearest), "node").filter(F.col("next") > F.col("node")).select(
        F.col("next").alias("hi"), F.col("least").alias("lo")
    ).filter("hi > lo")
    large = large if few else large.distinct()
    small = large.join(held(_least(large, "hi", "lo")), "hi")
    return small.select(
        F.explode(F.array(F.struct("hi", F.col("least").alias("lo")), F.struct(F.col("lo").alias("hi"), F.col("least").alias("lo")))).alias("e")
    ).select("e.hi", "e.lo").filter("hi > lo").distinct()


def _unsettled(edges: DataFrame) -> tuple[int, int]:
    """Number of edges (hi, lo), and of the nodes that hang on several others or on one and have others hang on them."""
    nothing = F.lit(None)
    ends = edges.select(F.col("hi").alias("node"), "lo").unionByName(edges.select(F.col("lo").alias("node"), nothing.alias("lo")))
    nodes = ends.groupBy("node").agg(
        F.count("lo").alias("up"), F.count("*").alias("all"), F.min("lo").alias("least"), F.max("lo").alias("most")
    )
    loose = F.count_if((F.col("up") > 0) & ((F.col("all") > F.col("up")) | (F.col("least") < F.col("most"))))
    rows, unsettled = nodes.agg(F.sum("up"), loose).first()
    return rows or 0, unsettled


def connected(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(id, component) for every id that has an edge; the component is its smallest id.

    Loops, repeated edges and edges with a null end are ignored; no edges give an empty table.
    """
    spark = edges.sparkSession
    flat = edges.select(F.greatest(a, b).alias("hi"), F.least(a, b).alias("lo"), F.col(a).alias("x"), F.col(b).alias("y"))
    current = through_table(flat.filter("x <> y").select("hi", "lo"), scratch_path(spark, "stars"))
    for i in range(MAX_ROUNDS):
        rows, unsettled = _unsettled(current)
        if unsettled == 0:
            break
        few = rows <= FEW_EDGES
        if i == 0 and not few:  # the rounds leave no edge twice
            current = through_table(current.distinct(), scratch_path(spark, "stars"))
        found = _round(current, few)
        found = found.coalesce(-(-rows // TASK_EDGES)) if few else found
        current = through_table(found, scratch_path(spark, "stars"))
    else:
        raise RuntimeError(f"components did not settle in {MAX_ROUNDS} rounds")
    if i == 0:
        current = current.distinct()
    leaves = current.select(F.col("hi").alias("id"), F.col("lo").alias("component"))
    return leaves.unionByName(current.select(F.col("lo").alias("id"), F.col("lo").alias("component")).distinct())
