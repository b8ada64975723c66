"""Fitted trees as a relation: one row per node, and what can be computed from it.

The node table is what MLlib writes when it saves a model. From it follow the probabilities, by walking every tree from
its root, and the importance of the features, as shares of the summed gains. Both are independent of MLlib's own code.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType

from ebbtide.sources.storage import scratch_path

FOREST, BOOSTED = "forest", "boosted"


def kind_of(model) -> str:
    return FOREST if "RandomForest" in type(model).__name__ else BOOSTED


def node_table(spark: SparkSession, model) -> DataFrame:
    """(tree, weight, node, feature, threshold, categories, left, right, gain, size, value) of every node.

    ``feature`` is -1 in a leaf. A row goes left when its value is at most ``threshold``, or, where that is null, among
    ``categories``. ``value`` is the share of positives in a forest and the prediction in a boosted model; ``size`` is the
    weight of the training rows that came by.
    """
    path = scratch_path(spark, "model")
    model.save(path)
    trees = spark.read.parquet(f"{path}/treesMetadata").select(F.col("_1").alias("tree"), F.col("_3").alias("weight"))
    node, split = F.col("nodeData"), F.col("nodeData.split")
    forest = kind_of(model) == FOREST
    statistics = node["impurityStats"]
    total = F.aggregate(statistics, F.lit(0.0), lambda a, b: a + b) if forest else statistics[0]
    nodes = spark.read.parquet(f"{path}/data").select(
        F.col("treeID").alias("tree"), node["id"].alias("node"), split["featureIndex"].alias("feature"),
        F.when(split["numCategories"] == -1, F.try_element_at(split["leftCategoriesOrThreshold"], F.lit(1))).alias("threshold"),
        split["leftCategoriesOrThreshold"].alias("categories"), node["leftChild"].alias("left"),
        node["rightChild"].alias("right"), node["gain"].alias("gain"), total.alias("size"),
        (F.try_divide(statistics[1], total) if forest else node["prediction"]).alias("value"),
    )
    # A row per tree: bounded by the number of trees.
    return nodes.join(F.broadcast(trees), "tree")


def probabilities(rows: DataFrame, nodes: DataFrame, kind: str, column: str, vector: str = "raw_features") -> DataFrame:
    """Adds the probability that the node table gives to every row.

    A forest averages the shares of its leaves; a boosted model is the logistic function of twice its weighted sum. The
    nodes, as many as the fitted model has whatever the number of rows, go to the tasks as arrays; all rows of a batch
    take a step of a tree at once, and as many steps as its deepest leaf is away.
    """
    # The size of the model, which the driver holds anyway.
    table = nodes.orderBy("tree", "node").toPandas()
    widest = max((len(c) for c in table["categories"] if c is not None), default=0)
    trees = []
    for _, own in table.groupby("tree", sort=True):
        at = {node: i for i, node in enumerate(own["node"])}
        feature = own["feature"].to_numpy(np.int64)
        inner = feature >= 0
        down = [np.array([at[c] if go else i for i, (c, go) in enumerate(zip(own[side], inner))]) for side in ("left", "right")]
        threshold = own["threshold"].to_numpy(np.float64, na_value=np.nan)
        members = np.full((len(own), max(1, widest)), np.nan)
        for i in np.flatnonzero(inner & np.isnan(threshold)):
            found = own["categories"].iloc[i]
            members[i, : len(found)] = found
        depth = np.zeros(len(own), np.int64)
        # Children have higher numbers than their parents.
        for i in np.flatnonzero(inner):
            depth[down[0][i]] = depth[down[1][i]] = depth[i] + 1
        named = bool((inner & np.isnan(threshold)).any())
        value = own["value"].to_numpy(np.float64, na_value=np.nan)
        trees.append((float(own["weight"].iloc[0]), int(depth.max()), np.where(inner, feature, 0), threshold, members if named else None, *down, value))
    forest = kind == FOREST
    weights = sum(tree[0] for tree in trees)

    @F.arrow_udf(DoubleType())
    def walked(slots: pa.Array) -> pa.Array:
        n = len(slots)
        if n == 0 or not trees:
            return pa.nulls(n, pa.float64())
        x = slots.flatten().to_numpy(zero_copy_only=False)
        start = np.arange(n) * (len(x) // n)
        sums = np.zeros(n)
        for weight, depth, feature, threshold, members, left, right, value in trees:
            at = np.zeros(n, np.int64)
            for _ in range(depth):
                seen = x[start + feature[at]]
                goes = seen <= threshold[at]
                if members is not None:
                    for place in range(members.shape[1]):
                        goes |= seen == members[at, place]
                at = np.where(goes, left[at], right[at])
            sums += weight * value[at]
        return pa.array(sums / weights if forest else 1.0 / (1.0 + np.exp(-2.0 * sums)))

    return rows.withColumn(column, walked(vector_to_array(vector)))


def importance_shares(nodes: DataFrame, kind: str) -> DataFrame:
    """(feature, share): summed gain, weighted by the rows of a node, as a share of all. Each tree of a forest counts 1."""
    gains = nodes.filter("feature >= 0").groupBy("tree", "feature").agg(F.sum(F.col("gain") * F.col("size")).alias("gain"))
    if kind == FOREST:
        # As many rows as trees times features.
        gains = gains.withColumn("gain", F.try_divide("gain", F.sum("gain").over(Window.partitionBy("tree"))))
    by_feature = gains.groupBy("feature").agg(F.sum("gain").alias("gain"))
    total = by_feature.agg(F.sum("gain").alias("total"))
    return by_feature.crossJoin(F.broadcast(total)).select("feature", F.try_divide("gain", F.col("total")).alias("share"))
