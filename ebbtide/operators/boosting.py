"""Boosting that continues until the ROC-AUC of the validation rows has stood still.

The values of all rows are sorted into bins once (``histograms``). Blocks of rows, as many as their number gives work to,
are kept with the bins and a margin per row. Trees are grown in chunks: within one, every round is a regression tree on the
gradients at the margins so far; the chunk ends with the margins of the next, and with the exact AUC of each of its rounds.
No tree is grown twice: the model is the first trees up to the best round, whatever was grown beyond it.

Where one block holds all rows, a chunk with its areas is one task. Rows of several blocks are counted by a job for each
level of a tree, which sends the driver counts and sums per bin, and their areas come from one pass of running sums in as
many ranges as the validation rows call for.

A lost executor costs the chunk at most. The driver holds the trees and one number a round.
"""

from __future__ import annotations

import math
import pickle
import uuid
from collections.abc import Iterator
from dataclasses import dataclass
from typing import Any

import numpy as np
import pyarrow as pa
from pyspark import RDD, StorageLevel, TaskContext
from pyspark.ml.classification import GBTClassificationModel
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import RandomForestRegressor
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ebbtide.operators import histograms as hs
from ebbtide.operators import metrics as mt
from ebbtide.sources.storage import checkpointed, remove, scratch_path, through_table

CHUNK = 25
# A level of a tree over several blocks is a job; a task counts as many rows in the time that a job takes by itself.
LEAST_ROWS = 1_000_000
# More rows are not put into one block, or into one range of the areas.
MOST_ROWS = 1_000_000
# Counts of more blocks are added up in the tasks before they go to the driver.
MOST_SENT = 32


@dataclass
class Boosted:
    """The model of the best round, the round, whether patience ended the search, and the AUC of every round grown."""

    model: GBTClassificationModel
    best: int
    stopped: bool
    areas: list[float | None]


def best_round(areas: list[float | None], patience: int) -> tuple[int, bool]:
    """Round with the highest AUC before ``patience`` rounds pass without a higher one, and whether they passed.

    Without an AUC (no validation rows, or one class) no round is better than the first.
    """
    best, highest = 0, None
    for i, area in enumerate(areas):
        if area is not None and (highest is None or area > highest):
            best, highest = i, area
        elif i - best >= patience:
            return best + 1, True
    return best + 1, False


def gradient(label: Column, margin: Column, first: bool) -> Column:
    """What the next tree is fitted to: labels as -1 and 1, then the negative gradient of the logistic loss at 2 y F.

    ``histograms.Rows`` has the same for arrays.
    """
    sign = 2.0 * label - 1.0
    return sign if first else 4.0 * sign / (1.0 + F.exp(2.0 * sign * margin))


class Grower(RandomForestRegressor):
    """A regressor that takes its one tree from a chunk of rounds, and fits any DataFrame as MLlib does."""

    def _fit(self, rows):
        return rows.tree(self) if isinstance(rows, Rounds) else super()._fit(rows)


def grower(params: dict[str, Any], seed: int) -> Grower:
    """One tree on a share of the rows, without replacement."""
    names = ("maxDepth", "minInstancesPerNode", "subsamplingRate", "featureSubsetStrategy")
    return Grower(
        featuresCol="raw_features", labelCol="_gradient", predictionCol="_step", numTrees=1, bootstrap=False, seed=seed,
        **{name: params[name] for name in names if name in params},
    )


def drawn_slots(strategy: str, slots: int) -> int:
    """How many slots a node may be split by, as MLlib counts them for a single tree."""
    named = {"auto": slots, "all": slots, "sqrt": math.ceil(math.sqrt(slots)), "onethird": math.ceil(slots / 3.0)}
    if strategy == "log2":
        return max(1, math.ceil(math.log2(slots)))
    return named[strategy] if strategy in named else min(int(strategy), slots) if strategy.isdigit() else math.ceil(float(strategy) * slots)


def shape_of(regressor: RandomForestRegressor, slots: int) -> dict[str, Any]:
    return {
        "slots": slots, "drawn": drawn_slots(regressor.getFeatureSubsetStrategy(), slots), "depth": regressor.getMaxDepth(),
        "least": regressor.getMinInstancesPerNode(), "rate": regressor.getSubsamplingRate(),
    }


def spread(rows: DataFrame, n: int | None = None) -> DataFrame:
    """The same rows in partitions that follow their number, ``n`` where it is known, in the order of their ids."""
    n, cores = rows.count() if n is None else n, rows.sparkSession.sparkContext.defaultParallelism
    parts = max(1, min(n // LEAST_ROWS, cores), -(-n // MOST_ROWS))
    return rows.repartition(parts).sortWithinPartitions("customer_id")


def _matrix(column: pa.Array) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)


def bin_plan(rows: DataFrame) -> dict[str, Any]:
    """The bins of every slot, from the different values of all training rows and how often they come."""

    def points(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: hs.Points = []
        for batch in batches:
            if batch.num_rows:
                found = hs.merged_points(found, hs.points_of(_matrix(batch.column(0))))
        yield pa.RecordBatch.from_pydict({"points": [pickle.dumps(found)]})

    values = rows.filter(F.col("split") == "train").select(vector_to_array("raw_features"))
    parts = values.mapInArrow(points, "points binary").rdd.map(lambda row: pickle.loads(row.points))
    found = parts.treeAggregate([], hs.merged_points, hs.merged_points)
    if not found:
        raise ValueError("no training rows to grow trees from")
    return hs.layout([hs.thresholds(v, c) for v, c in found])


def blocks(encoded: DataFrame) -> tuple[RDD, dict[str, Any]]:
    """Training and validation rows as blocks (see ``histograms``) with margins of 0, and where their bins are."""
    rows = encoded.filter(F.col("split").isin("train", "val"))
    plan = bin_plan(rows)

    def binned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            codes = hs.coded(_matrix(batch.column(3)), plan) if batch.num_rows else []
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], pa.array([c.tobytes() for c in codes], pa.binary())], ["customer_id", "train", "label", "codes"])

    def gathered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [batch for batch in batches if batch.num_rows]
        train, label = (np.concatenate([b.column(i).to_numpy(zero_copy_only=False) for b in held] or [np.array([])]) for i in (1, 2))
        codes = np.frombuffer(b"".join(code for b in held for code in b.column(3).to_pylist()), np.uint16)
        block = {
            "part": TaskContext.get().partitionId(), "codes": np.ascontiguousarray(codes.reshape(len(label), -1).T) if len(label) else codes.reshape(-1, 0),
            "train": train.astype(bool), "label": label.astype(float), "margin": np.zeros(len(label)),
        }
        yield pa.RecordBatch.from_pydict({"block": [pickle.dumps(block)]})

    kind = rows.schema["customer_id"].dataType.simpleString()
    narrow = rows.select("customer_id", (F.col("split") == "train").alias("train"), F.col("label").cast("double"), vector_to_array("raw_features"))
    # Counted before they are sorted into bins, which is done once.
    placed = spread(narrow.mapInArrow(binned, f"customer_id {kind}, train boolean, label double, codes binary"), rows.count())
    state = placed.mapInArrow(gathered, "block binary").rdd.map(lambda row: pickle.loads(row.block))
    return checkpointed(encoded.sparkSession, state), plan


@dataclass
class Grown:
    """A tree as lists by node, and the number of slots it was grown from."""

    nodes: hs.Tree
    numFeatures: int


class Rounds:
    """A chunk of rounds over blocks: every grower takes its tree in turn, then ``end`` gives the blocks after them."""

    def __init__(self, state: RDD, plan: dict[str, Any], todo: list[Grower], weights: list[float], start: int, spark: SparkSession) -> None:
        self.before, self.state, self.plan, self.todo, self.weights = state, state, plan, todo, weights
        self.start, self.parts, self.spark = start, state.getNumPartitions(), spark
        self.slots = len(plan["cuts"])
        self.found: list[hs.Tree] = []
        self.areas: list[float | None] = []
        self.taken = 0

    def _whole(self) -> None:
        """All rounds in the one task that has all rows."""
        plan, shape = self.plan, shape_of(self.todo[0], self.slots)
        rounds = [(g.getSeed(), weight, self.start + i == 0) for i, (g, weight) in enumerate(zip(self.todo, self.weights))]
        self.state = checkpointed(self.spark, self.before.map(lambda block: hs.grown_here(block, plan, shape, rounds)), at_once=False)
        ((self.found, self.areas),) = self.state.map(lambda block: (block["trees"], block["areas"])).collect()

    def _level_by_level(self, regressor: Grower) -> None:
        """One round over several blocks."""
        state, plan, shape, seed = self.state, self.plan, shape_of(regressor, self.slots), regressor.getSeed()
        first, weight, parts = self.start + self.taken == 0, self.weights[self.taken], self.parts

        class Counted:
            def measure(self, tree, nodes, level):
                sent = state.map(lambda block: hs.Rows(block, plan, first, shape["rate"], seed).measure(tree, nodes, level))
                add = lambda a, b: tuple(x + y for x, y in zip(a, b))
                return sent.treeReduce(add) if parts > MOST_SENT else sent.reduce(add)

        tree = hs.grow(Counted(), shape, seed)
        self.found.append(tree)
        self.state = state.map(lambda block: hs.after(block, plan, shape, (seed, weight, first), tree)).persist(StorageLevel.MEMORY_AND_DISK)
        self.state.foreach(lambda block: None)
        if state is not self.before:
            state.unpersist()

    def tree(self, regressor: Grower) -> Grown:
        if self.parts == 1 and not self.found:
            self._whole()
        elif self.parts > 1:
            self._level_by_level(regressor)
        self.taken += 1
        return Grown(self.found[self.taken - 1], self.slots)

    def _spread_areas(self) -> list[float | None]:
        names = [str(i) for i in range(len(self.todo))]

        def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for sent in batch.column(0).to_pylist():
                    label, marks = pickle.loads(sent)
                    yield pa.RecordBatch.from_arrays([pa.array(label), *map(pa.array, marks)], ["label", *[f"prob_{name}" for name in names]])

        sent = self.state.map(lambda block: (pickle.dumps((block["label"][~block["train"]], block["marks"])),))
        found = self.spark.createDataFrame(sent, "held binary").mapInArrow(rows, ", ".join(["label double", *[f"prob_{name} double" for name in names]]))
        path = scratch_path(self.spark, "margins")
        table = through_table(found, path).select(F.lit(None).cast("bigint").alias("customer_id"), F.lit("val").alias("split"), "*")
        areas = round_areas(table, names)
        remove(self.spark, path)
        return areas

    def end(self) -> tuple[RDD, list[float | None]]:
        state = self.state
        if self.parts > 1:
            self.areas = self._spread_areas()
            state = checkpointed(self.spark, self.state.map(hs.cleared))
            self.state.unpersist()
        forgotten(self.spark, self.before)
        return state, self.areas


def forgotten(spark: SparkSession, state: RDD) -> None:
    """Blocks that nothing reads any more."""
    state.unpersist()
    remove(spark, state.getCheckpointFile())


def round_areas(validation: DataFrame, rounds: list[str]) -> list[float | None]:
    """The exact AUC of each round's margins, all rounds in one relation; ``histograms.area`` is that of rows in one task."""
    ranges = max(1, -(-validation.count() * len(rounds) // MOST_ROWS))
    summary = mt.split_summary(mt.rank_groups(mt.score_groups(mt.scored_long(validation, rounds)), parts=ranges))
    found = {row.model: row.roc_auc for row in summary.select("model", "roc_auc").collect()}
    return [found.get(name) for name in rounds]


def _gathered(spark: SparkSession, grown: list, weights: list[float]):
    """The single trees of some regressors, and their weights, as the arrays that MLlib's ensembles are made of."""
    jvm, gateway = spark.sparkContext._jvm, spark.sparkContext._gateway
    kind = jvm.org.apache.spark.ml.regression.DecisionTreeRegressionModel
    trees, scales = gateway.new_array(kind, len(grown)), gateway.new_array(jvm.double, len(grown))
    for i, (tree, weight) in enumerate(zip(grown, weights)):
        trees[i], scales[i] = tree._java_obj.trees()[0], weight
    return jvm.org.apache.spark.ml, f"boosted_{uuid.uuid4().hex[:12]}", trees, scales, grown[0].numFeatures


_NODE = (
    "treeID int, nodeData struct<id: int, prediction: double, impurity: double, impurityStats: array<double>, rawCount: bigint, "
    "gain: double, leftChild: int, rightChild: int, split: struct<featureIndex: int, leftCategoriesOrThreshold: array<double>, numCategories: int>>"
)


def _node_rows(number: int, nodes: hs.Tree, cuts: list[np.ndarray]) -> Iterator[tuple]:
    """The nodes of a tree as MLlib saves them; a split is a threshold, which a value of a binary slot is held against too."""
    for i, slot in enumerate(nodes["slot"]):
        n, total, square = nodes["stats"][i]
        mean = nodes["value"][i]
        split = (slot, [float(cuts[slot][nodes["bin"][i]])], -1) if slot >= 0 else (-1, [], -1)
        impurity = max(0.0, square / n - mean * mean) if n else 0.0
        yield number, (i, mean, impurity, [n, total, square], int(n), nodes["gain"][i], nodes["left"][i], nodes["right"][i], split)


def ensemble(spark: SparkSession, grown: list[Grown], weights: list[float], cuts: list[np.ndarray]) -> GBTClassificationModel:
    """The classifier of trees that were grown one by one, put together as MLlib reads a saved one."""
    jvm, gateway = spark.sparkContext._jvm, spark.sparkContext._gateway
    ml = jvm.org.apache.spark.ml
    nothing = jvm.org.apache.spark.mllib.tree.impurity.VarianceCalculator(gateway.new_array(jvm.double, 3), 0)
    kind = ml.regression.DecisionTreeRegressionModel
    stump = kind(f"tree_{uuid.uuid4().hex[:12]}", ml.tree.LeafNode(0.0, 0.0, nothing), grown[0].numFeatures)
    trees, scales = gateway.new_array(kind, len(grown)), gateway.new_array(jvm.double, len(grown))
    for i, weight in enumerate(weights):
        trees[i], scales[i] = stump, weight
    name = f"boosted_{uuid.uuid4().hex[:12]}"
    path = scratch_path(spark, "boosted")
    GBTClassificationModel(ml.classification.GBTClassificationModel(name, trees, scales, grown[0].numFeatures, 2)).save(path)
    rows = [row for number, tree in enumerate(grown) for row in _node_rows(number, tree.nodes, cuts)]
    spark.createDataFrame(rows, _NODE, verifySchema=False).write.mode("overwrite").parquet(f"{path}/data")
    model = GBTClassificationModel.load(path).setFeaturesCol("raw_features")
    remove(spark, path)
    return model


def first_rounds(model: GBTClassificationModel, rounds: int) -> GBTClassificationModel:
    """The model that fewer rounds would have given: round by round the same trees grow, whatever number is to follow."""
    java, ml = model._java_obj, SparkSession.active().sparkContext._jvm.org.apache.spark.ml
    # A slice of a Java array is a Java array.
    trees, scales = java.trees()[:rounds], java.treeWeights()[:rounds]
    made = ml.classification.GBTClassificationModel(f"{model.uid}_{rounds}", trees, scales, model.numFeatures, 2)
    return GBTClassificationModel(made).setFeaturesCol(model.getFeaturesCol())


def stepped(rows: DataFrame, grown: list, weights: list[float]) -> DataFrame:
    """Rows with what the trees add to their margin, in one call for a row."""
    spark = rows.sparkSession
    ml, name, trees, scales, width = _gathered(spark, grown, weights)
    model = ml.regression.GBTRegressionModel(name, trees, scales, width)
    model.setFeaturesCol("raw_features").setPredictionCol("_step")
    # A Python model around it would look at every tree once more in every round.
    added = DataFrame(model.transform(rows._jdf), spark)
    return added.withColumn("margin", F.col("margin") + F.col("_step")).drop("_step")


def boost(encoded: DataFrame, params: dict[str, Any], patience: int, seed: int, chunk: int = CHUNK) -> Boosted:
    """Grow trees on the training rows until ``patience`` rounds bring no higher validation AUC, or ``maxIter`` is reached.

    ``encoded`` has customer_id, split, label and raw_features.
    """
    spark = encoded.sparkSession
    state, plan = blocks(encoded)
    grown, weights, areas = [], [], []
    while True:
        done = len(grown)
        todo = [grower(params, seed + done + i) for i in range(min(chunk, params["maxIter"] - done))]
        added = [1.0 if done + i == 0 else params["stepSize"] for i in range(len(todo))]
        rounds = Rounds(state, plan, todo, added, done, spark)
        grown += [regressor.fit(rounds) for regressor in todo]
        weights += added
        state, seen = rounds.end()
        areas += seen
        best, stopped = best_round(areas, patience)
        if stopped or len(grown) >= params["maxIter"]:
            break
    forgotten(spark, state)
    return Boosted(ensemble(spark, grown[:best], weights[:best], plan["cuts"]), best, stopped, areas)
