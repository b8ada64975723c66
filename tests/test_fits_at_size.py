"""What fits do per round and per row: partitions that follow the rows, one call for a chunk's trees."""

import pytest
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from ebbtide.operators import boosting as bo
from ebbtide.operators import metrics as mt
from ebbtide.operators import models as md
from ebbtide.operators import trees as tr
from tests.planted import planted


@pytest.fixture(scope="module")
def encoded(spark):
    features = planted(spark, 2400)
    df = md.encode(md.fit_encoder(features), features).cache()
    yield df
    df.unpersist()


def test_rows_are_spread_by_their_number(encoded, monkeypatch):
    rows = encoded.select("customer_id", "label").withColumn("copy", F.explode(F.sequence(F.lit(1), F.lit(2)))).coalesce(1)
    assert bo.spread(rows).rdd.getNumPartitions() == 1
    monkeypatch.setattr(bo, "LEAST_ROWS", 1000)
    assert bo.spread(rows).rdd.getNumPartitions() == 4
    assert bo.spread(rows).exceptAll(rows).count() == 0 == rows.exceptAll(bo.spread(rows)).count()
    monkeypatch.setattr(bo, "MOST_ROWS", 300)
    assert bo.spread(rows).rdd.getNumPartitions() == 16
    assert bo.spread(rows.limit(0)).count() == 0


def test_a_chunk_of_trees_is_added_in_one_call(encoded):
    rows = encoded.select("customer_id", "raw_features", "label", F.lit(0.25).alias("margin"))
    params = {"maxDepth": 3, "subsamplingRate": 1.0}
    trees = [bo.grower(params, seed).fit(rows.withColumn("_gradient", F.col("label") * seed)) for seed in (1, 2, 3)]
    weights, one_by_one = [1.0, 0.3, 0.3], rows
    for tree, weight in zip(trees, weights):
        one_by_one = tree.transform(one_by_one).withColumn("margin", F.col("margin") + weight * F.col("_step")).drop("_step")
    got = {r.customer_id: r.margin for r in bo.stepped(rows, trees, weights).select("customer_id", "margin").collect()}
    assert got == pytest.approx({r.customer_id: r.margin for r in one_by_one.select("customer_id", "margin").collect()}, abs=1e-12)
    plan = bo.stepped(rows, trees, weights)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("UDF(") == 1


def test_areas_take_as_many_ranges_as_they_have_rows_for(encoded, monkeypatch):
    asked = []
    rank = mt.rank_groups
    monkeypatch.setattr(mt, "rank_groups", lambda groups, parts=None, unit=1.0: asked.append(parts) or rank(groups, parts, unit))
    rows = encoded.select("customer_id", "split", "label", F.col("age").alias("prob_0"), (-F.col("age")).alias("prob_1"))
    rows = rows.filter("split = 'val'")
    few = bo.round_areas(rows, ["0", "1"])
    monkeypatch.setattr(bo, "MOST_ROWS", 100)
    assert bo.round_areas(rows, ["0", "1"]) == pytest.approx(few, abs=1e-12) and sum(few) == pytest.approx(1.0, abs=1e-12)
    assert asked == [1, -(-rows.count() * 2 // 100)]


def test_trees_are_walked_in_batches(spark, encoded):
    """Numbers and categories, trees of several depths and a single leaf, against a walk node by node."""
    slots = vector_to_array("raw_features")
    number, middle = max(((i, m) for i, m in enumerate(encoded.select(
        *[F.median(slots[i]) for i in range(31)]).first()) if encoded.filter(slots[i] > m).count()), key=lambda found: -found[0])
    columns = "tree int, weight double, node int, feature int, threshold double, categories array<double>, left int, right int, value double"
    nodes = spark.createDataFrame([
        (0, 1.0, 0, number, middle, [middle], 1, 2, 0.0), (0, 1.0, 1, -1, None, [], -1, -1, 0.5), (0, 1.0, 2, 31, None, [1.0], 3, 4, 0.0),
        (0, 1.0, 3, -1, None, [], -1, -1, -0.25), (0, 1.0, 4, -1, None, [], -1, -1, 2.0), (1, 0.5, 0, -1, None, [], -1, -1, 0.125),
    ], columns)
    walked = tr.probabilities(encoded, nodes, tr.BOOSTED, "p")
    assert "ArrowEvalPython" in walked._jdf.queryExecution().executedPlan().toString()
    own = F.when(slots[number] <= middle, 0.5).when(slots[31] == 1.0, -0.25).otherwise(2.0) + 0.5 * 0.125
    wanted = walked.select("p", (1.0 / (1.0 + F.exp(-2.0 * own))).alias("q"))
    assert wanted.filter("p IS NULL OR abs(p - q) > 1e-12").count() == 0 and wanted.select("q").distinct().count() == 3
    assert tr.probabilities(encoded.limit(0), nodes, tr.BOOSTED, "p").count() == 0
    average = tr.probabilities(encoded, nodes, tr.FOREST, "p").filter(slots[number] <= middle).select("p").distinct().collect()
    assert [r.p for r in average] == [(0.5 + 0.0625) / 1.5]


def test_points_that_differ_in_rounds_share_a_fit(encoded, monkeypatch):
    """Fewer rounds are the first trees of more rounds: the same scores as from fits of their own."""
    train = md.training_rows(encoded)
    points = md.grid_points({"maxDepth": [2, 3], "maxIter": [3, 6]})
    assert md.families("gbt", points) == [[1, 0], [3, 2]] and md.families("random_forest", points) == [[0], [1], [2], [3]]
    fits = []
    fit = GBTClassifier.fit
    monkeypatch.setattr(GBTClassifier, "fit", lambda self, rows: fits.append(self.getMaxIter()) or fit(self, rows))
    scored = md.out_of_fold("gbt", train, points, {"subsamplingRate": 0.8}, folds=2)
    assert fits == [6] * 4
    monkeypatch.setattr(md, "families", lambda name, points: [[i] for i in range(len(points))])
    alone = md.out_of_fold("gbt", train, points, {"subsamplingRate": 0.8}, folds=2)
    assert len(fits) == 4 + 8 and scored.count() == 4 * train.count()
    assert scored.exceptAll(alone).count() == 0 == alone.exceptAll(scored).count()


def test_a_forest_keeps_the_nodes_of_its_rows(encoded):
    """The same trees as of a fit that walks down from the root at every level."""
    train = md.training_rows(encoded)
    kept = md.classifier("random_forest", {"numTrees": 5, "maxDepth": 4})
    assert kept.getCacheNodeIds() and not md.classifier("gbt").getCacheNodeIds()
    trees = lambda fitted: fitted.toDebugString.split("\n", 1)[1]
    assert trees(kept.fit(train)) == trees(kept.copy().setCacheNodeIds(False).fit(train))


def test_a_search_keeps_its_rows_in_memory(encoded, monkeypatch):
    seen = []
    search = md.out_of_fold
    monkeypatch.setattr(md, "out_of_fold", lambda name, rows, *rest: seen.append((rows, rows.storageLevel.useMemory)) or search(name, rows, *rest))
    model, table = md.grid_search("logistic_regression", md.training_rows(encoded), {"regParam": [0.01, 0.1]}, folds=2)
    assert [kept for _, kept in seen] == [True] and not seen[0][0].storageLevel.useMemory
    assert table.count() == 2 and model.getRegParam() in (0.01, 0.1)
