"""Trees from bins: MLlib's trees, whatever the blocks, and few jobs."""

import numpy as np
import pytest
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from ebbtide.operators import boosting as bo
from ebbtide.operators import histograms as hs
from ebbtide.operators import metrics as mt
from ebbtide.operators import models as md
from tests.planted import planted

PARAMS = {"maxIter": 5, "maxDepth": 4, "stepSize": 0.3, "subsamplingRate": 1.0, "minInstancesPerNode": 20}


@pytest.fixture(scope="module")
def encoded(spark):
    features = planted(spark, 2400)
    df = md.encode(md.fit_encoder(features), features).cache()
    yield df
    df.unpersist()


def test_rounds_are_those_of_mllib(encoded):
    """All rows and all slots: the margins of trees that MLlib grows on the same gradients, and their areas."""
    rows = encoded.select("customer_id", "split", "raw_features", "label", F.lit(0.0).alias("margin"))
    train = F.col("split") == "train"
    wanted = []
    for i in range(5):
        aims = rows.filter(train).select("raw_features", bo.gradient(F.col("label"), F.col("margin"), i == 0).alias("_gradient"))
        tree = bo.grower(PARAMS, i).fit(aims)
        rows = bo.stepped(rows, [tree], [1.0 if i == 0 else 0.3]).localCheckpoint()
        scored = rows.filter("split = 'val'").withColumn("prob_m", F.col("margin"))
        wanted.append(mt.split_summary(mt.rank_groups(mt.score_groups(mt.scored_long(scored, ["m"])), parts=1)).first().roc_auc)
    grown = bo.boost(encoded, PARAMS, patience=50, seed=0, chunk=3)
    assert grown.areas == pytest.approx(wanted, abs=1e-9)
    whole = grown.model
    assert whole.getNumTrees == grown.best and whole.numFeatures == 51


def test_draws_of_rows_and_slots(encoded):
    """A node looks at the drawn slots alone, a tree grows from its share of the rows, another seed draws others."""
    assert [bo.drawn_slots(s, 51) for s in ("all", "auto", "0.8", "sqrt", "onethird", "log2", "7")] == [51, 51, 41, 8, 17, 6, 7]
    shape = {"slots": 3, "drawn": 1, "depth": 1, "least": 1, "rate": 0.5}
    x = np.random.default_rng(0).integers(0, 5, (4000, 3)).astype(float)
    plan = hs.layout([hs.thresholds(v, c) for v, c in hs.points_of(x)])
    label = (x.sum(axis=1) > 6).astype(float)
    block = {"part": 0, "codes": np.ascontiguousarray(hs.coded(x, plan).T), "train": np.ones(4000, bool), "label": label, "margin": np.zeros(4000)}
    trees = [hs.grow(hs.Rows(block, plan, True, 0.5, seed), shape, seed) for seed in range(30)]
    assert {tree["slot"][0] for tree in trees} == {0, 1, 2}
    sizes = {tree["stats"][0][0] for tree in trees}
    assert len(sizes) > 10 and all(1800 < n < 2200 for n in sizes)
    again = hs.grow(hs.Rows(block, plan, True, 0.5, 3), shape, 3)
    assert again == trees[3]


def test_bins_hold_all_rows():
    """Few values lie in bins of their own; many in bins of equal numbers of rows, also when they come in many batches."""
    few = np.array([2.0, 0.0, 0.0, 7.0])
    (points,) = hs.points_of(few[:, None])
    assert hs.thresholds(*points).tolist() == [1.0, 4.5]
    many = np.random.default_rng(1).normal(size=40_000)
    points = []
    for batch in np.split(many, 8):
        points = hs.merged_points(points, hs.points_of(batch[:, None]))
    assert points[0][1].sum() == 40_000 and len(points[0][0]) <= 2 * hs.POINTS
    cuts = hs.thresholds(*points[0])
    inside = np.bincount(np.searchsorted(cuts, many), minlength=32)
    assert len(cuts) == 31 and abs(inside - 1250).max() < 40
    plan = hs.layout([cuts, np.array([0.5]), np.array([])])
    x = np.stack([many, (many > 1).astype(float), np.zeros(40_000)], axis=1)
    codes = hs.coded(x, plan)
    assert codes.shape == (40_000, 1) and plan["code"] == [0, 0, -1]
    assert (codes[:, 0] & 31 == np.searchsorted(cuts, many)).all() and (codes[:, 0] >> 5 == (many > 1)).all()


def test_area_counts_ties_as_half():
    assert hs.area(np.array([1.0, 0.0, 1.0, 0.0]), np.array([0.3, 0.3, 0.9, 0.1])) == 0.875
    assert hs.area(np.array([1.0]), np.array([0.3])) is None and hs.area(np.array([]), np.array([])) is None


def test_blocks_give_the_same_rounds(encoded, monkeypatch):
    """One block in one task, or several that are counted level by level."""
    one = bo.boost(encoded, PARAMS, patience=50, seed=0, chunk=3)
    monkeypatch.setattr(bo, "LEAST_ROWS", 600)
    assert bo.blocks(encoded)[0].getNumPartitions() == 3
    several = bo.boost(encoded, PARAMS, patience=50, seed=0, chunk=3)
    assert several.areas == pytest.approx(one.areas, abs=1e-9) and several.best == one.best
    monkeypatch.setattr(bo, "MOST_SENT", 2)
    assert bo.boost(encoded, PARAMS, patience=50, seed=0, chunk=5).areas == pytest.approx(one.areas, abs=1e-9)


def test_a_chunk_takes_fewer_jobs_than_rounds(spark, encoded):
    """The rows are sorted into bins once, not in every round, and rounds over one block are no jobs of their own."""
    def jobs(rounds):
        spark.sparkContext.setJobGroup(f"boost-{rounds}", "")
        grown = bo.boost(encoded, {**PARAMS, "maxIter": rounds, "maxDepth": 2}, patience=50, seed=0, chunk=20)
        assert len(grown.areas) == rounds
        return len(spark.sparkContext.statusTracker().getJobIdsForGroup(f"boost-{rounds}"))

    try:
        assert jobs(20) <= jobs(2) + 2
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)


def test_rows_without_bins_and_without_training(encoded):
    """Slots of a single value split nothing; without training rows there is nothing to fit."""
    flat = encoded.filter("split = 'train'").limit(1)
    grown = bo.boost(flat.unionByName(flat), {**PARAMS, "maxIter": 2}, patience=50, seed=0)
    assert grown.areas == [None, None] and grown.best == 1
    mean = 2.0 * flat.first().label - 1.0
    assert [n.prediction() for n in (t.rootNode() for t in grown.model._java_obj.trees())] == [mean]
    with pytest.raises(ValueError, match="no training rows"):
        bo.boost(encoded.filter("split = 'val'"), PARAMS, patience=50, seed=0)


def test_a_model_from_bins_gives_the_margins_of_its_rounds(encoded):
    grown = bo.boost(encoded, {**PARAMS, "subsamplingRate": 0.8, "featureSubsetStrategy": "0.8"}, patience=50, seed=0)
    model = grown.model.setProbabilityCol("p").setRawPredictionCol("raw")
    scored = model.transform(encoded.filter("split = 'val'")).select("customer_id", "split", "label", vector_to_array("p")[1].alias("prob_m"))
    found = mt.split_summary(mt.rank_groups(mt.score_groups(mt.scored_long(scored, ["m"])), parts=1)).first().roc_auc
    assert found == pytest.approx(grown.areas[grown.best - 1], abs=1e-12)
