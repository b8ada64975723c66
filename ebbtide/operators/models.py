"""Attrition classifiers on Spark MLlib.

Categories, one-hot slots and scaling are fitted once on the training rows and shared by all classifiers; scoring
chains the fitted models over one encoded relation, so no join is needed to bring their probabilities together.
"""

from __future__ import annotations

import itertools
import time
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field
from functools import reduce
from typing import Any

import numpy as np
from pyspark import inheritable_thread_target
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import GBTClassifier, LogisticRegression, RandomForestClassifier
from pyspark.ml.feature import OneHotEncoder, StandardScaler, StringIndexer, VectorAssembler
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ebbtide.operators import metrics as mt
from ebbtide.operators.boosting import boost, first_rounds
from ebbtide.sources.storage import scratch_path, through_table
from ebbtide.spec import CATEGORICAL, NUMERIC, SEED

# Names, hyper-parameters and search grids of the classifiers.
DISPLAY_NAMES = {
    "logistic_regression": "Logistic Regression (MLlib)",
    "random_forest": "Random Forest (MLlib)",
    "gbt": "Gradient Boosted Trees (MLlib)",
    "boosted_deep": "Early-stopped boosting, depth 5 (MLlib)",
    "boosted_shallow": "Early-stopped boosting, depth 4 (MLlib)",
}
PARAMS: dict[str, dict[str, Any]] = {
    "logistic_regression": {"maxIter": 100, "regParam": 0.01},
    "random_forest": {"numTrees": 100, "maxDepth": 8, "subsamplingRate": 0.8},
    "gbt": {"maxIter": 100, "maxDepth": 5, "stepSize": 0.1, "subsamplingRate": 0.8},
    "boosted_deep": {
        "maxIter": 1000, "maxDepth": 5, "stepSize": 0.03, "subsamplingRate": 0.8, "minInstancesPerNode": 40,
        "featureSubsetStrategy": "0.8",
    },
    "boosted_shallow": {
        "maxIter": 1000, "maxDepth": 4, "stepSize": 0.03, "subsamplingRate": 0.8, "featureSubsetStrategy": "0.8",
    },
}
GRIDS: dict[str, dict[str, list[Any]]] = {
    "logistic_regression": {"regParam": [0.001, 0.01, 0.1], "elasticNetParam": [0.0, 0.5]},
    "random_forest": {"maxDepth": [6, 8], "numTrees": [60, 100]},
    "gbt": {"maxDepth": [3, 5], "maxIter": [60, 120]},
}
REPORTED_PARAMS = ("regParam", "elasticNetParam", "maxIter", "maxDepth", "numTrees", "stepSize")
# What fitting reads of an encoded relation.
TRAINING_COLUMNS = ("customer_id", "split", "label", "raw_features", "features")
FOLDS = 3
PATIENCE = 50
TOP_FEATURES = 15
PARALLEL_FITS = 4
PARALLEL_SEARCH = 2

MODELS = tuple(DISPLAY_NAMES)
EARLY_STOPPED = ("boosted_deep", "boosted_shallow")
_CLASSES = {
    "logistic_regression": LogisticRegression,
    "random_forest": RandomForestClassifier,
    "gbt": GBTClassifier,
    "boosted_deep": GBTClassifier,
    "boosted_shallow": GBTClassifier,
}


@dataclass
class Fitted:
    """A fitted classifier with what the run report says about it."""

    name: str
    model: Any
    seconds: float
    params: dict[str, float] = field(default_factory=dict)
    search: DataFrame | None = None


def encoder() -> Pipeline:
    """Category index, one-hot, assembly, scaling. A category unseen in training has a slot of its own."""
    indexed = [f"{c}_idx" for c in CATEGORICAL]
    hot = [f"{c}_ohe" for c in CATEGORICAL]
    return Pipeline(
        stages=[
            StringIndexer(inputCols=list(CATEGORICAL), outputCols=indexed, handleInvalid="keep"),
            OneHotEncoder(inputCols=indexed, outputCols=hot, dropLast=False),
            VectorAssembler(inputCols=list(NUMERIC) + hot, outputCol="raw_features"),
            StandardScaler(inputCol="raw_features", outputCol="features", withMean=False, withStd=True),
        ]
    )


def training_rows(features: DataFrame) -> DataFrame:
    return features.filter(F.col("split") == "train")


def fit_encoder(features: DataFrame) -> PipelineModel:
    return encoder().fit(training_rows(features))


def encode(encoding: PipelineModel, features: DataFrame) -> DataFrame:
    labelled = features.withColumn("label", F.col("label").cast("double"))
    return encoding.transform(labelled).drop(*[f"{c}_idx" for c in CATEGORICAL], *[f"{c}_ohe" for c in CATEGORICAL])


def slot_names(encoded: DataFrame) -> list[str]:
    groups = encoded.schema["raw_features"].metadata["ml_attr"]["attrs"]
    slots = {slot["idx"]: slot["name"] for members in groups.values() for slot in members}
    return [slots[i] for i in range(len(slots))]


def classifier(name: str, overrides: dict[str, Any] | None = None):
    if name not in _CLASSES:
        raise ValueError(f"unknown model {name!r}; choose from {', '.join(MODELS)}")
    params = {**PARAMS[name], **(overrides or {})}
    if name == "logistic_regression":
        return LogisticRegression(featuresCol="features", labelCol="label", **params)
    chosen = _CLASSES[name](featuresCol="raw_features", labelCol="label", seed=SEED, **params)
    # The trees of a forest grow together: rows keep the node they are at in each instead of walking down anew at every level.
    return chosen.setCacheNodeIds(True) if name == "random_forest" else chosen


def grid_points(grid: dict[str, list[Any]]) -> list[dict[str, Any]]:
    return [dict(zip(grid, values)) for values in itertools.product(*grid.values())]


def families(name: str, points: list[dict[str, Any]]) -> list[list[int]]:
    """Numbers of the points that one fit serves, the one to be fitted first.

    Boosting with fewer rounds gives the first trees of boosting with more, so points that differ in nothing else are one
    family; any other classifier has families of one.
    """
    found: dict[Any, list[int]] = {}
    for i, point in enumerate(points):
        shared = tuple(sorted((k, v) for k, v in point.items() if k != "maxIter")) if name == "gbt" and "maxIter" in point else i
        found.setdefault(shared, []).append(i)
    return [sorted(members, key=lambda i: -points[i].get("maxIter", 0)) for members in found.values()]


def out_of_fold(name: str, train: DataFrame, points: list[dict[str, Any]], overrides=None, folds: int = FOLDS) -> DataFrame:
    """(model, split, customer_id, label, score): what every grid point, fitted without a fold, gives the rows of that fold.

    ``model`` is the number of the point, ``split`` that of the fold. Folds come from a hash of the id, so a re-run has the
    same ones. The fits run a few at a time, one for a family of points, and one job scores and writes them all.
    """
    fold = F.pmod(F.xxhash64(F.lit("fold"), "customer_id"), F.lit(folds)).cast("int")
    rows = train.withColumn("fold", fold)

    def one(task: tuple[list[int], int]) -> list[DataFrame]:
        family, left_out = task
        whole = classifier(name, {**(overrides or {}), **points[family[0]]}).fit(rows.filter(F.col("fold") != left_out))
        scored = []
        for point in family:
            model = whole if point == family[0] else first_rounds(whole, points[point]["maxIter"])
            found = model.setProbabilityCol("_probability").transform(rows.filter(F.col("fold") == left_out))
            scored.append(found.select(
                F.lit(str(point)).alias("model"), F.lit(str(left_out)).alias("split"), "customer_id",
                F.col("label").cast("int").alias("label"), vector_to_array("_probability")[1].alias("score"),
            ))
        return scored

    tasks = list(itertools.product(families(name, points), range(folds)))
    with ThreadPoolExecutor(max_workers=PARALLEL_SEARCH) as pool:
        scored = list(pool.map(inheritable_thread_target(train.sparkSession)(one), tasks))
    return reduce(DataFrame.unionByName, itertools.chain(*scored))


def search_table(scored: DataFrame, points: list[dict[str, Any]]) -> DataFrame:
    """(point, parameters, folds, n, positives, mean_auc, rank): every grid point with its exact AUC, mean of the folds.

    Rank 1 is the winner, the highest mean, the first of equal ones. Folds with a single class have no AUC.
    """
    spark = scored.sparkSession
    summary = mt.split_summary(mt.rank_groups(mt.score_groups(scored)))
    means = summary.groupBy(F.col("model").cast("int").alias("point")).agg(
        F.count("*").alias("folds"), F.sum("n").alias("n"), F.sum("positives").alias("positives"), F.avg("roc_auc").alias("mean_auc")
    )
    # A row per grid point.
    named = spark.createDataFrame(
        [(i, {k: float(v) for k, v in point.items()}) for i, point in enumerate(points)], "point int, parameters map<string,double>"
    )
    order = Window.orderBy(F.col("mean_auc").desc_nulls_last(), "point")
    return named.join(means, "point").withColumn("rank", F.row_number().over(order)).select(
        "point", "parameters", "folds", "n", "positives", "mean_auc", "rank"
    )


def grid_search(name: str, train: DataFrame, grid: dict[str, list[Any]], overrides=None, folds: int = FOLDS):
    """The model of the best grid point, fitted to all training rows, and the table of all points.

    The rows stay in memory, on disk beyond it, while the fits pass over them.
    """
    spark, points = train.sparkSession, grid_points(grid)
    kept = train.select(*TRAINING_COLUMNS).persist()
    try:
        scored = through_table(out_of_fold(name, kept, points, overrides, folds), scratch_path(spark, "out-of-fold"))
        table = through_table(search_table(scored, points), scratch_path(spark, "search"))
        best = table.filter("rank = 1").first().point
        return classifier(name, {**(overrides or {}), **points[best]}).fit(kept), table
    finally:
        kept.unpersist()


def stationarity(scored: DataFrame, model, probability: str, regularisation: float) -> DataFrame:
    """(slot, coefficient, residual): how far a logistic regression with an L2 penalty is from its optimum.

    The residual of a slot is |mean((p - y) x) + regularisation * coefficient| over the training rows, that of the
    intercept (slot -1) the mean of p - y. All are 0 at the optimum; one pass and one sum per slot find them.
    """
    error = F.col(probability) - F.col("label")
    rows = scored.select(error.alias("error"), F.posexplode(F.array_append(vector_to_array("features"), F.lit(1.0))).alias("slot", "x"))
    width = model.numFeatures
    slot = F.when(F.col("slot") == width, -1).otherwise(F.col("slot")).alias("slot")
    means = rows.groupBy(slot).agg(F.avg(F.col("error") * F.col("x")).alias("gradient"))
    values = [(-1, float(model.intercept), 0.0)] + [(i, float(w), regularisation) for i, w in enumerate(model.coefficients)]
    # A row per slot.
    weights = scored.sparkSession.createDataFrame(values, "slot int, coefficient double, penalty double")
    return weights.join(means, "slot").select(
        "slot", "coefficient", F.abs(F.col("gradient") + F.col("penalty") * F.col("coefficient")).alias("residual")
    )


def fit(
    name: str,
    encoded: DataFrame,
    tune: bool = False,
    overrides: dict[str, Any] | None = None,
    grid: dict[str, list[Any]] | None = None,
    folds: int = FOLDS,
    patience: int = PATIENCE,
) -> Fitted:
    """Fit one classifier on the training rows of an encoded relation."""
    train = training_rows(encoded)
    started = time.monotonic()
    search = None
    if name in EARLY_STOPPED:
        grown = boost(encoded, {**PARAMS[name], **(overrides or {})}, patience, SEED)
        model = grown.model
        params = {"best_iteration": float(grown.best), "stopped": float(grown.stopped), "rounds_grown": float(len(grown.areas))}
    else:
        if tune:
            model, search = grid_search(name, train, grid or GRIDS[name], overrides, folds)
        else:
            model = classifier(name, overrides).fit(train)
        params = fitted_params(model)
    return Fitted(name, model, round(time.monotonic() - started, 1), params, search)


def fit_all(
    names: tuple[str, ...],
    encoded: DataFrame,
    tune: bool = False,
    overrides: dict[str, dict[str, Any]] | None = None,
    patience: int = PATIENCE,
    parallelism: int = PARALLEL_FITS,
) -> list[Fitted]:
    """Fit several classifiers, ``parallelism`` at a time; their many short jobs then share the executors."""

    def one(name: str) -> Fitted:
        return fit(
            name, encoded, tune=tune and name in GRIDS, overrides=(overrides or {}).get(name), patience=patience
        )

    in_session = inheritable_thread_target(encoded.sparkSession)
    with ThreadPoolExecutor(max_workers=parallelism) as pool:
        return list(pool.map(in_session(one), names))


def fitted_params(model) -> dict[str, float]:
    found = {param.name: value for param, value in model.extractParamMap().items()}
    return {name: float(found[name]) for name in REPORTED_PARAMS if name in found}


def score(encoded: DataFrame, fitted: list[Fitted]) -> DataFrame:
    """Add ``prob_<model>`` for every customer: one pass, one chain of transformations.

    Trees look slots up at every node, which in a sparse vector is a search, so they get dense ones.
    """
    scored = encoded.withColumn("raw_features", array_to_vector(vector_to_array("raw_features")))
    for item in fitted:
        vector = f"_probability_{item.name}"
        model = item.model.copy()
        model.setRawPredictionCol(f"_raw_{item.name}")
        model.setProbabilityCol(vector)
        model.setPredictionCol("")
        scored = (
            model.transform(scored)
            .withColumn(f"prob_{item.name}", vector_to_array(vector)[1])
            .drop(vector, f"_raw_{item.name}")
        )
    return scored.drop("raw_features", "features")


def importance(spark: SparkSession, item: Fitted, names: list[str], k: int = TOP_FEATURES) -> DataFrame:
    """(model, feature, importance): the ``k`` largest shares of |coefficient| or tree importance.

    Works on one number per feature slot, which the fitted model holds on the driver anyway.
    """
    raw = item.model.coefficients if hasattr(item.model, "coefficients") else item.model.featureImportances
    weights = np.abs(raw.toArray())
    total = float(weights.sum())
    rows = [(item.name, name, float(w) / total if total else 0.0) for name, w in zip(names, weights)]
    return (
        spark.createDataFrame(rows, "model string, feature string, importance double")
        .orderBy(F.desc("importance"), "feature")
        .limit(k)
        .withColumn("importance", F.round("importance", 5))
    )
