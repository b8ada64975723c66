"""Models on planted signal, and the end-to-end job."""

import math

import duckdb
import pytest
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import RandomForestRegressor
from pyspark.sql import functions as F

from ebbtide.operators import boosting as bo
from ebbtide.operators import metrics as mt
from ebbtide.operators import models as md
from ebbtide.operators import reports as rp
from ebbtide.operators import trees as tr
from ebbtide.plans.evaluation import comparison_table, read_document
from ebbtide.plans import reports
from ebbtide.plans.job import run
from ebbtide.sources import storage as st
from ebbtide.sources import testdata as td
from ebbtide.sources.schemas import SchemaError
from ebbtide.spec import NUMERIC
from tests.conftest import SF_SMALL
from tests.planted import SIGNAL, planted

FITS = {
    "logistic_regression": {"maxIter": 30},
    "random_forest": {"numTrees": 15, "maxDepth": 5},
    "gbt": {"maxIter": 10, "maxDepth": 3},
    "boosted_deep": {"maxIter": 24, "maxDepth": 3, "stepSize": 0.2},
    "boosted_shallow": {"maxIter": 24, "maxDepth": 2, "stepSize": 0.2},
}


@pytest.fixture(scope="module")
def encoded(spark):
    features = planted(spark, 2400)
    df = md.encode(md.fit_encoder(features), features).cache()
    yield df
    df.unpersist()


def held_out_auc(scored, name):
    long = mt.scored_long(scored, [name]).filter("split = 'test'")
    return mt.split_summary(mt.rank_groups(mt.score_groups(long), parts=4)).first().roc_auc


@pytest.mark.parametrize("name", md.MODELS)
def test_models_find_planted_signal(encoded, name):
    fitted = md.fit(name, encoded, overrides=FITS[name], patience=6)
    scored = md.score(encoded, [fitted])
    assert scored.count() == 2400 and scored.filter(f"prob_{name} < 0 or prob_{name} > 1").count() == 0
    assert held_out_auc(scored, name) > 0.75


def test_shuffled_labels_give_no_signal(spark):
    features = planted(spark, 3000, shuffled_labels=True)
    encoded = md.encode(md.fit_encoder(features), features)
    fitted = md.fit("logistic_regression", encoded, overrides={"maxIter": 20, "regParam": 0.1})
    assert abs(held_out_auc(md.score(encoded, [fitted]), "logistic_regression") - 0.5) < 0.08


def test_slots_and_importance(spark, encoded):
    names = md.slot_names(encoded)
    assert names[: len(NUMERIC)] == list(NUMERIC)
    assert len(names) == len(NUMERIC) + 5 * 4 and names[len(NUMERIC)].startswith("contract_ohe_")
    fitted = md.fit("random_forest", encoded, overrides=FITS["random_forest"])
    rows = md.importance(spark, fitted, names).collect()
    assert len(rows) == 15 and [r.importance for r in rows] == sorted((r.importance for r in rows), reverse=True)
    assert {r.feature for r in rows[:5]} <= set(SIGNAL)
    assert rp.labelled_importance(md.importance(spark, fitted, names)).first().label == rows[0].feature.replace("_", " ")


NUMBER_SLOTS = [
    "age", "tenure_months", "monthly_charges", "total_charges", "avg_call_minutes", "avg_data_gb", "avg_sms", "avg_app_logins",
    "minutes_trend", "data_trend", "logins_trend", "late_payments", "late_payment_ratio", "avg_days_late", "max_days_late",
    "late_payments_recent", "ticket_count", "complaint_count", "escalated_count", "billing_tickets", "network_tickets",
    "cancellation_inquiries", "avg_resolution_hours", "avg_satisfaction", "tickets_last_30d", "call_count", "avg_call_duration",
    "unresolved_calls", "avg_sentiment", "calls_last_30d", "contacts_per_month",
]


def test_slot_names_in_full(encoded):
    """Numbers in their order, then the categories, each with its values, the unknown one last."""
    names = md.slot_names(encoded)
    assert names[:31] == NUMBER_SLOTS
    for i, column in enumerate(["contract", "plan", "internet_service", "payment_method", "region"]):
        block = names[31 + 4 * i : 35 + 4 * i]
        assert sorted(block[:3]) == [f"{column}_ohe_{column}-{k}" for k in range(3)] and block[3] == f"{column}_ohe___unknown"
    assert len(names) == 51


def test_unseen_category_has_its_own_slot(spark, encoded):
    features = planted(spark, 300)
    encoding = md.fit_encoder(features)
    odd = features.withColumn("contract", F.lit("never seen"))
    assert md.encode(encoding, odd).count() == 300


def test_search_reports_the_winner(encoded):
    fitted = md.fit(
        "logistic_regression", encoded, tune=True, overrides={"maxIter": 10},
        grid={"regParam": [0.01, 100.0], "elasticNetParam": [0.5]}, folds=2,
    )
    assert fitted.params["regParam"] == 0.01


def test_every_point_is_judged_on_all_training_rows(spark, encoded):
    """The table of a search, against areas counted pair by pair."""
    train = md.training_rows(encoded)
    points = md.grid_points({"regParam": [0.01, 100.0], "elasticNetParam": [0.5]})
    assert points == [{"regParam": 0.01, "elasticNetParam": 0.5}, {"regParam": 100.0, "elasticNetParam": 0.5}]
    scored = md.out_of_fold("logistic_regression", train, points, {"maxIter": 10}, folds=2).persist()
    assert scored.count() == 2 * train.count() == scored.select("model", "customer_id").distinct().count()
    table = {row.point: row for row in md.search_table(scored, points).collect()}
    for point in (0, 1):
        areas = []
        for fold in ("0", "1"):
            rows = scored.filter((F.col("model") == str(point)) & (F.col("split") == fold)).collect()
            up, down = ([r.score for r in rows if r.label == y] for y in (1, 0))
            areas.append(sum((a > b) + (a == b) / 2 for a in up for b in down) / (len(up) * len(down)))
        assert table[point].mean_auc == pytest.approx(sum(areas) / 2, abs=1e-12)
        assert table[point].folds == 2 and table[point].n == train.count()
    assert [table[0].rank, table[1].rank] == [1, 2]
    scored.unpersist()


@pytest.mark.parametrize(
    "areas, patience, expected",
    [
        ([0.5, 0.6, 0.7], 2, (3, False)),
        ([0.5, 0.6, 0.55, 0.54, 0.9], 2, (2, True)),
        ([0.5, 0.6, 0.55, 0.61, 0.6], 3, (4, False)),
        ([0.5, 0.5, 0.5], 2, (1, True)),
        ([None, None, None], 2, (1, True)),
    ],
)
def test_best_round(areas, patience, expected):
    assert bo.best_round(areas, patience) == expected


BOOST = {"maxIter": 16, "maxDepth": 4, "stepSize": 0.9, "subsamplingRate": 0.8}


def test_boosting_stops_by_area_and_grows_no_tree_twice(encoded, monkeypatch):
    fits = []
    fit = RandomForestRegressor.fit
    monkeypatch.setattr(RandomForestRegressor, "fit", lambda self, rows: fits.append(self.getSeed()) or fit(self, rows))
    grown = bo.boost(encoded, BOOST, patience=3, seed=1, chunk=4)
    assert grown.stopped and len(fits) == len(set(fits)) == len(grown.areas) <= 16
    seen = grown.areas[: grown.best + 3]  # what lies beyond was grown in the same chunk, too late to count
    assert grown.model.getNumTrees == grown.best == seen.index(max(seen)) + 1
    assert len(grown.areas) - grown.best < 3 + 4
    # The model's own scores have the area that the search saw.
    item = md.Fitted("boosted_deep", grown.model, 0.0)
    scored = mt.scored_long(md.score(encoded, [item]), ["boosted_deep"]).filter("split = 'val'")
    assert mt.split_summary(mt.rank_groups(mt.score_groups(scored))).first().roc_auc == pytest.approx(max(seen), abs=1e-12)


def test_boosting_continues_from_its_margins(encoded):
    """Chunks of any size give the same rounds; all rows are used, as a sample depends on how they lie."""
    params = {**BOOST, "maxIter": 6, "stepSize": 0.1, "subsamplingRate": 1.0}
    one, other = (bo.boost(encoded, params, patience=50, seed=1, chunk=chunk) for chunk in (6, 2))
    assert one.areas == pytest.approx(other.areas, abs=1e-12) and len(one.areas) == 6 and not one.stopped


def test_boosting_without_validation_rows(encoded):
    grown = bo.boost(encoded.filter("split = 'train'"), {**BOOST, "maxIter": 9}, patience=2, seed=1, chunk=3)
    assert grown.best == 1 and grown.stopped and grown.areas == [None] * 3


def test_gradients_are_those_of_the_logistic_loss(spark):
    rows = [(y, f) for y in (0.0, 1.0) for f in (-2.0, 0.0, 0.7)]
    df = spark.createDataFrame(rows, "label double, margin double")
    got = [r[0] for r in df.select(bo.gradient(F.col("label"), F.col("margin"), False)).collect()]

    def loss(y, f):
        return 2.0 * math.log1p(math.exp(-2.0 * (2.0 * y - 1.0) * f))

    assert got == pytest.approx([-(loss(y, f + 1e-6) - loss(y, f - 1e-6)) / 2e-6 for y, f in rows], abs=1e-6)


@pytest.mark.parametrize("name", ["random_forest", "gbt", "boosted_deep"])
def test_node_tables_give_the_probabilities(spark, encoded, name, tmp_path):
    """In DataFrame functions, and in another engine that reads the exported nodes and encoded rows."""
    fitted = md.fit(name, encoded, overrides=FITS[name], patience=6)
    nodes = st.through_table(tr.node_table(spark, fitted.model), str(tmp_path / "nodes"))
    kind = tr.kind_of(fitted.model)
    both = md.score(tr.probabilities(encoded, nodes, kind, "walked"), [fitted])
    assert both.filter(f"abs(walked - prob_{name}) > 1e-9 OR walked IS NULL").count() == 0
    both.select("customer_id", f"prob_{name}").write.parquet(str(tmp_path / "scores"))
    encoded.select("customer_id", vector_to_array("raw_features").alias("x")).write.parquet(str(tmp_path / "rows"))
    sums = "AVG(value)" if kind == tr.FOREST else "1 / (1 + exp(-2 * SUM(weight * value)))"
    wrong = duckdb.sql(
        f"""WITH RECURSIVE nodes AS (FROM '{tmp_path}/nodes/*.parquet'), walk AS (
          SELECT customer_id, x, tree, 0 AS node FROM '{tmp_path}/rows/*.parquet', (SELECT DISTINCT tree FROM nodes)
          UNION ALL
          SELECT customer_id, x, w.tree, CASE WHEN (n.threshold IS NOT NULL AND x[n.feature + 1] <= n.threshold)
                 OR (n.threshold IS NULL AND list_contains(n.categories, x[n.feature + 1])) THEN n."left" ELSE n."right" END
          FROM walk AS w JOIN nodes AS n ON n.tree = w.tree AND n.node = w.node WHERE n.feature >= 0),
        scored AS (SELECT customer_id, {sums} AS p FROM walk JOIN nodes USING (tree, node) WHERE feature < 0 GROUP BY 1)
        SELECT COUNT(*) FILTER (WHERE abs(p - prob_{name}) <= 1e-9), COUNT(*) FROM scored JOIN '{tmp_path}/scores/*.parquet' USING (customer_id)"""
    ).fetchall()[0]
    assert wrong == (2400, 2400)


@pytest.mark.parametrize("name", ["random_forest", "gbt"])
def test_importance_from_nodes(spark, encoded, name):
    fitted = md.fit(name, encoded, overrides=FITS[name])
    nodes = tr.node_table(spark, fitted.model)
    got = {row.feature: row.share for row in tr.importance_shares(nodes, tr.kind_of(fitted.model)).collect()}
    want = fitted.model.featureImportances
    assert {i: got.get(i, 0.0) for i in range(want.size)} == pytest.approx(dict(enumerate(want.toArray())), abs=1e-12)


def test_logistic_regression_is_at_its_optimum(spark, encoded):
    fitted = md.fit("logistic_regression", encoded, overrides={"maxIter": 200})
    train = md.score(encoded.withColumn("x", F.col("features")), [fitted]).withColumnRenamed("x", "features").filter("split = 'train'")
    found = md.stationarity(train, fitted.model, "prob_logistic_regression", 0.01).collect()
    assert len(found) == fitted.model.numFeatures + 1 and max(row.residual for row in found) < 1e-4
    # Weights that are off by a little are told apart.
    moved = md.Fitted("logistic_regression", fitted.model, 0.0)
    assert max(r.residual for r in md.stationarity(train, moved.model, "prob_logistic_regression", 0.05).collect()) > 1e-3


def test_unknown_model():
    with pytest.raises(ValueError, match="unknown model"):
        md.classifier("perceptron")


def test_job_end_to_end(spark, tmp_path):
    tables = td.relations(td.Source(spark, SF_SMALL))
    names = ("logistic_regression", "random_forest", "boosted_shallow")
    paths = run(
        tables, str(tmp_path / "out"), td.SPEC, names, split_hash="md5", overrides=FITS,
        raw_label="/home/someone/data/raw", parts=4,
    )
    scores = spark.read.parquet(paths["scores"])
    assert scores.count() == 150 and scores.select("customer_id").distinct().count() == 150
    assert {f"prob_{n}" for n in names} <= set(scores.columns)
    document = read_document(spark, paths["report"])
    report = document.first()
    assert report.table_rows == {"customers": 150, "usage": 657, "payments": 705, "tickets": 1747, "service_calls": 1000}
    assert report.n_customers == 150 and sum(report.split_sizes.values()) == 150 and report.n_features == 36
    assert report.raw_source == "data/raw" and report.band_cutoffs == {"high": 0.5, "medium": 0.25}
    assert set(report.models) == set(names) and report.best_model in names
    best = max(report.models.values(), key=lambda m: m.validation_roc_auc)
    assert best.display_name == report.models[report.best_model].display_name
    assert len(report.models["random_forest"].importance) == 15
    assert report.models["boosted_shallow"].params["best_iteration"] >= 1
    confusion = report.models["random_forest"].at_tuned.confusion
    assert confusion.tp + confusion.fp + confusion.fn + confusion.tn == report.split_sizes["test"]
    # A saved report leads to the same comparison as the evaluation it was made of.
    table = {r.model: r.roc_auc for r in comparison_table(document).collect()}
    assert table == {r.model: r.roc_auc for r in spark.read.parquet(paths["evaluation"]).collect()}
    # Bands and predictions follow from the exported, rounded probability.
    wrong = scores.filter(
        (F.col("predicted_churn") == 1) != (F.col("churn_probability") >= F.lit(report.best_threshold))
    )
    assert wrong.count() == 0
    assert scores.filter(F.col("churn_probability") != F.col(f"prob_{report.best_model}")).count() == 0


def test_reports_over_a_stored_run(spark, tmp_path):
    tables = td.relations(td.Source(spark, SF_SMALL))
    names = ("logistic_regression", "random_forest")
    paths = run(tables, str(tmp_path / "out"), td.SPEC, names, split_hash="md5", overrides=FITS)
    written = reports.run(spark, paths["scores"], paths["report"], str(tmp_path / "reports"))
    read = {name: spark.read.parquet(path) for name, path in written.items() if name != "export"}
    assert read["kpis"].first().customers == 150 and read["histogram"].count() == 40
    assert {r.display_name for r in read["comparison"].collect()} == {md.DISPLAY_NAMES[n] for n in names}
    assert read["gains"].select("model").distinct().count() == 2 and read["tables"].count() == 5
    assert read["importance"].count() == 30 and read["confusion"].count() == 2
    scores = spark.read.parquet(paths["scores"])
    found, by_model = reports.customer_report(scores, " 7 ")
    assert found.count() == 1 and {r.model for r in by_model.collect()} == {md.DISPLAY_NAMES[n] for n in names}
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(customer_key,7)" in plan
    # Reports start from the scores alone.
    plan = reports.score_reports(scores)["segments"]._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1
    assert not (tmp_path / "out" / "_checkpoints").exists() or not any((tmp_path / "out" / "_checkpoints").iterdir())


def test_job_refuses_repeated_customers(spark, tmp_path):
    tables = td.relations(td.Source(spark, SF_SMALL))
    tables["customers"] = tables["customers"].union(tables["customers"])
    with pytest.raises(SchemaError, match="repeated"):
        run(tables, str(tmp_path), td.SPEC, ("logistic_regression",))
