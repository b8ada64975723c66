"""Every operator as a query over the test tables: name -> (spark, sf_dir) -> DataFrame."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ebbtide.operators import features as ft
from ebbtide.operators import metrics as mt
from ebbtide.operators import models as md
from ebbtide.operators import normalize as nm
from ebbtide.operators import reports as rp
from ebbtide.operators import resample as rs
from ebbtide.operators import trees as tr
from ebbtide.operators.scoring import risk_scores
from ebbtide.plans.evaluation import comparison_table, evaluate, metrics_document, read_document
from ebbtide.plans.job import as_map, source_label, training_facts
from ebbtide.sources import storage
from ebbtide.sources import testdata as td
from ebbtide.sources.schemas import CONTRACTS
from ebbtide.sources.tables import load_tables, register, table_counts
from ebbtide.spec import CATEGORICAL, HIGH_CUTOFF, MEDIUM_CUTOFF, NUMERIC, TABLES

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
BASIS = 10_000.0


def query(function: Query) -> Query:
    QUERIES[function.__name__] = function
    return function


# ---- building blocks


def _features(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ft.feature_table(td.relations(td.Source(spark, sf_dir)), td.SPEC, split_hash="md5")


def _scored(spark: SparkSession, sf_dir: str) -> DataFrame:
    return td.surrogate_scored(td.Source(spark, sf_dir))


def _ranked(spark: SparkSession, sf_dir: str, *splits: str) -> DataFrame:
    scored = _scored(spark, sf_dir).filter(F.col("split").isin(*splits))
    return mt.rank_groups(mt.score_groups(scored), unit=BASIS)


def _choice(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mt.pick_best(mt.split_summary(_ranked(spark, sf_dir, "val")))


_STORED: dict[tuple, str] = {}


def _scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The scores table, written once per application and state of the input; reports read it like a finished run's."""
    stamps = [storage.stamp(spark, f"{sf_dir}/{table}.parquet") for table in td.SCHEMAS]
    key = (spark.sparkContext.applicationId, sf_dir, *stamps)
    if key not in _STORED:
        wide = td.surrogate_wide(_features(spark, sf_dir))
        choice = storage.through_table(_choice(spark, sf_dir), storage.scratch_path(spark, "choice"))
        path = storage.scratch_path(spark, "scores")
        storage.write_scores(risk_scores(wide, td.SURROGATES, choice, td.SPEC, unit=BASIS), path)
        _STORED[key] = path
    return spark.read.parquet(_STORED[key])


def _encoded(spark: SparkSession, sf_dir: str) -> DataFrame:
    features = _features(spark, sf_dir)
    # Fitting passes over the rows repeatedly, so they are written once.
    features = storage.through_table(features, storage.scratch_path(spark, "features"))
    encoded = md.encode(md.fit_encoder(features), features)
    return storage.through_table(encoded, storage.scratch_path(spark, "encoded"))


def _fit(encoded: DataFrame, *names: str) -> list[md.Fitted]:
    """With the published parameters; encoded rows stay in memory while the models pass over them."""
    kept = encoded.select(*md.TRAINING_COLUMNS).persist()
    try:
        return md.fit_all(names, kept)
    finally:
        kept.unpersist()


# ---- sources and cleaning


@query
def ingest_counts(spark, sf_dir):
    return table_counts(register(td.relations(td.Source(spark, sf_dir))))


def _fingerprint(tables) -> DataFrame:
    """Per table: rows, customers, sum of a measure, missing measures, first and last day."""
    described = {
        "customers": ("monthly_charges", "signup_date"), "usage": ("call_minutes", "month"),
        "payments": ("days_late", "due_date"), "tickets": ("satisfaction", "created_date"),
        "service_calls": ("sentiment", "call_date"),
    }
    parts = None
    for table, (measure, day) in described.items():
        part = tables[table].agg(
            F.count(F.lit(1)).alias("row_count"),
            F.countDistinct("customer_id").alias("customers"),
            F.sum(F.col(measure).cast("double")).alias("measure_sum"),
            F.count_if(F.col(measure).isNull()).alias("measure_missing"),
            F.min(day).alias("first_day"),
            F.max(day).alias("last_day"),
        ).select(F.lit(table).alias("table_name"), "*")
        parts = part if parts is None else parts.unionByName(part)
    return parts


@query
def csv_roundtrip(spark, sf_dir):
    """All relations written as CSV with a header and read back with typed columns."""
    base = storage.scratch_path(spark, "csv")
    for name, df in td.relations(td.Source(spark, sf_dir)).items():
        storage.write_csv(df, f"{base}/{name}.csv")
    return _fingerprint(load_tables(spark, base, "csv", id_type="bigint"))


@query
def norm_customers(spark, sf_dir):
    return nm.normalize_customers(td.raw_customers(td.Source(spark, sf_dir)), td.SPEC)


@query
def bootstrap_customers(spark, sf_dir):
    """Twice as many rows as there are customers, charges as they are."""
    customers = nm.normalize_customers(td.raw_customers(td.Source(spark, sf_dir)), td.SPEC)
    return rs.bootstrap_customers(customers, 2 * customers.count(), jitter=False)


@query
def bootstrap_jitter(spark, sf_dir):
    customers = nm.normalize_customers(td.raw_customers(td.Source(spark, sf_dir)), td.SPEC)
    return rs.bootstrap_customers(customers, 2 * customers.count()).select(
        "customer_id", "source_customer_id", "monthly_charges"
    )


@query
def label_rate(spark, sf_dir):
    return nm.outcome_rate(td.customers(td.Source(spark, sf_dir)))


# ---- features


@query
def usage_features(spark, sf_dir):
    return ft.usage_features(td.usage(td.Source(spark, sf_dir)), td.SPEC)


@query
def payment_features(spark, sf_dir):
    return ft.payment_features(td.payments(td.Source(spark, sf_dir)), td.SPEC)


@query
def ticket_features(spark, sf_dir):
    return ft.ticket_features(td.tickets(td.Source(spark, sf_dir)), td.SPEC)


@query
def call_features(spark, sf_dir):
    return ft.call_features(td.service_calls(td.Source(spark, sf_dir)), td.SPEC)


@query
def feature_table(spark, sf_dir):
    return _features(spark, sf_dir)


@query
def split_assignment(spark, sf_dir):
    return ft.split_assignment(td.customers(td.Source(spark, sf_dir)), split_hash="md5")


@query
def split_xxhash(spark, sf_dir):
    return ft.split_assignment(td.customers(td.Source(spark, sf_dir)))


@query
def split_profile(spark, sf_dir):
    return ft.split_profile(_features(spark, sf_dir))


# ---- metrics over the surrogate scores


@query
def roc_auc(spark, sf_dir):
    return mt.split_summary(_ranked(spark, sf_dir, "val", "test")).select("model", "split", "n", "positives", "roc_auc")


@query
def average_precision(spark, sf_dir):
    summary = mt.split_summary(_ranked(spark, sf_dir, "val", "test"))
    # The only metric whose value depends on the order of addition.
    return summary.select("model", "split", F.round("average_precision", 9).alias("average_precision"))


@query
def best_f1_threshold(spark, sf_dir):
    summary = mt.split_summary(_ranked(spark, sf_dir, "val", "test"))
    return summary.select("model", "split", "best_threshold", "best_f1")


@query
def best_model(spark, sf_dir):
    return _choice(spark, sf_dir)


def _cuts(spark, sf_dir):
    ranked = _ranked(spark, sf_dir, "val", "test")
    cuts = mt.cut_table(mt.split_summary(ranked), BASIS)
    return mt.confusion(ranked.filter(F.col("split") == "test"), cuts)


@query
def confusion_at_threshold(spark, sf_dir):
    """As the 2 x 2 layout [[tn, fp], [fn, tp]], flattened to columns."""
    return _cuts(spark, sf_dir).select("model", "cut", "threshold", "tn", "fp", "fn", "tp")


@query
def threshold_metrics(spark, sf_dir):
    return mt.threshold_metrics(_cuts(spark, sf_dir), BASIS)


@query
def roc_curve(spark, sf_dir):
    points = mt.curve_points(_ranked(spark, sf_dir, "test")).filter(F.col("curve") == "roc")
    return points.select("model", "idx", F.col("x").alias("fpr"), F.col("y").alias("tpr"))


@query
def pr_curve(spark, sf_dir):
    points = mt.curve_points(_ranked(spark, sf_dir, "test")).filter(F.col("curve") == "pr")
    return points.select("model", "idx", F.col("x").alias("recall"), F.col("y").alias("precision"))


@query
def curve_downsample(spark, sf_dir):
    return mt.downsample(mt.curve_points(_ranked(spark, sf_dir, "test"))).drop("split")


def _held_out(spark, sf_dir):
    scored = _scored(spark, sf_dir).filter(F.col("split") == "test")
    return scored, mt.rank_groups(mt.score_groups(scored), unit=BASIS)


@query
def top_decile_lift(spark, sf_dir):
    return mt.top_decile_lift(*_held_out(spark, sf_dir)).drop("split")


@query
def cumulative_gains(spark, sf_dir):
    return mt.cumulative_gains(*_held_out(spark, sf_dir)).drop("split")


@query
def gains_at_decile(spark, sf_dir):
    return mt.gains_at_decile(*_held_out(spark, sf_dir)).drop("split")


def _ranked_exact(spark, sf_dir):
    scored = td.surrogate_scored_exact(td.Source(spark, sf_dir)).filter(F.col("split") == "test")
    return scored, mt.rank_groups(mt.score_groups(scored))


@query
def exact_score_summary(spark, sf_dir):
    """The ranking metrics over unrounded scores, i.e. through range placement instead of one window."""
    scored, ranked = _ranked_exact(spark, sf_dir)
    lift = mt.top_decile_lift(scored, ranked).select("model", "top_decile_lift")
    return mt.split_summary(ranked).join(lift, "model").select(
        "model", "n", "positives", "roc_auc", F.round("average_precision", 9).alias("average_precision"),
        "best_threshold", "best_f1", "top_decile_lift",
    )


@query
def exact_score_curves(spark, sf_dir):
    return mt.downsample(mt.curve_points(_ranked_exact(spark, sf_dir)[1])).drop("split")


@query
def model_comparison(spark, sf_dir):
    """Evaluation bundle of all models, put into a metrics document and flattened again."""
    scored = storage.through_table(_scored(spark, sf_dir), storage.scratch_path(spark, "scored"))
    facts = spark.createDataFrame(
        [(m, f"Surrogate {m}", "Spark SQL", 0.0) for m in td.SURROGATES],
        "model string, display_name string, engine string, train_seconds double",
    )
    table = comparison_table(metrics_document(evaluate(scored, unit=BASIS), facts))
    return table.withColumn("pr_auc", F.round("pr_auc", 9))


# ---- scores and reports


@query
def risk_scores_query(spark, sf_dir):
    return _scores(spark, sf_dir).select(
        "customer_id", "churn_probability", "risk_band", "predicted_churn", "actual_churn", "split",
        "prob_s1", "prob_s2",
    )


QUERIES["risk_scores"] = QUERIES.pop("risk_scores_query")


@query
def risk_scores_exact(spark, sf_dir):
    """Unrounded probabilities: bands and predictions go by the rounded one, the threshold stays as it is."""
    scored = td.surrogate_scored_exact(td.Source(spark, sf_dir)).filter(F.col("split") == "val")
    choice = mt.pick_best(mt.split_summary(mt.rank_groups(mt.score_groups(scored))))
    wide = td.surrogate_wide(_features(spark, sf_dir), exact=True)
    return risk_scores(wide, td.SURROGATES, choice, td.SPEC).select(
        "customer_id", "churn_probability", "risk_band", "predicted_churn", "prob_s1", "prob_s2"
    )


@query
def risk_factors(spark, sf_dir):
    return _scores(spark, sf_dir).select("customer_id", "risk_factors")


@query
def portfolio_kpis(spark, sf_dir):
    return rp.portfolio_kpis(_scores(spark, sf_dir))


@query
def band_rollup(spark, sf_dir):
    return rp.band_rollup(_scores(spark, sf_dir))


@query
def probability_histogram(spark, sf_dir):
    return rp.probability_histogram(_scores(spark, sf_dir))


@query
def segment_rollup(spark, sf_dir):
    return rp.segment_rollup(_scores(spark, sf_dir))


@query
def facet_values(spark, sf_dir):
    return rp.facet_values(_scores(spark, sf_dir))


@query
def customer_list(spark, sf_dir):
    return rp.customer_list(rp.matching(_scores(spark, sf_dir)))


@query
def customer_list_export(spark, sf_dir):
    """All matches of a narrow filter, through the CSV sink."""
    matches = rp.matching(
        _scores(spark, sf_dir), bands=("High", "Medium", "Low"), contracts=("Month-to-month", "One year"),
        regions=("ASIA", "EUROPE", "AFRICA"), plans=("Standard", "Premium"), probability=(0.1, 0.45),
        held_out_only=True,
    )
    rows = rp.list_export(matches)
    path = storage.scratch_path(spark, "export")
    storage.write_csv(rows, path)
    return spark.read.schema(rows.schema).option("header", True).csv(path)


@query
def parquet_roundtrip(spark, sf_dir):
    """All relations written as Parquet with dates as text, and read back through the loader; every column counts."""
    base = storage.scratch_path(spark, "parquet")
    for name, df in td.relations(td.Source(spark, sf_dir)).items():
        days = {c: F.col(c).cast("string") for c, kind in df.dtypes if kind == "date"}
        df.withColumns(days).write.parquet(f"{base}/{name}.parquet")
    tables = load_tables(spark, base, "parquet")
    parts = []
    for name in TABLES:
        columns = CONTRACTS[name]
        values = F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(c).cast("string").alias("value")) for c in columns])
        typed = {c: kind for c, kind in tables[name].dtypes}
        numbers = [c for c in columns if typed[c] in ("int", "bigint", "double")]
        sums = F.create_map(*[x for c in numbers for x in (F.lit(c), F.sum(F.floor(F.col(c).cast("double")).cast("double")))])
        totals = tables[name].agg(sums.alias("sums"))
        parts.append(
            tables[name].select(F.inline(values)).groupBy("column_name").agg(
                F.count("*").alias("row_count"), F.count("value").alias("present"),
                F.countDistinct("value").alias("different"),
            ).crossJoin(F.broadcast(totals)).select(
                F.lit(name).alias("table_name"), "column_name", "row_count", "present", "different",
                F.try_element_at("sums", F.col("column_name")).alias("total"),
            )
        )
    return reduce(DataFrame.unionByName, parts)


@query
def customer_list_summary(spark, sf_dir):
    return rp.list_summary(rp.matching(_scores(spark, sf_dir)))


@query
def customer_lookup(spark, sf_dir):
    found = rp.customer_lookup(_scores(spark, sf_dir), " 7 ")
    return found.select(
        "customer_id", "churn_probability", "risk_band", "tenure_months", "contract", "monthly_charges", "plan",
        "risk_factors", "prob_s1", "prob_s2", "actual_churn", "split",
    )


@query
def model_scores_long(spark, sf_dir):
    return rp.model_scores_long(_scores(spark, sf_dir), td.SURROGATES, {m: f"Surrogate {m}" for m in td.SURROGATES})


@query
def rate_by_behaviour(spark, sf_dir):
    return rp.rate_by_behaviour(_scores(spark, sf_dir))


@query
def rate_by_tenure(spark, sf_dir):
    return rp.rate_by_tenure(_scores(spark, sf_dir))


# ---- models


@query
def encoded_features(spark, sf_dir):
    """Where the one-hot ones of each customer are, the numeric block in front of them, and its scaled values."""
    slots, scaled = vector_to_array("raw_features"), vector_to_array("features")
    width = len(NUMERIC)
    hot = F.array_compact(
        F.transform(slots, lambda value, i: F.when((i >= width) & (value == 1.0), i))
    )
    return _encoded(spark, sf_dir).select(
        "customer_id",
        F.size(slots).alias("n_slots"),
        *[hot[i].alias(f"{name}_slot") for i, name in enumerate(CATEGORICAL)],
        *[slots[i].alias(name) for i, name in enumerate(NUMERIC)],
        *[F.round(scaled[i], 6).alias(f"{name}_scaled") for i, name in enumerate(NUMERIC)],
    )


def _node_scores(spark, encoded, fitted):
    """Encoded rows with ``nodes_<model>``: the probabilities that the node tables of tree models give."""
    rows = encoded
    for item in fitted:
        nodes = storage.through_table(tr.node_table(spark, item.model), storage.scratch_path(spark, "nodes"))
        rows = tr.probabilities(rows, nodes, tr.kind_of(item.model), f"nodes_{item.name}")
    return rows


def _checked_scores(spark, sf_dir, *names):
    """Scores of tree models, each held against the walk of its node table, and the number of trees."""
    encoded = _encoded(spark, sf_dir)
    fitted = _fit(encoded, *names)
    scored = md.score(_node_scores(spark, encoded, fitted), fitted)
    agree = [F.abs(F.col(f"prob_{name}") - F.col(f"nodes_{name}")) <= 1e-9 for name in names]
    valid = [F.col(f"prob_{name}").between(0.0, 1.0) for name in names]
    rows = scored.select(
        "customer_id", "split", F.col("label").cast("int").alias("label"), reduce(lambda a, b: a & b, valid).alias("valid"),
        reduce(lambda a, b: a & b, agree).alias("as_walked"),
    )
    return rows, fitted


@query
def scores_lr(spark, sf_dir):
    """Whether the coefficients are the optimum: no slot's gradient, penalty included, is larger than 1e-4."""
    encoded = _encoded(spark, sf_dir)
    (fitted,) = _fit(encoded, "logistic_regression")
    scored = storage.through_table(
        md.score(encoded.withColumn("x", F.col("features")), [fitted]).withColumnRenamed("x", "features"),
        storage.scratch_path(spark, "model-scores"),
    )
    p = "prob_logistic_regression"
    residuals = md.stationarity(scored.filter("split = 'train'"), fitted.model, p, fitted.params["regParam"])
    fits = residuals.agg((F.max("residual") < 1e-4).alias("optimal"), F.count("*").alias("n_weights"))
    # One row, two values.
    return scored.select(
        "customer_id", "split", F.col("label").cast("int").alias("label"), F.col(p).between(0.0, 1.0).alias("valid"),
    ).crossJoin(F.broadcast(fits))


@query
def scores_rf(spark, sf_dir):
    rows, (fitted,) = _checked_scores(spark, sf_dir, "random_forest")
    return rows.withColumn("n_trees", F.lit(fitted.model.getNumTrees))


@query
def scores_gbt(spark, sf_dir):
    rows, (fitted,) = _checked_scores(spark, sf_dir, "gbt")
    return rows.withColumn("n_trees", F.lit(fitted.model.getNumTrees))


@query
def scores_gbt_es(spark, sf_dir):
    """Both boosted models: their scores, and whether each kept its best rounds and grew few beyond them."""
    rows, fitted = _checked_scores(spark, sf_dir, *md.EARLY_STOPPED)
    kept = all(f.model.getNumTrees == f.params["best_iteration"] for f in fitted)
    stopped = all(f.params["stopped"] or f.params["rounds_grown"] == md.PARAMS[f.name]["maxIter"] for f in fitted)
    return rows.withColumn("kept_best", F.lit(kept)).withColumn("stopped_or_full", F.lit(stopped))


def _search(spark, sf_dir, name):
    """Cross-validated search over the whole grid: every point with the rows it was judged on and its place."""
    table = md.fit(name, _encoded(spark, sf_dir), tune=True).search
    better = F.lag("mean_auc").over(Window.orderBy("rank"))
    parameters = F.concat_ws(",", F.transform(
        F.array(*[F.lit(p) for p in md.GRIDS[name]]), lambda p: F.concat_ws("=", p, F.col("parameters")[p].cast("string"))
    ))
    return table.select(
        F.lit(name).alias("model"), "point", parameters.alias("parameters"), "folds", "n", "positives",
        F.col("mean_auc").between(0.0, 1.0).alias("is_area"), (F.coalesce(better, F.lit(1.0)) >= F.col("mean_auc")).alias("in_order"),
    )


@query
def tuned_params(spark, sf_dir):
    return _search(spark, sf_dir, "logistic_regression")


@query
def tuned_params_rf(spark, sf_dir):
    return _search(spark, sf_dir, "random_forest")


@query
def tuned_params_gbt(spark, sf_dir):
    return _search(spark, sf_dir, "gbt")


@query
def feature_importance(spark, sf_dir):
    """The listed features of every model: place by place, held against its neighbour and against the node table's shares."""
    encoded = _encoded(spark, sf_dir)
    slots = md.slot_names(encoded)
    fitted = _fit(encoded, *md.MODELS)
    shares = []
    for item in fitted:
        listed = rp.labelled_importance(md.importance(spark, item, slots))
        if item.name == "logistic_regression":
            weights = [(i, abs(float(w))) for i, w in enumerate(item.model.coefficients)]
            sizes = spark.createDataFrame(weights, "feature int, size double")
            own = sizes.crossJoin(F.broadcast(sizes.agg(F.sum("size").alias("total")))).select("feature", (F.col("size") / F.col("total")).alias("share"))
        else:
            own = tr.importance_shares(tr.node_table(spark, item.model), tr.kind_of(item.model))
        names = spark.createDataFrame(list(enumerate(slots)), "feature int, name string")
        own = own.join(names, "feature").select(F.col("name").alias("feature"), "share")
        shares.append(listed.join(own, "feature", "left"))
    rows = reduce(DataFrame.unionByName, shares)
    by_model = Window.partitionBy("model").orderBy(F.desc("importance"), "feature")
    return rows.select(
        "model", F.row_number().over(by_model).alias("rank"),
        (F.coalesce(F.lag("importance").over(by_model), F.lit(1.0)) >= F.col("importance")).alias("in_order"),
        (F.abs(F.coalesce("share", F.lit(0.0)) - F.col("importance")) <= 1e-5).alias("as_in_nodes"),
        (~F.col("label").contains("_")).alias("reads"), F.col("feature").isin(slots).alias("is_slot"),
    )


@query
def scored_customers(spark, sf_dir):
    """All models, the best one chosen on the validation split, exported rows read back and held against each other."""
    encoded = _encoded(spark, sf_dir)
    names = list(md.MODELS)
    wide = md.score(encoded, _fit(encoded, *names))
    wide = storage.through_table(wide, storage.scratch_path(spark, "probabilities"))
    scored = mt.scored_long(wide, names).filter(F.col("split") == "val")
    choice = mt.pick_best(mt.split_summary(mt.rank_groups(mt.score_groups(scored))))
    choice = storage.through_table(choice, storage.scratch_path(spark, "choice"))
    path = storage.scratch_path(spark, "scores")
    storage.write_scores(risk_scores(wide, names, choice, td.SPEC), path)
    rows = spark.read.parquet(path).crossJoin(F.broadcast(choice.select("model", "threshold")))
    p = F.col("churn_probability")
    best = F.element_at(F.create_map(*[x for n in names for x in (F.lit(n), F.col(f"prob_{n}"))]), F.col("model"))
    band = F.when(p >= HIGH_CUTOFF, "High").when(p >= MEDIUM_CUTOFF, "Medium").otherwise("Low")
    return rows.select(
        "customer_id", F.col("actual_churn").cast("int").alias("actual_churn"), "split", *CATEGORICAL, "tenure_months",
        "monthly_charges", "late_payments", (p == best).alias("best_model_used"),
        (F.col("risk_band") == band).alias("band_fits"),
        (F.col("predicted_churn") == (p >= F.col("threshold")).cast("int")).alias("prediction_fits"),
    )


@query
def run_metrics(spark, sf_dir):
    """Run report of all models through the JSON sink, read back and flattened."""
    relations = td.relations(td.Source(spark, sf_dir))
    encoded = _encoded(spark, sf_dir)
    names = list(md.MODELS)
    fitted = _fit(encoded, *names)
    wide = storage.through_table(md.score(encoded, fitted), storage.scratch_path(spark, "probabilities"))
    counts = {row.table_name: row.row_count for row in table_counts(relations).collect()}
    document = metrics_document(
        evaluate(mt.scored_long(wide, names)),
        training_facts(spark, fitted, md.slot_names(encoded)),
        snapshot_date=F.lit(td.SPEC.snapshot.isoformat()),
        raw_source=F.lit(source_label("/data/somewhere/raw/2000-06-30")),
        table_rows=as_map(counts),
        n_features=F.lit(len(NUMERIC) + len(CATEGORICAL)),
        band_cutoffs=as_map({"high": HIGH_CUTOFF, "medium": MEDIUM_CUTOFF}),
    )
    path = storage.scratch_path(spark, "report")
    storage.write_document(document, path)
    report = read_document(spark, path)
    tuned = F.col(f"e.{mt.TUNED_CUT}.confusion")
    return report.select("*", F.explode("models").alias("model", "e")).select(
        "snapshot_date", "raw_source", "n_features", *[F.col("table_rows")[t].alias(f"n_{t}") for t in TABLES], "model",
        "e.display_name", "e.engine", F.size("e.importance").alias("n_importance"),
        (tuned["tp"] + tuned["fp"] + tuned["fn"] + tuned["tn"]).alias("n_test"),
        (F.col("e.roc_auc").between(0, 1) & F.col("e.pr_auc").between(0, 1)).alias("areas"),
        (F.col("e.train_seconds") > 0).alias("timed"),
        ((F.size("e.roc_curve") > 1) & (F.size("e.pr_curve") > 1)).alias("curves"),
        *[F.col("e.params")[name].alias(name) for name in md.REPORTED_PARAMS],
        (F.col("e.params")["best_iteration"] >= 1).alias("early_stopped"),
    )
