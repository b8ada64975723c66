"""Everything the run report says about each model, from one aggregation of the scores."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ebbtide.operators import metrics as m
from ebbtide.sources.storage import cut_lineage

_AT_CUT = (
    "struct<threshold:double,precision:double,recall:double,f1:double,accuracy:double,"
    "confusion:struct<tp:bigint,fp:bigint,fn:bigint,tn:bigint>>"
)
# Schema of the run report; without it a JSON reader would take the model map for a struct.
REPORT_SCHEMA = (
    "generated_at string, snapshot_date string, raw_source string, tuned boolean, table_rows map<string,bigint>, "
    "n_customers bigint, churn_rate double, split_sizes map<string,bigint>, n_features int, best_model string, "
    "best_threshold double, band_cutoffs map<string,double>, pipeline_seconds double, "
    "models map<string,struct<display_name:string,engine:string,train_seconds:double,params:map<string,double>,"
    "importance:array<struct<feature:string,importance:double>>,roc_auc:double,pr_auc:double,"
    "validation_roc_auc:double,best_threshold:double,top_decile_lift:double,"
    f"`{m.DEFAULT_CUT}`:{_AT_CUT},{m.TUNED_CUT}:{_AT_CUT},"
    "roc_curve:array<array<double>>,pr_curve:array<array<double>>>>"
)
FACT_FIELDS = ("display_name", "engine", "train_seconds")
THRESHOLD_FIELDS = ("threshold", "precision", "recall", "f1", "accuracy")


def evaluate(scored: DataFrame, unit: float = 1.0, parts: int | None = None) -> DataFrame:
    """One row per model. Thresholds are tuned on the validation split; all else is measured on the test split."""
    judged = scored.filter(F.col("split").isin("val", "test"))
    # What several results start from is computed once, and survives the loss of an executor.
    ranked = cut_lineage(m.rank_groups(m.score_groups(judged), parts, unit))
    summary = cut_lineage(m.split_summary(ranked))
    tests = ranked.filter(F.col("split") == "test")
    held_out = judged.filter(F.col("split") == "test")

    def of(split: str, column: str) -> Column:
        return F.max(F.when(F.col("split") == split, F.col(column)))

    base = summary.groupBy("model").agg(
        of("test", "roc_auc").alias("roc_auc"),
        of("test", "average_precision").alias("pr_auc"),
        of("val", "roc_auc").alias("validation_roc_auc"),
        (of("val", "best_threshold").cast("double") / unit).alias("best_threshold"),
    )
    cuts = m.threshold_metrics(m.confusion(tests, m.cut_table(summary, unit)), unit)
    measured = F.struct(*THRESHOLD_FIELDS, F.struct("tp", "fp", "fn", "tn").alias("confusion"))
    at_cuts = cuts.groupBy("model").agg(
        *[
            F.first(F.when(F.col("cut") == cut, measured), ignorenulls=True).alias(cut)
            for cut in (m.DEFAULT_CUT, m.TUNED_CUT)
        ]
    )
    lift = m.top_decile_lift(held_out, tests).select("model", "top_decile_lift")
    # At most CURVE_POINTS points per curve.
    curves = m.downsample(m.curve_points(tests)).groupBy("model").agg(
        _as_pairs("roc").alias("roc_curve"), _as_pairs("pr").alias("pr_curve")
    )
    return base.join(lift, "model", "left").join(at_cuts, "model", "left").join(curves, "model", "left")


def _as_pairs(curve: str) -> Column:
    """The points of a curve in order, as [[x, y], ...]."""
    listed = F.collect_list(F.when(F.col("curve") == curve, F.struct("idx", "x", "y")))
    return F.transform(F.sort_array(listed), lambda point: F.array(point["x"], point["y"]))


def metrics_document(evaluation: DataFrame, facts: DataFrame | None = None, **run_values) -> DataFrame:
    """One row: the values describing the run, and ``models`` as a map from model name to its evaluation.

    ``facts`` holds what only the training knows (model, display_name, engine, ...); ``run_values`` are columns.
    """
    described = evaluation if facts is None else evaluation.join(F.broadcast(facts), "model")
    fields = [F.col(f"`{c}`") for c in described.columns if c != "model"]
    entry = F.struct("model", F.struct(*fields).alias("evaluation"))
    return described.agg(F.map_from_entries(F.collect_list(entry)).alias("models")).select(
        *[value.alias(name) for name, value in run_values.items()], "models"
    )


def comparison_table(document: DataFrame) -> DataFrame:
    """The model map of a metrics document as a flat table, with what the training knows of each model where it is told."""
    tuned = f"evaluation.{m.TUNED_CUT}"
    present = document.schema["models"].dataType.valueType.names
    return document.select(F.explode("models").alias("model", "evaluation")).select(
        "model",
        *[F.col(f"evaluation.{field}") for field in FACT_FIELDS if field in present],
        "evaluation.roc_auc",
        "evaluation.pr_auc",
        *[F.col(f"{tuned}.{field}").alias(field) for field in ("threshold", "precision", "recall", "f1")],
        "evaluation.top_decile_lift",
    )


def read_document(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(REPORT_SCHEMA).json(path)
