"""Reports over the stored results of a run: the scores table and the run report are all they read.

    python -m ebbtide.plans.reports --scores hdfs://host/out/scores --report hdfs://host/out/metrics/report \\
        --out hdfs://host/out/reports [--customer C-0017]
"""

from __future__ import annotations

import argparse

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ebbtide.operators import metrics as mt
from ebbtide.operators import models as md
from ebbtide.operators import reports as rp
from ebbtide.plans.evaluation import comparison_table, read_document
from ebbtide.session import build_session
from ebbtide.sources.storage import write_csv

BASIS = 10_000.0


def models_of(scores: DataFrame) -> list[str]:
    return [c.removeprefix("prob_") for c in scores.columns if c.startswith("prob_")]


def model_scored(scores: DataFrame) -> DataFrame:
    """(model, split, customer_id, label, score) from the stored, rounded probabilities, in basis points."""
    wide = scores.withColumnRenamed("actual_churn", "label")
    return mt.scored_long(wide, models_of(scores), BASIS).filter(F.col("split") == "test")


def score_reports(scores: DataFrame) -> dict[str, DataFrame]:
    """Every report that follows from the scores alone."""
    listed = rp.matching(scores)
    held_out = model_scored(scores)
    ranked = mt.rank_groups(mt.score_groups(held_out), unit=BASIS)
    return {
        "kpis": rp.portfolio_kpis(scores), "bands": rp.band_rollup(scores),
        "histogram": rp.probability_histogram(scores), "segments": rp.segment_rollup(scores),
        "facets": rp.facet_values(scores), "customers": rp.customer_list(listed), "summary": rp.list_summary(listed),
        "behaviour": rp.rate_by_behaviour(scores), "tenure": rp.rate_by_tenure(scores),
        "gains": mt.cumulative_gains(held_out, ranked), "gains_at_decile": mt.gains_at_decile(held_out, ranked),
    }


def document_reports(document: DataFrame) -> dict[str, DataFrame]:
    """What the run report says of the models, their curves' leading features and the tables read."""
    entries = document.select(F.explode("models").alias("model", "evaluation"))
    importance = entries.select("model", F.inline("evaluation.importance"))
    tuned = F.col(f"evaluation.{mt.TUNED_CUT}.confusion")
    return {
        "comparison": comparison_table(document), "importance": rp.labelled_importance(importance),
        "confusion": entries.select("model", *[tuned[c].alias(c) for c in ("tn", "fp", "fn", "tp")]),
        "tables": document.select(F.explode("table_rows").alias("table_name", "row_count")),
    }


def customer_report(scores: DataFrame, customer_id: str) -> tuple[DataFrame, DataFrame]:
    """The row of one customer, and its probability by every model under the model's display name."""
    found = rp.customer_lookup(scores, customer_id)
    return found, rp.model_scores_long(found, models_of(scores), md.DISPLAY_NAMES)


def run(spark: SparkSession, scores_path: str, report_path: str, out: str) -> dict[str, str]:
    """Writes every report below ``out``; the full customer list as CSV, in order."""
    scores = spark.read.parquet(scores_path)
    tables = {**score_reports(scores), **document_reports(read_document(spark, report_path))}
    paths = {name: f"{out.rstrip('/')}/{name}" for name in (*tables, "export")}
    for name, table in tables.items():
        table.write.mode("overwrite").parquet(paths[name])
    write_csv(rp.list_export(rp.matching(scores)), paths["export"])
    return paths


def main(argv: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(description=__doc__, formatter_class=argparse.RawDescriptionHelpFormatter)
    parser.add_argument("--scores", required=True, help="scores table of a run")
    parser.add_argument("--report", required=True, help="run report of the same run")
    parser.add_argument("--out", required=True, help="folder or URI for the reports")
    parser.add_argument("--customer", help="also show this customer")
    args = parser.parse_args(argv)
    spark = build_session()
    run(spark, args.scores, args.report, args.out)
    if args.customer:
        for table in customer_report(spark.read.parquet(args.scores), args.customer):
            table.show(truncate=False)
    spark.stop()


if __name__ == "__main__":
    main()
