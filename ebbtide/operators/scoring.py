"""From model probabilities to the exported row per customer."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ebbtide.functions.risk import risk_band, risk_reasons, rounded_probability
from ebbtide.spec import CATEGORICAL, NUMERIC, ObservationSpec


def select_probability(wide: DataFrame, models: list[str], choice: DataFrame) -> DataFrame:
    """Add ``p`` and ``threshold`` of the chosen model. ``choice`` is one row (model, threshold).

    The choice enters as a scalar subquery: evaluated once, then a constant for every row.
    """
    chosen = choice.select(F.struct("model", "threshold")).scalar()
    probability = F.coalesce(*[F.when(chosen["model"] == m, F.col(f"prob_{m}")) for m in models])
    return wide.select("*", probability.alias("p"), chosen["threshold"].alias("threshold"))


def risk_scores(
    wide: DataFrame,
    models: list[str],
    choice: DataFrame,
    spec: ObservationSpec,
    unit: float = 1.0,
    half_even: bool = False,
) -> DataFrame:
    """Features plus probability, band, predicted and actual outcome, reasons and every model's probability.

    Band and predicted outcome compare the rounded probability; the threshold itself stays unrounded.
    """
    threshold = F.col("threshold").cast("double") / unit
    return (
        select_probability(wide, models, choice)
        .withColumn("churn_probability", rounded_probability(F.col("p"), half_even))
        .select(
            "customer_id",
            F.upper(F.trim(F.col("customer_id").cast("string"))).alias("customer_key"),
            F.col("label").cast("int").alias("actual_churn"),
            *CATEGORICAL,
            *NUMERIC,
            "split",
            "churn_probability",
            risk_band(F.col("churn_probability")).alias("risk_band"),
            (F.col("churn_probability") >= threshold).cast("int").alias("predicted_churn"),
            risk_reasons(spec).alias("risk_factors"),
            *[rounded_probability(F.col(f"prob_{m}"), half_even).alias(f"prob_{m}") for m in models],
        )
    )
