"""Customers whose outcome follows from some of their features, to see whether models learn."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ebbtide.functions.hashing import split_of, standard_normal
from ebbtide.spec import CATEGORICAL, NUMERIC

SIGNAL = {
    "late_payments": 1, "minutes_trend": -1, "complaint_count": 1, "unresolved_calls": 1, "avg_satisfaction": -1,
    "tenure_months": -1, "cancellation_inquiries": 1, "avg_sentiment": -1,
}
CUT = 0.9  # about a quarter of the customers lie above


def planted(spark: SparkSession, n: int, shuffled_labels: bool = False) -> DataFrame:
    def noise(name: str):
        return standard_normal(F.concat(F.lit(f"{name}-"), F.col("id").cast("string")))

    base = spark.range(n).withColumn("z", noise("latent"))
    outcome = noise("label-only") if shuffled_labels else F.col("z") + 0.5 * noise("outcome")
    numbers = [
        (F.lit(float(SIGNAL[name])) * F.col("z") + noise(name) if name in SIGNAL else noise(name)).alias(name)
        for name in NUMERIC
    ]
    categories = [
        F.concat(F.lit(f"{name}-"), F.pmod(F.xxhash64(F.lit(name), "id"), F.lit(3)).cast("string")).alias(name)
        for name in CATEGORICAL
    ]
    return base.select(
        F.col("id").alias("customer_id"), (outcome > CUT * 0.8).cast("int").alias("label"), *categories, *numbers,
        split_of(F.col("id")).alias("split"),
    )
