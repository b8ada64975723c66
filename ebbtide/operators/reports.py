"""Reports over the scored customers. Probabilities are summed as basis points, so a mean has one value."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ebbtide.functions.buckets import BASIS, basis_points, capped_count, probability_bin, readable_feature, tenure_bucket
from ebbtide.functions.windows import ratio
from ebbtide.operators.prefix import numbered
from ebbtide.spec import BANDS, CATEGORICAL

# Columns of the customer list and the features of the behaviour report.
LIST_COLUMNS = (
    "customer_id", "churn_probability", "risk_band", "risk_factors", "contract", "plan", "tenure_months",
    "monthly_charges", "late_payments", "ticket_count", "call_count", "minutes_trend", "region",
)
FACETS = ("contract", "region", "plan")
BEHAVIOUR_FEATURES = (
    "late_payments", "ticket_count", "complaint_count", "call_count", "unresolved_calls",
    "cancellation_inquiries",
)
LIST_SIZE = 1000
BINS = 40


def _count() -> Column:
    return F.count(F.lit(1))


def _outcome_rate() -> Column:
    return F.avg(F.col("actual_churn").cast("double"))


def portfolio_kpis(scores: DataFrame) -> DataFrame:
    high = F.col("risk_band") == "High"
    return scores.agg(
        _count().alias("customers"),
        _outcome_rate().alias("actual_rate"),
        F.count_if(high).alias("high_risk"),
        F.coalesce(F.sum(F.when(high, F.col("monthly_charges"))), F.lit(0.0)).alias("revenue_at_risk"),
    ).withColumn("high_share", ratio(F.col("high_risk"), F.col("customers")))


def band_rollup(scores: DataFrame) -> DataFrame:
    """Every band has a row, in the order Low, Medium, High; without customers count and rate are NULL."""
    spark = scores.sparkSession
    bands = spark.createDataFrame(list(enumerate(BANDS)), "position int, risk_band string")
    rolled = scores.groupBy("risk_band").agg(_count().alias("n"), _outcome_rate().alias("actual_rate"))
    return bands.join(rolled, "risk_band", "left").orderBy("position").select("position", "risk_band", "n", "actual_rate")


def probability_histogram(scores: DataFrame) -> DataFrame:
    """All bins have a row, empty ones with 0."""
    found = scores.groupBy(probability_bin(F.col("churn_probability")).alias("bin")).agg(_count().alias("n"))
    bins = scores.sparkSession.range(BINS).select(F.col("id").cast("int").alias("bin"))
    return bins.join(found, "bin", "left").select("bin", F.coalesce("n", F.lit(0)).alias("n"))


def segment_rollup(scores: DataFrame, segments: tuple[str, ...] = CATEGORICAL) -> DataFrame:
    """Mean prediction and outcome per value of each segment column; all columns in one aggregation."""
    values = F.array(*[F.struct(F.lit(s).alias("segment"), F.col(s).alias("value")) for s in segments])
    return (
        scores.select(F.inline(values), basis_points(F.col("churn_probability")).alias("bp"), "actual_churn")
        .groupBy("segment", "value")
        .agg(
            ratio(F.sum("bp"), _count() * BASIS).alias("mean_probability"),
            _outcome_rate().alias("actual_rate"),
            _count().alias("n"),
        )
        .orderBy("segment", F.desc("actual_rate"), "value")
    )


def facet_values(scores: DataFrame, facets: tuple[str, ...] = FACETS) -> DataFrame:
    values = F.array(*[F.struct(F.lit(f).alias("facet"), F.col(f).alias("value")) for f in facets])
    return scores.select(F.inline(values)).distinct().orderBy("facet", "value")


def matching(
    scores: DataFrame,
    bands: tuple[str, ...] = ("High", "Medium"),
    contracts: tuple[str, ...] = (),
    regions: tuple[str, ...] = (),
    plans: tuple[str, ...] = (),
    probability: tuple[float, float] = (0.0, 1.0),
    held_out_only: bool = False,
) -> DataFrame:
    """Faceted filter. An empty facet lets everything through; the probability range includes its ends."""
    wanted = {"risk_band": bands, "contract": contracts, "region": regions, "plan": plans}
    conditions = [F.col(column).isin(*values) for column, values in wanted.items() if values]
    conditions.append(F.col("churn_probability").between(*probability))
    if held_out_only:
        conditions.append(F.col("split") == "test")
    return scores.filter(reduce(Column.__and__, conditions))


def customer_list(matches: DataFrame, size: int = LIST_SIZE) -> DataFrame:
    """The ``size`` riskiest matches; a top-k, so no full sort."""
    return matches.orderBy(F.desc("churn_probability"), "customer_id").limit(size).select(*LIST_COLUMNS)


def list_export(matches: DataFrame) -> DataFrame:
    """All matches with the list's columns and their place in it, the riskiest first, for the CSV sink."""
    order = (F.desc("churn_probability"), F.asc("customer_id"))
    return numbered(matches.select(*LIST_COLUMNS), *order)


def list_summary(matches: DataFrame) -> DataFrame:
    return matches.agg(_count().alias("n"), F.avg("monthly_charges").alias("mean_monthly_charge"))


def customer_lookup(scores: DataFrame, customer_id: str) -> DataFrame:
    """One customer, whatever the case of the id and the blanks around the text asked for.

    Compares the stored ``customer_key``, so that the reader can skip what does not hold it.
    """
    return scores.filter(F.col("customer_key") == customer_id.strip().upper())


def model_scores_long(scores: DataFrame, models: list[str], names: dict[str, str] | None = None) -> DataFrame:
    """A row per customer and model; ``names`` are the models' display names, where they have one."""
    long = scores.unpivot(["customer_id"], [f"prob_{m}" for m in models], "column", "probability")
    shown = F.array(*[F.struct(F.lit(f"prob_{m}"), F.lit((names or {}).get(m, m))) for m in models])
    model = F.element_at(F.map_from_entries(shown), F.col("column"))
    return long.select("customer_id", model.alias("model"), "probability")


def rate_by_behaviour(scores: DataFrame, features: tuple[str, ...] = BEHAVIOUR_FEATURES) -> DataFrame:
    """Outcome rate by count, counts from five on together; all features in one aggregation."""
    values = F.array(
        *[F.struct(F.lit(f).alias("feature"), capped_count(F.col(f)).alias("bucket")) for f in features]
    )
    return (
        scores.select(F.inline(values), "actual_churn")
        .groupBy("feature", "bucket")
        .agg(_outcome_rate().alias("rate"), _count().alias("n"))
    )


def rate_by_tenure(scores: DataFrame) -> DataFrame:
    """Outcome rate by tenure bucket; customers outside all buckets and empty buckets do not appear."""
    return (
        scores.select(tenure_bucket(F.col("tenure_months")).alias("bucket"), "actual_churn")
        .filter(F.col("bucket").isNotNull())
        .groupBy("bucket")
        .agg(_outcome_rate().alias("rate"), _count().alias("n"))
    )


def labelled_importance(importance: DataFrame) -> DataFrame:
    return importance.withColumn("label", readable_feature(F.col("feature")))
