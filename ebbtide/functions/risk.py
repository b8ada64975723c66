"""Risk band and reason texts of one scored customer, as native expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ebbtide.spec import HIGH_CUTOFF, MEDIUM_CUTOFF, ObservationSpec

MAX_REASONS = 4
NO_REASON = "No standout risk signals"


def rounded_probability(probability: Column, half_even: bool = False) -> Column:
    return (F.bround if half_even else F.round)(probability, 4)


def risk_band(probability: Column) -> Column:
    return (
        F.when(probability >= HIGH_CUTOFF, "High")
        .when(probability >= MEDIUM_CUTOFF, "Medium")
        .otherwise("Low")
    )


def risk_reasons(spec: ObservationSpec) -> Column:
    """The first four of eight ordered rules that hold, joined by "; "."""

    def counted(column: str, suffix: str) -> Column:
        return F.when(
            F.col(column) >= 2, F.concat(F.col(column).cast("bigint").cast("string"), F.lit(suffix))
        )

    # Rule texts and limits, in order of priority.
    rules = F.array(
        F.when(F.col("contract") == "Month-to-month", "Month-to-month contract"),
        counted("late_payments_recent", f" late payments in last {spec.recent_months} months"),
        F.when((F.col("minutes_trend") < 0.75) | (F.col("logins_trend") < 0.75), "Usage declining"),
        F.when(F.col("cancellation_inquiries") >= 1, "Asked about cancelling"),
        counted("complaint_count", " complaints"),
        counted("unresolved_calls", " unresolved calls"),
        F.when(F.col("avg_satisfaction") <= 2.5, "Low satisfaction score"),
        F.when(F.col("payment_method") == "Electronic check", "Pays by electronic check"),
    )
    holding = F.slice(F.array_compact(rules), 1, MAX_REASONS)
    return F.when(F.size(holding) == 0, NO_REASON).otherwise(F.array_join(holding, "; "))
