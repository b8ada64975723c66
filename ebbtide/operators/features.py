"""Histories to one wide feature row per customer.

Each history is reduced to one row per customer before any join. All reductions are algebraic, so Spark combines
them map-side: a customer that owns a large part of a history arrives at the shuffle as one partial row per task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ebbtide.functions.hashing import split_of
from ebbtide.functions.windows import in_last_days, in_window, is_recent, ratio
from ebbtide.sources.tables import Tables
from ebbtide.spec import (
    CALL_FEATURES, CATEGORICAL, NEUTRAL, NUMERIC, PAYMENT_FEATURES, TICKET_FEATURES, USAGE_FEATURES,
    ObservationSpec,
)


def _mean(column: str) -> Column:
    return F.avg(F.col(column).cast("double"))


def usage_features(usage: DataFrame, spec: ObservationSpec) -> DataFrame:
    recent = is_recent("month", spec)

    def trend(column: str) -> Column:
        value = F.col(column).cast("double")
        late, early = F.avg(F.when(recent, value)), F.avg(F.when(~recent, value))
        return F.coalesce(ratio(late, early), F.lit(1.0))

    return usage.filter(in_window("month", spec)).groupBy("customer_id").agg(
        _mean("call_minutes").alias("avg_call_minutes"),
        _mean("data_gb").alias("avg_data_gb"),
        _mean("sms_count").alias("avg_sms"),
        _mean("app_logins").alias("avg_app_logins"),
        trend("call_minutes").alias("minutes_trend"),
        trend("data_gb").alias("data_trend"),
        trend("app_logins").alias("logins_trend"),
    )


def payment_features(payments: DataFrame, spec: ObservationSpec) -> DataFrame:
    late = F.col("days_late") > 0
    return payments.filter(in_window("due_date", spec)).groupBy("customer_id").agg(
        F.count_if(late).alias("late_payments"),
        F.avg(F.when(late, 1.0).otherwise(0.0)).alias("late_payment_ratio"),
        _mean("days_late").alias("avg_days_late"),
        F.max("days_late").alias("max_days_late"),
        F.count_if(late & is_recent("due_date", spec)).alias("late_payments_recent"),
    )


def ticket_features(tickets: DataFrame, spec: ObservationSpec) -> DataFrame:
    def in_category(name: str) -> Column:
        return F.count_if(F.col("category") == name)

    return tickets.filter(in_window("created_date", spec)).groupBy("customer_id").agg(
        F.count(F.lit(1)).alias("ticket_count"),
        F.sum("is_complaint").alias("complaint_count"),
        F.sum("escalated").alias("escalated_count"),
        in_category("Billing").alias("billing_tickets"),
        in_category("Network").alias("network_tickets"),
        in_category("Cancellation inquiry").alias("cancellation_inquiries"),
        _mean("resolution_hours").alias("avg_resolution_hours"),
        _mean("satisfaction").alias("avg_satisfaction"),
        F.count_if(in_last_days("created_date", spec)).alias("tickets_last_30d"),
    )


def call_features(calls: DataFrame, spec: ObservationSpec) -> DataFrame:
    return calls.filter(in_window("call_date", spec)).groupBy("customer_id").agg(
        F.count(F.lit(1)).alias("call_count"),
        _mean("duration_min").alias("avg_call_duration"),
        F.sum(1 - F.col("resolved")).alias("unresolved_calls"),
        _mean("sentiment").alias("avg_sentiment"),
        F.count_if(in_last_days("call_date", spec)).alias("calls_last_30d"),
    )


def feature_table(
    tables: Tables, spec: ObservationSpec, split_hash: str = "xxhash64", split_key: str = "customer_id"
) -> DataFrame:
    """customer_id, label, 5 categorical and 31 numeric features (all DOUBLE), split.

    The aggregates come out hashed by customer_id, hence the joins add no exchange of their own except for
    ``customers``. ``split_key`` other than the id keeps all copies of a resampled customer in one split.
    """
    customers = tables["customers"]
    joined = (
        customers
        .join(usage_features(tables["usage"], spec), "customer_id", "left")
        .join(payment_features(tables["payments"], spec), "customer_id", "left")
        .join(ticket_features(tables["tickets"], spec), "customer_id", "left")
        .join(call_features(tables["service_calls"], spec), "customer_id", "left")
    )
    history = USAGE_FEATURES + PAYMENT_FEATURES + TICKET_FEATURES + CALL_FEATURES
    age_in_days = F.datediff(F.lit(spec.snapshot), F.col("signup_date"))
    filled = joined.select(
        "customer_id",
        F.col("churned").alias("label"),
        *CATEGORICAL,
        F.col("age").cast("double").alias("age"),
        F.floor(age_in_days / 30).cast("double").alias("tenure_months"),
        F.col("monthly_charges").cast("double").alias("monthly_charges"),
        *[
            F.coalesce(F.col(name).cast("double"), F.lit(NEUTRAL.get(name, 0.0))).alias(name)
            for name in history
        ],
        split_of(F.col(split_key), split_hash).alias("split"),
    )
    observed_months = F.least(F.lit(float(spec.obs_months)), F.greatest(F.col("tenure_months"), F.lit(1.0)))
    return filled.select(
        "customer_id",
        "label",
        *CATEGORICAL,
        *[
            {
                "total_charges": F.col("monthly_charges") * F.col("tenure_months"),
                "contacts_per_month": (F.col("ticket_count") + F.col("call_count")) / observed_months,
            }.get(name, F.col(name)).alias(name)
            for name in NUMERIC
        ],
        "split",
    )


def split_assignment(customers: DataFrame, split_hash: str = "xxhash64", key: str = "customer_id") -> DataFrame:
    return customers.select("customer_id", split_of(F.col(key), split_hash).alias("split"))


def split_profile(features: DataFrame) -> DataFrame:
    """Size and outcome rate of each split, and how many features a row carries."""
    return features.groupBy("split").agg(
        F.count(F.lit(1)).alias("n"),
        F.avg(F.col("label").cast("double")).alias("label_rate"),
        F.lit(len(NUMERIC) + len(CATEGORICAL)).alias("n_features"),
    )
