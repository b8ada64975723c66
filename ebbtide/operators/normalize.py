"""Raw customer file to typed customer attributes."""

from __future__ import annotations

from itertools import chain

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ebbtide.spec import ObservationSpec

# Raw vocabulary to table vocabulary, and the add-on columns that decide the plan.
INTERNET_NAMES = {"Fiber optic": "Fiber", "DSL": "DSL", "No": "None"}
PAYMENT_NAMES = {
    "Bank transfer (automatic)": "Bank transfer (auto)",
    "Credit card (automatic)": "Credit card (auto)",
    "Electronic check": "Electronic check",
    "Mailed check": "Mailed check",
}
ADDONS = (
    "OnlineSecurity", "OnlineBackup", "DeviceProtection", "TechSupport", "StreamingTV", "StreamingMovies",
)
MAX_TENURE = 72
PREMIUM_ADDONS = 5
STANDARD_ADDONS = 2


def trim_header(raw: DataFrame) -> DataFrame:
    return raw.toDF(*[name.strip() for name in raw.columns])


def cleaned_total_charges() -> Column:
    """Total charges as a number; blank or unreadable text counts as one month."""
    return F.coalesce(F.trim("TotalCharges").try_cast("double"), F.col("MonthlyCharges"))


def recode(column: str, names: dict[str, str]) -> Column:
    """Dictionary lookup; a value outside the dictionary becomes NULL."""
    pairs = F.create_map(*[F.lit(part) for part in chain.from_iterable(names.items())])
    return F.try_element_at(pairs, F.col(column))


def plan_tier() -> Column:
    taken = sum((F.when(F.col(name) == "Yes", 1).otherwise(0) for name in ADDONS), F.lit(0))
    return (
        F.when(taken >= PREMIUM_ADDONS, "Premium").when(taken >= STANDARD_ADDONS, "Standard").otherwise("Basic")
    )


def normalize_customers(raw: DataFrame, spec: ObservationSpec, keep: tuple[str, ...] = ()) -> DataFrame:
    """One narrow projection; ``keep`` names extra columns to pass through."""
    tenure = F.least(F.greatest(F.col("tenure").cast("int"), F.lit(0)), F.lit(MAX_TENURE))
    return trim_header(raw).select(
        F.col("customerID").cast("string").alias("customer_id"),
        F.date_sub(F.lit(spec.snapshot), F.greatest(tenure, F.lit(1)) * 30).alias("signup_date"),
        tenure.alias("tenure"),
        F.col("SeniorCitizen").cast("int").alias("senior_citizen"),
        F.col("Contract").alias("contract"),
        plan_tier().alias("plan"),
        recode("InternetService", INTERNET_NAMES).alias("internet_service"),
        recode("PaymentMethod", PAYMENT_NAMES).alias("payment_method"),
        F.round(F.col("MonthlyCharges").cast("double"), 2).alias("monthly_charges"),
        cleaned_total_charges().alias("total_charges"),
        F.when(F.col("Churn") == "Yes", 1).otherwise(0).cast("int").alias("churned"),
        *[F.col(name) for name in keep],
    )


def outcome_rate(customers: DataFrame, outcome: str = "churned") -> DataFrame:
    return customers.agg(
        F.count(F.lit(1)).alias("n"),
        F.sum(F.col(outcome).cast("bigint")).alias("positives"),
        F.avg(F.col(outcome).cast("double")).alias("rate"),
    )
