"""The five relations and the raw customer file, derived from the TPC-H-like test tables.

Every number is whole or a multiple of 1/4, so sums are exact in any order of addition.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ebbtide.functions.hashing import digest_number, md5_bucket, split_of
from ebbtide.functions.windows import in_window
from ebbtide.operators.features import payment_features, ticket_features
from ebbtide.sources.schemas import RAW_CUSTOMER_SCHEMA
from ebbtide.sources.tables import Tables
from ebbtide.spec import ObservationSpec

SPEC = ObservationSpec(snapshot=date(2000, 6, 30), obs_months=36, recent_months=18, recent_days=30)
OUTCOME_MONTHS = 12
EVENT_EPOCH = date(2024, 1, 30)


# Columns in use; with a given schema a scan needs no footer-reading job up front.
SCHEMAS = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_regionkey int",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "orders": "o_orderkey bigint, o_custkey bigint, o_totalprice double, o_orderdate timestamp_ntz, "
              "o_orderpriority string",
    "lineitem": "l_orderkey bigint, l_linenumber int, l_quantity double, l_discount double, l_tax double, "
                "l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz",
    "events": "ts timestamp_ntz, user_id bigint, event_type string, value double",
}


class Source:
    """Test tables of one scale, each opened once."""

    def __init__(self, spark: SparkSession, sf_dir: str) -> None:
        self.spark = spark
        self.sf_dir = sf_dir
        self._open: dict[str, DataFrame] = {}

    def table(self, name: str) -> DataFrame:
        if name not in self._open:
            reader = self.spark.read.schema(SCHEMAS[name])
            self._open[name] = reader.parquet(f"{self.sf_dir}/{name}.parquet")
        return self._open[name]

    def dated_orders(self) -> DataFrame:
        return self.table("orders").withColumn("o_day", F.col("o_orderdate").cast("date"))


def _contract() -> Column:
    return (
        F.when(F.col("c_mktsegment") == "FURNITURE", "One year")
        .when(F.col("c_mktsegment") == "HOUSEHOLD", "Two year")
        .otherwise("Month-to-month")
    )


def _monthly_charges() -> Column:
    return F.lit(20.0) + F.floor(F.abs("c_acctbal") / 25.0).cast("double") * 0.25


def _pick(code: Column, values: list[str]) -> Column:
    return F.element_at(F.array(*[F.lit(v) for v in values]), code.cast("int") + 1)


def customers(source: Source) -> DataFrame:
    snapshot = F.lit(SPEC.snapshot)
    history = source.dated_orders().groupBy(F.col("o_custkey").alias("c_custkey")).agg(
        F.min("o_day").alias("first_day"),
        F.bool_or(
            (F.col("o_day") > snapshot) & (F.col("o_day") <= F.add_months(snapshot, OUTCOME_MONTHS))
        ).alias("came_back"),
    )
    newest_signup = F.date_sub(snapshot, 30)
    acctbal = F.col("c_acctbal")
    return (
        source.table("customer")
        .join(source.table("nation"), F.col("c_nationkey") == F.col("n_nationkey"))
        .join(source.table("region"), F.col("n_regionkey") == F.col("r_regionkey"))
        .join(history, "c_custkey", "left")
        .select(
            F.col("c_custkey").alias("customer_id"),
            F.least(F.coalesce("first_day", newest_signup), newest_signup).alias("signup_date"),
            (20 + F.col("c_custkey") % 66).cast("int").alias("age"),
            F.col("r_name").alias("region"),
            _contract().alias("contract"),
            F.when(acctbal < 2000, "Basic").when(acctbal < 7000, "Standard").otherwise("Premium").alias("plan"),
            _pick(F.col("c_nationkey") % 3, ["Fiber", "DSL", "None"]).alias("internet_service"),
            _pick(
                F.col("c_custkey") % 4,
                ["Electronic check", "Mailed check", "Bank transfer (auto)", "Credit card (auto)"],
            ).alias("payment_method"),
            _monthly_charges().alias("monthly_charges"),
            F.when(F.col("came_back"), 0).otherwise(1).alias("churned"),
        )
    )


def usage(source: Source) -> DataFrame:
    monthly = (
        source.dated_orders()
        .filter(in_window("o_day", SPEC))
        .groupBy(F.col("o_custkey").alias("customer_id"), F.trunc("o_day", "month").alias("month"))
        .agg(
            F.sum(F.floor(F.col("o_totalprice") / 1000.0)).cast("double").alias("call_minutes"),
            (F.floor(F.max("o_totalprice") / 10000.0).cast("double") * 0.25).alias("volume"),
            F.count(F.lit(1)).alias("sms_count"),
            F.sum(F.substring("o_orderpriority", 1, 1).cast("int")).alias("app_logins"),
        )
    )
    offline = source.table("customer").select(
        F.col("c_custkey").alias("customer_id"), (F.col("c_nationkey") % 3 == 2).alias("offline")
    )
    return monthly.join(offline, "customer_id").select(
        "customer_id", "month", "call_minutes",
        F.when(F.col("offline"), 0.0).otherwise(F.col("volume")).alias("data_gb"),
        "sms_count", "app_logins",
    )


def payments(source: Source) -> DataFrame:
    priority = F.substring("o_orderpriority", 1, 1)
    return (
        source.dated_orders()
        .filter(in_window("o_day", SPEC))
        .withColumn("days_late", F.when(priority == "5", 10).when(priority == "4", 3).otherwise(0))
        .select(
            F.col("o_custkey").alias("customer_id"),
            F.col("o_day").alias("due_date"),
            F.date_add("o_day", F.col("days_late")).alias("paid_date"),
            F.col("o_totalprice").alias("amount"),
            F.col("days_late").cast("bigint").alias("days_late"),
        )
    )


def tickets(source: Source) -> DataFrame:
    lines = (
        source.table("lineitem")
        .withColumn("created_date", F.col("l_shipdate").cast("date"))
        .filter((F.col("l_returnflag") != "N") & in_window("created_date", SPEC))
    )
    owners = source.table("orders").select("o_orderkey", "o_custkey")
    number = F.col("l_linenumber")
    return lines.join(owners, F.col("l_orderkey") == F.col("o_orderkey")).select(
        F.col("o_custkey").alias("customer_id"),
        "created_date",
        _pick(number % 4, ["Billing", "Network", "Service", "Cancellation inquiry"]).alias("category"),
        (F.col("l_returnflag") == "R").cast("int").alias("is_complaint"),
        F.col("l_quantity").alias("resolution_hours"),
        ((F.col("l_linestatus") == "F") & (F.col("l_tax") >= 0.06)).cast("int").alias("escalated"),
        F.when(number % 3 != 0, (1 + F.round(F.col("l_discount") * 100) % 5).cast("double"))
        .alias("satisfaction"),
    )


def service_calls(source: Source) -> DataFrame:
    age_in_days = F.datediff(F.lit(EVENT_EPOCH), F.col("ts").cast("date"))
    kind = F.col("event_type")
    return source.table("events").select(
        F.col("user_id").alias("customer_id"),
        F.date_sub(F.lit(SPEC.snapshot), age_in_days * 6).alias("call_date"),
        (F.floor(F.col("value") * 4.0).cast("double") / 4.0).alias("duration_min"),
        (kind != "error").cast("int").alias("resolved"),
        F.when(kind == "error", -0.5).when(kind == "purchase", 0.75).when(kind == "signup", 0.5)
        .otherwise(0.0).alias("sentiment"),
    )


def relations(source: Source) -> Tables:
    makers = (customers, usage, payments, tickets, service_calls)
    return {maker.__name__: maker(source) for maker in makers}


def raw_customers(source: Source) -> DataFrame:
    """The raw customer file: text-heavy, header names padded with blanks."""
    key = F.col("c_custkey")
    charge = _monthly_charges()
    tenure = (key % 80 - 2).cast("int")
    addons = RAW_CUSTOMER_SCHEMA.names[8:14]
    columns = [
        F.col("c_name").alias("customerID"),
        (key % 5 == 0).cast("int").alias("SeniorCitizen"),
        tenure.alias("tenure"),
        _contract().alias("Contract"),
        _pick(F.col("c_nationkey") % 4, ["Fiber optic", "DSL", "No", "Satellite"]).alias("InternetService"),
        _pick(
            key % 5,
            ["Electronic check", "Mailed check", "Bank transfer (automatic)", "Credit card (automatic)", "Cash"],
        ).alias("PaymentMethod"),
        charge.alias("MonthlyCharges"),
        F.when(tenure <= 0, " ").otherwise((charge * tenure).cast("string")).alias("TotalCharges"),
        *[
            F.when(F.shiftright(key, bit) % 2 == 1, "Yes").otherwise("No").alias(name)
            for bit, name in enumerate(addons)
        ],
        F.when(key % 4 == 0, "Yes").otherwise("No").alias("Churn"),
    ]
    df = source.table("customer").select(columns)
    return df.toDF(*[f" {name} " for name in df.columns])


SURROGATES = ["s1", "s2"]


def surrogate_points() -> Column:
    """A score in basis points from feature values: whole numbers with many ties, all bands present."""
    return F.least(
        F.lit(9999),
        500
        + F.when(F.col("contract") == "Month-to-month", 2000).otherwise(0)
        + 300 * F.least(F.col("late_payments"), F.lit(5))
        + 400 * F.least(F.col("complaint_count"), F.lit(5))
        + 20 * md5_bucket(F.col("customer_id")),
    ).cast("bigint")


def _fraction() -> Column:
    """Below one basis point and different for nearly all customers."""
    return digest_number(F.col("customer_id"), 9).cast("double") / F.lit(float(2 ** 32))


def surrogate_wide(features: DataFrame, exact: bool = False) -> DataFrame:
    """Features with the two surrogate models ``s1`` and its mirror image ``s2`` as probabilities.

    ``exact`` adds a fraction of a basis point, so that rounding has something to do.
    """
    points = features.withColumn("_points", surrogate_points())
    fraction = _fraction() if exact else F.lit(0.0)
    for model, value in zip(SURROGATES, (F.col("_points"), 9999 - F.col("_points"))):
        points = points.withColumn(f"prob_{model}", (value.cast("double") + fraction) / F.lit(10_000.0))
    return points.drop("_points")


def surrogate_rows(source: Source) -> DataFrame:
    """(customer_id, split, label, points) with only the histories that the surrogate score looks at."""
    return (
        customers(source)
        .join(payment_features(payments(source), SPEC), "customer_id", "left")
        .join(ticket_features(tickets(source), SPEC), "customer_id", "left")
        .fillna(0, ["late_payments", "complaint_count"])
        .select(
            "customer_id",
            split_of(F.col("customer_id"), "md5").alias("split"),
            F.col("churned").alias("label"),
            surrogate_points().alias("points"),
        )
    )


def surrogate_scored(source: Source) -> DataFrame:
    """Long scores of both surrogates in basis points."""
    both = F.array(
        F.struct(F.lit("s1").alias("model"), F.col("points").alias("score")),
        F.struct(F.lit("s2").alias("model"), (9999 - F.col("points")).alias("score")),
    )
    return surrogate_rows(source).select("customer_id", "split", "label", F.inline(both)).select(
        "model", "split", "customer_id", "label", "score"
    )


def surrogate_scored_exact(source: Source) -> DataFrame:
    """As ``surrogate_scored``, with hardly any two customers sharing a score."""
    return surrogate_scored(source).withColumn(
        "score", (F.col("score").cast("double") + _fraction()) / F.lit(10_000.0)
    )
