"""Window borders, defaults and quirks of the feature table on hand-made rows."""

from datetime import date, timedelta

import pytest
import xxhash
from pyspark.sql import functions as F

from ebbtide.operators import features as ft
from ebbtide.sources.schemas import SchemaError, conform, require_unique_customers
from ebbtide.spec import CATEGORICAL, NUMERIC, ObservationSpec

SPEC = ObservationSpec()
SNAPSHOT = SPEC.snapshot

USAGE = "customer_id string, month date, call_minutes double, data_gb double, sms_count bigint, app_logins bigint"
PAYMENTS = "customer_id string, due_date date, paid_date date, amount double, days_late bigint"
TICKETS = (
    "customer_id string, created_date date, category string, is_complaint int, resolution_hours double, "
    "escalated int, satisfaction double"
)
CALLS = "customer_id string, call_date date, duration_min double, resolved int, sentiment double"
CUSTOMERS = (
    "customer_id string, signup_date date, age int, region string, contract string, plan string, "
    "internet_service string, payment_method string, monthly_charges double, churned int"
)


def usage_row(cid, day, minutes, gb=1.0, sms=1, logins=1):
    return (cid, day, minutes, gb, sms, logins)


def customer(cid, signup=date(2020, 1, 1), charge=50.0):
    return (cid, signup, 40, "North", "One year", "Basic", "DSL", "Mailed check", charge, 0)


def tables(spark, customers, usage=(), payments=(), tickets=(), calls=()):
    def frame(rows, schema):
        return spark.createDataFrame(list(rows), schema)

    return {
        "customers": frame(customers, CUSTOMERS), "usage": frame(usage, USAGE), "payments": frame(payments, PAYMENTS),
        "tickets": frame(tickets, TICKETS), "service_calls": frame(calls, CALLS),
    }


def only(df, **where):
    rows = df.filter(" and ".join(f"{k} = '{v}'" for k, v in where.items())).collect() if where else df.collect()
    assert len(rows) == 1
    return rows[0]


def test_month_borders_of_the_trend(spark):
    rows = [
        usage_row("a", date(2025, 9, 30), 100.0),  # last prior day
        usage_row("a", date(2025, 10, 1), 50.0),  # first recent day
        usage_row("a", date(2026, 1, 1), 9999.0),  # after the snapshot
        usage_row("a", date(2025, 6, 30), 9999.0),  # before the window
    ]
    row = only(ft.usage_features(spark.createDataFrame(rows, USAGE), SPEC))
    assert row.minutes_trend == 0.5
    assert row.avg_call_minutes == 75.0


def test_trend_is_neutral_without_a_base(spark):
    rows = [
        usage_row("no recent", date(2025, 8, 1), 10.0),
        usage_row("prior zero", date(2025, 8, 1), 0.0),
        usage_row("prior zero", date(2025, 11, 1), 10.0),
    ]
    t = tables(spark, [customer("no recent"), customer("prior zero"), customer("no usage")], usage=rows)
    assert {r.minutes_trend for r in ft.feature_table(t, SPEC).collect()} == {1.0}


def test_last_thirty_days_include_the_border(spark):
    rows = [
        ("a", date(2025, 11, 30), "Billing", 0, 1.0, 0, None),
        ("a", date(2025, 12, 1), "Billing", 0, 1.0, 0, None),
        ("a", date(2025, 12, 31), "Network", 1, 1.0, 1, None),
    ]
    row = only(ft.ticket_features(spark.createDataFrame(rows, TICKETS), SPEC))
    assert (row.ticket_count, row.tickets_last_30d, row.billing_tickets, row.network_tickets) == (3, 2, 2, 1)
    assert row.avg_satisfaction is None


def test_satisfaction_skips_nan_and_defaults_to_three(spark):
    rows = [
        ("nan", date(2025, 12, 1), "Billing", 0, 1.0, 0, float("nan")),
        ("nan", date(2025, 12, 2), "Billing", 0, 1.0, 0, 4.0),
        ("none", date(2025, 12, 2), "Billing", 0, 1.0, 0, None),
    ]
    t = tables(spark, [customer("nan"), customer("none")], tickets=rows)
    t["tickets"] = conform(t["tickets"], "tickets")
    found = {r.customer_id: r.avg_satisfaction for r in ft.feature_table(t, SPEC).collect()}
    assert found == {"nan": 4.0, "none": 3.0}


def test_late_payments(spark):
    rows = [
        ("a", date(2025, 7, 10), date(2025, 7, 12), 5.0, 2),
        ("a", date(2025, 9, 30), date(2025, 10, 1), 5.0, 1),
        ("a", date(2025, 10, 1), date(2025, 10, 4), 5.0, 3),
        ("a", date(2025, 11, 10), date(2025, 11, 10), 5.0, 0),
    ]
    row = only(ft.payment_features(spark.createDataFrame(rows, PAYMENTS), SPEC))
    assert (row.late_payments, row.late_payments_recent, row.max_days_late) == (3, 1, 3)
    assert (row.late_payment_ratio, row.avg_days_late) == (0.75, 1.5)


def test_late_ratio_is_not_cut_to_five_digits(spark):
    rows = [("a", date(2025, 8, d), date(2025, 8, d), 5.0, int(d == 1)) for d in range(1, 4)]
    assert only(ft.payment_features(spark.createDataFrame(rows, PAYMENTS), SPEC)).late_payment_ratio == 1 / 3


def test_tenure_and_derived_columns(spark):
    t = tables(
        spark,
        [customer("29", SNAPSHOT - timedelta(days=29)), customer("30", SNAPSHOT - timedelta(days=30), 20.5),
         customer("old", SNAPSHOT - timedelta(days=3000))],
        calls=[(c, date(2025, 12, 1), 4.0, 0, -0.5) for c in ("29", "30", "old") for _ in range(3)],
    )
    rows = {r.customer_id: r for r in ft.feature_table(t, SPEC).collect()}
    assert [rows[c].tenure_months for c in ("29", "30", "old")] == [0.0, 1.0, 100.0]
    assert rows["30"].total_charges == 20.5
    assert [rows[c].contacts_per_month for c in ("29", "30", "old")] == [3.0, 3.0, 0.5]
    assert rows["29"].unresolved_calls == 3.0


def test_every_customer_once_with_all_features(spark):
    df = ft.feature_table(tables(spark, [customer("a"), customer("b")]), SPEC)
    assert df.columns == ["customer_id", "label", *CATEGORICAL, *NUMERIC, "split"]
    assert len(NUMERIC) == 31
    assert {t for c, t in df.dtypes if c in NUMERIC} == {"double"}
    row = only(df, customer_id="a")
    assert row.avg_satisfaction == 3.0 and row.minutes_trend == 1.0 and row.ticket_count == 0.0


def test_split_is_the_published_hash(spark):
    ids = [f"C{i:05d}" for i in range(500)]
    df = spark.createDataFrame([(i,) for i in ids], "customer_id string")
    found = {r.customer_id: r.split for r in ft.split_assignment(df).collect()}

    def expected(text):
        value = xxhash.xxh64_intdigest(text.encode(), seed=42)
        value -= (value >> 63) << 64
        bucket = value % 100
        return "train" if bucket < 70 else "val" if bucket < 85 else "test"

    assert found == {i: expected(i) for i in ids}
    again = {r.customer_id: r.split for r in ft.split_assignment(df.orderBy(F.desc("customer_id")).repartition(3)).collect()}
    assert again == found


def test_copies_share_the_split_of_their_source(spark):
    t = tables(spark, [customer(f"s-{i:07d}") for i in range(40)])
    t["customers"] = t["customers"].withColumn("source_customer_id", F.lit("s"))
    assert ft.feature_table(t, SPEC, split_key="source_customer_id").select("split").distinct().count() == 1


def test_contract_violations(spark):
    good = spark.createDataFrame([customer("a")], CUSTOMERS)
    with pytest.raises(SchemaError, match="missing column.*region"):
        conform(good.drop("region"), "customers")
    with pytest.raises(SchemaError, match="age is string"):
        conform(good.withColumn("age", F.lit("x")), "customers")
    with pytest.raises(SchemaError, match="repeated customer_id, e.g. a"):
        require_unique_customers(good.union(good))
    require_unique_customers(good)


def _exchanges(df):
    return df._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning")


def test_joins_add_no_exchange_between_aggregates(spark):
    t = tables(spark, [customer("a")])
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        # Four aggregates and the customers themselves.
        assert _exchanges(ft.feature_table(t, SPEC)) == 5
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def test_one_customer_with_most_of_the_rows(spark):
    """The hot customer's history leaves the map side as one partial row per task."""
    calls = spark.range(30_000).select(
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("c"), (F.col("id") % 500).cast("string")))
        .alias("customer_id"),
        F.lit(date(2025, 12, 1)).alias("call_date"), F.lit(1.5).alias("duration_min"), F.lit(0).alias("resolved"),
        F.lit(0.25).alias("sentiment"),
    )
    found = {r.customer_id: r.call_count for r in ft.call_features(calls, SPEC).collect()}
    assert found["hot"] == 10_000 and sum(found.values()) == 30_000
