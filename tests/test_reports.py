"""Bands, reasons, buckets and report queries on hand-made rows."""

from datetime import date

import pytest
from pyspark.sql import functions as F

from ebbtide.functions.buckets import capped_count, probability_bin, readable_feature, tenure_bucket
from ebbtide.functions.risk import risk_band, risk_reasons, rounded_probability
from ebbtide.operators import reports as rp
from ebbtide.operators.scoring import risk_scores
from ebbtide.spec import CATEGORICAL, NUMERIC, ObservationSpec

SPEC = ObservationSpec()
CALM = {
    "contract": "Two year", "late_payments_recent": 0.0, "minutes_trend": 1.0, "logins_trend": 1.0,
    "cancellation_inquiries": 0.0, "complaint_count": 0.0, "unresolved_calls": 0.0, "avg_satisfaction": 3.0,
    "payment_method": "Mailed check",
}


def column(spark, values, kind, expression):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {kind}")
    return [r.out for r in df.select("i", expression(F.col("v")).alias("out")).orderBy("i").collect()]


def reasons(spark, **changes):
    row = {**CALM, **changes}
    df = spark.createDataFrame([tuple(row.values())], list(row))
    return df.select(risk_reasons(SPEC).alias("text")).first().text


def test_reasons(spark):
    assert reasons(spark) == "No standout risk signals"
    assert reasons(spark, late_payments_recent=2.0) == "2 late payments in last 3 months"
    assert reasons(spark, late_payments_recent=1.0, complaint_count=1.0, unresolved_calls=1.0) == "No standout risk signals"
    assert reasons(spark, minutes_trend=0.75, logins_trend=0.74) == "Usage declining"
    assert reasons(spark, avg_satisfaction=2.5, payment_method="Electronic check") == (
        "Low satisfaction score; Pays by electronic check"
    )
    assert reasons(
        spark, contract="Month-to-month", late_payments_recent=3.0, minutes_trend=0.1, cancellation_inquiries=1.0,
        complaint_count=5.0, unresolved_calls=4.0, avg_satisfaction=1.0, payment_method="Electronic check",
    ) == "Month-to-month contract; 3 late payments in last 3 months; Usage declining; Asked about cancelling"
    assert reasons(spark, complaint_count=2.0, unresolved_calls=7.0) == "2 complaints; 7 unresolved calls"


def test_bands_use_the_rounded_probability(spark):
    found = column(spark, [0.2499, 0.25, 0.49996, 0.5, 1.0], "double", lambda p: risk_band(rounded_probability(p)))
    assert found == ["Low", "Medium", "High", "High", "High"]


def test_half_even_rounding(spark):
    assert column(spark, [0.00005, 0.00015], "double", lambda p: rounded_probability(p, half_even=True)) == [0.0, 0.0002]
    assert column(spark, [0.00005, 0.00015], "double", rounded_probability) == [0.0001, 0.0002]


def test_buckets(spark):
    assert column(spark, [0.0, 0.0249, 0.025, 0.5, 0.9999, 1.0], "double", probability_bin) == [0, 0, 1, 20, 39, 39]
    assert column(spark, [0.0, 4.0, 5.0, 17.0], "double", capped_count) == ["0", "4", "5+", "5+"]
    assert column(spark, [-1.0, 0.0, 6.0, 7.0, 12.0, 48.0, 49.0, 100.0, 101.0], "double", tenure_bucket) == [
        None, "0–6", "0–6", "7–12", "7–12", "37–48", "49+", "49+", None,
    ]
    assert column(spark, ["contract_ohe_Two year", "avg_sms"], "string", readable_feature) == [
        "contract = Two year", "avg sms",
    ]


@pytest.fixture
def wide(spark):
    base = {**{c: "x" for c in CATEGORICAL}, **{n: 0.0 for n in NUMERIC}, "avg_satisfaction": 3.0}
    people = [
        ("C1", "train", 1, 0.9, {"contract": "a", "monthly_charges": 10.0, "tenure_months": 6.0}),
        ("C2", "test", 0, 0.49996, {"contract": "a", "monthly_charges": 20.0, "tenure_months": 7.0}),
        ("c3", "test", 1, 0.3, {"contract": "b", "monthly_charges": 30.0, "tenure_months": 101.0}),
    ]
    rows = [
        {"customer_id": cid, "split": split, "label": label, "prob_m": p, "prob_other": 1 - p, **base, **changes}
        for cid, split, label, p, changes in people
    ]
    return spark.createDataFrame([tuple(r.values()) for r in rows], list(rows[0]))


@pytest.fixture
def scores(spark, wide):
    choice = spark.createDataFrame([("m", 0.49998)], "model string, threshold double")
    return risk_scores(wide, ["m", "other"], choice, SPEC)


def test_scores_compare_the_rounded_probability_with_the_unrounded_threshold(scores):
    found = {r.customer_id: (r.churn_probability, r.risk_band, r.predicted_churn) for r in scores.collect()}
    assert found == {"C1": (0.9, "High", 1), "C2": (0.5, "High", 1), "c3": (0.3, "Medium", 0)}
    assert {r.customer_id: r.prob_other for r in scores.collect()} == {"C1": 0.1, "C2": 0.5, "c3": 0.7}


def test_portfolio_and_bands(scores):
    kpis = rp.portfolio_kpis(scores).first()
    assert (kpis.customers, kpis.high_risk, kpis.revenue_at_risk) == (3, 2, 30.0)
    assert kpis.high_share == pytest.approx(2 / 3)
    assert [(r.risk_band, r.n) for r in rp.band_rollup(scores).collect()] == [("Low", None), ("Medium", 1), ("High", 2)]


def test_segments_are_sorted_by_outcome(scores):
    rows = [r for r in rp.segment_rollup(scores).collect() if r.segment == "contract"]
    assert [(r.value, r.n, r.actual_rate) for r in rows] == [("b", 1, 1.0), ("a", 2, 0.5)]
    assert rows[1].mean_probability == 0.7


def test_filters_and_lists(scores):
    assert rp.matching(scores, bands=()).count() == 3
    assert rp.matching(scores, probability=(0.3, 0.5)).count() == 2
    assert rp.matching(scores, contracts=("a",), held_out_only=True).first().customer_id == "C2"
    assert [r.customer_id for r in rp.customer_list(rp.matching(scores), size=2).collect()] == ["C1", "C2"]
    summary = rp.list_summary(rp.matching(scores)).first()
    assert (summary.n, summary.mean_monthly_charge) == (3, 20.0)
    assert rp.list_summary(rp.matching(scores, bands=("Low",))).first().n == 0


def test_export_is_in_order_and_the_histogram_is_full(scores):
    rows = rp.list_export(rp.matching(scores, bands=())).orderBy("position").collect()
    assert [(r.position, r.customer_id) for r in rows] == [(1, "C1"), (2, "C2"), (3, "c3")]
    bins = {r.bin: r.n for r in rp.probability_histogram(scores).collect()}
    assert sorted(bins) == list(range(40)) and sum(bins.values()) == 3 and bins[36] == 1


def test_lookup_ignores_case_and_blanks(scores):
    assert rp.customer_lookup(scores, " C3 ").first().customer_id == "c3"
    assert rp.customer_lookup(scores, "C4").count() == 0


def test_rates(scores):
    assert {r.bucket: r.n for r in rp.rate_by_tenure(scores).collect()} == {"0–6": 1, "7–12": 1}
    assert {(r.feature, r.bucket, r.n) for r in rp.rate_by_behaviour(scores).collect()} == {
        (f, "0", 3) for f in rp.BEHAVIOUR_FEATURES
    }
    long = rp.model_scores_long(scores, ["m", "other"], {"m": "A model"})
    assert long.count() == 6 and {r.model for r in long.collect()} == {"A model", "other"}
    assert [r.value for r in rp.facet_values(scores).filter("facet = 'contract'").collect()] == ["a", "b"]


def test_top_list_needs_no_full_sort(scores):
    plan = rp.customer_list(rp.matching(scores))._jdf.queryExecution().executedPlan().toString()
    assert "TakeOrderedAndProject" in plan


def test_filters_reach_the_scan(spark, scores, tmp_path):
    path = str(tmp_path / "scores")
    scores.write.parquet(path)
    spark.conf.set("spark.sql.maxMetadataStringLength", "10000")
    plan = rp.list_summary(rp.matching(spark.read.parquet(path), held_out_only=True))
    text = plan._jdf.queryExecution().executedPlan().toString()
    spark.conf.unset("spark.sql.maxMetadataStringLength")
    assert "EqualTo(split,test)" in text and "GreaterThanOrEqual(churn_probability,0.0)" in text
    assert "risk_factors" not in text.split("ReadSchema")[1]
