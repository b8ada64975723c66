"""Ranking metrics against brute force in plain Python, in both ways of computing running sums."""

import hashlib
import random

import pytest
from pyspark.sql import functions as F

from ebbtide.operators import metrics as mt
from ebbtide.plans.evaluation import comparison_table, evaluate, metrics_document

SCHEMA = "model string, split string, customer_id bigint, label int, score double"
WINDOW = None  # basis points in one window; a number stands for fractional scores in that many ranges


def scored(spark, rows, split="test"):
    """Whole-number scores become basis points, anything else stays fractional."""
    whole = all(isinstance(p, int) for _, p in rows)
    schema = SCHEMA.replace("double", "bigint") if whole else SCHEMA
    return spark.createDataFrame([("m", split, i, y, p) for i, (y, p) in enumerate(rows)], schema)


def random_rows(n, distinct, seed, rate=0.3, parts=WINDOW):
    rng = random.Random(seed)
    drawn = [(int(rng.random() < rate), rng.randrange(distinct)) for _ in range(n)]
    return drawn if parts is WINDOW else [(y, p / distinct) for y, p in drawn]


def brute_auc(rows):
    pos = [p for y, p in rows if y]
    neg = [p for y, p in rows if not y]
    return sum((a > b) + 0.5 * (a == b) for a in pos for b in neg) / (len(pos) * len(neg))


def brute_groups(rows):
    tp = fp = 0
    for p in sorted({p for _, p in rows}, reverse=True):
        tp += sum(1 for y, q in rows if q == p and y)
        fp += sum(1 for y, q in rows if q == p and not y)
        yield p, tp, fp


def brute_ap(rows):
    total, before, ap = sum(y for y, _ in rows), 0, 0.0
    for _, tp, fp in brute_groups(rows):
        ap += (tp - before) / total * tp / (tp + fp)
        before = tp
    return ap


def brute_threshold(rows):
    total = sum(y for y, _ in rows)
    return max((2 * tp / (tp + fp + total), -p) for p, tp, fp in brute_groups(rows))


def brute_order(rows):
    return sorted(
        range(len(rows)), key=lambda i: (-rows[i][1], hashlib.md5(str(i).encode()).hexdigest(), i)
    )


def ranked(df, parts=WINDOW, unit=1.0):
    return mt.rank_groups(mt.score_groups(df), parts, unit)


def curve(groups, name):
    points = mt.curve_points(groups).filter(F.col("curve") == name).orderBy("idx").collect()
    assert [p.idx for p in points] == list(range(points[0].length))
    return [(p.x, p.y) for p in points]


def test_way_is_chosen_by_the_unit(spark):
    assert "_range" not in ranked(scored(spark, [(1, 3)]), unit=10_000.0).columns
    assert "_range" in ranked(scored(spark, [(1, 3)])).columns
    assert "_range" in ranked(scored(spark, [(1, 0.3)])).columns


@pytest.mark.parametrize("score", [10_001, -1])
def test_scores_outside_the_unit_are_refused(spark, score):
    with pytest.raises(Exception, match="score outside"):
        ranked(scored(spark, [(1, score), (0, 5)]), unit=10_000.0).collect()


def test_number_of_ranges_follows_the_rows(spark, monkeypatch):
    from ebbtide.operators import prefix

    monkeypatch.setattr(prefix, "RANGE_ROWS", 10)
    assert prefix.range_count(spark.range(10_000)) == 1000
    assert prefix.range_count(spark.range(1)) == 2 * 8


def test_numbered_is_a_global_order(spark):
    from ebbtide.operators.prefix import numbered

    rows = spark.range(1000).select(F.col("id"), (F.col("id") * 7919 % 1000).alias("v"))
    assert all(r.position == r.v + 1 for r in numbered(rows, F.asc("v")).collect())


@pytest.mark.parametrize("parts", [WINDOW, 1, 5, 64])
@pytest.mark.parametrize("distinct", [3, 10_000])
def test_summary_equals_brute_force(spark, parts, distinct):
    rows = random_rows(400, distinct, seed=distinct, parts=parts)
    row = mt.split_summary(ranked(scored(spark, rows), parts)).collect()[0]
    f1, negated = brute_threshold(rows)
    assert row.roc_auc == pytest.approx(brute_auc(rows), abs=1e-12)
    assert row.average_precision == pytest.approx(brute_ap(rows), abs=1e-12)
    assert (row.best_f1, row.best_threshold) == (pytest.approx(f1), -negated)
    assert (row.n, row.positives) == (400, sum(y for y, _ in rows))


@pytest.mark.parametrize("parts", [WINDOW, 7])
def test_curves_equal_brute_force(spark, parts):
    rows = random_rows(300, 60, seed=4, parts=parts)
    groups = ranked(scored(spark, rows), parts)
    positives = sum(y for y, _ in rows)
    cumulated = list(brute_groups(rows))
    steps = [
        (b[1] - a[1], b[2] - a[2]) for a, b in zip([(None, 0, 0), *cumulated], cumulated)
    ]
    expected = [(0.0, 0.0)] + [
        (fp / (300 - positives), tp / positives)
        for i, (_, tp, fp) in enumerate(cumulated)
        if i in (0, len(cumulated) - 1) or steps[i] != steps[i + 1]
    ]
    assert curve(groups, "roc") == expected
    expected = [(tp / positives, tp / (tp + fp)) for _, tp, fp in reversed(cumulated)] + [(0.0, 1.0)]
    assert curve(groups, "pr") == expected


def test_roc_leaves_out_collinear_points(spark):
    rows = [(y, p) for p in (0.9, 0.8, 0.7, 0.6) for y in (0, 1)]
    assert curve(ranked(scored(spark, rows)), "roc") == [(0.0, 0.0), (0.25, 0.25), (1.0, 1.0)]


@pytest.mark.parametrize("length", [1, 2, 3, 60, 119, 120, 121, 239, 240, 357, 1000, 9_999, 10_002])
def test_downsample_takes_evenly_spread_indices(spark, length):
    points = spark.range(length).selectExpr(
        "'m' AS model", "'test' AS split", "'pr' AS curve", "id AS idx", f"{length}L AS length", "0D AS x", "0D AS y"
    )
    expected = {int(i * ((length - 1) / 119)) for i in range(119)} | {length - 1}
    assert {r.idx for r in mt.downsample(points).collect()} == expected


@pytest.mark.parametrize("parts", [WINDOW, 6])
@pytest.mark.parametrize("distinct", [1, 4, 10_000])
def test_gains_and_lift_equal_brute_force(spark, parts, distinct):
    rows = random_rows(1234, distinct, seed=distinct, parts=parts)
    df = scored(spark, rows)
    groups = ranked(df, parts)
    order = brute_order(rows)
    positives, n = sum(y for y, _ in rows), len(rows)
    cumulated, found = [], 0
    for i in order:
        found += rows[i][0]
        cumulated.append(found)
    step = max(1, n // 200)
    gains = mt.cumulative_gains(df, groups).orderBy("rank").collect()
    assert [r["rank"] for r in gains] == list(range(1, n + 1, step))
    assert [r.captured for r in gains] == [cumulated[r["rank"] - 1] / positives for r in gains]
    k = n // 10
    lift = mt.top_decile_lift(df, groups).collect()[0]
    assert (lift.k, lift.top_decile_lift) == (k, pytest.approx((cumulated[k - 1] / k) / (positives / n)))
    decile = mt.gains_at_decile(df, groups).collect()[0]
    assert decile.captured == cumulated[int(0.1 * n)] / positives


def test_gains_rise_and_end_at_one(spark):
    df = scored(spark, random_rows(150, 20, seed=1))
    captured = [r.captured for r in mt.cumulative_gains(df, ranked(df)).orderBy("rank").collect()]
    assert captured == sorted(captured) and captured[-1] == 1.0 and len(captured) == 150


def test_a_third_of_the_scores_tied(spark):
    """The hot score group is cut inside by digest cells; the count at the cut is still exact."""
    rows = [(int(i % 4 == 0), 0.5 if i % 3 == 0 else 1 / (i + 2)) for i in range(9_000)]
    df = scored(spark, rows)
    order = brute_order(rows)
    found = sum(rows[i][0] for i in order[:900])
    lift = mt.top_decile_lift(df, ranked(df)).collect()[0]
    assert lift.top_decile_lift == pytest.approx((found / 900) / (sum(y for y, _ in rows) / 9_000))


def test_auc_properties(spark):
    rows = random_rows(300, 50, seed=2)

    def auc(df):
        return mt.split_summary(ranked(df)).collect()[0].roc_auc

    df = scored(spark, rows)
    base = auc(df)
    assert auc(df.withColumn("score", F.exp(F.col("score") / 10))) == base
    assert auc(df.withColumn("score", -F.col("score"))) == pytest.approx(1 - base)
    assert auc(df.withColumn("score", F.lit(0.4))) == 0.5
    assert auc(df.withColumn("label", F.lit(1))) is None


def test_pair_counts_beyond_64_bits(spark):
    groups = spark.createDataFrame(
        [("m", "test", 9000, 4_000_000_000, 1_000_000_000), ("m", "test", 1000, 1_000_000_000, 4_000_000_000)],
        "model string, split string, score bigint, pos bigint, neg bigint",
    )
    assert mt.split_summary(mt.rank_groups(groups)).collect()[0].roc_auc == pytest.approx(0.8)


def test_single_row_and_single_class(spark):
    df = scored(spark, [(1, 0.7)])
    groups = ranked(df)
    assert mt.top_decile_lift(df, groups).collect()[0].k == 1
    assert mt.gains_at_decile(df, groups).collect()[0].captured == 1.0
    negatives = scored(spark, [(0, 0.7), (0, 0.2)])
    row = mt.split_summary(ranked(negatives)).collect()[0]
    assert row.roc_auc is None and row.best_threshold == 0.2
    assert mt.cumulative_gains(negatives, ranked(negatives)).collect()[0].captured is None


def test_equal_f1_takes_the_lower_threshold(spark):
    # F1 is 2/3 at 0.9 (1 of 2 found, nothing wrong) and at 0.4 (2 of 2 found, 2 wrong).
    rows = [(1, 0.9), (0, 0.6), (0, 0.5), (1, 0.4)]
    row = mt.split_summary(ranked(scored(spark, rows))).collect()[0]
    assert row.best_threshold == 0.4 and row.best_f1 == pytest.approx(2 / 3)


def test_confusion_adds_up_and_empty_denominators_give_zero(spark):
    df = scored(spark, random_rows(200, 30, seed=3, parts=2))
    cuts = spark.createDataFrame([("m", "low", 0.0), ("m", "high", 2.0)], "model string, cut string, threshold double")
    found = {r.cut: r for r in mt.threshold_metrics(mt.confusion(ranked(df), cuts)).collect()}
    assert all(r.tp + r.fp + r.fn + r.tn == 200 for r in found.values())
    assert found["low"].recall == 1.0
    assert (found["high"].precision, found["high"].recall, found["high"].f1) == (0.0, 0.0, 0.0)


def test_evaluation_is_the_same_both_ways(spark):
    """Four-digit scores: basis points in one window against probabilities in ranges."""
    rows = []
    for model in ("a", "b"):
        for split in ("val", "test", "train"):
            for i, (y, p) in enumerate(random_rows(250, 10_000, seed=ord(model) + len(split), parts=5)):
                rows.append((model, split, i, y, p))
    df = spark.createDataFrame(rows, SCHEMA)
    points = df.withColumn("score", F.round(F.col("score") * 10_000).cast("bigint"))
    one = {r.model: r.asDict(True) for r in evaluate(points, unit=10_000.0).collect()}
    other = {r.model: r.asDict(True) for r in evaluate(df, parts=5).collect()}
    for model in one:
        for name, value in one[model].items():
            if isinstance(value, float):
                assert other[model][name] == pytest.approx(value, abs=1e-12), name
            else:
                assert other[model][name] == value, name
    table = comparison_table(metrics_document(evaluate(df, parts=5)))
    assert {r.model: r.f1 for r in table.collect()} == {m: other[m]["at_tuned"]["f1"] for m in other}
