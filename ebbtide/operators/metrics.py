"""Ranking metrics as DataFrame operators.

Input is ``scored``: (model, split, customer_id, label, score), one row per model and customer. ``score`` is either
a probability or, in reporting mode, a whole number of basis points; ``unit`` is 1.0 or 10,000 accordingly.

All curve-like metrics start from ``score_groups``: one row per distinct score with the number of positives and
negatives. That aggregate is combined map-side, so even a score shared by a third of all customers is one row per
task when it reaches the shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ebbtide.functions.hashing import cell_of, digest
from ebbtide.functions.windows import ratio
from ebbtide.operators.prefix import place_by_range, running_sums
from ebbtide.sources.storage import cut_lineage

CURVE_POINTS = 120
GAINS_POINTS = 200
DEFAULT_CUT = "at_default_0.5"
TUNED_CUT = "at_tuned"
KEYS = ["model", "split"]


def scored_long(wide: DataFrame, models: list[str], unit: float = 1.0) -> DataFrame:
    """``prob_<model>`` columns to one row per model; a narrow operation."""
    score = F.col("p") if unit == 1.0 else F.round(F.col("p") * unit).cast("bigint")
    return (
        wide.unpivot(
            ["customer_id", "split", "label"], [f"prob_{m}" for m in models], "column", "p"
        )
        .select(
            F.replace("column", F.lit("prob_"), F.lit("")).alias("model"),
            "split", "customer_id", F.col("label").cast("int").alias("label"), score.alias("score"),
        )
    )


def score_groups(scored: DataFrame) -> DataFrame:
    return scored.groupBy(*KEYS, "score").agg(
        F.sum(F.col("label").cast("bigint")).alias("pos"),
        F.sum((1 - F.col("label")).cast("bigint")).alias("neg"),
    )


def rank_groups(groups: DataFrame, parts: int | None = None, unit: float = 1.0) -> DataFrame:
    """Score groups with cumulative and total counts, scores descending.

    With a ``unit`` over 1, scores are whole numbers from 0 to it (basis points), hence few groups, and take one window
    per model and split; any other value is an error. All other scores may be as many as customers: they are placed in
    ``parts`` ranges, by default as many as the number of distinct scores calls for.
    """
    if unit > 1.0:
        fits = F.col("score").between(0, unit) & (F.col("score") == F.floor("score"))
        wrong = F.raise_error(F.concat(F.lit(f"score outside 0..{unit:.0f}: "), F.col("score").cast("string")))
        groups = groups.withColumn("score", F.when(fits | F.col("score").isNull(), F.col("score")).otherwise(wrong))
    else:
        groups = place_by_range(groups, KEYS, "score", parts)
    return running_sums(groups, KEYS, "score", ["pos", "neg"], following=("pos", "neg"))


def _product(left: Column, right: Column) -> Column:
    # Pair counts outgrow 64 bits beyond a few billion customers.
    return left.cast("decimal(18,0)") * right.cast("decimal(18,0)")


def split_summary(ranked: DataFrame) -> DataFrame:
    """Per model and split: size, ROC-AUC, average precision and the threshold with the highest F1.

    ROC-AUC counts a tied pair as one half and is NULL with a single class. Average precision is the step-wise sum
    over distinct thresholds, not a trapezoid. Among thresholds with equal F1 the lowest one is reported.
    """
    pos, neg = F.col("pos"), F.col("neg")
    tp, fp = F.col("cum_pos"), F.col("cum_neg")
    all_pos, all_neg = F.col("total_pos"), F.col("total_neg")
    half_wins = _product(pos, 2 * (all_neg - fp) + neg)
    precision = tp.cast("double") / (tp + fp).cast("double")
    f1 = (2 * tp).cast("double") / (tp + fp + all_pos).cast("double")
    best = F.max(F.struct(f1.alias("f1"), (-F.col("score")).alias("negated")))
    totals = ranked.groupBy(*KEYS).agg(
        F.max(all_pos).alias("positives"),
        F.max(all_neg).alias("negatives"),
        F.sum(half_wins).cast("double").alias("half_wins"),
        F.sum(pos * precision).alias("precision_sum"),
        best.alias("best"),
    )
    pairs = _product(F.col("positives"), F.col("negatives")).cast("double")
    return totals.select(
        *KEYS,
        (F.col("positives") + F.col("negatives")).alias("n"),
        "positives",
        ratio(F.col("half_wins"), 2.0 * pairs).alias("roc_auc"),
        ratio(F.col("precision_sum"), F.col("positives")).alias("average_precision"),
        (-F.col("best.negated")).alias("best_threshold"),
        F.col("best.f1").alias("best_f1"),
    )


def pick_best(summary: DataFrame, split: str = "val") -> DataFrame:
    """The model with the highest ROC-AUC on a split, and its F1-optimal threshold; one row."""
    return (
        summary.filter(F.col("split") == split)
        .orderBy(F.col("roc_auc").desc_nulls_last(), "model")
        .limit(1)
        .select("model", "roc_auc", F.col("best_threshold").alias("threshold"))
    )


def cut_table(summary: DataFrame, unit: float = 1.0) -> DataFrame:
    """(model, cut, threshold): the default cut and the one tuned on the validation split."""
    threshold = F.col("best_threshold")
    half = F.lit(0.5 * unit).cast(summary.schema["best_threshold"].dataType)
    cuts = F.array(
        F.struct(F.lit(DEFAULT_CUT).alias("cut"), half.alias("threshold")),
        F.struct(F.lit(TUNED_CUT).alias("cut"), threshold.alias("threshold")),
    )
    return summary.filter(F.col("split") == "val").select("model", F.inline(cuts))


def confusion(groups: DataFrame, cuts: DataFrame) -> DataFrame:
    """tp, fp, fn, tn per model and cut; a customer is flagged when score >= threshold."""
    flagged = F.col("score") >= F.col("threshold")

    def total(count: str, condition: Column) -> Column:
        return F.sum(F.when(condition, F.col(count)).otherwise(F.lit(0)))

    # Two cuts per model: the broadcast side has a handful of rows.
    return groups.join(F.broadcast(cuts), "model").groupBy("model", "cut", "threshold").agg(
        total("pos", flagged).alias("tp"),
        total("neg", flagged).alias("fp"),
        total("pos", ~flagged).alias("fn"),
        total("neg", ~flagged).alias("tn"),
    )


def threshold_metrics(confusions: DataFrame, unit: float = 1.0) -> DataFrame:
    """Precision, recall, F1 and accuracy; 0 where the denominator is 0."""
    tp, fp, fn, tn = (F.col(c) for c in ("tp", "fp", "fn", "tn"))

    def share(numerator: Column, denominator: Column) -> Column:
        return F.coalesce(ratio(numerator, denominator), F.lit(0.0))

    precision, recall = F.col("precision"), F.col("recall")
    return (
        confusions
        .withColumn("precision", share(tp, tp + fp))
        .withColumn("recall", share(tp, tp + fn))
        .select(
            "model",
            "cut",
            F.round(F.col("threshold").cast("double") / unit, 4).alias("threshold"),
            "precision",
            "recall",
            share(2.0 * precision * recall, precision + recall).alias("f1"),
            share(tp + tn, tp + fp + fn + tn).alias("accuracy"),
            "tp", "fp", "fn", "tn",
        )
    )


def curve_points(ranked: DataFrame) -> DataFrame:
    """(model, split, curve, idx, length, x, y) of the ROC and the precision-recall curve, in one pass.

    ``roc``: fpr and tpr from (0, 0) on, thresholds descending. A threshold is left out when it lies on the straight
    line between its neighbours, that is when the next group has the same number of positives and of negatives; the
    first and the last threshold always stay.

    ``pr``: recall and precision, thresholds ascending, closed by (0, 1).
    """
    first = (F.col("cum_pos") == F.col("pos")) & (F.col("cum_neg") == F.col("neg"))
    bends = (F.col("next_pos") != F.col("pos")) | (F.col("next_neg") != F.col("neg"))
    bends = first | F.col("next_pos").isNull() | bends
    flagged = ranked.withColumn("bend", F.when(bends, 1).otherwise(0).cast("bigint"))
    numbered = running_sums(flagged.withColumn("one", F.lit(1).cast("bigint")), KEYS, "score", ["bend", "one"])

    tp, fp, positives, negatives = (F.col(c) for c in ("cum_pos", "cum_neg", "total_pos", "total_neg"))
    bend_count, count, at_start = F.col("total_bend"), F.col("total_one"), F.col("cum_one") == 1

    def point(curve: str, idx: Column, last: Column, x: Column, y: Column) -> Column:
        return F.struct(
            F.lit(curve).alias("curve"), idx.cast("bigint").alias("idx"), (last + 1).alias("length"),
            x.alias("x"), y.alias("y"),
        )

    points = F.array(
        F.when(
            F.col("bend") == 1, point("roc", F.col("cum_bend"), bend_count, ratio(fp, negatives), ratio(tp, positives))
        ),
        point("pr", count - F.col("cum_one"), count, ratio(tp, positives), ratio(tp, tp + fp)),
        F.when(
            at_start,
            point("roc", F.lit(0), bend_count, F.when(negatives > 0, 0.0), F.when(positives > 0, 0.0)),
        ),
        F.when(at_start, point("pr", count, count, F.lit(0.0), F.lit(1.0))),
    )
    return numbered.select(*KEYS, F.inline(F.array_compact(points)))


def downsample(points: DataFrame, n: int = CURVE_POINTS) -> DataFrame:
    """At most ``n`` evenly spread points per curve, both ends included, rounded to 4 digits.

    The i-th wanted index is ``floor(i * stride)``. Whether an index is one of them follows from the few ``i`` around
    ``idx / stride``, so this is a filter.
    """
    last, idx = F.col("length") - 1, F.col("idx")
    stride = last.cast("double") / F.lit(float(n - 1))
    near = F.floor(ratio(idx, stride)).cast("bigint")
    wanted = F.exists(
        F.array(*[near + shift for shift in (-1, 0, 1, 2)]),
        lambda i: i.between(0, n - 2) & (F.floor(i * stride) == idx),
    )
    return points.filter((idx == last) | wanted).select(
        *KEYS, "curve", "idx", F.round("x", 4).alias("x"), F.round("y", 4).alias("y")
    )


def positives_at_ranks(scored: DataFrame, ranked: DataFrame, first: Column, step: Column) -> DataFrame:
    """Cumulative positives at the ranks ``first, first+step, ...`` of each model and split.

    Rank 1 is the highest score; equal scores are ordered by the digest of the customer id, which favours nobody.
    ``first`` and ``step`` may use ``n``, the number of customers, and must select few ranks.

    Nothing is sorted as a whole. The cumulative counts tell which score groups hold a wanted rank; only their
    rows are counted by digest cell, and only the rows of the cells that hold a wanted rank are put in order. A
    score group of any size is thus spread over thousands of cells.
    """

    def wanted_upto(rank: Column) -> Column:
        return F.when(rank < F.col("first"), 0).otherwise(
            F.floor((rank - F.col("first")) / F.col("step")).cast("bigint") + 1
        )

    def holds_wanted(before: Column, size: Column) -> Column:
        return wanted_upto(before + size) > wanted_upto(before)

    size = F.col("pos") + F.col("neg")
    groups = (
        ranked
        .withColumn("n", F.col("total_pos") + F.col("total_neg"))
        .withColumn("first", first.cast("bigint"))
        .withColumn("step", step.cast("bigint"))
        .withColumn("before", F.col("cum_pos") + F.col("cum_neg") - size)
        .filter(holds_wanted(F.col("before"), size))
        .select(
            *KEYS, "score", "n", F.col("total_pos").alias("positives"), "first", "step", "before",
            (F.col("cum_pos") - F.col("pos")).alias("pos_before"),
        )
    )
    group_keys = [*KEYS, "score"]
    # Each group listed holds a wanted rank, so there are no more groups than wanted ranks. Only their rows are hashed.
    rows = cut_lineage(
        scored.join(F.broadcast(groups), group_keys).withColumn("_digest", digest(F.col("customer_id")))
        .withColumn("_cell", cell_of(F.col("_digest")))
    )
    earlier = Window.partitionBy(*group_keys).orderBy("_cell").rowsBetween(Window.unboundedPreceding, -1)
    cells = (
        rows.groupBy(*groups.columns, "_cell")
        .agg(F.count(F.lit(1)).alias("size"), F.sum(F.col("label").cast("bigint")).alias("pos"))
        .withColumn("before", F.col("before") + F.coalesce(F.sum("size").over(earlier), F.lit(0)))
        .withColumn("pos_before", F.col("pos_before") + F.coalesce(F.sum("pos").over(earlier), F.lit(0)))
        .filter(holds_wanted(F.col("before"), F.col("size")))
        .drop("size", "pos")
    )
    inside = Window.partitionBy(*group_keys, "_cell").orderBy("_digest", "customer_id")
    upto = inside.rowsBetween(Window.unboundedPreceding, 0)
    return (
        rows.select(*group_keys, "_cell", "_digest", "customer_id", "label")
        .join(F.broadcast(cells), [*group_keys, "_cell"])  # again at most one cell per wanted rank
        .withColumn("rank", F.col("before") + F.row_number().over(inside))
        .withColumn("captured", F.col("pos_before") + F.sum(F.col("label").cast("bigint")).over(upto))
        .filter((F.col("rank") >= F.col("first")) & ((F.col("rank") - F.col("first")) % F.col("step") == 0))
        .select(*KEYS, "rank", "captured", "n", "positives")
    )


def top_decile_lift(scored: DataFrame, ranked: DataFrame) -> DataFrame:
    """Outcome rate of the top ``max(1, n // 10)`` customers over the overall rate."""
    k = F.greatest(F.lit(1), F.floor(F.col("n") / 10))
    at_k = positives_at_ranks(scored, ranked, first=k, step=F.col("n"))
    lift = ratio(_product(F.col("captured"), F.col("n")), _product(F.col("rank"), F.col("positives")))
    return at_k.select(*KEYS, F.col("rank").alias("k"), lift.alias("top_decile_lift"))


def cumulative_gains(scored: DataFrame, ranked: DataFrame, points: int = GAINS_POINTS) -> DataFrame:
    """Share of positives reached by contacting the riskiest customers first, at evenly spaced ranks."""
    step = F.greatest(F.lit(1), F.floor(F.col("n") / points))
    return positives_at_ranks(scored, ranked, first=F.lit(1), step=step).select(
        *KEYS,
        "rank",
        ratio(F.col("rank"), F.col("n")).alias("contacted"),
        ratio(F.col("captured"), F.col("positives")).alias("captured"),
    )


def gains_at_decile(scored: DataFrame, ranked: DataFrame) -> DataFrame:
    """The gains curve read at index ``int(0.1 n)``, which is one customer further than the lift's ``k``."""
    index = F.floor(F.lit(0.1) * F.col("n")).cast("bigint")
    return positives_at_ranks(scored, ranked, first=index + 1, step=F.col("n")).select(
        *KEYS, "rank", ratio(F.col("captured"), F.col("positives")).alias("captured")
    )
