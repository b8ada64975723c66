"""Report buckets."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

PROBABILITY_BINS = 40
BASIS = 10_000
COUNT_CAP = 5

# Right-closed tenure buckets as (upper bound, label); above the last bound a row has no bucket.
TENURE_FLOOR = -1
TENURE_BUCKETS = (
    (6, "0–6"), (12, "7–12"), (24, "13–24"), (36, "25–36"), (48, "37–48"), (100, "49+"),
)


def basis_points(probability: Column) -> Column:
    """Probability as an integer, so that sums do not depend on the order of addition."""
    return F.round(probability * BASIS).cast("bigint")


def probability_bin(probability: Column) -> Column:
    width = BASIS // PROBABILITY_BINS
    return F.least(F.floor(basis_points(probability) / width), F.lit(PROBABILITY_BINS - 1)).cast("int")


def capped_count(value: Column) -> Column:
    """``5+`` for anything at or above the cap, else the count as text."""
    whole = F.least(value, F.lit(float(COUNT_CAP))).cast("int")
    return F.when(whole == COUNT_CAP, f"{COUNT_CAP}+").otherwise(whole.cast("string"))


def tenure_bucket(tenure: Column) -> Column:
    bucket = F.when(tenure <= TENURE_FLOOR, None)
    for upper, label in TENURE_BUCKETS:
        bucket = bucket.when(tenure <= upper, label)
    return bucket


def readable_feature(name: Column) -> Column:
    """``contract_ohe_Two year`` reads ``contract = Two year``; other underscores become blanks."""
    return F.replace(F.replace(name, F.lit("_ohe_"), F.lit(" = ")), F.lit("_"), F.lit(" "))
