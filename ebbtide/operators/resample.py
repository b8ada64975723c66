"""Sampling customers with replacement up to any size.

Both the position given to a customer and the position a draw asks for come from digests. Nothing depends on
partitioning or on the order in which tasks run, so a recomputed task repeats its draws.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ebbtide.functions.hashing import cell_of, digest, digest_number, standard_normal

CHARGE_SPREAD = 0.03
CHARGE_FLOOR = 15.0


def with_position(df: DataFrame, key: str, name: str = "position") -> DataFrame:
    """Positions 0..n-1 without gaps, in the order of (digest of key, key).

    Rows fall into equally filled digest cells; a window runs inside a cell, and the cells' start positions come
    from a running sum over the few thousand cell sizes.
    """
    placed = df.withColumn("_digest", digest(F.col(key))).withColumn("_cell", cell_of(F.col("_digest")))
    earlier = Window.orderBy("_cell").rowsBetween(Window.unboundedPreceding, -1)
    starts = (
        placed.groupBy("_cell").agg(F.count(F.lit(1)).alias("_size"))
        .select("_cell", F.coalesce(F.sum("_size").over(earlier), F.lit(0)).alias("_start"))
    )
    within = Window.partitionBy("_cell").orderBy("_digest", key)
    return (
        placed
        .join(F.broadcast(starts), "_cell")  # at most CELLS rows, however large the input
        .withColumn(name, F.col("_start") + F.row_number().over(within) - 1)
        .drop("_digest", "_cell", "_start")
    )


def draws(customers: DataFrame, size: int, population: int) -> DataFrame:
    """(draw, position) pairs: ``size`` draws over positions ``0 .. population-1``."""
    spark = customers.sparkSession
    return spark.range(size).select(
        F.col("id").alias("draw"),
        (digest_number(F.concat(F.lit("draw-"), F.col("id").cast("string")), 1, 12) % population)
        .alias("position"),
    )


def bootstrap_customers(customers: DataFrame, size: int | None, jitter: bool = True) -> DataFrame:
    """``size`` rows drawn with replacement; the input itself when no size, or its own size, is asked for.

    A drawn row has the id ``<id>-<draw, 7 digits>`` and remembers its ``source_customer_id``, which is what a
    train/test split has to go by: copies of one customer must not be spread over several splits.
    """
    population = customers.count()
    source = customers.withColumn("source_customer_id", F.col("customer_id").cast("string"))
    if size is None or size == population:
        return source.withColumn("customer_id", F.col("source_customer_id"))
    drawn = (
        draws(customers, size, population)
        .join(with_position(source, "source_customer_id"), "position")
        .withColumn("customer_id", F.format_string("%s-%07d", "source_customer_id", "draw"))
    )
    if jitter:
        drawn = drawn.withColumn("monthly_charges", jittered_charge("monthly_charges", "draw"))
    return drawn.select(*source.columns)


def jittered_charge(charge: str, draw: str):
    noise = standard_normal(F.concat(F.lit("jitter-"), F.col(draw).cast("string")))
    return F.greatest(F.round(F.col(charge) * (1.0 + CHARGE_SPREAD * noise), 2), F.lit(CHARGE_FLOOR))
