"""Set membership in a broadcast of fixed size, for sets of any size.

A set of 64-bit hashes becomes a table of bits, one per value of some of the bits of a hash. Members always pass; others
pass when their bit is set by chance, which is rare up to some ten million members and more frequent beyond. So a sieve
spares work, and whoever uses it must be right whatever passes.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ROWS, WORDS = 1 << 19, 8  # of 64 bits: 32 MB


def _place(key: str, width: int, below: int) -> Column:
    return F.shiftrightunsigned(F.col(key), below).bitwiseAND(F.lit(width - 1))


def _bit(key: str) -> Column:
    return F.call_function("shiftleft", F.lit(1).cast("bigint"), _place(key, 64, 0).cast("int"))


def _joined(rows: DataFrame, members: DataFrame, key: str, how: str) -> tuple[DataFrame, Column]:
    words = [F.bit_or(F.when(_place(key, WORDS, 6) == i, _bit(key)).otherwise(0)).alias(f"_sieve_{i}") for i in range(WORDS)]
    table = members.groupBy(_place(key, ROWS, 9).alias("_sieve_row")).agg(*words)
    word = F.lit(0).cast("bigint")
    for i in range(WORDS):
        word = F.when(_place(key, WORDS, 6) == i, F.col(f"_sieve_{i}")).otherwise(word)
    found = rows.withColumn("_sieve_row", _place(key, ROWS, 9)).join(F.broadcast(table), "_sieve_row", how)
    return found, F.coalesce(word.bitwiseAND(_bit(key)) != 0, F.lit(False))


def passing(rows: DataFrame, members: DataFrame, key: str) -> DataFrame:
    """Rows whose hash ``key`` is that of a member, and a few others. No shuffle of the rows."""
    found, passes = _joined(rows, members, key, "inner")
    return found.filter(passes).select(rows.columns)


def parted(rows: DataFrame, members: DataFrame, key: str) -> tuple[DataFrame, DataFrame]:
    """The rows that pass and those that do not; a null key does not."""
    found, passes = _joined(rows, members, key, "left")
    return found.filter(passes).select(rows.columns), found.filter(~passes).select(rows.columns)
