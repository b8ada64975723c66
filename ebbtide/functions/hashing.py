"""Hash-derived values: they depend on the row alone, so a recomputed task gives the same answer."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

from ebbtide.spec import TRAIN_SHARE, VALIDATION_SHARE

CELL_DIGITS = 3
CELLS = 16 ** CELL_DIGITS


def digest(value: Column) -> Column:
    return F.md5(value.cast("string"))


def digest_number(value: Column, first: int = 1, digits: int = 8) -> Column:
    """Hex digits ``first .. first+digits-1`` of the md5 as a number."""
    return F.conv(F.substring(digest(value), first, digits), 16, 10).cast("bigint")


def md5_bucket(value: Column) -> Column:
    return digest_number(value) % 100


def xxhash_bucket(value: Column) -> Column:
    return F.pmod(F.xxhash64(value), F.lit(100)).cast("bigint")


def cell_of(digest_column: Column) -> Column:
    """One of ``CELLS`` equally likely cells; cells are ordered the way digests are."""
    return F.conv(F.substring(digest_column, 1, CELL_DIGITS), 16, 10).cast("int")


def split_label(bucket: Column) -> Column:
    return (
        F.when(bucket < TRAIN_SHARE, "train")
        .when(bucket < TRAIN_SHARE + VALIDATION_SHARE, "val")
        .otherwise("test")
    )


SPLIT_HASHES = {"xxhash64": xxhash_bucket, "md5": md5_bucket}


def split_of(key: Column, method: str = "xxhash64") -> Column:
    return split_label(SPLIT_HASHES[method](key))


def standard_normal(key: Column) -> Column:
    """Box-Muller on two independent 32-bit pieces of the key's digest."""
    span = float(2 ** 32)
    radius = (digest_number(key, 1) + 1).cast("double") / F.lit(span)
    angle = digest_number(key, 9).cast("double") / F.lit(span)
    return F.sqrt(F.lit(-2.0) * F.ln(radius)) * F.cos(F.lit(2.0 * math.pi) * angle)
