"""Date predicates of the observation window.

Bounds are literals that Catalyst folds, so on DATE columns they reach the Parquet scan.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ebbtide.spec import ObservationSpec


def window_start(spec: ObservationSpec, months: int) -> Column:
    return F.add_months(F.lit(spec.snapshot), -months)


def in_window(day: str, spec: ObservationSpec) -> Column:
    return (F.col(day) > window_start(spec, spec.obs_months)) & (F.col(day) <= F.lit(spec.snapshot))


def is_recent(day: str, spec: ObservationSpec) -> Column:
    return F.col(day) > window_start(spec, spec.recent_months)


def in_last_days(day: str, spec: ObservationSpec) -> Column:
    return F.col(day) >= F.date_sub(F.lit(spec.snapshot), spec.recent_days)


def ratio(numerator: Column, denominator: Column) -> Column:
    """Division that yields NULL for a zero denominator, also under ANSI mode."""
    return numerator.cast("double") / F.nullif(denominator.cast("double"), F.lit(0.0))
