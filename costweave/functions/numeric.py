"""Numeric column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def to_double(c: Column | str) -> Column:
    """Parse as double; text that is no number, and NaN, become null."""
    value = (F.col(c) if isinstance(c, str) else c).try_cast("double")
    return F.when(~F.isnan(value), value)


def fixed(c: Column, places: int = 4) -> Column:
    """Round by floor(x * 10^places + 0.500001): the same on engines whose round() differ on ties."""
    scale = 10**places
    return F.floor(c * F.lit(float(scale)) + F.lit(0.500001)).cast("double") / F.lit(float(scale))


def round_pretty(x: Column) -> Column:
    """Round half-even to a step that grows with the magnitude: 1, 10, 100, 1 000, 10 000."""

    def to_step(step: int) -> Column:
        return F.bround(x / F.lit(float(step)), 0) * step

    return (
        F.when(x < 100, F.bround(x, 0))
        .when(x < 1_000, to_step(10))
        .when(x < 100_000, to_step(100))
        .when(x < 1_000_000, to_step(1_000))
        .otherwise(to_step(10_000))
        .cast("long")
    )


def upper_median(values: Column) -> Column:
    """``sorted(values)[n // 2]`` of an array that is short by construction (top-k hits); null if empty."""
    present = F.array_sort(F.filter(values, lambda v: v.isNotNull()))
    return F.try_element_at(present, (F.floor(F.size(present) / 2) + 1).cast("int"))


def mean_of(*cols: Column) -> Column:
    """Row-wise mean that skips nulls; null when all are null."""
    total = sum((F.coalesce(c, F.lit(0.0)) for c in cols), F.lit(0.0))
    n = sum((F.when(c.isNotNull(), 1).otherwise(0) for c in cols), F.lit(0))
    return F.try_divide(total, n)


def equal_width_bin(x: Column, lo: Column, hi: Column, bins: int) -> Column:
    """0-based bin of ``x`` in ``bins`` equal bins of [lo, hi]; the last bin is closed on the right."""
    pos = F.floor(F.try_divide((x - lo) * bins, hi - lo)).cast("int")
    return F.coalesce(F.least(pos, F.lit(bins - 1)), F.lit(0))
