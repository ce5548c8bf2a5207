"""Join helpers."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def null_safe_join(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "inner") -> DataFrame:
    """Join on ``keys`` where null equals null; the key columns appear once (filled from either side).

    The right keys are renamed first, so ``right`` may be derived from ``left``.
    """
    if not keys:
        raise ValueError("null_safe_join needs at least one key")
    renamed = right
    for k in keys:
        renamed = renamed.withColumnRenamed(k, f"_r_{k}")
    cond = F.lit(True)
    for k in keys:
        cond = cond & F.col(k).eqNullSafe(F.col(f"_r_{k}"))
    joined = left.join(renamed, cond, how)
    if how in ("left_semi", "left_anti"):
        return joined
    if how in ("full_outer", "right"):
        for k in keys:
            joined = joined.withColumn(k, F.coalesce(k, f"_r_{k}"))
    return joined.drop(*[f"_r_{k}" for k in keys])
