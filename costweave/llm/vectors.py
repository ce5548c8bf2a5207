"""What the two vector searches share: clean rows, matrices from Arrow columns, blocks of queries."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def clean(vectors: DataFrame, key: str, vector: str, zero: bool) -> DataFrame:
    """(id, v) of the rows with a key and only finite components; ``zero`` admits vectors of zeros and empty ones.

    A key that repeats stands once, with its smallest vector.
    """
    x = F.col(vector)
    good = F.col(key).isNotNull() & x.isNotNull() & F.forall(x, lambda e: F.coalesce(F.abs(e) < float("inf"), F.lit(False)))
    if not zero:
        good &= F.exists(x, lambda e: e != 0)
    return vectors.where(good).groupBy(F.col(key).alias("id")).agg(F.min(x).alias("v"))


def matrix(column: pa.Array, dim: int) -> np.ndarray:
    """Rows of ``dim`` doubles; shorter vectors are filled up with zeros."""
    flat = column.flatten().to_numpy(zero_copy_only=False)
    sizes = np.diff(column.offsets.to_numpy())
    if (sizes == dim).all():
        return flat.reshape(-1, dim).astype(np.float64)
    out = np.zeros((len(column), dim))
    out[np.repeat(np.arange(len(sizes)), sizes), np.arange(len(flat)) - np.repeat(np.cumsum(sizes) - sizes, sizes)] = flat
    return out


def stacked(column: pa.Array | pa.ChunkedArray, kind: str, dim: int) -> np.ndarray:
    """A column of vectors' bytes as a matrix."""
    return np.frombuffer(b"".join(column.to_pylist()), kind).reshape(-1, dim)


def nth(values: list[int], index: str) -> Column:
    """The number in ``values`` that the column counts from 0; for lists of bounded length."""
    return F.element_at(F.array(*map(F.lit, values)), F.col(index) + 1)


def best_of_each(found: DataFrame, k: int) -> DataFrame:
    """Ranks from 1 of each query's best ``k``, ties to the smaller id."""
    place = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return found.withColumn("rank", place).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
