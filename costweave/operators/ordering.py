"""First-per-key, numbering, top-n, caps, batches and sampling, all under an explicit row order."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from costweave.functions.joins import null_safe_join
from costweave.session import cut_lineage


def first_row(df: DataFrame, keys: Sequence[str], order: str, cols: Sequence[str]) -> DataFrame:
    """First row per key in ``order``. An aggregate, so it combines before the shuffle even on hot keys."""
    picked = df.groupBy(*keys).agg(F.min_by(F.struct(*cols), F.col(order)).alias("_first"))
    return picked.select(*keys, "_first.*")


def first_value(col: str, order: str) -> Column:
    """Aggregate: first non-null value of ``col`` in ``order``."""
    return F.min_by(F.col(col), F.when(F.col(col).isNotNull(), F.col(order)))


def numbered(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[Column | str],
    name: str = "rn",
    block: Column | None = None,
) -> DataFrame:
    """1-based row number per key, by a distributed rank: rows are numbered inside each (key, block) and shifted
    by the sizes of the blocks of the key before, so that a hot key, or the whole table when ``keys`` is empty, is
    numbered by many tasks.

    ``block`` is a coarse value that never decreases along ``order`` (a file, a range of ids). Without it the
    blocks are ranges cut by sampled splitters: the rows are range-partitioned on (keys, order) and a row's block
    is its range, so texts, times and a value held by most rows are spread alike. ``order`` should end in a
    unique tie-breaker, as for any row number.
    """
    if block is None:
        # The ranges are sampled when the plan runs; written once, every later use sees the same range of a row.
        ranges = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        spread = df.repartitionByRange(ranges, *(F.col(k).asc_nulls_first() for k in keys), *order)
        marked = cut_lineage(spread.withColumn("_block", F.spark_partition_id()))
    else:
        marked = df.withColumn("_block", block)
    part = [*keys, "_block"]
    before = W.partitionBy(*keys).orderBy("_block").rowsBetween(W.unboundedPreceding, -1)
    offsets = (
        marked.groupBy(*part)
        .agg(F.count(F.lit(1)).alias("_size"))
        .withColumn("_before", F.coalesce(F.sum("_size").over(before), F.lit(0)))
        .drop("_size")
    )
    local = marked.withColumn("_local", F.row_number().over(W.partitionBy(*part).orderBy(*order)))
    joined = null_safe_join(local, offsets, part)
    return joined.select(*df.columns, (F.col("_before") + F.col("_local")).cast("long").alias(name))


def batches(df: DataFrame, size: int, order: Sequence[Column | str], block: Column | None = None,
            keys: Sequence[str] = ()) -> DataFrame:
    """Consecutive batch numbers (0-based) of ``size`` rows in ``order``."""
    numbered_rows = numbered(df, keys, order, "_rn", block)
    return numbered_rows.withColumn("batch", F.floor((F.col("_rn") - 1) / size).cast("long")).withColumn(
        "slot", (F.col("_rn") - 1) % size).drop("_rn")


def top_n(df: DataFrame, value: str, n: int, order: Sequence[Column | str]) -> DataFrame:
    """The n largest rows by ``value``; ``order`` breaks ties."""
    return df.filter(F.col(value).isNotNull()).orderBy(F.col(value).desc(), *order).limit(n)


def top_groups(df: DataFrame, key: str, n: int, counted: str | None = None) -> DataFrame:
    """The n most frequent non-null keys, by rows or by non-null values of ``counted``."""
    counter = F.count(F.lit(1)) if counted is None else F.count(counted)
    return (
        df.filter(F.col(key).isNotNull())
        .groupBy(key)
        .agg(counter.alias("n"))
        .orderBy(F.col("n").desc(), F.col(key))
        .limit(n)
    )


def top_with_ties(df: DataFrame, value: str, n: int) -> DataFrame:
    """Rows whose value is at least the n-th largest.

    The threshold comes from a bounded sort, so no window has to hold the whole table.
    """
    cut = df.select(value).filter(F.col(value).isNotNull()).orderBy(F.col(value).desc()).limit(n)
    threshold = cut.agg(F.min(value).alias("_cut"))
    return df.filter(F.col(value) >= threshold.scalar())


def cap_per_group(df: DataFrame, keys: Sequence[str], n: int, order: Sequence[Column | str]) -> DataFrame:
    """At most n rows per group: a report feature. Spark trims each group before the shuffle."""
    w = W.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rn", F.row_number().over(w)).filter(F.col("_rn") <= n).drop("_rn")


def seeded_sample(df: DataFrame, n: int, keys: Sequence[str], seed: int = 42) -> DataFrame:
    """At most n rows, chosen by a digest of the seed and ``keys``: the same rows on every run and layout."""
    draw = F.sha1(F.concat_ws("|", F.lit(str(seed)), *[F.col(k).cast("string") for k in keys]))
    return df.orderBy(draw, *keys).limit(n)


def page_after(df: DataFrame, key: str, last, n: int) -> DataFrame:
    """Keyset pagination: the next n rows after ``last``."""
    rows = df if last is None else df.filter(F.col(key) > F.lit(last))
    return rows.orderBy(key).limit(n)
