"""Exact order statistics per group that do not need a whole group in one task.

The distinct values of every group are counted first, which combines before the shuffle and spreads a hot group or a
hot value over all tasks, and the counts are written once. Ranks are then sums of counts. Where the largest group has
more distinct values than one task should sort, a histogram over each group's own range finds the bin that holds each
wanted rank, the same is done inside those bins, and only what is left is ranked: a hot group is spread over its bins.
A caller who has counted that every group is small has its values gathered by one shuffle and nothing written.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from costweave.functions.joins import null_safe_join
from costweave.functions.sizing import BROADCAST_BYTES, is_bounded
from costweave.session import cut_lineage

BINS = 4096
VALUES_PER_TASK = 500_000
#: So many groups, counted first, are few enough to be sent to all tasks; a group has a few wanted ranks.
FEW_GROUPS = 10_000


#: The rows that a task is given where groups are gathered.
ROWS_PER_TASK = 1_000_000


def gathered(df: DataFrame, keys: Sequence[str], n_rows: int) -> DataFrame:
    """Rows dealt by ``keys`` to as many tasks as ``n_rows`` ask for; what groups by these and more keys needs no other shuffle."""
    parts = -(-n_rows // ROWS_PER_TASK)
    usual = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return df.repartition(parts, *keys) if parts > usual else df.repartition(*keys)


def _spread(v: Column) -> Column:
    # Weakly monotone, so bins keep the order of values; it evens out long-tailed prices.
    return F.signum(v) * F.log1p(F.abs(v))


def exact_quantiles(
    df: DataFrame,
    keys: Sequence[str],
    value: str,
    probs: dict[str, float],
    upper_median: str | None = None,
    refine: bool | None = None,
    lower: dict[str, float] | None = None,
    rows_if_near: int | None = None,
) -> DataFrame:
    """One row per key: interpolated quantiles named by ``probs``, those named by ``lower`` as ``sorted[floor(p * (n - 1))]``
    and, if named, ``sorted[n // 2]``.

    Groups without any value are absent; callers left-join. ``refine`` forces a path (tests). The input is
    read once, by a job that writes the counts of values to the shared folder. ``rows_if_near`` is the number of rows,
    from a caller who has counted that no group has more than ``VALUES_PER_TASK`` of them: then nothing is written.
    """
    lower = lower or {}
    rows = df.select(*keys, F.col(value).cast("double").alias("_v")).filter(F.col("_v").isNotNull())
    if near := rows_if_near is not None and bool(keys) and not refine:
        rows = gathered(rows, keys, rows_if_near)
    counts = rows.groupBy(*keys, "_v").agg(F.count(F.lit(1)).alias("_c"))
    exact = [*lower, *([upper_median] if upper_median else [])]
    if near:
        n = F.sum("_c").over(W.partitionBy(*keys))
        summed = _running(counts.withColumns({"_start": F.lit(0).cast("long"), "_n": n}), keys)
        return _picked(summed.withColumn("_want", _wanted(F.col("_n"), probs, lower, upper_median)), keys, probs, exact)
    counts = cut_lineage(counts)
    # One row per group, written once; where their number is bounded, they and what is picked by them travel to the
    # values, so that the values of a large group are never gathered by a join.
    spans = cut_lineage(_spans(counts, keys))
    few = is_bounded(spans, FEW_GROUPS, BROADCAST_BYTES)
    if refine is None:
        refine = (spans.agg(F.max("_d")).first()[0] or 0) > VALUES_PER_TASK
    spans = spans.drop("_d")

    if not refine:
        # The values are sorted alone; what is wanted of a group meets them afterwards.
        summed = _running(counts.withColumn("_start", F.lit(0).cast("long")), keys)
        told = _with_span(summed, spans, keys, few).withColumns({"_n": F.col("_all"), "_want": _wanted(F.col("_all"), probs, lower, upper_median)})
        return _picked(told, keys, probs, exact)
    first = _with_span(counts, spans, keys, few).withColumns(
        {"_n": F.col("_all"), "_start": F.lit(0).cast("long"), "_want": _wanted(F.col("_all"), probs, lower, upper_median)})
    inside = cut_lineage(_narrow(first, keys, "_bin", _spread, few))
    part = [*keys, "_bin"]
    again = _with_span(inside, _spans(inside, part).drop("_d"), part, few)
    inside = _narrow(again, part, "_bin2", lambda v: v, few)
    return _picked(_running(inside, [*part, "_bin2"]), keys, probs, exact)


def _wanted(n: Column, probs: dict[str, float], lower: dict[str, float], upper_median: str | None) -> Column:
    """The ranks, in a group of ``n`` values, that the quantiles are made of."""
    out = []
    for name, p in probs.items():
        at = F.lit(float(p)) * (n - 1)
        out.append(F.struct(F.lit(name).alias("q"), F.lit(0).alias("side"), F.floor(at).alias("rank")))
        out.append(F.struct(F.lit(name).alias("q"), F.lit(1).alias("side"), F.ceil(at).alias("rank")))
    for name, p in lower.items():
        out.append(F.struct(F.lit(name).alias("q"), F.lit(0).alias("side"), F.floor(F.lit(float(p)) * (n - 1)).alias("rank")))
    if upper_median:
        out.append(F.struct(F.lit(upper_median).alias("q"), F.lit(0).alias("side"), F.floor(n / 2).alias("rank")))
    return F.array(*out)


def _running(inside: DataFrame, part: Sequence[str]) -> DataFrame:
    """The ranks that a value's rows take, from running sums of counts inside each part; ``_start`` is the rank of a part's first value."""
    run = W.partitionBy(*part).orderBy("_v").rowsBetween(W.unboundedPreceding, W.currentRow)
    return inside.withColumn("_to", F.col("_start") + F.sum("_c").over(run)).withColumn("_from", F.col("_to") - F.col("_c"))


def _picked(summed: DataFrame, keys: Sequence[str], probs: dict[str, float], exact: Sequence[str]) -> DataFrame:
    """The wanted ranks' values, those of ``exact`` as they are."""
    hits = (
        summed.withColumn("_w", F.explode("_want"))
        .filter((F.col("_w.rank") >= F.col("_from")) & (F.col("_w.rank") < F.col("_to")))
    )
    aggs = []
    for name, p in probs.items():
        below = F.max(F.when((F.col("_w.q") == name) & (F.col("_w.side") == 0), F.col("_v")))
        above = F.max(F.when((F.col("_w.q") == name) & (F.col("_w.side") == 1), F.col("_v")))
        at = F.lit(float(p)) * (F.max("_n") - 1)
        aggs.append((below + (at - F.floor(at)) * (above - below)).alias(name))
    aggs += [F.max(F.when(F.col("_w.q") == name, F.col("_v"))).alias(name) for name in exact]
    return hits.groupBy(*keys).agg(*aggs)


def _spans(rows: DataFrame, part: Sequence[str]) -> DataFrame:
    return rows.groupBy(*part).agg(
        F.min("_v").alias("_lo"), F.max("_v").alias("_hi"), F.sum("_c").alias("_all"), F.count(F.lit(1)).alias("_d"))


def _with_span(rows: DataFrame, spans: DataFrame, part: Sequence[str], few: bool) -> DataFrame:
    if part:
        return null_safe_join(rows, F.broadcast(spans) if few else spans, part)
    span = spans.select(F.struct("_lo", "_hi", "_all")).scalar()
    return rows.withColumn("_span", span).select(*rows.columns, "_span.*")


def _narrow(rows: DataFrame, part: Sequence[str], bin_name: str, scale, few: bool) -> DataFrame:
    """Keep the rows of those bins that hold a wanted rank; ``_start`` becomes the rank of the bin's first value."""
    lo, hi = scale(F.col("_lo")), scale(F.col("_hi"))
    pos = F.floor(F.try_divide((scale(F.col("_v")) - lo) * BINS, hi - lo)).cast("int")
    binned = rows.withColumn(bin_name, F.coalesce(F.least(pos, F.lit(BINS - 1)), F.lit(0))).drop("_lo", "_hi", "_all")
    upto = W.partitionBy(*part).orderBy(bin_name).rowsBetween(W.unboundedPreceding, W.currentRow)
    sizes = binned.groupBy(*part, bin_name).agg(
        F.sum("_c").alias("_size"), F.max("_start").alias("_start"), F.any_value("_want").alias("_want"))
    ends = sizes.withColumn("_end", F.col("_start") + F.sum("_size").over(upto))
    begin = F.col("_end") - F.col("_size")
    picked = (
        ends.select(*part, bin_name, begin.alias("_start"),
                    F.filter("_want", lambda w: (w["rank"] >= begin) & (w["rank"] < F.col("_end"))).alias("_want"))
        .filter(F.size("_want") > 0)
    )
    return null_safe_join(binned.drop("_start", "_want"), F.broadcast(picked) if few else picked, [*part, bin_name])
