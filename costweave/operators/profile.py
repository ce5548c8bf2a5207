"""Profiling: overview, numeric summaries, null reports, value counts, box plots, histograms."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from costweave.functions.joins import null_safe_join
from costweave.functions.numeric import equal_width_bin
from costweave.operators.ordering import top_groups
from costweave.operators.quantiles import exact_quantiles


def overview(df: DataFrame, distinct_cols: Sequence[str], approx: bool = False) -> DataFrame:
    """Rows, columns and distinct counts of a few columns.

    Exact distinct counts are made column by column over an unpivoted frame: one shuffle, and no
    set of values is ever held in one place.
    """
    if approx:
        return df.agg(F.count(F.lit(1)).alias("rows"), F.lit(len(df.columns)).cast("long").alias("columns"),
                      *[F.approx_count_distinct(c).alias(f"distinct_{c}") for c in distinct_cols])
    long = df.select(F.explode(F.array(
        F.struct(F.lit("").alias("c"), F.lit("").alias("v")),
        *[F.struct(F.lit(c).alias("c"), F.col(c).cast("string").alias("v")) for c in distinct_cols])).alias("_p"))
    values = long.filter(F.col("_p.v").isNotNull()).groupBy("_p.c", "_p.v").agg(F.count(F.lit(1)).alias("n"))
    return values.agg(
        F.coalesce(F.sum(F.when(F.col("c") == "", F.col("n"))), F.lit(0)).alias("rows"),
        F.lit(len(df.columns)).cast("long").alias("columns"),
        *[F.count_if(F.col("c") == c).alias(f"distinct_{c}") for c in distinct_cols])


def unpivot_numbers(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """(col, v) rows of the named columns as doubles; text that is no number is null."""
    pairs = [F.struct(F.lit(c).alias("col"), F.col(c).try_cast("double").alias("v")) for c in cols]
    return df.select(F.inline(F.array(*pairs)))


def numeric_summary(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """count, mean, median, min, max and sample standard deviation of each column."""
    long = unpivot_numbers(df, cols)
    stats = long.groupBy("col").agg(
        F.count("v").alias("count"), F.avg("v").alias("mean"), F.min("v").alias("min"), F.max("v").alias("max"),
        F.stddev_samp("v").alias("std"))
    medians = exact_quantiles(long, ["col"], "v", {"median": 0.5})
    return null_safe_join(stats, medians, ["col"], "left").select("col", "count", "mean", "median", "min", "max", "std")


def column_profile(df: DataFrame, samples: int = 3) -> DataFrame:
    """One row per column, whatever its type: type, nulls, then range and mean (numbers), true/false counts
    (booleans) or distinct count and the first values in sort order (text, and the text form of all else)."""
    flat = df.schema.fields
    aggs = [F.count(F.lit(1)).alias("_n")]
    for i, f in enumerate(flat):
        c = F.col(f.name)
        aggs.append(F.count(c).alias(f"_c{i}"))
        if isinstance(f.dataType, T.NumericType):
            aggs += [F.min(c).cast("double").alias(f"_lo{i}"), F.max(c).cast("double").alias(f"_hi{i}"),
                     F.avg(c).alias(f"_avg{i}")]
        elif isinstance(f.dataType, T.BooleanType):
            aggs += [F.count_if(c).alias(f"_t{i}"), F.count_if(~c).alias(f"_f{i}")]
    one = df.agg(*aggs)
    null_d, null_l = F.lit(None).cast("double"), F.lit(None).cast("long")
    rows = []
    for i, f in enumerate(flat):
        num, boo = isinstance(f.dataType, T.NumericType), isinstance(f.dataType, T.BooleanType)
        rows.append(F.struct(
            F.lit(f.name).alias("col"), F.lit(f.dataType.simpleString()).alias("dtype"),
            (F.col("_n") - F.col(f"_c{i}")).alias("nulls"),
            F.try_divide((F.col("_n") - F.col(f"_c{i}")) * 100.0, F.col("_n")).alias("null_pct"),
            (F.col(f"_lo{i}") if num else null_d).alias("min"), (F.col(f"_hi{i}") if num else null_d).alias("max"),
            (F.col(f"_avg{i}") if num else null_d).alias("mean"),
            (F.col(f"_t{i}") if boo else null_l).alias("n_true"), (F.col(f"_f{i}") if boo else null_l).alias("n_false")))
    base = one.select(F.inline(F.array(*rows)))
    texts = {f.name: _as_text(f) for f in flat if not isinstance(f.dataType, (T.NumericType, T.BooleanType))}
    if not texts:
        return base.withColumns({"distinct": null_l, "samples": F.lit(None).cast("string")})
    values = (
        df.select(F.inline(F.array(*[F.struct(F.lit(c).alias("col"), v.alias("v")) for c, v in texts.items()])))
        .filter(F.col("v").isNotNull())
        .distinct()
    )
    counted = values.groupBy("col").agg(F.count(F.lit(1)).alias("distinct"))
    from costweave.operators.ordering import cap_per_group

    shown = cap_per_group(values, ["col"], samples, ["v"]).groupBy("col").agg(
        F.array_join(F.array_sort(F.collect_list("v")), ", ").alias("samples"))
    joined = null_safe_join(base, counted, ["col"], "left")
    return null_safe_join(joined, shown, ["col"], "left")


def _as_text(field: T.StructField) -> Column:
    """Dates, times and bytes as text; nested values as JSON, or as they print where JSON has no form for them."""
    if isinstance(field.dataType, (T.ArrayType, T.MapType, T.StructType)):
        return F.to_json(F.col(field.name))
    return F.col(field.name).cast("string")


def null_counts(profile: DataFrame) -> DataFrame:
    """How many columns of a profile have nulls, and how many have none."""
    return profile.agg(F.count_if(F.col("nulls") > 0).alias("with_nulls"), F.count_if(F.col("nulls") == 0).alias("without_nulls"))


def null_summary(profile: DataFrame, threshold: float = 50.0) -> DataFrame:
    """Columns of a profile that have nulls, worst first, with a mark for those above the threshold."""
    return (
        profile.filter(F.col("nulls") > 0)
        .select("col", "nulls", "null_pct", (F.col("null_pct") > threshold).alias("mostly_null"))
        .orderBy(F.col("null_pct").desc(), "col")
    )


def value_counts(df: DataFrame, col: str) -> DataFrame:
    """Rows per non-null value, most frequent first."""
    return df.filter(F.col(col).isNotNull()).groupBy(col).agg(F.count(F.lit(1)).alias("n")).orderBy(
        F.col("n").desc(), col)


def breakdown(df: DataFrame, col: str, cost: str) -> DataFrame:
    """Rows and mean cost per value, null group included, most frequent first."""
    return df.groupBy(col).agg(
        F.count(F.lit(1)).alias("n"), F.avg(F.col(cost).try_cast("double")).alias("avg_cost")).orderBy(
        F.col("n").desc(), col)


def box_stats(df: DataFrame, group: str, value: str, top: int = 15) -> DataFrame:
    """Quartiles and 1.5-IQR whiskers (outermost rows inside the fences) of the most frequent groups."""
    groups = top_groups(df.filter(F.col(value).isNotNull()), group, top, value)
    rows = df.filter(F.col(value).isNotNull()).join(groups.select(group), group, "left_semi")
    quartiles = exact_quantiles(rows, [group], value, {"q1": 0.25, "median": 0.5, "q3": 0.75})
    low = F.col("q1") - (F.col("q3") - F.col("q1")) * 1.5
    high = F.col("q3") + (F.col("q3") - F.col("q1")) * 1.5
    fenced = null_safe_join(rows.select(group, F.col(value).alias("_v")), quartiles, [group])
    inside = (F.col("_v") >= low) & (F.col("_v") <= high)
    whiskers = fenced.groupBy(group).agg(
        F.min(F.when(inside, F.col("_v"))).alias("whisker_low"),
        F.max(F.when(inside, F.col("_v"))).alias("whisker_high"), F.count(F.lit(1)).alias("n"))
    return null_safe_join(quartiles, whiskers, [group]).orderBy(F.col("median").desc(), group)


def utilisation(df: DataFrame, n: int = 20) -> DataFrame:
    """Most used resources: uses, mean quantity, mean price."""
    return (
        df.filter(F.col("resource_name").isNotNull())
        .groupBy("resource_name")
        .agg(F.count(F.lit(1)).alias("usage_count"), F.avg("resource_quantity").alias("avg_quantity"),
             F.avg("resource_price_per_unit_current").alias("avg_price"))
        .orderBy(F.col("usage_count").desc(), "resource_name")
        .limit(n)
    )


def histogram(df: DataFrame, value: str, bins: int = 50) -> DataFrame:
    """Counts in equal-width bins over the value's range; the last bin is closed on the right.

    A single value is put in the middle of a range of width 1.
    """
    rows = df.select(F.col(value).cast("double").alias("_x")).filter(F.col("_x").isNotNull())
    pad = F.when(F.min("_x") == F.max("_x"), 0.5).otherwise(0.0)
    span = rows.agg(F.struct((F.min("_x") - pad).alias("lo"), (F.max("_x") + pad).alias("hi")).alias("s")).scalar()
    placed = rows.withColumn("_s", span).withColumn(
        "bin", equal_width_bin(F.col("_x"), F.col("_s.lo"), F.col("_s.hi"), bins))
    return placed.groupBy("bin").agg(F.count(F.lit(1)).alias("n"), F.min("_s.lo").alias("_lo"), F.max("_s.hi").alias("_hi")).select(
        "bin",
        (F.col("_lo") + (F.col("_hi") - F.col("_lo")) * F.col("bin") / bins).alias("left_edge"),
        (F.col("_lo") + (F.col("_hi") - F.col("_lo")) * (F.col("bin") + 1) / bins).alias("right_edge"), "n")


def log_histogram(df: DataFrame, value: str, bins: int = 30) -> DataFrame:
    """Density histogram of log10 of the positive values."""
    logs = df.filter(F.col(value) > 0).select(F.log10(value).alias("log10"))
    counted = histogram(logs, "log10", bins)
    total = counted.agg(F.sum("n")).scalar()
    width = F.col("right_edge") - F.col("left_edge")
    return counted.withColumn("density", F.try_divide(F.col("n"), total * width))


def section_means(df: DataFrame, section: str, cost: str, min_rows: int = 2) -> DataFrame:
    """Mean cost of sections with enough rows."""
    return df.groupBy(section).agg(F.count(F.lit(1)).alias("n"), F.avg(cost).alias("avg_cost")).filter(
        F.col("n") >= min_rows)


def language_stats(df: DataFrame, lang: str) -> DataFrame:
    """Items per language and, with a null language, the total."""
    return df.rollup(lang).agg(F.count(F.lit(1)).alias("items"), F.grouping(lang).cast("int").alias("is_total"))


def share(flag: Column) -> Column:
    """Aggregate: fraction of rows where ``flag`` is true; null without rows."""
    return F.try_divide(F.count_if(flag), F.count(F.lit(1)))
