"""Predicates and projections over work items; each is a Column or composes Columns."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from costweave.functions.joins import null_safe_join
from costweave.operators.ordering import numbered
from costweave.operators.quantiles import exact_quantiles

# Elements of a building model that are drawing aids, not things to build.
NON_PHYSICAL = ["levels?", "grids?", "reference planes?", "scope boxes", "annotations?", "dimensions?",
                "text notes?", "tags?", "views?", "sheets?", "schedules?", "legends?", "rpc"]


def contains_text(col: str, term: str) -> Column:
    """Case-insensitive substring match; null counts as no match. The term is literal text."""
    return F.coalesce(F.contains(F.lower(F.col(col)), F.lit(term.lower())), F.lit(False))


def in_range(col: str, low: float | None = None, high: float | None = None) -> Column:
    """Inclusive range with optional bounds."""
    parts = []
    if low is not None:
        parts.append(F.col(col) >= low)
    if high is not None:
        parts.append(F.col(col) <= high)
    return all_of(parts)


def all_of(parts: Sequence[Column]) -> Column:
    """Conjunction; no parts means no filter."""
    return reduce(lambda a, b: a & b, parts, F.lit(True))


def criteria(
    department: str | None = None,
    unit: str | None = None,
    min_cost: float | None = None,
    max_cost: float | None = None,
    is_material: bool | None = None,
    is_machine: bool | None = None,
    cost_col: str = "total_cost_per_position",
) -> Column:
    """The filter for those criteria that are given."""
    parts = []
    if department is not None:
        parts.append(F.col("department_name") == department)
    if unit is not None:
        parts.append(F.col("rate_unit") == unit)
    if min_cost is not None or max_cost is not None:
        parts.append(in_range(cost_col, min_cost, max_cost))
    if is_material is not None:
        parts.append(F.col("is_material") == is_material)
    if is_machine is not None:
        parts.append(F.col("is_machine") == is_machine)
    return all_of(parts)


def has_all_tokens(col: str, text: str) -> Column:
    """True when every word of ``text`` is a word of the column, ignoring case."""
    words = F.split(F.lower(F.col(col)), r"[^\p{L}\p{Nd}]+")
    wanted = [t for t in text.lower().split() if t]
    return F.coalesce(all_of([F.array_contains(words, t) for t in wanted]), F.lit(False))


def not_blank(col: str) -> Column:
    return F.coalesce(F.length(F.trim(F.col(col))) > 0, F.lit(False))


def display_name(final: str = "rate_final_name", original: str = "rate_original_name") -> Column:
    return F.coalesce(final, original)


def clip_to_quantile(df: DataFrame, col: str, prob: float = 0.95) -> DataFrame:
    """Positive rows up to the given quantile of the positive values."""
    rows = df.filter(F.col(col) > 0)
    upper = exact_quantiles(rows, [], col, {"_upper": prob})
    return rows.filter(F.col(col) <= upper.scalar())


def keep_keys(df: DataFrame, keys: DataFrame, on: Sequence[str]) -> DataFrame:
    """Rows whose key is in ``keys``."""
    return df.join(keys.select(*on), list(on), "left_semi")


def payload(cols: Sequence[str]) -> Column:
    """Map of the named columns as text, without nulls and empty strings."""
    pairs = []
    for c in cols:
        pairs += [F.lit(c), F.col(c).cast("string")]
    return F.map_filter(F.create_map(*pairs), lambda _k, v: v.isNotNull() & (v != ""))


def physical_elements(df: DataFrame, col: str, patterns: Sequence[str] = tuple(NON_PHYSICAL)) -> DataFrame:
    """Drop elements whose category has one of the patterns as a word; null categories stay."""
    pattern = r"(?i)\b(?:" + "|".join(patterns) + r")\b"
    return df.filter(~F.coalesce(F.rlike(F.col(col), F.lit(pattern)), F.lit(False)))


def pending_tracks(config: DataFrame, summary: DataFrame) -> DataFrame:
    """Tracks still to do: no audit summary yet, flagged strings left, or fewer points than rates."""
    done = summary.filter((F.col("flagged_count") == 0) & (F.col("n_points") == F.col("n_rates")))
    return config.join(done.select("region"), "region", "left_anti")


def answer_requests(items: DataFrame, requests: DataFrame, order: str, keys: Sequence[str],
                    cost: str = "total_cost_per_position", default_limit: int = 5) -> DataFrame:
    """Structured searches as a table: the ``limit`` cheapest items of each request's group and range.

    ``requests`` carry request_id, the key columns, min_cost, max_cost and limit (null bounds: open).
    Items are numbered by cost within their group. A request finds the number of its lower bound by
    being numbered among the items, and then meets just the ``limit`` items after it, so requests
    and items of a group are never paired with each other.
    """
    ranked = numbered(items, keys, [cost, order], "_rank")
    floor_cost = F.coalesce("min_cost", F.lit(-1e300))
    asks = requests.select("request_id", *keys, floor_cost.alias("_at"))
    marks = asks.withColumn("_kind", F.lit(0)).unionByName(
        items.select(F.lit(None).cast(asks.schema["request_id"].dataType).alias("request_id"), *keys,
                     F.col(cost).alias("_at"), F.lit(1).alias("_kind")))
    by = ["_at", "_kind", "request_id"]
    among_all = numbered(marks, keys, by, "_pos").filter("_kind = 0")
    among_asks = numbered(asks, keys, ["_at", "request_id"], "_before")
    start = among_all.select("request_id", "_pos").join(among_asks.select("request_id", "_before"), "request_id")
    limit = F.coalesce("limit", F.lit(default_limit)).cast("long")
    probes = requests.join(start, "request_id").select(
        "request_id", *keys, "max_cost", (F.col("_pos") - F.col("_before")).alias("_start"),
        F.explode(F.sequence(F.lit(1).cast("long"), limit)).alias("rank")).withColumn(
        "_rank", F.col("_start") + F.col("rank"))
    hits = null_safe_join(ranked, probes, [*keys, "_rank"])
    within = F.col("max_cost").isNull() | (F.col(cost) <= F.col("max_cost"))
    return hits.filter(within).select("request_id", "rank", *items.columns)


def context_lines(df: DataFrame, fields: Sequence[tuple[str, str]], score: str, rank: str) -> Column:
    """Numbered line of ``label: value`` parts joined by a spaced bar, nulls skipped, score last."""
    parts = [F.when(F.col(c).isNotNull(), F.concat(F.lit(f"{label}: "), F.col(c).cast("string")))
             for c, label in fields]
    return F.concat(F.col(rank).cast("string"), F.lit(". "),
                    F.concat_ws(" | ", *parts, F.concat(F.lit("Score: "), F.format_number(F.col(score), 3))))
