"""From bills of quantities to priced estimates, their checks and roll-ups."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from costweave.functions.joins import null_safe_join
from costweave.functions.numeric import upper_median
from costweave.operators.filters import physical_elements
from costweave.operators.ordering import first_value, numbered
from costweave.operators.quantiles import exact_quantiles

ITEMS_SCHEMA = "array<struct<description: string, quantity: double, unit: string>>"
PROMOTE_AT = 27


# ---- input --------------------------------------------------------------------------------------------

def parse_work_items(df: DataFrame, id_col: str, raw: str) -> DataFrame:
    """Work items from answers that hold a JSON array, maybe in a code fence. Quantity defaults to 1, unit to pcs."""
    body = F.regexp_replace(F.regexp_replace(raw, r"(?s)^\s*```[A-Za-z]*\s*", ""), r"\s*```\s*$", "")
    items = F.posexplode(F.from_json(body, ITEMS_SCHEMA))
    return df.select(id_col, items.alias("pos", "it")).select(
        id_col, (F.col("pos") + 1).alias("item"), "it.description",
        F.coalesce("it.quantity", F.lit(1.0)).alias("quantity"), F.coalesce("it.unit", F.lit("pcs")).alias("unit"))


def apply_edits(lines: DataFrame, edits: DataFrame) -> DataFrame:
    """Lines after the latest edit of each: set or add gives the quantity, remove drops the line.

    ``lines(line_id, quantity)``, ``edits(line_id, op, quantity, ord)``.
    """
    last = edits.groupBy("line_id").agg(F.max_by(F.struct("op", F.col("quantity").alias("new")), "ord").alias("_e")).select(
        "line_id", "_e.op", "_e.new")
    joined = null_safe_join(lines, last, ["line_id"], "full_outer")
    kept = joined.filter(~F.col("op").eqNullSafe("remove"))
    changed = F.col("op").isNotNull()
    known = kept.filter(F.col("quantity").isNotNull() | (F.col("op") == "add"))
    return known.select("line_id", F.when(changed, F.col("new")).otherwise(F.col("quantity")).alias("quantity"),
                        changed.alias("edited"))


# ---- pricing ---------------------------------------------------------------------------------------------

def _sum(c: Column) -> Column:
    return F.coalesce(F.sum(c), F.lit(0.0))


def price_lines(lines: DataFrame, best: DataFrame, order: Sequence[Column | str] = ("line_id",),
                block: Column | None = None) -> DataFrame:
    """Numbered priced lines. Without a match: rate 0 and the line's own text and unit.

    ``lines(line_id, description, quantity, unit)``, ``best(line_id, rate_code, rate_name, rate_unit, unit_rate)``.
    """
    joined = lines.join(best, "line_id", "left")
    rows = joined.select(
        "line_id",
        F.coalesce("rate_code", F.lit("")).alias("rate_code"),
        F.coalesce("rate_name", "description").alias("description"),
        F.coalesce("rate_unit", "unit").alias("unit"),
        "quantity",
        F.coalesce("unit_rate", F.lit(0.0)).alias("rate"),
        (F.coalesce("unit_rate", F.lit(0.0)) * F.col("quantity")).alias("amount"))
    return numbered(rows, [], order, "item_no", block)


def with_total_row(priced: DataFrame) -> DataFrame:
    """Lines with rate and amount at two places, and a TOTAL row: the rounded sum of unrounded amounts."""
    lines = priced.select(F.col("item_no"), "rate_code", "description", "unit", "quantity",
                          F.bround("rate", 2).alias("rate"), F.bround("amount", 2).alias("amount"))
    total = priced.agg(_sum(F.col("amount")).alias("amount")).select(
        F.lit(None).cast("long").alias("item_no"), F.lit("").alias("rate_code"), F.lit("TOTAL").alias("description"),
        F.lit("").alias("unit"), F.lit(None).cast("double").alias("quantity"), F.lit(None).cast("double").alias("rate"),
        F.bround("amount", 2).alias("amount"))
    return lines.unionByName(total)


def cost_totals(priced: DataFrame, quantity: str, parts: dict[str, str], keys: Sequence[str] = ()) -> DataFrame:
    """Lines, and the sum of quantity times each unit cost; nulls count as 0. ``parts``: result name -> unit cost column."""
    q = F.coalesce(quantity, F.lit(0.0))
    return priced.groupBy(*keys).agg(F.count(F.lit(1)).alias("lines"), *[_sum(q * F.coalesce(c, F.lit(0.0))).alias(n) for n, c in parts.items()])


def scenario_estimates(scenarios: DataFrame, hits: DataFrame, cost: str = "unit_cost") -> DataFrame:
    """Upper median of the hits' costs times the quantity, and the number of hits; 0 without costs.

    ``hits`` hold the top k of each scenario, so a scenario's costs are a short array.
    """
    per = hits.groupBy("scenario_id").agg(F.count(F.lit(1)).alias("matches"), F.collect_list(cost).alias("_costs"))
    joined = scenarios.join(per, "scenario_id", "left")
    return joined.select(
        "scenario_id", "quantity",
        (F.coalesce(upper_median(F.col("_costs")), F.lit(0.0)) * F.col("quantity")).alias("estimate"),
        F.coalesce("matches", F.lit(0)).cast("long").alias("matches"))


# ---- units ------------------------------------------------------------------------------------------------

# Our own table of common units: spelling, base unit, how many base units one is.
UNITS = [
    ("m", "m", 1.0), ("100 m", "m", 100.0), ("100m", "m", 100.0), ("km", "m", 1000.0),
    ("m2", "m2", 1.0), ("m²", "m2", 1.0), ("100 m2", "m2", 100.0), ("m3", "m3", 1.0), ("m³", "m3", 1.0),
    ("100 m3", "m3", 100.0), ("kg", "kg", 1.0), ("t", "kg", 1000.0), ("pcs", "pcs", 1.0), ("100 pcs", "pcs", 100.0),
    ("1000 pcs", "pcs", 1000.0), ("1000pcs", "pcs", 1000.0), ("set", "set", 1.0), ("h", "h", 1.0),
]


def convert_quantity(df: DataFrame, quantity: str, unit: str, rate_unit: str, units: Sequence[tuple[str, str, float]] = tuple(UNITS)) -> DataFrame:
    """``converted``: quantity in the rate's unit; null with ``unit_mismatch`` when the units measure different things."""
    base = F.create_map(*[F.lit(x) for u, b, _ in units for x in (u, b)])
    factor = F.create_map(*[F.lit(x) for u, _, f in units for x in (u, f)])

    def look(table: Column, c: str) -> Column:
        return F.try_element_at(table, F.col(c))

    same = F.col(unit).eqNullSafe(F.col(rate_unit)) | F.coalesce(look(base, unit) == look(base, rate_unit), F.lit(False))
    ratio = F.when(F.col(unit).eqNullSafe(F.col(rate_unit)), F.lit(1.0)).otherwise(
        F.try_divide(look(factor, unit), look(factor, rate_unit)))
    return df.withColumns({"converted": F.when(same, F.col(quantity) * ratio), "unit_mismatch": ~same})


# ---- checks -------------------------------------------------------------------------------------------------

def check_ranges(estimates: DataFrame, ranges: DataFrame) -> DataFrame:
    """benchmark_pass: estimate within [min, max]; null without a range. Keys: track, scenario_id."""
    joined = estimates.join(ranges.select("track", "scenario_id", F.col("min").alias("_lo"), F.col("max").alias("_hi")),
                            ["track", "scenario_id"], "left")
    return joined.withColumn("benchmark_pass", F.col("estimate").between(F.col("_lo"), F.col("_hi"))).withColumnsRenamed(
        {"_lo": "benchmark_min", "_hi": "benchmark_max"})


def check_neighbours(estimates: DataFrame, neighbours: DataFrame) -> DataFrame:
    """neighbour_pass: estimate within half to one and a half of the upper median of its neighbour tracks.

    ``neighbours(track, neighbour)`` lists a few tracks each; null without data or with a median of 0 or less.
    """
    theirs = estimates.select(F.col("track").alias("neighbour"), "scenario_id", F.col("estimate").alias("_e"))
    medians = (
        neighbours.join(theirs, "neighbour", "inner")
        .groupBy("track", "scenario_id")
        .agg(upper_median(F.collect_list("_e")).alias("neighbour_median"))
    )
    joined = estimates.join(medians, ["track", "scenario_id"], "left")
    ratio = F.when(F.col("neighbour_median") > 0, F.col("estimate") / F.col("neighbour_median"))
    return joined.withColumn("neighbour_ratio", ratio).withColumn(
        "neighbour_pass", F.col("neighbour_ratio").between(0.5, 1.5))


def verdict(signals: Sequence[str], matches: str = "matches") -> Column:
    """True when at least one signal is present, all present signals are true, and something matched."""
    present = F.filter(F.array(*signals), lambda s: s.isNotNull())
    return (F.size(present) > 0) & F.forall(present, lambda s: s) & (F.col(matches) >= 1)


def pass_score(results: DataFrame, passed: str, keys: Sequence[str] = ("track",), promote_at: int = PROMOTE_AT) -> DataFrame:
    return results.groupBy(*keys).agg(
        F.count_if(passed).alias("passed"), F.count(F.lit(1)).alias("total")).withColumn(
        "promote", F.col("passed") >= promote_at)


def functional_suite(estimates: DataFrame, ranges: DataFrame, neighbours: DataFrame, judged: DataFrame | None = None) -> DataFrame:
    """All signals and the verdict per (track, scenario). ``judged`` may add an outside opinion, judge_pass."""
    out = check_neighbours(check_ranges(estimates, ranges), neighbours)
    signals = ["benchmark_pass", "neighbour_pass"]
    if judged is not None:
        out = out.join(judged.select("track", "scenario_id", "judge_pass"), ["track", "scenario_id"], "left")
        signals.append("judge_pass")
    return out.withColumn("overall_pass", verdict(signals))


def deviations(df: DataFrame, group: Sequence[str], price: str, limit: float = 0.30) -> DataFrame:
    """Rows with their group's median, and whether the price is further from it than ``limit``."""
    medians = exact_quantiles(df, group, price, {"group_median": 0.5})
    joined = null_safe_join(df, medians, group, "left")
    off = F.abs(F.try_divide(F.col(price), F.col("group_median")) - 1)
    return joined.withColumn("needs_rationale", F.coalesce(off > limit, F.lit(False)))


def outliers(df: DataFrame, group: Sequence[str], value: str) -> DataFrame:
    """Rows outside the 1.5-IQR fences of their group."""
    q = exact_quantiles(df, group, value, {"_q1": 0.25, "_q3": 0.75})
    joined = null_safe_join(df, q, group)
    reach = (F.col("_q3") - F.col("_q1")) * 1.5
    bad = (F.col(value) < F.col("_q1") - reach) | (F.col(value) > F.col("_q3") + reach)
    return joined.filter(bad).drop("_q1", "_q3")


def without_works(elements: DataFrame, works: DataFrame, key: str) -> DataFrame:
    """Element types that no work item covers."""
    return elements.select(key).distinct().join(works.select(key), key, "left_anti")


def duplicate_works(works: DataFrame, keys: Sequence[str]) -> DataFrame:
    return works.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > 1)


# ---- roll-ups -------------------------------------------------------------------------------------------------

def phase_rollup(df: DataFrame, phase: str, item: str, amount: str) -> DataFrame:
    """Item, phase and grand totals in one aggregation; ``level`` is 0, 1 or 2."""
    level = (F.grouping(phase) + F.grouping(item)).cast("int")
    return df.rollup(phase, item).agg(level.alias("level"), F.sum(amount).alias("amount"), F.count(F.lit(1)).alias("n"))


AGGREGATES = {
    "sum": lambda c, order: F.sum(c),
    "mean": lambda c, order: F.avg(c),
    "first": lambda c, order: first_value(c, order),
    "last": lambda c, order: F.max_by(F.col(c), F.when(F.col(c).isNotNull(), F.col(order))),
}


def aggregate_by_rules(df: DataFrame, keys: Sequence[str], rules: dict[str, str], order: str = "ord") -> DataFrame:
    """Group with a rule per field: sum, mean, first or last (non-null, in ``order``)."""
    unknown = sorted(set(rules.values()) - set(AGGREGATES))
    if unknown:
        raise ValueError(f"unknown aggregation rules: {unknown}")
    return df.groupBy(*keys).agg(*[AGGREGATES[r](c, order).alias(c) for c, r in rules.items()])


def take_off(elements: DataFrame, rules: dict[str, str], phases: DataFrame, works: DataFrame, prices: DataFrame,
             category: str = "category", type_name: str = "type_name", order: str = "ord") -> DataFrame:
    """Model take-off: drop drawing aids, group by type, map to phases, break down to works, price.

    ``phases(type_name, phase)``, ``works(type_name, work, quantity_col share, unit)``,
    ``prices(work, unit_rate, rate_unit)``. One row per type and work; types without works keep a row.
    """
    grouped = aggregate_by_rules(physical_elements(elements, category), [type_name], rules, order)
    joined = grouped.join(phases, type_name, "left").join(works, type_name, "left").join(prices, "work", "left")
    sized = joined.withColumn("work_quantity", F.col("quantity") * F.col("share"))
    converted = convert_quantity(sized, "work_quantity", "unit", "rate_unit")
    return converted.withColumn("amount", F.coalesce(F.col("converted") * F.col("unit_rate"), F.lit(0.0)))
