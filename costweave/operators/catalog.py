"""Resource catalog and other per-key collapses of a work-item table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from costweave.functions.joins import null_safe_join
from costweave.operators.ordering import first_value
from costweave.operators.quantiles import VALUES_PER_TASK, exact_quantiles, gathered
from costweave.session import cut_lineage

_CATALOG_COLS = [
    "resource_code", "rate_code", "resource_name", "collection_name", "resource_unit", "collection_code",
    "department_name", "section_name", "is_labor", "is_material", "is_machine", "resource_price_per_unit_current",
    "resource_cost", "resource_quantity",
]


def type_label() -> Column:
    """Aggregate: Labour, Material, Equipment or Other, by the first flag that any row of the group sets."""
    return (
        F.when(F.bool_or(F.coalesce("is_labor", F.lit(False))), "Labour")
        .when(F.bool_or(F.coalesce("is_material", F.lit(False))), "Material")
        .when(F.bool_or(F.coalesce("is_machine", F.lit(False))), "Equipment")
        .otherwise("Other")
    )


def resource_catalog(df: DataFrame, currency: str, order: str = "ord") -> DataFrame:
    """One row per resource_code: names, type, price and use statistics, parent taxonomy.

    "First" values follow ``order``. ``price_variants`` counts prices, not distinct prices. The
    columns that are used are written once, so that joins below ``df`` run once (a job), and the largest
    resource is counted (another). The aggregates combine before the shuffle. Prices and rates meet by
    resource where the largest has few enough rows for one task; otherwise distinct rates are spread by
    (resource, rate), and the median's values by ``exact_quantiles``: a resource used by a third of all
    rows never ends up in one task.
    """
    used = [c for c in _CATALOG_COLS if c in df.columns]
    rows = cut_lineage(df.filter(F.col("resource_code").isNotNull()).select(*dict.fromkeys([*used, order])))
    per_resource = rows.groupBy("resource_code").agg(F.count(F.lit(1)).alias("n"))
    n_rows, largest = (x or 0 for x in per_resource.agg(F.sum("n"), F.max("n")).first())
    near = largest <= VALUES_PER_TASK

    def text(col: str, name: str) -> Column:
        value = first_value(col, order) if col in df.columns else F.lit(None).cast("string")
        return F.coalesce(value, F.lit("")).alias(name)

    grouped = rows.groupBy("resource_code").agg(
        text("resource_name", "name"),
        type_label().alias("type"),
        text("collection_name", "category"),
        text("resource_unit", "unit"),
        F.avg("resource_price_per_unit_current").alias("price_avg"),
        F.min("resource_price_per_unit_current").alias("price_min"),
        F.max("resource_price_per_unit_current").alias("price_max"),
        F.count("resource_price_per_unit_current").alias("price_variants"),
        F.avg("resource_cost").alias("avg_cost_per_use"),
        F.avg("resource_quantity").alias("avg_qty_per_use"),
        F.count(F.lit(1)).alias("usage_count"),
        text("collection_code", "parent_collection"),
        text("department_name", "parent_department"),
        text("section_name", "parent_section"),
    )
    # Kept apart: a distinct count in the same aggregation would carry every other buffer per (resource, rate).
    rates = rows.select("resource_code", "rate_code")
    rates = gathered(rates, ["resource_code"], n_rows) if near else rates
    uses = rates.distinct().groupBy("resource_code").agg(F.count("rate_code").alias("used_in_work_items"))
    medians = exact_quantiles(rows, ["resource_code"], "resource_price_per_unit_current", {"price_median": 0.5},
                              rows_if_near=n_rows if near else None)
    return (
        null_safe_join(grouped, uses, ["resource_code"])
        .transform(lambda d: null_safe_join(d, medians, ["resource_code"], "left"))
        .withColumn("currency", F.lit(currency))
        .withColumn("parent_category", F.col("category"))
        .select(
            "resource_code", "name", "type", "category", "unit", "price_avg", "price_min", "price_max",
            "price_median", "price_variants", "currency", "avg_cost_per_use", "avg_qty_per_use", "usage_count",
            "used_in_work_items", "parent_category", "parent_collection", "parent_department", "parent_section")
        .orderBy("resource_code")
    )


def max_cost_per_rate(df: DataFrame, cost: str, name: str, order: str = "ord") -> DataFrame:
    """Highest cost and first non-null name per rate, over rows that have a cost."""
    return df.filter(F.col(cost).isNotNull()).groupBy("rate_code").agg(
        F.max(cost).alias(cost), first_value(name, order).alias(name))


def distinct_in_order(df: DataFrame, key: str, value: str, order: str = "ord") -> DataFrame:
    """Distinct non-null values per key as an array, in first-seen order.

    Values are made distinct first, so a hot key only carries its distinct values.
    """
    distinct = df.filter(F.col(value).isNotNull()).groupBy(key, value).agg(F.min(order).alias("_first"))
    pairs = F.array_sort(F.collect_list(F.struct("_first", value)))
    return distinct.groupBy(key).agg(F.transform(pairs, lambda p: p[value]).alias(value))


def resource_cost_by_rate(df: DataFrame, order: str = "ord", total: str = "total_cost_per_position") -> DataFrame:
    """Quantity times price per rate, split by resource type, beside the stored total."""
    amount = F.col("resource_quantity") * F.col("resource_price_per_unit_current")
    labour = F.coalesce("is_labor", F.lit(False))
    material = ~labour & F.coalesce("is_material", F.lit(False))

    def part(cond: Column, name: str) -> Column:
        return F.coalesce(F.sum(F.when(cond, amount)), F.lit(0.0)).alias(name)

    return df.groupBy("rate_code").agg(
        part(labour, "labour_cost"),
        part(material, "material_cost"),
        part(~labour & ~material, "equipment_cost"),
        F.coalesce(F.sum(amount), F.lit(0.0)).alias("resource_sum"),
        first_value(total, order).alias("stored_total"),
    )


def cost_of_codes(df: DataFrame, codes: DataFrame, price: str, order: str = "ord") -> DataFrame:
    """Price times quantity for a list of (rate_code, quantity), price from the first row of each rate."""
    first = df.groupBy("rate_code").agg(F.min_by(F.struct(price), order).alias("_p")).select(
        "rate_code", F.col(f"_p.{price}").alias("unit_price"))
    return codes.join(first, "rate_code", "inner").withColumn("amount", F.col("unit_price") * F.col("quantity"))


def resource_demand(lines: DataFrame, items: DataFrame, norms: Sequence[str] = ("resource_quantity",)) -> DataFrame:
    """Resources needed for lines(rate_code, quantity): quantity times norm, summed per resource."""
    quantities = lines.groupBy("rate_code").agg(F.sum("quantity").alias("_qty"))
    joined = items.join(quantities, "rate_code", "inner")
    sums = [F.sum(F.col(n) * F.col("_qty")).alias(n) for n in norms]
    return joined.groupBy("resource_code").agg(*sums)
