"""Rule-based classification. Rules are small ordered tables the caller supplies; each becomes one
branch of a CASE expression, so classifying is a projection."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from costweave.operators.catalog import distinct_in_order
from costweave.operators.ordering import first_row
from costweave.operators.translation import propagate
from costweave.functions.joins import null_safe_join

MAX_RULES = 500

# Unit patterns, tried in this order on the lower-cased unit.
UNIT_TYPES = [
    (r"м\s*[3³]|м3|m3|m³|куб", "Volume"),
    (r"м\s*[2²]|м2|m2|m²|кв", "Area"),
    (r"\bт\b|тонн|кг", "Mass"),
    (r"\bшт\b|компл|штук", "Count"),
    (r"\bм\b|метр|пог", "Linear"),
    (r"100\s*м[2²]|100м2", "Area"),
    (r"100\s*м[3³]|100м3", "Volume"),
    (r"100\s*м\b", "Linear"),
]


@dataclass(frozen=True)
class Rules:
    """The rule tables of one classifier: (pattern, value), in priority order."""

    classes: Sequence[tuple[str, str, str, str]]  # pattern, category, class, aliases
    materials: Sequence[tuple[str, str]] = ()
    disciplines: Sequence[tuple[str, str]] = ()
    work_types: Sequence[tuple[str, str]] = ()
    targets: Sequence[tuple[str, str]] = ()

    def __post_init__(self) -> None:
        for name in ("classes", "materials", "disciplines", "work_types", "targets"):
            if len(getattr(self, name)) > MAX_RULES:
                raise ValueError(f"{name}: more than {MAX_RULES} rules do not belong in one expression")


def rules_from_table(df: DataFrame, cols: Sequence[str], order: str = "ord") -> list[tuple]:
    """Rules kept in a table, in order. A table with more rules than one expression holds is an error."""
    rows = df.orderBy(order).select(*cols).limit(MAX_RULES + 1).collect()
    if len(rows) > MAX_RULES:
        raise ValueError(f"more than {MAX_RULES} rules")
    return [tuple(r) for r in rows]


def _hit(text: Column, pattern: str) -> Column:
    return F.rlike(text, F.lit(f"(?Ui){pattern}"))


def first_match(text: Column, rules: Sequence[tuple], part: int = 1) -> Column:
    """Value of the first rule whose pattern is found in the text; null if none is."""
    out = None
    for rule in rules:
        value = F.lit(rule[part])
        out = F.when(_hit(text, rule[0]), value) if out is None else out.when(_hit(text, rule[0]), value)
    return F.lit(None).cast("string") if out is None else out


def all_matches(text: Column, rules: Sequence[tuple[str, str]]) -> Column:
    """Distinct values of all matching rules, in rule order."""
    hits = F.array(*[F.when(_hit(text, p), F.lit(v)) for p, v in rules])
    return F.array_distinct(F.array_compact(hits))


def context_text(name: str, *more: str) -> Column:
    """Name, section and collection joined by a spaced bar; missing parts are skipped."""
    return F.concat_ws(" | ", F.coalesce(name, F.lit("")), *[F.when(F.length(c) > 0, F.col(c)) for c in more])


def unit_type(unit: Column) -> Column:
    """Volume, Area, Mass, Count or Linear from a unit's spelling."""
    return first_match(F.lower(F.trim(unit)), UNIT_TYPES)


CLASS_COLUMNS = ["ost_category", "ifc_class", "aliases", "applies_to_classes", "material_class", "unit_type", "discipline", "work_type"]


def enrich(df: DataFrame, rules: Rules, name: str, unit: str, section: str, collection: str) -> DataFrame:
    """All classes of an item. A class needs a name; targets look at the name only."""
    text = context_text(name, section, collection)
    rule_no = first_match(text, [(r[0], i) for i, r in enumerate(rules.classes)])
    named = F.length(F.col(name)) > 0
    staged = df.withColumns({"_text": text}).withColumn("_rule", F.when(named, rule_no))

    def of_rule(part: int) -> Column:
        values = F.array(*[F.lit(r[part]) for r in rules.classes])
        return F.get(values, F.col("_rule"))

    t = F.col("_text")
    return staged.withColumns({
        "ost_category": of_rule(1),
        "ifc_class": of_rule(2),
        "aliases": F.coalesce(of_rule(3), F.lit("")),
        "applies_to_classes": all_matches(F.coalesce(name, F.lit("")), rules.targets),
        "material_class": first_match(t, rules.materials),
        "unit_type": unit_type(F.col(unit)),
        "discipline": first_match(t, rules.disciplines),
        "work_type": first_match(t, rules.work_types),
    }).drop("_text", "_rule")


def rates_for_embedding(
    items: DataFrame,
    rules: Rules,
    cols: Sequence[str],
    lists: Sequence[str],
    name: str,
    unit: str,
    section: str,
    collection: str,
    known: DataFrame | None = None,
    order: str = "ord",
) -> DataFrame:
    """One row per rate: its first row, classes, and ordered distinct lists of text columns.

    ``known`` are classified rates of another language; all their classes are copied over where the base
    code matches, so that a rate never mixes two texts' classes.
    """
    first = first_row(items, ["rate_code"], order, cols)
    out = enrich(first, rules, name, unit, section, collection)
    if known is not None:
        out = propagate(out, known, [c for c in CLASS_COLUMNS if c in known.columns], order)
    else:
        out = out.withColumn("propagated", F.lit(False))
    for c in lists:
        values = distinct_in_order(items, "rate_code", c, order).withColumnRenamed(c, f"{c}_list")
        out = null_safe_join(out, values, ["rate_code"], "left")
    return out


def coverage(classified: DataFrame, *more: Column) -> DataFrame:
    """Rates, the percentage with a class and with a propagated class, and further aggregates in the same pass."""
    n = F.count(F.lit(1))
    return classified.agg(
        n.alias("rates"),
        F.try_divide(F.count("ifc_class") * 100.0, n).alias("with_class_pct"),
        F.try_divide(F.count_if("propagated") * 100.0, n).alias("propagated_pct"), *more)
