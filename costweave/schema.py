"""Column groups and types of a work-item table, and normalising a scan to them."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Column names of the published data set.
KEY_COLS = ["rate_code", "resource_code"]
NORM_COLS = [
    "resource_quantity", "parameter_resource_quantity", "electricity_consumption_kwh_per_machine_hour",
    "count_workers_per_unit", "count_engineers_per_unit", "count_operators_per_unit",
    "count_total_people_per_unit", "count_people_per_day", "labor_hours_construction_workers",
    "labor_hours_operators", "labor_hours_engineers", "total_labor_hours_workers_operators",
    "total_labor_hours_all_personnel", "mass_value", "price_abstract_resource_position_count",
]
PRICE_COLS = [
    "resource_price_per_unit_current", "resource_cost", "price_abstract_resource_est_price_median",
    "price_abstract_resource_est_price_min", "price_abstract_resource_est_price_max",
    "price_abstract_resource_est_price_mean", "materials_resource_cost", "total_resource_cost_per_position",
    "total_cost_per_position", "total_material_cost_per_position", "total_value_machinery_equipment",
    "total_value_abstract_resources", "price_operator_wages", "electricity_cost_per_unit",
    "electricity_cost_total_sum", "cost_operator_sum", "cost_of_working_hours", "service_cost_sum",
    "price_cost_without_wages", "labor_rate_per_hr",
]
TEXT_COLS = [
    "rate_original_name", "rate_final_name", "rate_unit", "work_composition_text", "resource_name",
    "resource_unit", "department_name", "section_name", "subsection_name", "collection_name", "mass_name",
    "mass_unit", "labor_class", "labor_title", "operator_class", "machine_class3_name", "machine_class2_name",
    "abstract_resource_tech_group", "service_category", "service_type", "parameter_service_name",
    "parameter_service_unit", "department_type", "section_type", "row_type", "category_type",
    "personnel_operator_grade", "masterformat_section_title", "masterformat_division",
    "price_abstract_resource_unit", "price_abstract_resource_common_start",
    "price_abstract_resource_variable_parts", "price_abstract_resource_est_price_range",
    "price_abstract_resource_est_price_all_values", "price_abstract_resource_group_per_unit",
    "price_abstract_resource_common_start_per_unit", "price_abstract_resource_variable_parts_per_unit",
    "price_abstract_resource_est_price_range_per_unit", "price_abstract_resource_est_price_all_values_per_unit",
    "price_region",
]
FLAG_COLS = ["is_scope", "is_abstract", "is_machine", "is_labor", "is_material"]
CODE_COLS = [
    "collection_code", "department_code", "subsection_code", "masterformat_section_code",
    "personnel_operator_code", "parameter_service_code", "rate_unit_copy", "currency",
]
US_EXTRA_COLS = [
    "cad_to_usd_rate", "conversion_date", "has_obfuscated_values", "location_factor", "regulatory_note",
    "source_database", "us_labor_class", "us_labor_rate_usd_hr", "us_labor_title", "us_operator_class",
]
# A track may carry the right-hand pair instead of the left-hand pair.
TAXONOMY_ALTERNATES = {
    ("masterformat_division", "masterformat_section_title"): ("nrm2_section_code", "nrm2_section_title"),
}
# Some tracks and scripts use the name on the right for the column on the left.
LEGACY_NAMES = {"resource_price_per_unit_current": "resource_price_per_unit_eur_current"}


def canonical_schema() -> T.StructType:
    """Typed columns of a work-item table (norm columns may coincide with no other group)."""
    fields = [T.StructField(c, T.StringType()) for c in [*KEY_COLS, *TEXT_COLS, *CODE_COLS]]
    fields += [T.StructField(c, T.BooleanType()) for c in FLAG_COLS]
    fields += [T.StructField(c, T.DoubleType()) for c in [*NORM_COLS, *PRICE_COLS]]
    return T.StructType(fields)


def normalise(df: DataFrame, schema: T.StructType | None = None) -> DataFrame:
    """Bring a scan to ``schema``: rename legacy columns, parse numbers kept as text, NaN to null,
    add missing columns as null. Columns outside the schema are kept as they are."""
    schema = schema or canonical_schema()
    have = set(df.columns)
    for name, legacy in LEGACY_NAMES.items():
        if legacy in have and name in have:
            df = df.withColumn(name, F.coalesce(name, legacy)).drop(legacy)
        elif legacy in have:
            df = df.withColumnRenamed(legacy, name)
    have = set(df.columns)
    out = []
    for field in schema.fields:
        if field.name not in have:
            out.append(F.lit(None).cast(field.dataType).alias(field.name))
            continue
        value = F.col(field.name).try_cast(field.dataType)
        if isinstance(field.dataType, T.DoubleType):
            value = F.when(~F.isnan(value), value)
        out.append(value.alias(field.name))
    extra = [F.col(c) for c in df.columns if c not in schema.fieldNames()]
    return df.select(*out, *extra)


def present(df: DataFrame, cols: Sequence[str]) -> list[str]:
    """Those of ``cols`` that the frame has, in the given order."""
    have = set(df.columns)
    return [c for c in cols if c in have]
