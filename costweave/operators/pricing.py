"""Re-price a source table for other regions: currency, wage and purchasing-power factors, regional
adjustment, price overrides."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from costweave.functions.numeric import round_pretty
from costweave.functions.sizing import is_bounded
from costweave.schema import PRICE_COLS


# ---- factors ---------------------------------------------------------------------------------

def join_rates(tracks: DataFrame, fx: DataFrame, wage: DataFrame, ppp: DataFrame) -> DataFrame:
    """Tracks with both sides' rates.

    tracks(region, iso, currency, source_iso, source_currency, ...), fx(currency, per_eur),
    wage(iso, value), ppp(iso, value). An unknown currency fails the job; an unknown index is null.
    """
    out = tracks
    for side, key in (("tgt", "currency"), ("src", "source_currency")):
        rates = fx.select(F.col("currency").alias(f"_{side}_ccy"), F.col("per_eur").alias(f"{side}_per_eur"))
        out = out.join(rates, F.col(key) == F.col(f"_{side}_ccy"), "left").drop(f"_{side}_ccy")
    for name, index in (("wage", wage), ("ppp", ppp)):
        for side, key in (("tgt", "iso"), ("src", "source_iso")):
            values = index.select(F.col("iso").alias(f"_{side}_iso"), F.col("value").alias(f"{side}_{name}"))
            out = out.join(values, F.col(key) == F.col(f"_{side}_iso"), "left").drop(f"_{side}_iso")
    return out


def _known(rate: Column, currency: Column) -> Column:
    message = F.concat(F.lit("currency has no exchange rate: "), F.coalesce(currency, F.lit("null")))
    return F.when(rate.isNull(), F.raise_error(message).cast("double")).otherwise(rate)


def fx_rate() -> Column:
    """Target units per source unit; 1.0 without a lookup when the currencies are the same."""
    tgt = _known(F.col("tgt_per_eur"), F.col("currency"))
    src = _known(F.col("src_per_eur"), F.col("source_currency"))
    return F.when(F.col("currency") == F.col("source_currency"), F.lit(1.0)).otherwise(tgt / src)


def labour_factor(fx: Column) -> Column:
    """Wage ratio (1.0 if either index is missing) brought into the target currency."""
    return F.coalesce(F.try_divide(F.col("tgt_wage"), F.col("src_wage")), F.lit(1.0)) * fx


def material_factor(fx: Column) -> Column:
    """Ratio of construction purchasing power, which already is in local currency; else the exchange rate."""
    return F.coalesce(F.try_divide(F.col("tgt_ppp"), F.col("src_ppp")), fx)


def track_factors(tracks: DataFrame, fx: DataFrame, wage: DataFrame, ppp: DataFrame) -> DataFrame:
    """Tracks with fx, labour, material and equipment factors."""
    joined = join_rates(tracks, fx, wage, ppp).withColumn("fx", fx_rate())
    return joined.select(
        *tracks.columns,
        "fx",
        labour_factor(F.col("fx")).alias("labour"),
        material_factor(F.col("fx")).alias("material"),
        F.col("fx").alias("equipment"),
    )


# ---- per-row rules ---------------------------------------------------------------------------

def resource_type() -> Column:
    """labour, material or equipment from the flags in that priority; a null flag counts as false."""
    return (
        F.when(F.coalesce("is_labor", F.lit(False)), "labour")
        .when(F.coalesce("is_material", F.lit(False)), "material")
        .otherwise("equipment")
    )


def factor_by_flags(labour: Column, material: Column, equipment: Column) -> Column:
    kind = resource_type()
    return F.when(kind == "labour", labour).when(kind == "material", material).otherwise(equipment)


def factor_by_type_name(name: Column, labour: Column, material: Column, equipment: Column) -> Column:
    """Factor for a free-text type name; unknown and null names are equipment."""
    text = F.lower(name)
    is_labour = text.contains("labor") | text.contains("labour") | text.contains("operator")
    return F.when(is_labour, labour).when(text.contains("material"), material).otherwise(equipment)


def numeric_price_cols(df: DataFrame) -> list[str]:
    """Price columns that hold numbers; encoded text ranges are left alone."""
    types = {f.name: f.dataType for f in df.schema.fields}
    return [c for c in PRICE_COLS if isinstance(types.get(c), T.NumericType)]


def scale_prices(df: DataFrame, factor: Column) -> DataFrame:
    """Multiply every numeric price column by ``factor`` in one projection."""
    priced = set(numeric_price_cols(df))
    return df.select(*[(F.col(c) * factor).alias(c) if c in priced else F.col(c) for c in df.columns])


def _override_keys(df: DataFrame, overrides: DataFrame) -> list[str]:
    """Overrides hold for a resource, or for a resource of one track if both tables name tracks."""
    return ["resource_code", *(["track"] if "track" in df.columns and "track" in overrides.columns else [])]


def latest_overrides(overrides: DataFrame, value: str, keys: Sequence[str] = ("resource_code",)) -> DataFrame:
    """One row per key: the last row by ``ord`` wins, also when its value is null."""
    return overrides.groupBy(*keys).agg(F.max_by(F.struct(value), "ord").alias("_o")).select(
        *[F.col(k).alias(f"_{k}") for k in keys], F.col(f"_o.{value}").alias("_value"), F.lit(True).alias("_hit"))


def _with_overrides(df: DataFrame, overrides: DataFrame, value: str) -> DataFrame:
    keys = _override_keys(df, overrides)
    same = [F.col(k) == F.col(f"_{k}") for k in keys]
    return df.join(latest_overrides(overrides, value, keys), same, "left")


def apply_price_overrides(df: DataFrame, overrides: DataFrame) -> DataFrame:
    """Unit price from the override table; resource_cost = price * quantity (null quantity as 0) on hits."""
    return _priced_by_hits(_with_overrides(df, overrides, "unit_price"), df)


def _priced_by_hits(joined: DataFrame, df: DataFrame, value: str = "_value", hit: str = "_hit") -> DataFrame:
    """The columns of ``df`` from ``joined``, which has the override's price and whether there is one beside them."""
    hit = F.coalesce(hit, F.lit(False))
    replaced = {"resource_price_per_unit_current": F.when(hit, F.col(value)).otherwise(
        F.col("resource_price_per_unit_current"))}
    if "resource_quantity" in df.columns:
        cost = F.col(value) * F.coalesce("resource_quantity", F.lit(0.0))
        replaced["resource_cost"] = F.when(hit, cost).otherwise(F.col("resource_cost"))
    return joined.select(*[replaced[c].alias(c) if c in replaced else F.col(c) for c in df.columns])


def _has_labour_rates(df: DataFrame, overrides: DataFrame) -> bool:
    return "labor_rate_per_hr" in overrides.columns and "labor_rate_per_hr" in df.columns


def apply_labour_overrides(df: DataFrame, overrides: DataFrame) -> DataFrame:
    """labor_rate_per_hr from the override table; rows without a rate there are ignored."""
    if not _has_labour_rates(df, overrides):
        return df
    joined = _with_overrides(df, overrides.filter(F.col("labor_rate_per_hr").isNotNull()), "labor_rate_per_hr")
    return _with_labour_rates(joined, df)


def _with_labour_rates(joined: DataFrame, df: DataFrame, rate: str = "_value") -> DataFrame:
    value = F.coalesce(rate, "labor_rate_per_hr").alias("labor_rate_per_hr")
    return joined.select(*[value if c == "labor_rate_per_hr" else F.col(c) for c in df.columns])


def recompute_cost(df: DataFrame) -> DataFrame:
    """resource_cost = quantity * price where both are present. Stored totals are authoritative and stay."""
    cost = F.coalesce(F.col("resource_quantity") * F.col("resource_price_per_unit_current"), F.col("resource_cost"))
    return df.withColumn("resource_cost", cost)


def stamp(df: DataFrame, currency: Column, fx: Column, snapshot_date: str, location: Column,
          metadata: bool = False) -> DataFrame:
    """Set the currency and, if asked, the conversion columns."""
    out = df.withColumn("currency", currency)
    if metadata:
        out = out.withColumns({"cad_to_usd_rate": fx, "conversion_date": F.lit(snapshot_date),
                               "location_factor": location})
    return out


def reprice(
    df: DataFrame,
    labour: float,
    material: float,
    equipment: float,
    currency: str,
    location: float = 1.0,
    overrides: DataFrame | None = None,
    snapshot_date: str = "",
    metadata: bool = False,
) -> DataFrame:
    """The whole cascade for one track: scale, override, recompute, stamp, copy the rate unit."""
    factor = factor_by_flags(F.lit(labour), F.lit(material), F.lit(equipment)) * F.lit(float(location))
    out = scale_prices(df, factor)
    if overrides is not None:
        out = apply_labour_overrides(apply_price_overrides(out, overrides), overrides)
    out = stamp(recompute_cost(out), F.lit(currency), F.lit(equipment), snapshot_date, F.lit(location), metadata)
    if "rate_unit" in out.columns:
        out = out.withColumn("rate_unit_copy", F.col("rate_unit"))
    return out


TARGET_ROWS, TARGET_BYTES = 10_000, 16 * 1024**2


def reprice_tracks(items: DataFrame, factors: DataFrame, overrides: DataFrame | None = None, snapshot_date: str = "",
                   metadata: bool = False) -> DataFrame:
    """The whole cascade for every target track from its source track, in one job.

    ``items`` carry ``track``; ``factors`` (see ``track_factors``) carry region, source_track, currency,
    location_factor and the factors of labour, material and equipment. Every row is scaled, overridden,
    recomputed and stamped once per target; ``overrides`` hold for all targets or name theirs in
    ``track``. The result is ready for ``write_parquet(..., ["track"])``. Targets of a counted, bounded
    size are broadcast, so a track that holds a third of the rows is not gathered; more of them are
    joined, and adaptive execution splits such a track.
    """
    targets = factors.select(
        F.col("region").alias("_target"), F.col("source_track").alias("_source"), F.col("currency").alias("_currency"),
        F.col("labour").alias("_labour"), F.col("material").alias("_material"), F.col("equipment").alias("_equipment"),
        F.coalesce("location_factor", F.lit(1.0)).alias("_location"))
    if is_bounded(targets, TARGET_ROWS, TARGET_BYTES):
        targets = F.broadcast(targets)
    rows, early = items, overrides is not None and _override_keys(items, overrides) == ["resource_code"]
    if early:
        # Overrides that hold for all targets are looked up once per source row, not once per target; they are
        # applied after the scaling, as they are not scaled.
        rows = _with_overrides(items, overrides, "unit_price").select(
            *items.columns, F.col("_value").alias("_price"), F.col("_hit").alias("_priced"))
        if _has_labour_rates(items, overrides):
            rated = overrides.filter(F.col("labor_rate_per_hr").isNotNull())
            rows = _with_overrides(rows, rated, "labor_rate_per_hr").select(*rows.columns, F.col("_value").alias("_rate"))
    joined = rows.join(targets, F.col("track") == F.col("_source"), "inner").withColumn("track", F.col("_target"))
    factor = factor_by_flags(F.col("_labour"), F.col("_material"), F.col("_equipment")) * F.col("_location")
    out = scale_prices(joined, factor)
    if early:
        out = _priced_by_hits(out, out, "_price", "_priced")
        if "_rate" in out.columns:
            out = _with_labour_rates(out, out, "_rate")
        out = out.drop("_price", "_priced", "_rate")
    elif overrides is not None:
        out = apply_labour_overrides(apply_price_overrides(out, overrides), overrides)
    if {"resource_quantity", "resource_price_per_unit_current", "resource_cost"} <= set(out.columns):
        out = recompute_cost(out)
    out = stamp(out, F.col("_currency"), F.col("_equipment"), snapshot_date, F.col("_location"), metadata)
    if "rate_unit" in out.columns:
        out = out.withColumn("rate_unit_copy", F.col("rate_unit"))
    return out.drop("_target", "_source", "_currency", "_labour", "_material", "_equipment", "_location")


def expected_benchmarks(pairs: DataFrame) -> DataFrame:
    """Expected cost = baseline * level * fx with a window of half to one and a half, in pretty steps.

    ``pairs`` has one row per (track, scenario_id) with baseline, level and fx.
    """
    expected = F.col("baseline") * F.col("level") * F.col("fx")
    return pairs.select(
        "track", "scenario_id",
        round_pretty(expected * 0.5).alias("min"),
        round_pretty(expected * 1.5).alias("max"),
        round_pretty(expected).alias("expected"),
    )


def select_tracks(config: DataFrame, tracks: DataFrame, regions: Sequence[str] = (),
                  skip_translated: bool = False) -> DataFrame:
    """Configured tracks: an explicit list, or all but those that need a real translation."""
    joined = config.join(tracks, "region", "inner")
    if regions:
        return joined.filter(F.col("region").isin(*regions))
    if skip_translated:
        wants = F.coalesce("translate", F.lit(True))
        translates = wants & ~F.col("language").eqNullSafe(F.col("source_language"))
        return joined.filter(~translates)
    return joined
