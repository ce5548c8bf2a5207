"""Queries for pricing: factors, scaling, overrides, fan-out."""

from __future__ import annotations

from pyspark.sql import functions as F

from costweave.functions.numeric import round_pretty
from costweave.operators import pricing as P
from costweave.operators.catalog import resource_catalog
from costweave.plans.registry import query
from costweave.plans.views import WI, WI_TRACKS, s4, table, with_ctes, work_items, work_items_by_track, x4


def _pretty(x: str) -> str:
    step = {100: 1, 1_000: 10, 100_000: 100, 1_000_000: 1_000}
    cases = " ".join(f"WHEN {x} < {top} THEN round_even({x} / {by}, 0) * {by}" for top, by in step.items())
    return f"CAST(CASE {cases} ELSE round_even({x} / 10000, 0) * 10000 END AS BIGINT)"


LABOUR, MATERIAL, EQUIPMENT, LOCATION = 1.84, 1.27, 1.09, 0.95


# ---- rate tables and tracks derived from the star schema ----------------------------------------
# A currency per seven nations; its rate, and the indices of each nation, come from row counts.
# Nations without suppliers have no wage index, nations with few building customers no purchasing
# power. Every customer is a target track of its nation; the source is the region's first nation.

def rate_tables(spark, sf):
    n, c, s = (table(spark, sf, t) for t in ("nation", "customer", "supplier"))
    ccy = F.concat(F.lit("C"), (F.col("n_nationkey") % 7).cast("string"))
    cn = c.join(n, F.col("c_nationkey") == F.col("n_nationkey"))
    fx = cn.groupBy(ccy.alias("currency")).agg((1 + F.count(F.lit(1)) / 100.0).alias("per_eur"))
    wage = s.join(n, F.col("s_nationkey") == F.col("n_nationkey")).groupBy(F.col("n_name").alias("iso")).agg(
        (F.count(F.lit(1)) / 10.0).alias("value"))
    ppp = (
        cn.groupBy(F.col("n_name").alias("iso"))
        .agg(F.count_if(F.col("c_mktsegment") == "BUILDING").alias("b"), F.count(F.lit(1)).alias("n"))
        .filter(F.col("b") * 6 >= F.col("n"))
        .select("iso", (F.col("b") / 7.0).alias("value"))
    )
    return fx, wage, ppp


def customer_tracks(spark, sf):
    n, c = table(spark, sf, "nation"), table(spark, sf, "customer")
    ccy = F.concat(F.lit("C"), (F.col("n_nationkey") % 7).cast("string"))
    nations = n.select("n_nationkey", "n_name", "n_regionkey", ccy.alias("ccy"))
    source = nations.groupBy("n_regionkey").agg(F.min_by(F.struct("n_name", "ccy"), "n_nationkey").alias("_s")).select(
        F.col("n_regionkey").alias("_rk"), F.col("_s.n_name").alias("source_iso"), F.col("_s.ccy").alias("source_currency"))
    return (
        c.join(nations, F.col("c_nationkey") == F.col("n_nationkey"))
        .join(source, F.col("n_regionkey") == F.col("_rk"))
        .select(F.col("c_name").alias("region"), F.col("n_name").alias("iso"), F.col("ccy").alias("currency"),
                "source_iso", "source_currency")
    )


RATES = """nat AS (SELECT *, 'C' || (n_nationkey % 7) AS ccy FROM nation),
cn AS (SELECT * FROM customer JOIN nat ON c_nationkey = n_nationkey),
fx AS (SELECT ccy AS currency, 1 + count(*) / 100.0::DOUBLE AS per_eur FROM cn GROUP BY 1),
wage AS (SELECT n_name AS iso, count(*) / 10.0::DOUBLE AS value FROM supplier JOIN nat ON s_nationkey = n_nationkey GROUP BY 1),
ppp AS (SELECT n_name AS iso, count(*) FILTER (c_mktsegment = 'BUILDING') / 7.0::DOUBLE AS value FROM cn
        GROUP BY 1 HAVING count(*) FILTER (c_mktsegment = 'BUILDING') * 6 >= count(*)),
tracks AS (
  SELECT c_name AS region, cn.n_name AS iso, cn.ccy AS currency, s.n_name AS source_iso, s.ccy AS source_currency
  FROM cn JOIN (SELECT * FROM nat QUALIFY row_number() OVER (PARTITION BY n_regionkey ORDER BY n_nationkey) = 1) s
       ON cn.n_regionkey = s.n_regionkey),
factors AS (
  SELECT t.*, CASE WHEN t.currency = t.source_currency THEN 1.0::DOUBLE ELSE ft.per_eur / fs.per_eur END AS fx,
         wt.value / ws.value AS wage_ratio, pt.value / ps.value AS ppp_ratio,
         wt.value AS tgt_wage, ws.value AS src_wage, pt.value AS tgt_ppp, ps.value AS src_ppp,
         ft.per_eur AS tgt_per_eur, fs.per_eur AS src_per_eur
  FROM tracks t LEFT JOIN fx ft ON ft.currency = t.currency LEFT JOIN fx fs ON fs.currency = t.source_currency
       LEFT JOIN wage wt ON wt.iso = t.iso LEFT JOIN wage ws ON ws.iso = t.source_iso
       LEFT JOIN ppp pt ON pt.iso = t.iso LEFT JOIN ppp ps ON ps.iso = t.source_iso)"""


def _factors(spark, sf):
    return P.track_factors(customer_tracks(spark, sf), *rate_tables(spark, sf))


@query("j15_track_rates", with_ctes(RATES) + f"""
SELECT region, {s4('tgt_per_eur', 'tgt_per_eur')}, {s4('src_per_eur', 'src_per_eur')}, {s4('tgt_wage', 'tgt_wage')},
       {s4('src_wage', 'src_wage')}, {s4('tgt_ppp', 'tgt_ppp')}, {s4('src_ppp', 'src_ppp')} FROM factors""")
def track_rates(spark, sf):
    out = P.join_rates(customer_tracks(spark, sf), *rate_tables(spark, sf))
    cols = ["tgt_per_eur", "src_per_eur", "tgt_wage", "src_wage", "tgt_ppp", "src_ppp"]
    return out.select("region", *[x4(c, c) for c in cols])


@query("p1_fx_cross_rate", with_ctes(RATES) + f"SELECT region, {s4('fx', 'fx')} FROM factors")
def fx_cross_rate(spark, sf):
    return _factors(spark, sf).select("region", x4("fx", "fx"))


@query("p2_labour_factor", with_ctes(RATES) + f"""
SELECT region, {s4('CASE WHEN wage_ratio IS NULL THEN fx ELSE wage_ratio * fx END', 'labour')} FROM factors""")
def labour(spark, sf):
    return _factors(spark, sf).select("region", x4("labour", "labour"))


@query("p3_material_factor", with_ctes(RATES) + f"""
SELECT region, {s4('CASE WHEN ppp_ratio IS NULL THEN fx ELSE ppp_ratio END', 'material')} FROM factors""")
def material(spark, sf):
    return _factors(spark, sf).select("region", x4("material", "material"))


@query("p4_equipment_factor", with_ctes(RATES) + f"""
SELECT iso, source_iso, count(*) AS n_tracks, {s4('max(fx)', 'equipment')} FROM factors GROUP BY 1, 2""")
def equipment(spark, sf):
    return _factors(spark, sf).groupBy("iso", "source_iso").agg(
        F.count(F.lit(1)).alias("n_tracks"), F.max("equipment").alias("e")).select(
        "iso", "source_iso", "n_tracks", x4("e", "equipment"))


# ---- per-row pricing ------------------------------------------------------------------------------

@query("p5_row_type", with_ctes(WI) + """
SELECT kind, count(*) AS n, count(DISTINCT rate_code) AS rates FROM (
  SELECT rate_code, CASE WHEN is_labor IS TRUE THEN 'labour' WHEN is_material IS TRUE THEN 'material' ELSE 'equipment' END AS kind
  FROM wi) GROUP BY kind""")
def row_type(spark, sf):
    return work_items(spark, sf).groupBy(P.resource_type().alias("kind")).agg(
        F.count(F.lit(1)).alias("n"), F.count_distinct("rate_code").alias("rates"))


_FACTOR_SQL = (f"(CASE WHEN is_labor IS TRUE THEN {LABOUR}::DOUBLE WHEN is_material IS TRUE THEN {MATERIAL}::DOUBLE "
               f"ELSE {EQUIPMENT}::DOUBLE END * {LOCATION}::DOUBLE)")


@query("p6_scaled_prices", with_ctes(WI) + f"""
SELECT rate_code, l_partkey, ord.l_linenumber AS line, {s4('resource_cost * ' + _FACTOR_SQL, 'resource_cost')},
       {s4('resource_price_per_unit_current * ' + _FACTOR_SQL, 'price')},
       {s4('total_cost_per_position * ' + _FACTOR_SQL, 'total')}
FROM (SELECT * REPLACE (struct_pack(l_linenumber := ord[2]) AS ord) FROM wi)""")
def scaled_prices(spark, sf):
    factor = P.factor_by_flags(F.lit(LABOUR), F.lit(MATERIAL), F.lit(EQUIPMENT)) * F.lit(LOCATION)
    return P.scale_prices(work_items(spark, sf), factor).select(
        "rate_code", "l_partkey", F.col("ord.l_linenumber").alias("line"), x4("resource_cost", "resource_cost"),
        x4("resource_price_per_unit_current", "price"), x4("total_cost_per_position", "total"))


@query("p7_recomputed_cost", with_ctes(WI) + f"""
SELECT rate_code, {s4('sum(cost)', 'cost')}, count(*) FILTER (recomputed) AS recomputed FROM (
  SELECT rate_code, resource_quantity IS NOT NULL AS recomputed,
         CASE WHEN resource_quantity IS NULL THEN resource_cost ELSE resource_quantity * (resource_price_per_unit_current * 1.5::DOUBLE) END AS cost
  FROM wi) GROUP BY rate_code""")
def recomputed_cost(spark, sf):
    wi = work_items(spark, sf).withColumn(
        "resource_price_per_unit_current", F.col("resource_price_per_unit_current") * 1.5)
    return P.recompute_cost(wi).groupBy("rate_code").agg(
        x4(F.sum("resource_cost"), "cost"), F.count("resource_quantity").alias("recomputed"))


@query("p8_currency_stamp", with_ctes(WI) + f"""
SELECT 'USD' AS currency, 1.09::DOUBLE AS cad_to_usd_rate, '2026-04-01' AS conversion_date, 0.95::DOUBLE AS location_factor,
       section_name, count(*) AS n FROM wi GROUP BY section_name""")
def currency_stamp(spark, sf):
    out = P.stamp(work_items(spark, sf), F.lit("USD"), F.lit(EQUIPMENT), "2026-04-01", F.lit(LOCATION), metadata=True)
    return out.groupBy("currency", "cad_to_usd_rate", "conversion_date", "location_factor", "section_name").agg(
        F.count(F.lit(1)).alias("n"))


# ---- overrides: two price lists over parts, the later one repeating codes of the first ---------------

def price_overrides(spark, sf):
    p = table(spark, sf, "part")
    code = F.concat(F.lit("P"), F.col("p_partkey").cast("string")).alias("resource_code")
    rate = F.when(F.col("p_type") == "PROMO", F.col("p_size") * 1.5)
    first = p.filter(F.col("p_size") <= 10).select(
        code, (F.col("p_retailprice") / 10).alias("unit_price"), rate.alias("labor_rate_per_hr"),
        F.struct(F.lit(0).alias("list"), "p_partkey").alias("ord"))
    second = p.filter(F.col("p_brand").isin("Brand#7", "Brand#11")).select(
        code, F.when(F.col("p_size") > 5, F.col("p_retailprice") / 5).alias("unit_price"),
        (rate * 2).alias("labor_rate_per_hr"), F.struct(F.lit(1).alias("list"), "p_partkey").alias("ord"))
    return first.unionByName(second)


OVERRIDES = """overrides AS (
  SELECT 'P' || p_partkey AS resource_code, p_retailprice / 10 AS unit_price,
         CASE WHEN p_type = 'PROMO' THEN p_size * 1.5::DOUBLE END AS labor_rate_per_hr, 0 AS list FROM part WHERE p_size <= 10
  UNION ALL
  SELECT 'P' || p_partkey, CASE WHEN p_size > 5 THEN p_retailprice / 5 END,
         CASE WHEN p_type = 'PROMO' THEN p_size * 1.5::DOUBLE END * 2, 1 FROM part WHERE p_brand IN ('Brand#7', 'Brand#11')),
last_price AS (SELECT resource_code, unit_price FROM overrides
               QUALIFY row_number() OVER (PARTITION BY resource_code ORDER BY list DESC) = 1),
last_rate AS (SELECT resource_code, labor_rate_per_hr FROM overrides WHERE labor_rate_per_hr IS NOT NULL
              QUALIFY row_number() OVER (PARTITION BY resource_code ORDER BY list DESC) = 1)"""


@query("j2_price_overrides", with_ctes(WI, OVERRIDES) + f"""
SELECT wi.resource_code, count(*) AS n, count(price) AS priced, {s4('sum(price)', 'price')}, {s4('sum(cost)', 'cost')} FROM (
  SELECT wi.resource_code, CASE WHEN o.resource_code IS NULL THEN resource_price_per_unit_current ELSE o.unit_price END AS price,
         CASE WHEN o.resource_code IS NULL THEN resource_cost ELSE o.unit_price * coalesce(resource_quantity, 0) END AS cost
  FROM wi LEFT JOIN last_price o ON wi.resource_code = o.resource_code) wi GROUP BY 1""")
def overridden_prices(spark, sf):
    out = P.apply_price_overrides(work_items(spark, sf), price_overrides(spark, sf))
    return out.groupBy("resource_code").agg(
        F.count(F.lit(1)).alias("n"), F.count("resource_price_per_unit_current").alias("priced"),
        x4(F.sum("resource_price_per_unit_current"), "price"), x4(F.sum("resource_cost"), "cost"))


@query("j3_labour_rate_overrides", with_ctes(WI, OVERRIDES) + f"""
SELECT wi.resource_code, count(*) AS n, {s4('min(coalesce(o.labor_rate_per_hr, 20.0::DOUBLE))', 'labor_rate_per_hr')}
FROM wi LEFT JOIN last_rate o ON wi.resource_code = o.resource_code GROUP BY 1""")
def overridden_rates(spark, sf):
    wi = work_items(spark, sf).withColumn("labor_rate_per_hr", F.lit(20.0))
    out = P.apply_labour_overrides(wi, price_overrides(spark, sf))
    return out.groupBy("resource_code").agg(
        F.count(F.lit(1)).alias("n"), x4(F.min("labor_rate_per_hr"), "labor_rate_per_hr"))


def repriced(spark, sf):
    wi = work_items(spark, sf)
    return P.reprice(wi, LABOUR, MATERIAL, EQUIPMENT, "USD", LOCATION, price_overrides(spark, sf))


REPRICED = OVERRIDES + f""",
scaled AS (SELECT wi.*, {_FACTOR_SQL} AS f FROM wi),
swapped AS (
  SELECT s.* EXCLUDE (resource_price_per_unit_current, resource_cost, total_cost_per_position, currency),
         CASE WHEN o.resource_code IS NULL THEN s.resource_price_per_unit_current * f ELSE o.unit_price END AS resource_price_per_unit_current,
         CASE WHEN o.resource_code IS NULL THEN s.resource_cost * f ELSE o.unit_price * coalesce(resource_quantity, 0) END AS rc,
         s.total_cost_per_position * f AS total_cost_per_position, 'USD' AS currency, s.rate_unit AS rate_unit_copy
  FROM scaled s LEFT JOIN last_price o ON s.resource_code = o.resource_code),
repriced AS (
  SELECT *, CASE WHEN resource_quantity IS NOT NULL AND resource_price_per_unit_current IS NOT NULL
                 THEN resource_quantity * resource_price_per_unit_current ELSE rc END AS resource_cost FROM swapped)"""


@query("p9_price_cascade", with_ctes(WI, REPRICED) + f"""
SELECT rate_code, currency, rate_unit_copy, count(*) AS n, count(resource_cost) AS costed, {s4('sum(resource_cost)', 'cost')},
       {s4('sum(resource_price_per_unit_current)', 'price')}, {s4('max(total_cost_per_position)', 'total')}
FROM repriced GROUP BY 1, 2, 3""")
def price_cascade(spark, sf):
    return repriced(spark, sf).groupBy("rate_code", "currency", "rate_unit_copy").agg(
        F.count(F.lit(1)).alias("n"), F.count("resource_cost").alias("costed"), x4(F.sum("resource_cost"), "cost"),
        x4(F.sum("resource_price_per_unit_current"), "price"), x4(F.max("total_cost_per_position"), "total"))


def _catalog_sql(source: str, currency: str) -> str:
    def first(col: str, name: str) -> str:
        return f"coalesce(arg_min({col}, ord) FILTER ({col} IS NOT NULL), '') AS {name}"

    return f"""
SELECT resource_code, {first('resource_name', 'name')},
       CASE WHEN bool_or(is_labor) THEN 'Labour' WHEN bool_or(is_material) THEN 'Material'
            WHEN bool_or(is_machine) THEN 'Equipment' ELSE 'Other' END AS type,
       {first('collection_name', 'category')}, {first('resource_unit', 'unit')},
       {s4('avg(resource_price_per_unit_current)', 'price_avg')}, {s4('min(resource_price_per_unit_current)', 'price_min')},
       {s4('max(resource_price_per_unit_current)', 'price_max')}, {s4('median(resource_price_per_unit_current)', 'price_median')},
       count(resource_price_per_unit_current) AS price_variants, '{currency}' AS currency,
       {s4('avg(resource_cost)', 'avg_cost_per_use')}, {s4('avg(resource_quantity)', 'avg_qty_per_use')},
       count(*) AS usage_count, count(DISTINCT rate_code) AS used_in_work_items,
       {first('collection_name', 'parent_category')}, {first('collection_code', 'parent_collection')},
       {first('department_name', 'parent_department')}, {first('section_name', 'parent_section')}
FROM {source} WHERE resource_code IS NOT NULL GROUP BY resource_code"""


_CATALOG_NUMBERS = ["price_avg", "price_min", "price_max", "price_median", "avg_cost_per_use", "avg_qty_per_use"]


def rounded_catalog(catalog):
    return catalog.select(*[x4(c, c) if c in _CATALOG_NUMBERS else F.col(c) for c in catalog.columns])


@query("a1_resource_catalog", with_ctes(WI) + _catalog_sql("wi", "EUR"))
def catalog(spark, sf):
    return rounded_catalog(resource_catalog(work_items(spark, sf), "EUR"))


@query("a1_catalog_of_repriced_track", with_ctes(WI, REPRICED) + _catalog_sql("repriced", "USD"))
def repriced_catalog(spark, sf):
    return rounded_catalog(resource_catalog(repriced(spark, sf), "USD"))


# ---- all target tracks in one job ---------------------------------------------------------------------

def nation_targets(spark, sf):
    """One target per nation, re-priced from its region's table."""
    n, r = table(spark, sf, "nation"), table(spark, sf, "region")
    tracks = customer_tracks(spark, sf).select("iso", "currency", "source_iso", "source_currency").distinct()
    factors = P.track_factors(tracks.withColumn("region", F.col("iso")), *rate_tables(spark, sf))
    home = n.join(r, F.col("n_regionkey") == F.col("r_regionkey")).select(
        F.col("n_name").alias("_iso"), F.col("r_name").alias("source_track"),
        F.when(F.col("n_nationkey") > 4, 1 - F.col("n_nationkey") / 100.0).alias("location_factor"))
    return factors.join(home, F.col("iso") == F.col("_iso")).drop("_iso")


@query("p10_track_fan_out", with_ctes(WI_TRACKS, RATES, OVERRIDES, """targets AS (
  SELECT DISTINCT f.iso AS target, r_name AS source_track, f.currency, fx,
         CASE WHEN wage_ratio IS NULL THEN fx ELSE wage_ratio * fx END AS labour, coalesce(ppp_ratio, fx) AS material,
         CASE WHEN n_nationkey > 4 THEN 1 - n_nationkey / 100.0::DOUBLE ELSE 1.0::DOUBLE END AS loc
  FROM factors f JOIN nation ON n_name = f.iso JOIN region ON n_regionkey = r_regionkey)""") + f"""
SELECT target AS track, currency, count(*) AS n, {s4('sum(total) / 1000', 'total')}, {s4('max(total)', 'highest')},
       {s4('sum(price) / 1000', 'price')}, {s4('sum(price * resource_quantity) / 1000', 'cost')}, count(DISTINCT rate_unit) AS units,
       {s4('max(loc)', 'location')} FROM (
  SELECT target, currency, total_cost_per_position * f AS total, resource_quantity, rate_unit, loc,
         CASE WHEN o.resource_code IS NULL THEN total_cost_per_position / resource_quantity * f ELSE o.unit_price END AS price FROM (
    SELECT w.*, target, t.currency, loc, CASE WHEN p_type = 'PROMO' THEN labour
           WHEN p_type IN ('STANDARD', 'ECONOMY') THEN material ELSE fx END * loc AS f
    FROM wi_tracks w JOIN targets t ON w.track = t.source_track JOIN part ON w.l_partkey = p_partkey)
  LEFT JOIN last_price o ON o.resource_code = 'P' || l_partkey) GROUP BY 1, 2""")
def track_fan_out(spark, sf):
    p = table(spark, sf, "part").select(
        F.col("p_partkey").alias("_pk"), (F.col("p_type") == "PROMO").alias("is_labor"),
        F.col("p_type").isin("STANDARD", "ECONOMY").alias("is_material"))
    items = work_items_by_track(spark, sf).join(p, F.col("l_partkey") == F.col("_pk")).select(
        "track", "rate_code", "rate_unit", "total_cost_per_position", "resource_quantity", "is_labor", "is_material",
        F.concat(F.lit("P"), F.col("l_partkey").cast("string")).alias("resource_code"),
        (F.col("total_cost_per_position") / F.col("resource_quantity")).alias("resource_price_per_unit_current"),
        F.col("total_cost_per_position").alias("resource_cost"))
    out = P.reprice_tracks(items, nation_targets(spark, sf), price_overrides(spark, sf), "2026-04-01", metadata=True)
    return out.groupBy("track", "currency").agg(
        F.count(F.lit(1)).alias("n"), x4(F.sum("total_cost_per_position") / 1000, "total"),
        x4(F.max("total_cost_per_position"), "highest"), x4(F.sum("resource_price_per_unit_current") / 1000, "price"),
        x4(F.sum("resource_cost") / 1000, "cost"), F.count_distinct("rate_unit_copy").alias("units"),
        x4(F.max("location_factor"), "location"))


@query("p11_expected_benchmarks", with_ctes(WI_TRACKS) + """
, base AS (SELECT CAST(l_partkey % 30 AS INTEGER) AS scenario_id, floor(avg(total_cost_per_position)) AS baseline FROM wi_tracks GROUP BY 1),
lvl AS (SELECT n_name AS track, count(*) / 4096.0::DOUBLE AS level FROM wi_tracks GROUP BY 1),
e AS (SELECT DISTINCT n_name AS track, scenario_id, baseline * level * 1.25::DOUBLE AS x
      FROM wi_tracks JOIN base ON scenario_id = l_partkey % 30 JOIN lvl ON lvl.track = n_name)
""" + f"""SELECT track, scenario_id, {_pretty('(x * 0.5::DOUBLE)')} AS min, {_pretty('(x * 1.5::DOUBLE)')} AS max, {_pretty('x')} AS expected FROM e""")
def benchmark_ranges(spark, sf):
    wi = work_items_by_track(spark, sf).withColumn("scenario_id", (F.col("l_partkey") % 30).cast("int"))
    base = wi.groupBy("scenario_id").agg(F.floor(F.avg("total_cost_per_position")).cast("double").alias("baseline"))
    level = wi.groupBy(F.col("n_name").alias("track")).agg((F.count(F.lit(1)) / 4096.0).alias("level"))
    pairs = wi.select(F.col("n_name").alias("track"), "scenario_id").distinct()
    pairs = pairs.join(base, "scenario_id").join(level, "track").withColumn("fx", F.lit(1.25))
    return P.expected_benchmarks(pairs)


@query("p12_factor_by_type_name", """
SELECT p_type, p_name, count(*) AS n, CASE WHEN p_name LIKE '%bolt%' THEN 1.84::DOUBLE WHEN p_name LIKE '%ring%' THEN 1.27::DOUBLE ELSE 1.09::DOUBLE END AS factor
FROM part GROUP BY p_type, p_name""")
def factor_by_type_name(spark, sf):
    # bolts stand for operators and rings for materials, in mixed case as tracks spell them
    name = F.regexp_replace(F.regexp_replace("p_name", "bolt", "Crane OPERATOR"), "ring", "Raw Material")
    factor = P.factor_by_type_name(name, F.lit(LABOUR), F.lit(MATERIAL), F.lit(EQUIPMENT))
    return table(spark, sf, "part").withColumn("factor", factor).groupBy("p_type", "p_name", "factor").agg(
        F.count(F.lit(1)).alias("n")).select("p_type", "p_name", "n", "factor")


@query("x11_round_pretty", f"""
SELECT o_orderkey, {_pretty('o_totalprice')} AS whole, {_pretty('(o_totalprice / 7)')} AS seventh,
       {_pretty('(o_totalprice / 1000)')} AS thousandth, {_pretty('(o_totalprice * 10)')} AS tenfold FROM orders""")
def pretty(spark, sf):
    t = F.col("o_totalprice")
    return table(spark, sf, "orders").select(
        "o_orderkey", round_pretty(t).alias("whole"), round_pretty(t / 7).alias("seventh"),
        round_pretty(t / 1000).alias("thousandth"), round_pretty(t * 10).alias("tenfold"))


@query("f12_track_selection", with_ctes(RATES) + """
SELECT region, iso, source_iso FROM tracks
WHERE NOT (coalesce(region NOT LIKE '%7', true) AND currency <> source_currency)""")
def track_selection(spark, sf):
    # the currency stands for the language; names ending in 7 are configured not to translate
    tracks = customer_tracks(spark, sf).withColumnsRenamed({"currency": "language", "source_currency": "source_language"})
    config = table(spark, sf, "customer").select(
        F.col("c_name").alias("region"), F.when(F.col("c_name").endswith("7"), False).alias("translate"))
    return P.select_tracks(config, tracks, skip_translated=True).select("region", "iso", "source_iso")
