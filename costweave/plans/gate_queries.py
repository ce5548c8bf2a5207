"""Queries for comparing tracks, aligning rows and the acceptance gates."""

from __future__ import annotations

from pyspark.sql import functions as F

from costweave import schema as S
from costweave.operators import compare as C
from costweave.operators import gates as G
from costweave.operators.ordering import top_n
from costweave.plans.pricing_queries import EQUIPMENT, REPRICED, repriced
from costweave.plans.registry import query
from costweave.plans.text_queries import PASSTHROUGH
from costweave.plans.views import (
    ORD, TRACKS, WI, WI_TRACKS, s4, table, with_ctes, work_items, work_items_by_track, x4,
)


def cnt():
    return F.count(F.lit(1)).alias("n")

PAIR_COLS = ["rate_code", "resource_code", "resource_quantity", "resource_price_per_unit_current", "resource_cost",
             "total_cost_per_position", "labor_hours_construction_workers", "currency", "ord", "l_partkey"]


def damaged_track(spark, sf):
    """The re-priced track with planted defects: lost prices, changed norms, wrong scale, one lost brand."""
    k = F.col("l_partkey")
    return repriced(spark, sf).filter("resource_unit <> 'Brand#13'").select(*PAIR_COLS).withColumns({
        "resource_price_per_unit_current": F.when(k % 97 != 0, F.col("resource_price_per_unit_current")),
        "resource_quantity": F.when(k % 101 == 0, F.col("resource_quantity") + 1).otherwise(F.col("resource_quantity")),
        "resource_cost": F.when(k % 103 == 0, F.col("resource_cost") * 1000).otherwise(F.col("resource_cost")),
    })


DAMAGED = """damaged AS (
  SELECT * REPLACE (CASE WHEN l_partkey % 97 <> 0 THEN resource_price_per_unit_current END AS resource_price_per_unit_current,
    CASE WHEN l_partkey % 101 = 0 THEN resource_quantity + 1 ELSE resource_quantity END AS resource_quantity,
    CASE WHEN l_partkey % 103 = 0 THEN resource_cost * 1000 ELSE resource_cost END AS resource_cost)
  FROM repriced WHERE resource_unit <> 'Brand#13'),
s AS (SELECT *, row_number() OVER (PARTITION BY rate_code, resource_code ORDER BY ord) AS occ FROM wi),
t AS (SELECT *, row_number() OVER (PARTITION BY rate_code, resource_code ORDER BY ord) AS occ FROM damaged),
pairs AS (SELECT coalesce(s.rate_code, t.rate_code) AS rate_code, coalesce(s.resource_code, t.resource_code) AS resource_code,
    coalesce(s.occ, t.occ) AS occ, s.rate_code IS NOT NULL AS in_s, t.rate_code IS NOT NULL AS in_t,
    s.resource_quantity AS sq, t.resource_quantity AS tq, s.labor_hours_construction_workers AS sh, t.labor_hours_construction_workers AS th,
    s.resource_price_per_unit_current AS sp, t.resource_price_per_unit_current AS tp, s.resource_cost AS sc, t.resource_cost AS tc,
    s.total_cost_per_position AS st, t.total_cost_per_position AS tt
  FROM s FULL JOIN t ON s.rate_code = t.rate_code AND s.resource_code IS NOT DISTINCT FROM t.resource_code AND s.occ = t.occ)"""
_PAIRED = with_ctes(WI, REPRICED, DAMAGED)


def _pairs(spark, sf, cols):
    source = work_items(spark, sf).select(*PAIR_COLS)
    return G.pair_rows(source, damaged_track(spark, sf), cols=cols)


@query("j4_positional_alignment", _PAIRED + f"""
SELECT rate_code, resource_code, occ, in_s, in_t, {s4('sc', 'source_cost')}, {s4('tc', 'target_cost')} FROM pairs""")
def alignment(spark, sf):
    return _pairs(spark, sf, ["resource_cost"]).select(
        "rate_code", "resource_code", "occ", F.col("s").isNotNull().alias("in_s"), F.col("t").isNotNull().alias("in_t"),
        x4(F.col("s.resource_cost"), "source_cost"), x4(F.col("t.resource_cost"), "target_cost"))


# ---- several tracks --------------------------------------------------------------------------------------

@query("s5_tracks_union", with_ctes(WI_TRACKS) + f"""
SELECT track, count(*) AS n, count(DISTINCT rate_code) AS rates, {s4('avg(total_cost_per_position)', 'avg_cost')}
FROM wi_tracks GROUP BY 1""")
def tracks_union(spark, sf):
    from costweave.session import scratch_path
    from costweave.sources.writers import write_parquet

    path = scratch_path(spark, "tracks")
    wi = work_items_by_track(spark, sf).select("track", "rate_code", "total_cost_per_position")
    write_parquet(wi, path, ["track"])
    paths = {t: f"{path}/track={t}" for t in [*TRACKS, "ATLANTIS"]}  # the last has no folder
    return C.scan_tracks(spark, paths).groupBy("track").agg(
        cnt(), F.count_distinct("rate_code").alias("rates"), x4(F.avg("total_cost_per_position"), "avg_cost"))


@query("u1_common_codes", with_ctes(WI_TRACKS) + " INTERSECT ".join(
    f"SELECT rate_code FROM wi_tracks WHERE track = '{t}'" for t in TRACKS))
def common(spark, sf):
    return C.common_codes(work_items_by_track(spark, sf), len(TRACKS))


@query("u2_code_difference", _PAIRED + """
SELECT 'resource_code' AS code, (SELECT count(*) FROM (SELECT resource_code FROM wi WHERE resource_code IS NOT NULL EXCEPT SELECT resource_code FROM damaged)) AS target_missing,
       (SELECT count(*) FROM (SELECT resource_code FROM damaged WHERE resource_code IS NOT NULL EXCEPT SELECT resource_code FROM wi)) AS target_extra
UNION ALL SELECT 'rate_code', (SELECT count(*) FROM (SELECT rate_code FROM wi EXCEPT SELECT rate_code FROM damaged)), 0""")
def difference(spark, sf):
    s, t = work_items(spark, sf), damaged_track(spark, sf)
    return C.code_difference(t, s, ["resource_code", "rate_code"]).withColumnRenamed("col", "code")


def _wide_sql() -> str:
    cols = ", ".join(
        f"""min(rate_final_name) FILTER (track = '{t}') AS "{t}_name", min({s4('total_cost_per_position')}) FILTER (track = '{t}') AS "{t}_cost",
            min(rate_unit) FILTER (track = '{t}') AS "{t}_unit\"""" for t in TRACKS)
    return f"""f AS (SELECT * FROM wi_tracks QUALIFY row_number() OVER (PARTITION BY rate_code, track ORDER BY ord) = 1)
SELECT rate_code, {cols} FROM f GROUP BY 1 HAVING count(*) = {len(TRACKS)}"""


@query("u6_wide_comparison", with_ctes(WI_TRACKS, _wide_sql()).rstrip())
def wide(spark, sf):
    out = C.wide_comparison(work_items_by_track(spark, sf), TRACKS)
    cols = []
    for t in TRACKS:
        cols += [F.col(f"{t}_rate_final_name").alias(f"{t}_name"), x4(F.col(f"{t}_total_cost_per_position"), f"{t}_cost"),
                 F.col(f"{t}_rate_unit").alias(f"{t}_unit")]
    return out.select("rate_code", *cols)


@query("x18_row_mean_of_tracks", with_ctes(WI_TRACKS) + f""", f AS (
  SELECT * FROM wi_tracks QUALIFY row_number() OVER (PARTITION BY rate_code, track ORDER BY ord) = 1)
SELECT rate_code, {s4('avg(total_cost_per_position)', 'avg_cost')} FROM f GROUP BY 1 HAVING count(*) = {len(TRACKS)}
ORDER BY avg(total_cost_per_position) DESC, rate_code LIMIT 25""")
def row_mean(spark, sf):
    out = C.with_row_mean(C.wide_comparison(work_items_by_track(spark, sf), TRACKS), TRACKS)
    return top_n(out, "avg_cost", 25, ["rate_code"]).select("rate_code", x4("avg_cost", "avg_cost"))


@query("j6_rate_alignment", with_ctes(WI_TRACKS) + """,
a AS (SELECT rate_code, arg_min(n_name, ord) AS src FROM wi_tracks WHERE track = 'ASIA' GROUP BY 1),
b AS (SELECT rate_code, arg_min(n_name, ord) AS tgt FROM wi_tracks WHERE track = 'EUROPE' GROUP BY 1)
SELECT rate_code, src, tgt FROM a JOIN b USING (rate_code) WHERE src <> tgt""")
def rate_alignment(spark, sf):
    wi = work_items_by_track(spark, sf)
    out = C.align_by_code(wi.filter("track = 'ASIA'"), wi.filter("track = 'EUROPE'"), "n_name")
    return out.select("rate_code", "src", "tgt")


# ---- gates -------------------------------------------------------------------------------------------------

@query("q1_schema_parity", """
SELECT 'schema_parity' AS name, true AS passed, '22 columns match' AS detail
UNION ALL SELECT 'schema_parity', false, 'missing=[] extra=[''rate_unit_copy'']'""")
def schema_gate(spark, sf):
    source, target = work_items(spark, sf), repriced(spark, sf)
    clean = G.schema_parity(spark, target.drop("rate_unit_copy").schema, source.schema, source.schema)
    extra = G.schema_parity(spark, target.schema, source.schema, source.schema)
    return clean.unionByName(extra)


@query("q2_code_stability", _PAIRED + """
SELECT 'code_stability' AS name, m = 0 AS passed, 'missing=' || m || ' extra=0' AS detail
FROM (SELECT (SELECT count(*) FROM (SELECT resource_code FROM wi WHERE resource_code IS NOT NULL EXCEPT SELECT resource_code FROM damaged))
           + (SELECT count(*) FROM (SELECT rate_code FROM wi EXCEPT SELECT rate_code FROM damaged)) AS m)""")
def code_gate(spark, sf):
    return G.code_stability(work_items(spark, sf), damaged_track(spark, sf))


_NORMS = ["resource_quantity", "labor_hours_construction_workers"]
_PRICES = ["resource_price_per_unit_current", "resource_cost", "total_cost_per_position"]
_RATIOS = ["total_cost_per_position", "resource_cost"]


def _counters(spark, sf, norms=_NORMS, prices=_PRICES, ratios=_RATIOS):
    # Prices need the quantities on one side alone: with all columns named, both sides share the shuffles of their joins.
    return G.pair_counters(_pairs(spark, sf, list(dict.fromkeys([*norms, *prices, *ratios]))), norms, prices, ratios, EQUIPMENT)


@query("q3_norm_changes", _PAIRED + """
SELECT count(*) FILTER (in_s) AS n_source, count(*) FILTER (in_t) AS n_target,
       count(*) FILTER (in_s AND in_t AND tq IS DISTINCT FROM sq) AS norm_resource_quantity,
       count(*) FILTER (in_s AND in_t AND th IS DISTINCT FROM sh) AS norm_labor_hours_construction_workers FROM pairs""")
def norm_changes(spark, sf):
    return _counters(spark, sf, prices=(), ratios=()).select("n_source", "n_target", *[f"norm_{c}" for c in _NORMS])


@query("q4_new_nulls", _PAIRED + """
SELECT count(*) FILTER (in_s AND in_t AND tp IS NULL AND sp IS NOT NULL) AS null_resource_price_per_unit_current,
       count(*) FILTER (in_s AND in_t AND tc IS NULL AND sc IS NOT NULL) AS null_resource_cost,
       count(*) FILTER (in_s AND in_t AND tt IS NULL AND st IS NOT NULL) AS null_total_cost_per_position FROM pairs""")
def new_nulls(spark, sf):
    return _counters(spark, sf).select(*[f"null_{c}" for c in _PRICES])


@query("q5_currency_consistency", """
SELECT 'currency_consistency' AS name, count(*) FILTER (o_orderpriority <> '1-URGENT') = 0 AS passed,
       'rows=' || count(*) || ' other=' || count(*) FILTER (o_orderpriority <> '1-URGENT') AS detail FROM lineitem JOIN orders ON l_orderkey = o_orderkey
UNION ALL SELECT 'currency_consistency', true, 'rows=' || count(*) || ' other=0' FROM lineitem""")
def currency_gate(spark, sf):
    wi = work_items(spark, sf)
    mixed = wi.withColumn("currency", F.col("department_name"))
    return G.currency_consistent(mixed, "1-URGENT").unionByName(G.currency_consistent(wi, "EUR"))


_RATIO_SQL = {"total_cost_per_position": ("tt", "st"), "resource_cost": ("tc", "sc")}


@query("q6_price_ratios", _PAIRED + "SELECT " + ", ".join(
    f"""count(*) FILTER (in_s AND in_t AND {s} > 0 AND ({t} / ({s} * {EQUIPMENT}) < 0.01 OR {t} / ({s} * {EQUIPMENT}) > 100)) AS bad_{c},
        {s4(f'min({t} / ({s} * {EQUIPMENT}::DOUBLE)) FILTER ({s} > 0)', f'lo_{c}')}, {s4(f'max({t} / ({s} * {EQUIPMENT}::DOUBLE)) FILTER ({s} > 0)', f'hi_{c}')}"""
    for c, (t, s) in _RATIO_SQL.items()) + " FROM pairs")
def price_ratios(spark, sf):
    out = _counters(spark, sf)
    cols = []
    for c in _RATIOS:
        cols += [F.col(f"bad_{c}"), x4(f"lo_{c}", f"lo_{c}"), x4(f"hi_{c}", f"hi_{c}")]
    return out.select(*cols)


# Text gate: every document's fields against its edited form; the source name is never translated.
def _doc_pairs(spark, sf):
    from costweave.plans.views import text_pairs

    tp = text_pairs(spark, sf)
    short = F.concat("lang", F.lit(" "), F.col("source"))
    return tp.select(
        F.struct(F.col("src").alias("text"), short.alias("label"), F.col("source").alias("code")).alias("s"),
        F.struct(F.col("tgt").alias("text"),
                 F.when(F.col("lang") == "en", short).otherwise(F.concat(F.lit("x"), short)).alias("label"),
                 F.upper("source").alias("code")).alias("t"))


_DOC_PAIRS = """, long AS (
  SELECT 'text' AS col, src, tgt FROM text_pair
  UNION ALL SELECT 'label', lang || ' ' || source, CASE WHEN lang = 'en' THEN lang || ' ' || source ELSE 'x' || lang || ' ' || source END FROM text_pair
  UNION ALL SELECT 'code', source, upper(source) FROM text_pair),
by_col AS (SELECT col, CAST(count(*) AS BIGINT) AS total, count(*) FILTER (src = tgt AND NOT p) AS untranslated
  FROM (SELECT col, src, tgt, (""" + PASSTHROUGH + """) AS p FROM (SELECT *, tgt AS w FROM long WHERE length(tgt) > 0)) GROUP BY 1)"""


def _text_pair_ctes() -> str:
    from costweave.plans.views import TEXT_PAIR

    return with_ctes(TEXT_PAIR) + _DOC_PAIRS


@query("q7_untranslated_by_column", _text_pair_ctes() + "SELECT col, total, untranslated FROM by_col")
def untranslated(spark, sf):
    return G.untranslated_by_column(_doc_pairs(spark, sf), ["text", "label", "code"])


@query("q7_translation_completeness", _text_pair_ctes() + """
SELECT 'translation_completeness' AS name, sum(untranslated) * 100.0 / sum(total) < 0.5 AS passed,
       'untranslated=' || CAST(sum(untranslated) AS BIGINT) || ' of ' || CAST(sum(total) AS BIGINT) AS detail FROM by_col""")
def completeness(spark, sf):
    return G.translation_complete(G.untranslated_by_column(_doc_pairs(spark, sf), ["text", "label", "code"]))


@query("w12_worst_columns", _text_pair_ctes() + """
SELECT string_agg(col || '=' || untranslated || '/' || total, ', ' ORDER BY untranslated DESC, col) AS worst FROM (
  SELECT * FROM by_col WHERE untranslated > 0 ORDER BY untranslated DESC, col LIMIT 5)""")
def worst(spark, sf):
    top = G.worst_columns(G.untranslated_by_column(_doc_pairs(spark, sf), ["text", "label", "code"]))
    text = F.concat(F.col("col"), F.lit("="), F.col("untranslated").cast("string"), F.lit("/"), F.col("total").cast("string"))
    ranked = F.array_sort(F.collect_list(F.struct((-F.col("untranslated")).alias("o"), F.col("col"), text.alias("t"))))
    return top.agg(F.array_join(F.transform(ranked, lambda r: r["t"]), ", ").alias("worst"))


@query("q8_vector_count", """
SELECT 'embedding_count' AS name, (SELECT count(*) FROM embeddings) = (SELECT count(*) FROM part) AS passed,
       'vectors=' || (SELECT count(*) FROM embeddings) || ' expected=' || (SELECT count(*) FROM part) AS detail
UNION ALL SELECT 'embedding_count', (SELECT count(*) FROM embeddings) = (SELECT count(DISTINCT p_brand) FROM part),
       'vectors=' || (SELECT count(*) FROM embeddings) || ' expected=' || (SELECT count(DISTINCT p_brand) FROM part)""")
def vector_gate(spark, sf):
    v, p = table(spark, sf, "embeddings"), table(spark, sf, "part")
    return G.vector_count(v, p).unionByName(G.vector_count(v, p, "p_brand"))


@query("q9_gate_results", _PAIRED + f"""
SELECT 'code_stability' AS name, m = 0 AS passed, 'missing=' || m || ' extra=0' AS detail
FROM (SELECT (SELECT count(*) FROM (SELECT resource_code FROM wi WHERE resource_code IS NOT NULL EXCEPT SELECT resource_code FROM damaged))
           + (SELECT count(*) FROM (SELECT rate_code FROM wi EXCEPT SELECT rate_code FROM damaged)) AS m)
UNION ALL SELECT 'currency_consistency', true, 'rows=' || count(*) || ' other=0' FROM damaged
UNION ALL SELECT 'norms_immutability', count(*) FILTER (in_s) = count(*) FILTER (in_t) AND count(*) FILTER (in_s AND in_t AND (tq IS DISTINCT FROM sq)) = 0,
  'rows source=' || count(*) FILTER (in_s) || ' target=' || count(*) FILTER (in_t) || ' changed cells=' || (count(*) FILTER (in_s AND in_t AND tq IS DISTINCT FROM sq) + count(*) FILTER (in_s AND in_t AND th IS DISTINCT FROM sh)) FROM pairs
UNION ALL SELECT 'no_nan_in_prices', count(*) FILTER (in_s AND in_t AND ((tp IS NULL AND sp IS NOT NULL) OR (tc IS NULL AND sc IS NOT NULL))) = 0,
  'new nulls=' || (count(*) FILTER (in_s AND in_t AND tp IS NULL AND sp IS NOT NULL) + count(*) FILTER (in_s AND in_t AND tc IS NULL AND sc IS NOT NULL)) FROM pairs
UNION ALL SELECT 'sanity_ranges', count(*) FILTER (bad) = 0, 'out of range=' || count(*) FILTER (bad) FROM (
  SELECT in_s AND in_t AND sc > 0 AND (tc / (sc * {EQUIPMENT}) < 0.01 OR tc / (sc * {EQUIPMENT}) > 100) AS bad FROM pairs)
UNION ALL SELECT 'translation_completeness', true, 'skipped'""")
def gate_results(spark, sf):
    source, target = work_items(spark, sf).select(*PAIR_COLS), damaged_track(spark, sf)
    return G.run_gates(source, target, "USD", EQUIPMENT, skip=["translation_completeness"])


@query("q9_gates_on_clean_track", with_ctes(WI) + """
SELECT unnest(['code_stability', 'currency_consistency', 'norms_immutability', 'no_nan_in_prices', 'sanity_ranges', 'translation_completeness']) AS name,
       true AS passed, count(*) AS rows FROM wi""")
def clean_gates(spark, sf):
    source = work_items(spark, sf).select(*PAIR_COLS)
    from costweave.operators.pricing import reprice

    target = reprice(work_items(spark, sf), 1.84, 1.27, 1.09, "USD", 0.95).select(*PAIR_COLS)
    out = G.run_gates(source, target, "USD", EQUIPMENT, skip=["translation_completeness"])
    total = source.agg(F.count(F.lit(1))).scalar()
    return out.select("name", "passed", total.alias("rows"))


@query("q10_missing_outputs", """
SELECT p_partkey AS track FROM part WHERE p_partkey NOT IN (SELECT l_partkey FROM lineitem WHERE l_quantity >= 48)""")
def missing_outputs(spark, sf):
    # parts as tracks; a track's output is its large line items
    expected = table(spark, sf, "part").select(F.col("p_partkey").alias("track"))
    actual = table(spark, sf, "lineitem").filter("l_quantity >= 48").select(F.col("l_partkey").alias("track"))
    return G.missing_outputs(expected, actual)
