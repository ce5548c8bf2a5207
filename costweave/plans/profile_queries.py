"""Queries for filters, profiling and ordering over work items."""

from __future__ import annotations

from pyspark.sql import functions as F

from costweave.operators import filters as FL
from costweave.operators import ordering as O
from costweave.operators import profile as PR
from costweave.operators.catalog import (
    cost_of_codes, distinct_in_order, max_cost_per_rate, resource_cost_by_rate, type_label,
)
from costweave.functions.numeric import fixed, to_double
from costweave.operators.quantiles import exact_quantiles
from costweave.plans.registry import query
from costweave.plans.views import TEXTS, WI, s4, table, texts, with_ctes, work_items, x4


def cnt():
    return F.count(F.lit(1)).alias("n")


# ---- filters ----------------------------------------------------------------------------------------


@query("f1_substring_filter", "SELECT p_partkey, p_name FROM part WHERE coalesce(instr(lower(p_name), 'ring'), 0) > 0")
def substring_filter(spark, sf):
    return table(spark, sf, "part").filter(FL.contains_text("p_name", "Ring")).select("p_partkey", "p_name")


@query("f2_exact_filter", with_ctes(WI) + """
SELECT rate_code, count(*) AS n FROM wi WHERE department_name = '2-HIGH' AND rate_unit = 'm3' GROUP BY 1""")
def exact_filter(spark, sf):
    wi = work_items(spark, sf).filter(FL.criteria(department="2-HIGH", unit="m3"))
    return wi.groupBy("rate_code").agg(cnt())


@query("f3_range_filter", """
SELECT 'both' AS bounds, count(*) AS n FROM orders WHERE o_totalprice BETWEEN 10000 AND 50000
UNION ALL SELECT 'low', count(*) FROM orders WHERE o_totalprice >= 50000
UNION ALL SELECT 'high', count(*) FROM orders WHERE o_totalprice <= 10000
UNION ALL SELECT 'none', count(*) FROM orders""")
def range_filter(spark, sf):
    o = table(spark, sf, "orders")
    bounds = {"both": (10_000, 50_000), "low": (50_000, None), "high": (None, 10_000), "none": (None, None)}
    counts = [F.count_if(FL.in_range("o_totalprice", *b)).alias(k) for k, b in bounds.items()]
    pairs = [F.struct(F.lit(k).alias("bounds"), F.col(k).alias("n")) for k in bounds]
    return o.agg(*counts).select(F.inline(F.array(*pairs)))


@query("f4_flag_filter", with_ctes(WI) + """
SELECT department_name, count(*) FILTER (is_material) AS material, count(*) FILTER (is_machine) AS machine FROM wi GROUP BY 1""")
def flag_filter(spark, sf):
    return work_items(spark, sf).groupBy("department_name").agg(
        F.count_if(FL.criteria(is_material=True)).alias("material"),
        F.count_if(FL.criteria(is_machine=True)).alias("machine"))


@query("f5_combined_filter", with_ctes(WI) + """
SELECT rate_code, resource_code, resource_cost FROM wi
WHERE department_name = '1-URGENT' AND total_cost_per_position >= 100000 AND total_cost_per_position <= 300000 AND is_material""")
def combined_filter(spark, sf):
    cond = FL.criteria(department="1-URGENT", min_cost=100_000, max_cost=300_000, is_material=True)
    return work_items(spark, sf).filter(cond).select("rate_code", "resource_code", "resource_cost")


@query("f6_token_filter", r"""
SELECT doc_id, lang FROM documents
WHERE list_contains(string_split_regex(lower(text), '[^\p{L}\p{Nd}]+'), 'the')
  AND list_contains(string_split_regex(lower(text), '[^\p{L}\p{Nd}]+'), 'with')""")
def token_filter(spark, sf):
    return table(spark, sf, "documents").filter(FL.has_all_tokens("text", "The with")).select("doc_id", "lang")


REQUESTS = """requests AS (SELECT c_custkey AS request_id, CASE c_nationkey % 5 WHEN 0 THEN '1-URGENT' WHEN 1 THEN '2-HIGH'
    WHEN 2 THEN '3-MEDIUM' WHEN 3 THEN '4-NOT SPECIFIED' ELSE '5-LOW' END AS department_name,
    CASE WHEN c_acctbal > 0 THEN c_acctbal * 20 END AS min_cost, CASE WHEN c_nationkey <> 7 THEN 150000.0::DOUBLE END AS max_cost,
    CASE WHEN c_mktsegment = 'BUILDING' THEN 3 END AS lim FROM customer)"""


@query("f7_search_requests", with_ctes(REQUESTS) + f"""
SELECT request_id, CAST(row_number() OVER (PARTITION BY request_id ORDER BY o_totalprice, o_orderkey) AS BIGINT) AS rank,
       o_orderkey, {s4('o_totalprice', 'cost')}
FROM requests r JOIN orders o ON o_orderpriority = department_name
 AND o_totalprice >= coalesce(min_cost, 0) AND o_totalprice <= coalesce(max_cost, 1e12)
QUALIFY row_number() OVER (PARTITION BY request_id ORDER BY o_totalprice, o_orderkey) <= coalesce(lim, 5)""")
def search_requests(spark, sf):
    items = table(spark, sf, "orders").select(
        "o_orderkey", F.col("o_orderpriority").alias("department_name"), "o_totalprice")
    nation = F.col("c_nationkey") % 5
    requests = table(spark, sf, "customer").select(
        F.col("c_custkey").alias("request_id"),
        F.when(nation == 0, "1-URGENT").when(nation == 1, "2-HIGH").when(nation == 2, "3-MEDIUM")
        .when(nation == 3, "4-NOT SPECIFIED").otherwise("5-LOW").alias("department_name"),
        F.when(F.col("c_acctbal") > 0, F.col("c_acctbal") * 20).alias("min_cost"),
        F.when(F.col("c_nationkey") != 7, 150_000.0).alias("max_cost"),
        F.when(F.col("c_mktsegment") == "BUILDING", 3).alias("limit"))
    out = FL.answer_requests(items, requests, "o_orderkey", ["department_name"], "o_totalprice")
    return out.select("request_id", "rank", "o_orderkey", x4("o_totalprice", "cost"))


@query("f8_outlier_clip", with_ctes(WI) + f"""
SELECT department_name, count(*) AS n, {s4('max(h)', 'highest')} FROM (SELECT department_name, labor_hours_construction_workers AS h FROM wi)
WHERE h > 0 AND h <= (SELECT quantile_cont(labor_hours_construction_workers, 0.95) FROM wi WHERE labor_hours_construction_workers > 0)
GROUP BY 1""")
def outlier_clip(spark, sf):
    h = "labor_hours_construction_workers"
    return FL.clip_to_quantile(work_items(spark, sf), h).groupBy("department_name").agg(cnt(), x4(F.max(h), "highest"))


@query("f9_rows_of_top_groups", with_ctes(WI) + f"""
SELECT collection_name, resource_unit, count(*) AS n, {s4('sum(resource_cost)', 'cost')} FROM wi
WHERE resource_unit IN (SELECT resource_unit FROM wi GROUP BY 1 ORDER BY count(*) DESC, 1 LIMIT 4) GROUP BY 1, 2""")
def rows_of_top_groups(spark, sf):
    wi = work_items(spark, sf)
    kept = FL.keep_keys(wi, O.top_groups(wi, "resource_unit", 4), ["resource_unit"])
    return kept.groupBy("collection_name", "resource_unit").agg(cnt(), x4(F.sum("resource_cost"), "cost"))


@query("f10_non_empty_texts", """
SELECT doc_id, lang FROM documents WHERE length(trim(text)) > 0
UNION ALL SELECT -1 - conv_id, role FROM conversations WHERE length(trim(replace(text, ' ', ''))) > 0""")
def non_empty_texts(spark, sf):
    d = table(spark, sf, "documents").filter(FL.not_blank("text")).select("doc_id", "lang")
    c = table(spark, sf, "conversations").filter(FL.not_blank("text")).select(
        (-1 - F.col("conv_id")).alias("doc_id"), F.col("role").alias("lang"))
    return d.unionByName(c)


@query("f11_payload", with_ctes(WI) + """
SELECT rate_code, l_partkey, CAST((resource_code IS NOT NULL)::INT + (resource_name IS NOT NULL)::INT + 2 AS INTEGER) AS n_fields,
       concat_ws(';', 'resource_code=' || resource_code, 'resource_name=' || resource_name, 'resource_unit=' || resource_unit,
                 'rate_unit=' || rate_unit) AS fields FROM wi""")
def payloads(spark, sf):
    wi = work_items(spark, sf).withColumn(
        "p", FL.payload(["resource_code", "resource_name", "resource_unit", "rate_unit"]))
    fields = F.array_join(F.transform(F.map_entries("p"), lambda e: F.concat_ws("=", e["key"], e["value"])), ";")
    return wi.select("rate_code", "l_partkey", F.size("p").alias("n_fields"), fields.alias("fields"))


@query("f13_pending_tracks", with_ctes("""done AS (
  SELECT n_name, count(DISTINCT s_suppkey) AS sup, count(DISTINCT c_custkey) AS cus, count(DISTINCT s_suppkey) FILTER (s_acctbal < 0) AS neg
  FROM nation JOIN supplier ON s_nationkey = n_nationkey JOIN customer ON c_nationkey = n_nationkey GROUP BY 1)""") + """
SELECT n_name AS region FROM nation WHERE n_name NOT IN (SELECT n_name FROM done WHERE neg = 0 AND sup >= 4)""")
def pending(spark, sf):
    # nations as tracks; negative balances stand for flagged strings, suppliers for points
    n, s = table(spark, sf, "nation"), table(spark, sf, "supplier")
    summary = (
        n.join(s, F.col("s_nationkey") == F.col("n_nationkey")).groupBy(F.col("n_name").alias("region"))
        .agg(F.count_if(F.col("s_acctbal") < 0).alias("flagged_count"), F.count(F.lit(1)).alias("n_points"))
        .withColumn("n_rates", F.greatest("n_points", F.lit(4)))
    )
    return FL.pending_tracks(n.select(F.col("n_name").alias("region")), summary)


@query("f14_physical_elements", r"""
SELECT p_type, count(*) AS n FROM (
  SELECT p_type, CASE WHEN p_name LIKE 'small%' THEN 'Text Notes: ' || p_name WHEN p_name LIKE '%ring' THEN p_name || ' GRID 4'
         WHEN p_name LIKE '%bolt' THEN 'reviewed ' || p_name ELSE p_name END AS category FROM part)
WHERE category NOT LIKE '% GRID %' AND category NOT LIKE 'Text Notes%' GROUP BY 1""")
def physical(spark, sf):
    name = F.col("p_name")
    category = (
        F.when(name.startswith("small"), F.concat(F.lit("Text Notes: "), name))
        .when(name.endswith("ring"), F.concat(name, F.lit(" GRID 4")))
        .when(name.endswith("bolt"), F.concat(F.lit("reviewed "), name)).otherwise(name)
    )
    parts = table(spark, sf, "part").withColumn("category", category)
    return FL.physical_elements(parts, "category").groupBy("p_type").agg(cnt())


@query("f15_display_name", with_ctes(WI) + "SELECT coalesce(resource_name, rate_final_name) AS name, count(*) AS n FROM wi GROUP BY 1")
def display(spark, sf):
    return work_items(spark, sf).groupBy(FL.display_name("resource_name", "rate_final_name").alias("name")).agg(cnt())


@query("f16_context_lines", """
SELECT p_partkey, row_number() OVER (PARTITION BY p_brand ORDER BY p_retailprice DESC, p_partkey) || '. Name: ' || p_name ||
  CASE WHEN p_size > 10 THEN ' | Unit: ' || p_type ELSE '' END || ' | Score: 0.' || (100 + p_size) AS line
FROM part""")
def context(spark, sf):
    from pyspark.sql import Window as W

    w = W.partitionBy("p_brand").orderBy(F.col("p_retailprice").desc(), "p_partkey")
    parts = table(spark, sf, "part").withColumns({
        "rank": F.row_number().over(w), "unit": F.when(F.col("p_size") > 10, F.col("p_type")),
        "score": (F.col("p_size") + 100) / 1000.0})
    line = FL.context_lines(parts, [("p_name", "Name"), ("unit", "Unit")], "score", "rank")
    return parts.select("p_partkey", line.alias("line"))


# ---- aggregations -------------------------------------------------------------------------------------

@query("a2_type_label", with_ctes(WI) + """
SELECT resource_code, CASE WHEN bool_or(is_labor) THEN 'Labour' WHEN bool_or(is_material) THEN 'Material'
       WHEN bool_or(is_machine) THEN 'Equipment' ELSE 'Other' END AS type FROM wi GROUP BY 1""")
def labels(spark, sf):
    return work_items(spark, sf).groupBy("resource_code").agg(type_label().alias("type"))


@query("a3_overview", with_ctes(WI) + """
SELECT count(*) AS rows, CAST(22 AS BIGINT) AS columns, count(DISTINCT department_name) AS distinct_department_name,
       count(DISTINCT rate_code) AS distinct_rate_code, count(DISTINCT resource_name) AS distinct_resource_name FROM wi""")
def data_overview(spark, sf):
    return PR.overview(work_items(spark, sf), ["department_name", "rate_code", "resource_name"])


_NUM = ["total_cost_per_position", "resource_cost", "resource_quantity", "labor_hours_construction_workers"]


@query("a4_numeric_summary", with_ctes(WI) + " UNION ALL ".join(f"""
SELECT '{c}' AS col, count({c}) AS count, {s4(f'avg({c})', 'mean')}, {s4(f'median({c})', 'median')}, {s4(f'min({c})', 'min')},
       {s4(f'max({c})', 'max')}, {s4(f'stddev_samp({c})', 'std')} FROM wi""" for c in _NUM))
def summary(spark, sf):
    out = PR.numeric_summary(work_items(spark, sf), _NUM)
    return out.select("col", "count", *[x4(c, c) for c in ["mean", "median", "min", "max", "std"]])


_PROFILE = {"rate_code": "string", "resource_code": "string", "resource_name": "string", "resource_unit": "string",
            "is_labor": "boolean", "is_material": "boolean", "resource_quantity": "double", "resource_cost": "double"}


def _profile_sql() -> str:
    parts = []
    for c, t in _PROFILE.items():
        num, boo, txt = t == "double", t == "boolean", t == "string"
        none_d, none_l = "CAST(NULL AS DOUBLE)", "CAST(NULL AS BIGINT)"
        parts.append(f"""SELECT '{c}' AS col, '{t}' AS dtype, count(*) - count({c}) AS nulls,
  {s4(f'(count(*) - count({c})) * 100.0::DOUBLE / count(*)', 'null_pct')},
  {s4(f'min({c})') if num else none_d} AS min, {s4(f'max({c})') if num else none_d} AS max, {s4(f'avg({c})') if num else none_d} AS mean,
  {f'count(*) FILTER ({c})' if boo else none_l} AS n_true, {f'count(*) FILTER (NOT {c})' if boo else none_l} AS n_false,
  {f'count(DISTINCT {c})' if txt else none_l} AS "distinct",
  {f"(SELECT string_agg(v, ', ' ORDER BY v) FROM (SELECT DISTINCT {c} AS v FROM wi WHERE {c} IS NOT NULL ORDER BY 1 LIMIT 3))" if txt else 'CAST(NULL AS VARCHAR)'} AS samples
  FROM wi""")
    return " UNION ALL ".join(parts)


def _profile(spark, sf):
    out = PR.column_profile(work_items(spark, sf).select(*_PROFILE))
    rounded = {c: x4(c, c) for c in ["null_pct", "min", "max", "mean"]}
    return out.select(*[rounded.get(c, F.col(c)) for c in out.columns])


@query("a5_column_profile", with_ctes(WI) + _profile_sql())
def profile(spark, sf):
    return _profile(spark, sf)


@query("a6_null_summary", with_ctes(WI) + "SELECT col, nulls, null_pct, null_pct > 5 AS mostly_null FROM (" + _profile_sql() + ") WHERE nulls > 0")
def nulls(spark, sf):
    return PR.null_summary(_profile(spark, sf), 5.0)


@query("a7_value_counts", with_ctes(WI) + "SELECT resource_name, count(*) AS n FROM wi WHERE resource_name IS NOT NULL GROUP BY 1")
def counts(spark, sf):
    return PR.value_counts(work_items(spark, sf), "resource_name")


@query("a8_breakdown", with_ctes(WI) + f"SELECT resource_name, count(*) AS n, {s4('avg(resource_cost)', 'avg_cost')} FROM wi GROUP BY 1")
def breakdown(spark, sf):
    return PR.breakdown(work_items(spark, sf), "resource_name", "resource_cost").select(
        "resource_name", "n", x4("avg_cost", "avg_cost"))


@query("a9_box_stats", with_ctes(WI) + f""", top AS (SELECT resource_unit FROM wi WHERE resource_cost IS NOT NULL GROUP BY 1 ORDER BY count(*) DESC, 1 LIMIT 15),
q AS (SELECT resource_unit, quantile_cont(resource_cost, 0.25) AS q1, quantile_cont(resource_cost, 0.5) AS median, quantile_cont(resource_cost, 0.75) AS q3
      FROM wi WHERE resource_unit IN (FROM top) GROUP BY 1)
SELECT resource_unit, {s4('q1', 'q1')}, {s4('median', 'median')}, {s4('q3', 'q3')},
       {s4('min(resource_cost) FILTER (resource_cost >= q1 - 1.5::DOUBLE * (q3 - q1))', 'whisker_low')},
       {s4('max(resource_cost) FILTER (resource_cost <= q3 + 1.5::DOUBLE * (q3 - q1))', 'whisker_high')}, count(*) AS n
FROM wi JOIN q USING (resource_unit) GROUP BY 1, q1, median, q3""")
def boxes(spark, sf):
    out = PR.box_stats(work_items(spark, sf), "resource_unit", "resource_cost")
    return out.select("resource_unit", *[x4(c, c) for c in ["q1", "median", "q3", "whisker_low", "whisker_high"]], "n")


@query("a10_max_cost_per_rate", with_ctes(WI) + f"""
SELECT rate_code, {s4('max(resource_cost)', 'resource_cost')}, arg_min(resource_name, ord) FILTER (resource_name IS NOT NULL) AS resource_name
FROM wi GROUP BY 1""")
def max_cost(spark, sf):
    out = max_cost_per_rate(work_items(spark, sf), "resource_cost", "resource_name")
    return out.select("rate_code", x4("resource_cost", "resource_cost"), "resource_name")


@query("a11_utilisation", with_ctes(WI) + f"""
SELECT resource_name, count(*) AS usage_count, {s4('avg(resource_quantity)', 'avg_quantity')}, {s4('avg(resource_price_per_unit_current)', 'avg_price')}
FROM wi WHERE resource_name IS NOT NULL GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 20""")
def usage(spark, sf):
    return PR.utilisation(work_items(spark, sf)).select(
        "resource_name", "usage_count", x4("avg_quantity", "avg_quantity"), x4("avg_price", "avg_price"))


@query("a12_histogram", f"""
WITH s AS (SELECT min(o_totalprice) AS lo, max(o_totalprice) AS hi FROM orders)
SELECT CAST(least(floor((o_totalprice - lo) * 50 / (hi - lo)), 49) AS INTEGER) AS bin, count(*) AS n,
       {s4('min(lo) + (min(hi) - min(lo)) * least(floor((min(o_totalprice) - min(lo)) * 50 / (min(hi) - min(lo))), 49) / 50', 'left_edge')}
FROM orders, s GROUP BY 1""")
def hist(spark, sf):
    return PR.histogram(table(spark, sf, "orders"), "o_totalprice").select("bin", "n", x4("left_edge", "left_edge"))


@query("a13_log_histogram", f"""
WITH v AS (SELECT log10(o_totalprice) AS x FROM orders WHERE o_totalprice > 0), s AS (SELECT min(x) AS lo, max(x) AS hi, count(*) AS total FROM v)
SELECT CAST(least(floor((x - lo) * 30 / (hi - lo)), 29) AS INTEGER) AS bin, count(*) AS n,
       {s4('count(*) / (min(total) * (min(hi) - min(lo)) / 30)', 'density')} FROM v, s GROUP BY 1""")
def log_hist(spark, sf):
    return PR.log_histogram(table(spark, sf, "orders"), "o_totalprice").select("bin", "n", x4("density", "density"))


@query("a14_section_means", with_ctes(WI) + f"""
SELECT rate_code, count(*) AS n, {s4('avg(resource_cost)', 'avg_cost')} FROM wi GROUP BY 1 HAVING count(*) >= 2""")
def sections(spark, sf):
    return PR.section_means(work_items(spark, sf), "rate_code", "resource_cost").select(
        "rate_code", "n", x4("avg_cost", "avg_cost"))


@query("a15_distinct_in_order", with_ctes(WI) + """
SELECT rate_code, string_agg(resource_name, '|' ORDER BY first_ord) AS resource_names
FROM (SELECT rate_code, resource_name, min(ord) AS first_ord FROM wi WHERE resource_name IS NOT NULL GROUP BY 1, 2) GROUP BY 1""")
def names_in_order(spark, sf):
    out = distinct_in_order(work_items(spark, sf), "rate_code", "resource_name")
    return out.select("rate_code", F.array_join("resource_name", "|").alias("resource_names"))


@query("a21_language_stats", """
SELECT lang, count(*) AS items, CAST(0 AS INTEGER) AS is_total FROM documents GROUP BY 1
UNION ALL SELECT NULL, count(*), 1 FROM documents""")
def languages(spark, sf):
    return PR.language_stats(table(spark, sf, "documents"), "lang")


@query("e7_resource_based_cost", with_ctes(WI) + f"""
SELECT rate_code, {s4("coalesce(sum(a) FILTER (kind = 'l'), 0)", 'labour_cost')}, {s4("coalesce(sum(a) FILTER (kind = 'm'), 0)", 'material_cost')},
       {s4("coalesce(sum(a) FILTER (kind = 'e'), 0)", 'equipment_cost')}, {s4('coalesce(sum(a), 0)', 'resource_sum')}, {s4('min(t)', 'stored_total')}
FROM (SELECT rate_code, resource_quantity * resource_price_per_unit_current AS a, total_cost_per_position AS t,
      CASE WHEN is_labor IS TRUE THEN 'l' WHEN is_material THEN 'm' ELSE 'e' END AS kind FROM wi) GROUP BY 1""")
def resource_based(spark, sf):
    out = resource_cost_by_rate(work_items(spark, sf))
    return out.select("rate_code", *[x4(c, c) for c in out.columns if c != "rate_code"])


@query("j14_cost_of_codes", with_ctes(WI) + f"""
SELECT rate_code, {s4('u', 'unit_price')}, {s4('u * q', 'amount')}
FROM (SELECT rate_code, arg_min(resource_price_per_unit_current, ord) AS u FROM wi GROUP BY 1)
JOIN (SELECT 'R' || o_orderkey AS rate_code, 1 + o_custkey % 9 AS q FROM orders) USING (rate_code)""")
def code_costs(spark, sf):
    codes = table(spark, sf, "orders").select(
        F.concat(F.lit("R"), F.col("o_orderkey").cast("string")).alias("rate_code"),
        (1 + F.col("o_custkey") % 9).alias("quantity"))
    out = cost_of_codes(work_items(spark, sf), codes, "resource_price_per_unit_current")
    return out.select("rate_code", x4("unit_price", "unit_price"), x4("amount", "amount"))


# ---- ordering ----------------------------------------------------------------------------------------

@query("w1_first_row_per_rate", with_ctes(WI) + f"""
SELECT rate_code, resource_code, resource_name, {s4('resource_cost', 'resource_cost')} FROM wi
QUALIFY row_number() OVER (PARTITION BY rate_code ORDER BY ord) = 1""")
def first_rows(spark, sf):
    out = O.first_row(work_items(spark, sf), ["rate_code"], "ord", ["resource_code", "resource_name", "resource_cost"])
    return out.select("rate_code", "resource_code", "resource_name", x4("resource_cost", "resource_cost"))


@query("w2_global_top_n", f"SELECT o_orderkey, {s4('o_totalprice', 'cost')} FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 25")
def global_top(spark, sf):
    return O.top_n(table(spark, sf, "orders"), "o_totalprice", 25, ["o_orderkey"]).select(
        "o_orderkey", x4("o_totalprice", "cost"))


@query("w3_top_groups", with_ctes(WI) + "SELECT resource_name, count(*) AS n FROM wi WHERE resource_name IS NOT NULL GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 15")
def groups(spark, sf):
    return O.top_groups(work_items(spark, sf), "resource_name", 15)


@query("w4_top_with_ties", """
SELECT l_orderkey, l_linenumber, l_quantity FROM lineitem QUALIFY rank() OVER (ORDER BY l_quantity DESC) <= 15""")
def with_ties(spark, sf):
    return O.top_with_ties(table(spark, sf, "lineitem"), "l_quantity", 15).select(
        "l_orderkey", "l_linenumber", "l_quantity")


@query("w8_seeded_sample", "SELECT o_orderkey, o_totalprice FROM orders ORDER BY sha1('42|' || o_orderkey), o_orderkey LIMIT 5000")
def sample(spark, sf):
    docs = table(spark, sf, "orders").select("o_orderkey", "o_totalprice")
    return O.seeded_sample(docs, 5000, ["o_orderkey"])


@query("w9_batch_numbers", """
SELECT doc_id, CAST(floor((rn - 1) / 25) AS BIGINT) AS batch, (rn - 1) % 25 AS slot
FROM (SELECT doc_id, row_number() OVER (ORDER BY n_chars DESC, doc_id) AS rn FROM documents)""")
def batch_numbers(spark, sf):
    docs = table(spark, sf, "documents").select("doc_id", "n_chars")
    out = O.batches(docs, 25, [F.col("n_chars").desc(), "doc_id"], block=F.floor(-F.col("n_chars") / 256))
    return out.select("doc_id", "batch", "slot")


@query("w10_keyset_page", "SELECT doc_id, lang, n_chars FROM documents WHERE doc_id > 100 ORDER BY doc_id LIMIT 50")
def page(spark, sf):
    return O.page_after(table(spark, sf, "documents"), "doc_id", 100, 50).select("doc_id", "lang", "n_chars")


@query("x12_upper_median", f"""
SELECT l_suppkey, {s4('list_sort(list(l_extendedprice))[CAST(floor(count(*) / 2.0) AS BIGINT) + 1]', 'upper_median')}
FROM lineitem GROUP BY 1""")
def upper_medians(spark, sf):
    return exact_quantiles(table(spark, sf, "lineitem"), ["l_suppkey"], "l_extendedprice", {}, "m").select(
        "l_suppkey", x4("m", "upper_median"))


@query("x16_numeric_coercion", r"""
SELECT w AS word, TRY_CAST(w AS DOUBLE) AS number, count(*) AS n FROM (
  SELECT unnest(string_split_regex(text, '[^0-9.]+')) AS w FROM documents) GROUP BY 1, 2""")
def coercion(spark, sf):
    words = table(spark, sf, "documents").select(F.explode(F.split("text", "[^0-9.]+")).alias("word"))
    return words.groupBy("word").agg(cnt()).select("word", to_double("word").alias("number"), "n")
