"""Queries for vector search, estimates and their checks."""

from __future__ import annotations

from pyspark.sql import functions as F

from costweave.operators import estimate as E
from costweave.operators import search as SE
from costweave.operators.catalog import resource_demand
from costweave.operators.quantiles import exact_quantiles
from costweave.plans.registry import query
from costweave.plans.views import WI, WI_TRACKS, s4, table, with_ctes, work_items, work_items_by_track, x4


def cnt():
    return F.count(F.lit(1)).alias("n")



# ---- vectors with payload: every embedding, priced by the part of the same number ------------------------

def corpus(spark, sf):
    e, p = table(spark, sf, "embeddings"), table(spark, sf, "part")
    return e.join(p, F.col("vec_id") == F.col("p_partkey"), "left").select(
        F.col("vec_id").alias("id"), F.col("embedding").alias("vector"), "label", "p_name", "p_brand", "p_type", "p_size",
        F.col("p_retailprice").alias("price"))


CORPUS = """corpus AS (SELECT vec_id AS id, embedding::DOUBLE[] AS v, label, p_name, p_brand, p_type, p_size, p_retailprice AS price
  FROM embeddings LEFT JOIN part ON vec_id = p_partkey)"""
CENTROID = """centre AS (SELECT list(x ORDER BY i) AS qv FROM (
  SELECT i, avg(x) AS x FROM (SELECT unnest(embedding::DOUBLE[]) AS x, generate_subscripts(embedding, 1) AS i FROM embeddings) GROUP BY i))"""


def centre(spark, sf):
    return SE.centroid(table(spark, sf, "embeddings"), "embedding").scalar()


# Every embedding with a part is a line to be priced by the other vectors.
HITS = """hits AS (SELECT a.vec_id AS qid, c.id, list_cosine_similarity(a.embedding::DOUBLE[], c.v) AS score
  FROM embeddings a JOIN corpus c ON a.vec_id <> c.id),
ranked AS (SELECT *, row_number() OVER (PARTITION BY qid ORDER BY round(score, 12) DESC, id) AS rank FROM hits),
lines AS (SELECT vec_id AS line_id, p_name AS description, p_size::DOUBLE AS quantity, 'pcs' AS unit FROM embeddings JOIN part ON vec_id = p_partkey)"""
_HITS = with_ctes(CORPUS, HITS)


def hits(spark, sf, k):
    return SE.top_k_batch(table(spark, sf, "embeddings"), corpus(spark, sf), k, "vec_id", "embedding", skip_same=True)


def lines(spark, sf):
    e, p = table(spark, sf, "embeddings"), table(spark, sf, "part")
    return e.join(p, F.col("vec_id") == F.col("p_partkey")).select(
        F.col("vec_id").alias("line_id"), F.col("p_name").alias("description"), F.col("p_size").cast("double").alias("quantity"),
        F.lit("pcs").alias("unit"))


@query("x13_cosine", f"""
SELECT a.vec_id, {s4('list_cosine_similarity(a.embedding::DOUBLE[], b.embedding::DOUBLE[]) + 1', 'shifted')}
FROM embeddings a JOIN embeddings b ON b.vec_id = a.vec_id + 1""")
def cosines(spark, sf):
    from costweave.functions.vectors import cosine

    e = table(spark, sf, "embeddings")
    other = e.select((F.col("vec_id") - 1).alias("vec_id"), F.col("embedding").alias("b"))
    return e.join(other, "vec_id").select("vec_id", x4(cosine(F.col("embedding"), F.col("b")) + 1, "shifted"))


@query("v1_top_k", with_ctes(CORPUS, CENTROID) + f"""
SELECT id, label, {s4('list_cosine_similarity(v, qv) + 1', 'shifted')} FROM corpus, centre ORDER BY list_cosine_similarity(v, qv) DESC, id LIMIT 20""")
def top_k(spark, sf):
    out = SE.top_k(corpus(spark, sf), centre(spark, sf), 20)
    return out.select("id", "label", x4(F.col("score") + 1, "shifted"))


@query("v2_filtered_top_k", with_ctes(CORPUS, CENTROID) + f"""
SELECT id, label, {s4('list_cosine_similarity(v, qv) + 1', 'shifted')} FROM corpus, centre WHERE label IN (1, 4) AND price >= 905
ORDER BY list_cosine_similarity(v, qv) DESC, id LIMIT 10""")
def filtered_top_k(spark, sf):
    out = SE.top_k(corpus(spark, sf), centre(spark, sf), 10, where=F.col("label").isin(1, 4) & (F.col("price") >= 905))
    return out.select("id", "label", x4(F.col("score") + 1, "shifted"))


@query("v3_batch_top_k", _HITS + f"SELECT qid, id, CAST(rank AS INTEGER) AS rank, {s4('score + 1', 'shifted')} FROM ranked WHERE rank <= 5")
def batch_top_k(spark, sf):
    return hits(spark, sf, 5).select("qid", "id", "rank", x4(F.col("score") + 1, "shifted"))


@query("v4_score_threshold", with_ctes(CORPUS, CENTROID) + f"""
SELECT id, {s4('s + 1', 'shifted')} FROM (SELECT id, list_cosine_similarity(v, qv) AS s FROM corpus, centre) WHERE s >= 0.2 ORDER BY s DESC, id LIMIT 5""")
def threshold(spark, sf):
    return SE.top_k(corpus(spark, sf), centre(spark, sf), 5, min_score=0.2).select("id", x4(F.col("score") + 1, "shifted"))


_TERMS = {"the": 1.0, "une": 2.0, "der": 1.5, "ring": 3.0}


@query("v5_hybrid_score", with_ctes(CENTROID) + rf""",
w AS (SELECT doc_id, unnest(string_split_regex(lower(text), '[^\p{{L}}]+')) AS w FROM documents),
sp AS (SELECT doc_id, (count(*) FILTER (w = 'the') * 1.0 + count(*) FILTER (w = 'une') * 2.0 + count(*) FILTER (w = 'der') * 1.5
       + count(*) FILTER (w = 'ring') * 3.0)::DOUBLE / count(*) AS s FROM w WHERE length(w) > 0 GROUP BY 1),
f AS (SELECT sp.doc_id, s, coalesce(list_cosine_similarity(embedding::DOUBLE[], qv), 0) AS d FROM sp CROSS JOIN centre LEFT JOIN embeddings ON vec_id = doc_id)
SELECT doc_id, {s4('s', 'sparse_score')}, {s4('0.5 * d + 0.5 * s + 1', 'shifted')} FROM f ORDER BY round(0.5 * d + 0.5 * s, 12) DESC, doc_id LIMIT 50""")
def hybrid(spark, sf):
    d, e = table(spark, sf, "documents"), table(spark, sf, "embeddings")
    rows = SE.token_weights(d, "doc_id", "text").join(e, F.col("doc_id") == F.col("vec_id"), "left").select(
        F.col("doc_id").alias("id"), "sparse", F.col("embedding").alias("vector"))
    out = SE.hybrid_top_k(rows, centre(spark, sf), _TERMS, 50)
    return out.select(F.col("id").alias("doc_id"), x4("sparse_score", "sparse_score"), x4(F.col("score") + 1, "shifted"))


@query("v6_cost_split", with_ctes(CORPUS, CENTROID) + f"""
SELECT id, {s4('100 * l / (l + m + e)', 'labour_pct')}, {s4('100 * m / (l + m + e)', 'material_pct')} FROM (
  SELECT id, price AS l, price * p_size AS m, p_size * 10.0::DOUBLE AS e FROM corpus, centre WHERE price IS NOT NULL
  ORDER BY list_cosine_similarity(v, qv) DESC, id LIMIT 20)""")
def cost_split(spark, sf):
    rows = corpus(spark, sf).filter("price IS NOT NULL").withColumns(
        {"l": F.col("price"), "m": F.col("price") * F.col("p_size"), "e": F.col("p_size") * 10.0})
    out = SE.with_cost_split(SE.search_page(rows, "wall", centre(spark, sf), 20), "l", "m", "e")
    total = F.col("l") + F.col("m") + F.col("e")
    exact = out.select("id", x4(F.col("l") * 100 / total, "labour_pct"), x4(F.col("m") * 100 / total, "material_pct"),
                       (F.abs(F.col("labour_pct") - F.col("l") * 100 / total) <= 0.0501).alias("_near"))
    return exact.filter("_near").drop("_near")


@query("v7_approximate_top_k")
def approximate(spark, sf):
    e = table(spark, sf, "embeddings").select(F.col("vec_id").alias("id"), F.col("embedding").alias("vector"))
    middle = SE.centroid(e).first()["vector"]
    return SE.approximate_top_k(e, middle, 20)


@query("c9_embedded_texts", r"""
WITH w AS (SELECT doc_id, CAST('0x' || substr(md5(w), 1, 7) AS BIGINT) AS h FROM (
  SELECT doc_id, unnest(string_split_regex(lower(text), '\s+')) AS w FROM documents WHERE length(trim(text)) > 0) WHERE w <> ''),
d AS (SELECT doc_id, h % 16 AS place, CAST(sum(CASE WHEN (h // 16) % 2 = 1 THEN 1 ELSE -1 END) AS INTEGER) AS x FROM w GROUP BY 1, 2),
g AS (SELECT doc_id, unnest(range(16)) AS place FROM documents WHERE length(trim(text)) > 0)
SELECT doc_id, string_agg(coalesce(x, 0), ',' ORDER BY place) AS vector FROM g LEFT JOIN d USING (doc_id, place) GROUP BY 1""")
def embedded(spark, sf):
    out = SE.embed_texts(table(spark, sf, "documents"), "doc_id", "text", SE.hash_embedder(16))
    return out.select("doc_id", F.array_join(F.transform("vector", lambda x: x.cast("int").cast("string")), ",").alias("vector"))


@query("c10_vector_upsert", f"""
WITH a AS (SELECT 'p' || vec_id AS id, 0 AS version, label, embedding[1]::DOUBLE AS x FROM embeddings
           UNION ALL SELECT 'p' || (vec_id + 100), 1, label + 100, embedding[2]::DOUBLE FROM embeddings)
SELECT id, label, {s4('x + 10', 'x')} FROM a QUALIFY row_number() OVER (PARTITION BY id ORDER BY version DESC) = 1""")
def vector_upsert(spark, sf):
    e = table(spark, sf, "embeddings")

    def points(shift, place, version):
        return e.select(F.concat(F.lit("p"), (F.col("vec_id") + shift).cast("string")).alias("id"), F.lit(version).alias("version"),
                        (F.col("label") + shift).alias("label"), F.element_at("embedding", place).cast("double").alias("x"))

    first, second = points(0, 1, 0), points(100, 2, 1)
    out = SE.upsert(SE.upsert(first, second), second)
    return out.select("id", "label", x4(F.col("x") + 10, "x"))


# ---- bills of quantities ------------------------------------------------------------------------------------

def best_match(spark, sf, min_score=0.0):
    c = corpus(spark, sf).select("id", "p_name", "price")
    return hits(spark, sf, 1).filter(F.col("score") >= min_score).join(c, "id").select(
        F.col("qid").alias("line_id"), F.concat(F.lit("C"), F.col("id").cast("string")).alias("rate_code"),
        F.col("p_name").alias("rate_name"), F.lit("m2").alias("rate_unit"), F.col("price").alias("unit_rate"))


def priced(spark, sf):
    return E.price_lines(lines(spark, sf), best_match(spark, sf, 0.5), ["line_id"], F.floor(F.col("line_id") / 1000))


PRICED = """priced AS (SELECT l.line_id, row_number() OVER (ORDER BY l.line_id) AS item_no, CASE WHEN r.id IS NULL THEN '' ELSE 'C' || r.id END AS rate_code,
  coalesce(c.p_name, l.description) AS description, CASE WHEN r.id IS NULL THEN l.unit ELSE 'm2' END AS unit, l.quantity,
  coalesce(c.price, 0) AS rate, coalesce(c.price, 0) * l.quantity AS amount, c.p_type, c.p_size
  FROM lines l LEFT JOIN (SELECT * FROM ranked WHERE rank = 1 AND score >= 0.5) r ON r.qid = l.line_id LEFT JOIN corpus c ON c.id = r.id)"""
_PRICED = with_ctes(CORPUS, HITS, PRICED)


@query("e1_priced_boq", _PRICED + f"""
SELECT rate_code, description, unit, {s4('rate', 'rate')}, {s4('amount', 'amount')}, quantity FROM priced
UNION ALL SELECT '', 'TOTAL', '', NULL, {s4('sum(amount)', 'amount')}, NULL FROM priced""")
def priced_boq(spark, sf):
    out = E.with_total_row(priced(spark, sf))
    return out.select("rate_code", "description", "unit", x4("rate", "rate"), x4("amount", "amount"), "quantity")


@query("w11_line_numbers", _PRICED + """
SELECT item_no, line_id, rate_code FROM priced UNION ALL SELECT count(*) + 1, NULL, 'TOTAL' FROM priced""")
def line_numbers(spark, sf):
    rows = priced(spark, sf).select("item_no", "line_id", "rate_code")
    total = rows.agg((F.count(F.lit(1)) + 1).alias("item_no"), F.lit(None).cast("long").alias("line_id"), F.lit("TOTAL").alias("rate_code"))
    return rows.unionByName(total)


_SPLIT = {"material": "m", "labour": "l", "equipment": "e", "total": "t"}


def _split_rows(spark, sf):
    c = corpus(spark, sf).select(
        "id", F.col("p_type").alias("kind"), F.when(F.col("p_size") > 5, F.col("price") * 0.5).alias("m"),
        (F.col("price") * 0.3).alias("l"), (F.col("price") * 0.2).alias("e"), F.col("price").alias("t"))
    best = hits(spark, sf, 1).select(F.col("qid").alias("line_id"), "id").join(c, "id")
    return lines(spark, sf).join(best, "line_id", "left")


SPLIT = """split AS (SELECT l.*, c.p_type AS kind, CASE WHEN c.p_size > 5 THEN c.price * 0.5::DOUBLE END AS m, c.price * 0.3::DOUBLE AS l, c.price * 0.2::DOUBLE AS e, c.price AS t
  FROM lines l LEFT JOIN (SELECT * FROM ranked WHERE rank = 1) r ON r.qid = l.line_id LEFT JOIN corpus c ON c.id = r.id)"""


@query("a17_cost_totals", with_ctes(CORPUS, HITS, SPLIT) + "SELECT kind, " + ", ".join(
    s4(f"coalesce(sum(quantity * coalesce({c}, 0)), 0)", n) for n, c in _SPLIT.items()) + " FROM split GROUP BY 1")
def cost_totals(spark, sf):
    out = E.cost_totals(_split_rows(spark, sf), "quantity", _SPLIT, ["kind"])
    return out.select("kind", *[x4(n, n) for n in _SPLIT])


# Each order is one answer with two items in a fenced JSON array; some fields are left out.
_JSON_SQL = """items AS (
  SELECT o_orderkey, 1 AS item, o_orderpriority AS description, CASE WHEN o_custkey % 5 = 0 THEN 1 ELSE o_custkey % 9 END::DOUBLE AS quantity, 'pcs' AS unit FROM orders
  UNION ALL SELECT o_orderkey, 2, o_orderstatus, 0.5::DOUBLE, CASE WHEN o_orderkey % 4 = 0 THEN 'pcs' ELSE 'm2' END FROM orders)"""


def _json_answers(spark, sf):
    first = F.concat(
        F.lit('{"description": "'), "o_orderpriority", F.lit('"'),
        F.when(F.col("o_custkey") % 5 != 0, F.concat(F.lit(', "quantity": '), (F.col("o_custkey") % 9).cast("string"))).otherwise(""),
        F.lit("}"))
    second = F.concat(
        F.lit('{"quantity": 0.5, "description": "'), "o_orderstatus", F.lit('"'),
        F.when(F.col("o_orderkey") % 4 != 0, F.lit(', "unit": "m2"')).otherwise(""), F.lit("}"))
    return table(spark, sf, "orders").select(
        "o_orderkey", F.concat(F.lit("```json\n["), first, F.lit(",\n"), second, F.lit("]\n```")).alias("raw"))


@query("x17_parsed_work_items", with_ctes(_JSON_SQL) + "SELECT o_orderkey, item, description, quantity, unit FROM items")
def parsed_items(spark, sf):
    return E.parse_work_items(_json_answers(spark, sf), "o_orderkey", "raw")


@query("e2_text_estimate", with_ctes(CORPUS, HITS, SPLIT) + f"""
SELECT line_id, description, {s4('coalesce(t, 0)', 'unit_rate')}, {s4('coalesce(t, 0) * quantity', 'amount')},
       {s4('coalesce(m, 0) * quantity', 'material')}, {s4('coalesce(l, 0) * quantity', 'labour')}, {s4('coalesce(e, 0) * quantity', 'equipment')} FROM split""")
def text_estimate(spark, sf):
    rows = _split_rows(spark, sf)

    def times(c):
        return F.coalesce(c, F.lit(0.0)) * F.col("quantity")

    return rows.select("line_id", "description", x4(F.coalesce("t", F.lit(0.0)), "unit_rate"), x4(times("t"), "amount"),
                       x4(times("m"), "material"), x4(times("l"), "labour"), x4(times("e"), "equipment"))


@query("e3_photo_estimate", with_ctes(CORPUS, HITS, SPLIT) + f"""
SELECT description AS element, kind AS matched_kind, count(*) AS lines, {s4('sum(coalesce(t, 0) * quantity)', 'amount')} FROM split GROUP BY 1, 2""")
def photo_estimate(spark, sf):
    # elements seen on photos are grouped by their name and matched kind
    out = E.cost_totals(_split_rows(spark, sf).withColumnsRenamed({"description": "element", "kind": "matched_kind"}),
                        "quantity", {"amount": "t"}, ["element", "matched_kind"])
    return out.select("element", "matched_kind", "lines", x4("amount", "amount"))


@query("e4_scenario_estimates", _HITS + f"""
SELECT line_id AS scenario_id, {s4('coalesce(list_sort(list(price) FILTER (price IS NOT NULL))[CAST(floor(count(price) / 2.0) AS BIGINT) + 1], 0) * min(quantity)', 'estimate')}, max(n) AS matches
FROM (SELECT line_id, quantity, price, count(*) OVER (PARTITION BY line_id) AS n FROM lines JOIN ranked r ON r.qid = line_id AND rank <= 5 JOIN corpus c ON c.id = r.id)
GROUP BY 1""")
def scenario(spark, sf):
    c = corpus(spark, sf).select("id", F.col("price").alias("unit_cost"))
    found = hits(spark, sf, 5).join(c, "id").withColumnRenamed("qid", "scenario_id")
    out = E.scenario_estimates(lines(spark, sf).withColumnRenamed("line_id", "scenario_id"), found)
    return out.select("scenario_id", x4("estimate", "estimate"), "matches")


# ---- estimates per region and scenario -----------------------------------------------------------------------

def estimates(spark, sf):
    wi = work_items_by_track(spark, sf).withColumn("scenario_id", (F.col("l_partkey") % 30).cast("int"))
    cost = exact_quantiles(wi, ["track", "scenario_id"], "total_cost_per_position", {}, "estimate")
    counts = wi.groupBy("track", "scenario_id").agg(F.count(F.lit(1)).alias("matches"))
    return cost.join(counts, ["track", "scenario_id"])


def ranges(spark, sf):
    wi = work_items_by_track(spark, sf).withColumn("scenario_id", (F.col("l_partkey") % 30).cast("int"))
    mid = exact_quantiles(wi, ["scenario_id"], "total_cost_per_position", {}, "m").filter("scenario_id <> 7")
    tracks = wi.select("track", "scenario_id").distinct()
    return tracks.join(mid, "scenario_id").select("track", "scenario_id", (F.col("m") * 0.95).alias("min"), (F.col("m") * 1.05).alias("max"))


def neighbours(spark, sf):
    """The next two regions by key; the last region has none."""
    r = table(spark, sf, "region").select("r_regionkey", "r_name")
    steps = r.select(F.col("r_name").alias("track"), F.explode(F.array((F.col("r_regionkey") + 1), (F.col("r_regionkey") + 2))).alias("k"))
    return steps.join(r, F.col("k") == F.col("r_regionkey")).select("track", F.col("r_name").alias("neighbour"))


def _upper(c: str) -> str:
    return f"list_sort(list({c}))[CAST(floor(count({c}) / 2.0) AS BIGINT) + 1]"


ESTIMATES = f"""sc AS (SELECT *, CAST(l_partkey % 30 AS INTEGER) AS scenario_id FROM wi_tracks),
est AS (SELECT track, scenario_id, {_upper('total_cost_per_position')} AS estimate, count(*) AS matches FROM sc GROUP BY 1, 2),
mid AS (SELECT scenario_id, {_upper('total_cost_per_position')} AS m FROM sc WHERE scenario_id <> 7 GROUP BY 1),
nb AS (SELECT a.r_name AS track, b.r_name AS neighbour FROM region a JOIN region b ON b.r_regionkey IN (a.r_regionkey + 1, a.r_regionkey + 2)),
nm AS (SELECT nb.track, scenario_id, {_upper('estimate')} AS neighbour_median FROM nb JOIN est ON est.track = nb.neighbour GROUP BY 1, 2),
suite AS (SELECT est.*, m * 0.95::DOUBLE AS lo, m * 1.05::DOUBLE AS hi, estimate BETWEEN m * 0.95::DOUBLE AND m * 1.05::DOUBLE AS bp,
    neighbour_median, estimate / neighbour_median BETWEEN 0.5 AND 1.5 AS np
  FROM est LEFT JOIN mid USING (scenario_id) LEFT JOIN nm ON nm.track = est.track AND nm.scenario_id = est.scenario_id)"""
_EST = with_ctes(WI_TRACKS, ESTIMATES)


@query("j12_benchmark_ranges", _EST + f"SELECT track, scenario_id, {s4('estimate', 'estimate')}, bp AS benchmark_pass, {s4('lo', 'lo')} FROM suite")
def in_ranges(spark, sf):
    out = E.check_ranges(estimates(spark, sf), ranges(spark, sf))
    return out.select("track", "scenario_id", x4("estimate", "estimate"), "benchmark_pass", x4("benchmark_min", "lo"))


@query("j13_neighbour_tracks", _EST + f"SELECT track, scenario_id, {s4('neighbour_median', 'neighbour_median')}, np AS neighbour_pass FROM suite")
def with_neighbours(spark, sf):
    out = E.check_neighbours(estimates(spark, sf), neighbours(spark, sf))
    return out.select("track", "scenario_id", x4("neighbour_median", "neighbour_median"), "neighbour_pass")


def _suite(spark, sf):
    return E.functional_suite(estimates(spark, sf), ranges(spark, sf), neighbours(spark, sf))


_VERDICT = "(bp IS NOT NULL OR np IS NOT NULL) AND coalesce(bp, true) AND coalesce(np, true) AND matches >= 1"


@query("q23_scenario_verdict", _EST + f"SELECT track, scenario_id, {_VERDICT} AS overall_pass FROM suite")
def scenario_verdict(spark, sf):
    return _suite(spark, sf).select("track", "scenario_id", "overall_pass")


@query("e5_functional_suite", _EST + f"""
SELECT track, scenario_id, {s4('estimate', 'estimate')}, matches, bp AS benchmark_pass, np AS neighbour_pass, {_VERDICT} AS overall_pass FROM suite""")
def suite(spark, sf):
    return _suite(spark, sf).select("track", "scenario_id", x4("estimate", "estimate"), "matches", "benchmark_pass",
                                    "neighbour_pass", "overall_pass")


@query("a22_pass_score", _EST + f"""
SELECT track, count(*) FILTER ({_VERDICT}) AS passed, count(*) AS total, count(*) FILTER ({_VERDICT}) >= 27 AS promote FROM suite GROUP BY 1""")
def score(spark, sf):
    return E.pass_score(_suite(spark, sf), "overall_pass")


# ---- units, resources, take-off ------------------------------------------------------------------------------

@query("e6_unit_mapping", with_ctes(WI) + f"""
SELECT unit, rate_unit, count(*) AS n, count(*) FILTER (conv IS NULL) AS mismatched, {s4('coalesce(sum(conv), 0)', 'converted')} FROM (
  SELECT unit, rate_unit, CASE WHEN unit = 'kg' AND rate_unit = 't' THEN q / 1000 WHEN unit = 'm2' AND rate_unit = '100 m2' THEN q / 100
         WHEN unit = 'm³' AND rate_unit = 'm3' THEN q END AS conv
  FROM (SELECT CASE section_name WHEN '1995' THEN 'kg' WHEN '1996' THEN 'm2' WHEN '1997' THEN 'm³' ELSE 'bucket' END AS unit, rate_unit,
               coalesce(resource_quantity, 0) AS q FROM wi)) GROUP BY 1, 2""")
def unit_mapping(spark, sf):
    year = F.col("section_name")
    unit = F.when(year == "1995", "kg").when(year == "1996", "m2").when(year == "1997", "m³").otherwise("bucket")
    wi = work_items(spark, sf).select(unit.alias("unit"), "rate_unit", F.coalesce("resource_quantity", F.lit(0.0)).alias("q"))
    out = E.convert_quantity(wi, "q", "unit", "rate_unit")
    return out.groupBy("unit", "rate_unit").agg(
        cnt(), F.count_if("unit_mismatch").alias("mismatched"), x4(F.coalesce(F.sum("converted"), F.lit(0.0)), "converted"))


@query("e11_resource_demand", with_ctes(WI) + f"""
SELECT resource_code, {s4('sum(resource_quantity * q)', 'resource_quantity')}, {s4('sum(labor_hours_construction_workers * q)', 'hours')}
FROM wi JOIN (SELECT 'R' || o_orderkey AS rate_code, 1 + o_custkey % 9 AS q FROM orders) USING (rate_code) GROUP BY 1""")
def demand(spark, sf):
    need = table(spark, sf, "orders").select(
        F.concat(F.lit("R"), F.col("o_orderkey").cast("string")).alias("rate_code"), (1 + F.col("o_custkey") % 9).alias("quantity"))
    out = resource_demand(need, work_items(spark, sf), ["resource_quantity", "labor_hours_construction_workers"])
    return out.select("resource_code", x4("resource_quantity", "resource_quantity"), x4("labor_hours_construction_workers", "hours"))


@query("e10_edited_quantities", f"""
WITH ed AS (SELECT user_id, CASE event_type WHEN 'purchase' THEN 'set' WHEN 'signup' THEN 'add' ELSE 'remove' END AS op, value, ROW(ts, event_id) AS ord
            FROM events),
last AS (SELECT user_id, arg_max(op, ord) AS op, arg_max(value, ord) AS value FROM ed GROUP BY 1)
SELECT coalesce(c_custkey, user_id) AS line_id, {s4('CASE WHEN op IS NULL THEN c_acctbal ELSE value END', 'quantity')}, op IS NOT NULL AS edited
FROM customer FULL JOIN last ON c_custkey = user_id WHERE op IS DISTINCT FROM 'remove' AND (c_custkey IS NOT NULL OR op = 'add')""")
def edited(spark, sf):
    base = table(spark, sf, "customer").select(F.col("c_custkey").alias("line_id"), F.col("c_acctbal").alias("quantity"))
    kind = F.col("event_type")
    edits = table(spark, sf, "events").select(
        F.col("user_id").alias("line_id"),
        F.when(kind == "purchase", "set").when(kind == "signup", "add").otherwise("remove").alias("op"),
        F.col("value").alias("quantity"), F.struct("ts", "event_id").alias("ord"))
    return E.apply_edits(base, edits).select("line_id", x4("quantity", "quantity"), "edited")


@query("a18_phase_rollup", f"""
SELECT l_returnflag AS phase, l_linenumber AS item, CAST(grouping(l_returnflag) + grouping(l_linenumber) AS INTEGER) AS level,
       {s4('sum(l_extendedprice)', 'amount')}, count(*) AS n FROM lineitem GROUP BY ROLLUP (l_returnflag, l_linenumber)""")
def phases(spark, sf):
    out = E.phase_rollup(table(spark, sf, "lineitem"), "l_returnflag", "l_linenumber", "l_extendedprice")
    return out.select(F.col("l_returnflag").alias("phase"), F.col("l_linenumber").alias("item"), "level", x4("amount", "amount"), "n")


@query("a19_rule_aggregation", with_ctes(WI) + f"""
SELECT collection_name, resource_unit, {s4('sum(resource_cost)', 'resource_cost')}, {s4('avg(resource_quantity)', 'resource_quantity')},
       arg_min(resource_name, ord) FILTER (resource_name IS NOT NULL) AS resource_name, arg_max(rate_final_name, ord) AS rate_final_name FROM wi GROUP BY 1, 2""")
def rule_aggregation(spark, sf):
    rules = {"resource_cost": "sum", "resource_quantity": "mean", "resource_name": "first", "rate_final_name": "last"}
    out = E.aggregate_by_rules(work_items(spark, sf), ["collection_name", "resource_unit"], rules)
    return out.select("collection_name", "resource_unit", x4("resource_cost", "resource_cost"), x4("resource_quantity", "resource_quantity"),
                      "resource_name", "rate_final_name")


@query("e8_model_take_off", with_ctes(WI) + f""",
el AS (SELECT resource_unit AS type_name, resource_quantity AS quantity, collection_name FROM wi WHERE NOT coalesce(resource_name LIKE 'small%', false)),
g AS (SELECT type_name, sum(quantity) AS quantity FROM el GROUP BY 1),
ph AS (SELECT p_brand AS type_name, CASE WHEN count(*) FILTER (p_size > 25) * 2 > count(*) THEN 'structure' ELSE 'finish' END AS phase FROM part GROUP BY 1),
wk AS (SELECT p_brand AS type_name, p_type AS work, count(*)::DOUBLE / sum(count(*)) OVER (PARTITION BY p_brand) AS share,
              CASE WHEN p_type = 'SMALL' THEN 'm2' ELSE 'kg' END AS unit FROM part GROUP BY 1, 2),
pr AS (SELECT p_type AS work, avg(p_retailprice) AS unit_rate, CASE p_type WHEN 'PROMO' THEN 't' WHEN 'LARGE' THEN 'm3' ELSE 'kg' END AS rate_unit FROM part GROUP BY 1),
c AS (SELECT type_name, phase, work, CASE WHEN unit = rate_unit THEN quantity * share WHEN unit = 'kg' AND rate_unit = 't' THEN quantity * share / 1000 END AS conv, unit_rate FROM g LEFT JOIN ph USING (type_name) LEFT JOIN wk USING (type_name) LEFT JOIN pr USING (work))
SELECT phase, type_name, CAST(grouping(phase) + grouping(type_name) AS INTEGER) AS level, {s4('sum(coalesce(conv * unit_rate, 0)) / 1000', 'amount')}, count(*) AS n
FROM c GROUP BY ROLLUP (phase, type_name)""")
def model_take_off(spark, sf):
    wi = work_items(spark, sf).select(
        F.when(F.col("resource_name").startswith("small"), "Reference Planes").otherwise(F.col("resource_name")).alias("category"),
        F.col("resource_unit").alias("type_name"), F.col("resource_quantity").alias("quantity"), "ord")
    p = table(spark, sf, "part").withColumn("type_name", F.col("p_brand"))
    phase_map = p.groupBy("type_name").agg(
        F.when(F.count_if(F.col("p_size") > 25) * 2 > F.count(F.lit(1)), "structure").otherwise("finish").alias("phase"))
    per = p.groupBy("type_name", F.col("p_type").alias("work")).agg(F.count(F.lit(1)).alias("n"))
    total = p.groupBy("type_name").agg(F.count(F.lit(1)).alias("total"))
    works = per.join(total, "type_name").select(
        "type_name", "work", (F.col("n") / F.col("total")).alias("share"),
        F.when(F.col("work") == "SMALL", "m2").otherwise("kg").alias("unit"))
    prices = p.groupBy(F.col("p_type").alias("work")).agg(F.avg("p_retailprice").alias("unit_rate")).withColumn(
        "rate_unit", F.when(F.col("work") == "PROMO", "t").when(F.col("work") == "LARGE", "m3").otherwise("kg"))
    out = E.take_off(wi, {"quantity": "sum"}, phase_map, works, prices)
    rolled = E.phase_rollup(out, "phase", "type_name", "amount")
    return rolled.select("phase", "type_name", "level", x4(F.col("amount") / 1000, "amount"), "n")


@query("e9_estimate_checks", f"""
WITH f AS (SELECT l_returnflag, l_linenumber, quantile_cont(l_extendedprice, 0.25) AS q1, quantile_cont(l_extendedprice, 0.75) AS q3 FROM lineitem GROUP BY 1, 2)
SELECT 'outlier' AS issue, l_orderkey AS k, l_linenumber AS line, count(*) AS n FROM lineitem JOIN f USING (l_returnflag, l_linenumber)
WHERE l_extendedprice < q1 - 1.5 * (q3 - q1) OR l_extendedprice > q3 + 1.5 * (q3 - q1) GROUP BY 2, 3
UNION ALL SELECT 'no work', p_partkey, NULL, 1 FROM part WHERE p_partkey NOT IN (SELECT l_partkey FROM lineitem WHERE l_quantity > 40)
UNION ALL SELECT 'duplicate', l_orderkey, l_linenumber, count(*) FROM lineitem GROUP BY 2, 3 HAVING count(*) > 1""")
def estimate_checks(spark, sf):
    li, p = table(spark, sf, "lineitem"), table(spark, sf, "part")
    odd = E.outliers(li, ["l_returnflag", "l_linenumber"], "l_extendedprice").groupBy("l_orderkey", "l_linenumber").agg(cnt())
    bare = E.without_works(p.select(F.col("p_partkey").alias("k")), li.filter("l_quantity > 40").select(F.col("l_partkey").alias("k")), "k")
    twice = E.duplicate_works(li, ["l_orderkey", "l_linenumber"])
    return (
        odd.select(F.lit("outlier").alias("issue"), F.col("l_orderkey").alias("k"), F.col("l_linenumber").alias("line"), "n")
        .unionByName(bare.select(F.lit("no work").alias("issue"), "k", F.lit(None).cast("int").alias("line"), F.lit(1).cast("long").alias("n")))
        .unionByName(twice.select(F.lit("duplicate").alias("issue"), F.col("l_orderkey").alias("k"), F.col("l_linenumber").alias("line"), "n")))


@query("q24_price_deviations", f"""
WITH m AS (SELECT l_partkey, median(l_extendedprice / l_quantity) AS med FROM lineitem GROUP BY 1)
SELECT l_partkey, {s4('med', 'group_median')}, count(*) FILTER (abs(l_extendedprice / l_quantity / med - 1) > 0.30) AS flagged, count(*) AS n
FROM lineitem JOIN m USING (l_partkey) GROUP BY 1, med""")
def price_deviations(spark, sf):
    li = table(spark, sf, "lineitem").select("l_partkey", (F.col("l_extendedprice") / F.col("l_quantity")).alias("price"))
    out = E.deviations(li, ["l_partkey"], "price")
    return out.groupBy("l_partkey").agg(x4(F.max("group_median"), "group_median"), F.count_if("needs_rationale").alias("flagged"), cnt())
