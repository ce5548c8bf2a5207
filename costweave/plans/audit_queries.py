"""Queries for text audits and classification."""

from __future__ import annotations

from pyspark.sql import functions as F

from costweave.functions import text as T
from costweave.operators import audit as A
from costweave.operators import classify as CL
from costweave.operators import translation as TR
from costweave.plans.registry import query
from costweave.plans.text_queries import (
    CACHE, CODES, GLOSSARY, LEFTOVER, PASSTHROUGH, PASSTHROUGH_SHORT, cache, codes, glossary, q, tokens_sql, word_pattern,
)
from costweave.plans.views import TEXT_PAIR, WI, s4, table, text_pairs, with_ctes, work_items, x4
from costweave.session import cut_lineage


def cnt():
    return F.count(F.lit(1)).alias("n")



# ---- aligned text in two columns: documents and conversation turns --------------------------------------

def long_pairs(spark, sf):
    d = text_pairs(spark, sf).select(
        F.lit("text").alias("col"), F.lit(0).alias("col_ord"),
        F.struct(F.col("doc_id").alias("a"), F.lit(0).cast("long").alias("b")).alias("row_ord"), "src", "tgt")
    c = table(spark, sf, "conversations").select(
        F.lit("turn").alias("col"), F.lit(1).alias("col_ord"),
        F.struct(F.col("conv_id").alias("a"), F.col("turn").alias("b")).alias("row_ord"), F.col("text").alias("src"),
        F.when(F.col("role") == "user", F.col("text")).otherwise(F.concat(F.lit("[1] "), F.col("text"))).alias("tgt"))
    return d.unionByName(c)


LONG = """long AS (SELECT 'text' AS col, 0 AS c, doc_id AS a, CAST(0 AS BIGINT) AS b, src, tgt FROM text_pair
  UNION ALL SELECT 'turn', 1, conv_id, turn, text, CASE WHEN role = 'user' THEN text ELSE '[1] ' || text END FROM conversations),
pairs AS (SELECT substr(sha1(src), 1, 16) AS h, arg_min(src, ROW(c, a, b)) AS src, arg_min(tgt, ROW(c, a, b)) AS tgt
  FROM long WHERE length(src) > 0 AND length(tgt) > 0 AND src <> tgt GROUP BY 1),
targets AS (SELECT substr(sha1(tgt), 1, 16) AS h, min(tgt) AS v, arg_min(col, ROW(c, a, b)) AS col FROM long WHERE length(trim(tgt)) > 0 GROUP BY 1)"""
_LONG = with_ctes(TEXT_PAIR, LONG)


def _key(c):
    return T.hash16(F.col(c))


@query("j5_shared_order_alignment", """
WITH d AS (SELECT doc_id, text FROM documents), e AS (SELECT doc_id, lang, n_chars FROM documents)
SELECT d.doc_id, sha1(d.text) AS source, e.lang || e.n_chars AS target FROM d JOIN e USING (doc_id)""")
def shared_order(spark, sf):
    from costweave.sources.readers import align_scans

    docs = table(spark, sf, "documents")
    pairs = align_scans(docs.select("doc_id", "text"), docs.select("lang", "n_chars"))
    return pairs.select("doc_id", F.sha1("text").alias("source"), F.concat("lang", F.col("n_chars").cast("string")).alias("target"))


@query("q11_translation_pairs", _LONG + "SELECT h, substr(sha1(src), 1, 16) AS s, substr(sha1(tgt), 1, 16) AS t FROM pairs")
def pairs(spark, sf):
    return A.translation_pairs(long_pairs(spark, sf)).select("h", _key("src").alias("s"), _key("tgt").alias("t"))


_L = r"regexp_replace(v, '[^\p{L}]', '', 'g')"
SCRIPT = rf"""script AS (SELECT h, col, v, latin / n AS share, CASE WHEN greatest(latin, cyr) = 0 THEN 'none' WHEN cyr >= latin THEN 'CYRILLIC' ELSE 'LATIN' END AS dom
  FROM (SELECT h, col, v, nullif(length({_L}), 0)::DOUBLE AS n, length(regexp_replace({_L}, '[^\p{{Latin}}]', '', 'g')) AS latin,
               length(regexp_replace({_L}, '[^\p{{Cyrillic}}]', '', 'g')) AS cyr FROM (SELECT *, v AS w FROM targets) WHERE NOT ({PASSTHROUGH_SHORT})))"""


@query("q12_script_block", with_ctes(TEXT_PAIR, LONG, SCRIPT) + """
SELECT h AS hash, col, coalesce(share < 0.15, false) AS flagged,
       CASE WHEN share < 0.15 THEN 'only ' || CAST(round_even(share * 100, 0) AS INTEGER) || '% chars in LATIN, dominant=' || dom END AS reason FROM script""")
def script_block(spark, sf):
    long = long_pairs(spark, sf)
    targets = long.filter(F.length(F.trim("tgt")) > 0).groupBy(_key("tgt").alias("h")).agg(
        F.min("tgt").alias("v"), F.min_by("col", F.struct("col_ord", "row_ord")).alias("col"))
    return A.script_block(targets, "en").select("hash", "col", "flagged", "reason")


# Documents spelled in Cyrillic letters stand in for a Bulgarian text with Russian leftovers.
_LAT, _CYR = "abcdefghijklmnoprstuvz", "абцйыфгхижклмноърстувз"


def _cyrillic(spark, sf):
    return table(spark, sf, "documents").select(
        "doc_id", F.lit("text").alias("col"), F.translate(F.lower("text"), _LAT, _CYR).alias("v")).withColumn("h", _key("v"))


def _in_words(pattern: str) -> str:
    return pattern.replace("(?Ui)", "(?i)").replace("\\b", "$")


@query("q13_sister_leakage", rf"""
WITH w AS (SELECT doc_id, unnest(string_split_regex(v, '[^\p{{L}}\p{{N}}\p{{M}}_]+')) AS w
           FROM (SELECT doc_id, translate(lower(text), '{_LAT}', '{_CYR}') AS v FROM documents WHERE length(trim(text)) > 0)),
n AS (SELECT doc_id, sum(len(regexp_extract_all(w, {q(_in_words(T.LANGUAGE_MARKERS['ru']))}))) AS ru,
             sum(len(regexp_extract_all(w, {q(_in_words(T.LANGUAGE_MARKERS['bg']))}))) AS bg FROM w GROUP BY 1)
SELECT doc_id, CAST(ru AS INTEGER) AS ru, CAST(bg AS INTEGER) AS bg, ru >= 2 AND bg = 0 AS flagged FROM n""")
def leakage(spark, sf):
    rows = _cyrillic(spark, sf)
    flags = A.sister_leakage(rows).select(F.col("hash").alias("h"), "flagged").distinct()
    return rows.join(flags, "h").select(
        "doc_id", T.marker_count(F.col("v"), "ru").alias("ru"), T.marker_count(F.col("v"), "bg").alias("bg"), "flagged")


_GLOSS = """, rules AS (SELECT term, item FROM glossary WHERE length(term) >= 3),
hit AS (SELECT h, item, term, contains(lower(tgt), term) AS ok FROM pairs JOIN rules ON contains(lower(src), term)),
bad AS (SELECT h, min(ROW(item, term)) FILTER (NOT ok) AS bad FROM hit GROUP BY 1)"""


@query("q14_glossary_consistency", with_ctes(TEXT_PAIR, LONG, GLOSSARY) + _GLOSS + """
SELECT h AS hash, bad IS NOT NULL AS flagged, count(*) FILTER (bad IS NULL OR ROW(item, term) <= bad) AS checks,
       CASE WHEN bad IS NOT NULL THEN 'glossary requires ''' || translate(bad[2], 'abcdefghijklmnopqrstuvwxyz', 'ABCDEFGHIJKLMNOPQRSTUVWXYZ') || ''' for ''' || bad[2] || '''' END AS reason
FROM hit JOIN bad USING (h) GROUP BY h, bad""")
def glossary_layer(spark, sf):
    # The layer reads the pairs three times, so they are written once, as in the whole audit.
    out = A.glossary_consistency(cut_lineage(A.translation_pairs(long_pairs(spark, sf))), glossary(spark, sf))
    return out.select("hash", "flagged", "checks", "reason")


NUMERIC = f"""numeric AS (SELECT h, src, tgt, {tokens_sql('src')} AS toks FROM pairs),
missing AS (SELECT h, src, tgt, list_filter(toks, lambda t: NOT contains(replace(tgt, '.', ','), replace(t, '.', ','))) AS miss FROM numeric WHERE len(toks) > 0)"""


@query("q15_numeric_preservation", with_ctes(TEXT_PAIR, LONG, NUMERIC) + """
SELECT h AS hash, len(miss) > 0 AS flagged, CASE WHEN len(miss) > 0 THEN 'missing numeric tokens: ' || array_to_string(miss, ', ') END AS reason FROM missing""")
def numeric_layer(spark, sf):
    return A.numeric_preservation(A.translation_pairs(long_pairs(spark, sf))).select("hash", "flagged", "reason")


@query("q16_length_sanity", _LONG + f"""
SELECT h AS hash, r < 0.3 OR r > 3 AS flagged, {s4('r', 'ratio')} FROM (SELECT h, length(tgt)::DOUBLE / length(src) AS r FROM pairs WHERE length(src) >= 5)""")
def length_layer(spark, sf):
    out = A.length_sanity(A.translation_pairs(long_pairs(spark, sf)), "it")
    return out.select("hash", "flagged", x4(F.length("target_value") / F.length("source_value"), "ratio"))


@query("q17_round_trip", f"""
WITH v AS (SELECT a.vec_id, list_cosine_similarity(a.embedding::DOUBLE[], b.embedding::DOUBLE[]) AS c
           FROM embeddings a JOIN embeddings b ON b.vec_id = a.vec_id + 1)
SELECT 'v' || vec_id AS hash, c < 0.7 AS flagged, {s4('c + 1', 'shifted')} FROM v""")
def round_trip(spark, sf):
    # the next vector plays the back-translation
    e = table(spark, sf, "embeddings")
    name = F.concat(F.lit("v"), F.col("vec_id").cast("string"))
    source = e.select(name.alias("h"), F.col("embedding").alias("vector"))
    back = e.select(F.concat(F.lit("v"), (F.col("vec_id") - 1).cast("string")).alias("h"), F.col("embedding").alias("vector"))
    pairs_ = e.select(name.alias("h"), F.col("label").cast("string").alias("src"), F.lit("x").alias("tgt"))
    from costweave.functions.vectors import cosine

    cos = source.join(back.withColumnRenamed("vector", "b"), "h").select(
        F.col("h").alias("hash"), x4(cosine(F.col("vector"), F.col("b")) + 1, "shifted"))
    return A.round_trip(pairs_, source, back).select("hash", "flagged").join(cos, "hash")


def _audit(spark, sf):
    return A.audit_text(long_pairs(spark, sf), "en", glossary(spark, sf))


_ALL = with_ctes(TEXT_PAIR, LONG, SCRIPT, NUMERIC, GLOSSARY) + _GLOSS + """,
checked AS (
  SELECT 'script_block' AS layer, h AS hash, 1 AS checks, coalesce(share < 0.15, false) AS flagged FROM script
  UNION ALL SELECT 'numeric_preservation', h, 1, len(miss) > 0 FROM missing
  UNION ALL SELECT 'length_sanity', h, 1, length(tgt)::DOUBLE / length(src) NOT BETWEEN 0.3 AND 3 FROM pairs WHERE length(src) >= 5
  UNION ALL SELECT 'glossary_consistency', h, count(*) FILTER (bad IS NULL OR ROW(item, term) <= bad), bad IS NOT NULL FROM hit JOIN bad USING (h) GROUP BY h, bad)"""


@query("a20_layer_stats", _ALL + f"""
SELECT layer, CAST(sum(checks) AS BIGINT) AS checked, count(*) FILTER (flagged) AS flagged, {s4('count(*) FILTER (flagged) * 100.0::DOUBLE / sum(checks)', 'pct')}
FROM checked GROUP BY 1""")
def stats(spark, sf):
    return A.layer_stats(_audit(spark, sf)).select("layer", "checked", "flagged", x4("pct", "pct"))


@query("w6_report_sample", _ALL + """
SELECT layer, hash FROM checked WHERE flagged QUALIFY row_number() OVER (PARTITION BY layer ORDER BY hash) <= 50""")
def sample(spark, sf):
    return A.report_sample(_audit(spark, sf)).select("layer", "hash")


@query("q18_audit", _ALL + """
SELECT count(*) FILTER (flagged AND layer = 'script_block') = 0 AS passed, count(*) FILTER (flagged) AS flagged_count FROM checked""")
def audit(spark, sf):
    return A.passes(_audit(spark, sf))


@query("q19_verbatim_leftovers", with_ctes(TEXT_PAIR, LONG) + f"""
SELECT DISTINCT sha1(w) AS h FROM (SELECT tgt AS w FROM long WHERE src = tgt AND length(tgt) > 0) WHERE NOT ({PASSTHROUGH})""")
def verbatim(spark, sf):
    return A.verbatim_leftovers(long_pairs(spark, sf)).select(F.sha1("tgt").alias("h"))


@query("q20_residual_language", with_ctes(TEXT_PAIR, LONG) + f"""
SELECT substr(sha1(src), 1, 16) AS s, substr(sha1(arg_min(w, ROW(c, a, b))), 1, 16) AS t
FROM (SELECT *, tgt AS w, CASE col WHEN 'text' THEN 'de_loose' ELSE 'en_latin' END AS kind FROM long WHERE length(src) > 0 AND length(tgt) > 0)
WHERE {LEFTOVER} GROUP BY src""")
def residual(spark, sf):
    kind = F.when(F.col("col") == "text", "de_loose").otherwise("en_latin")
    out = A.residual_language(long_pairs(spark, sf), kind)
    return out.select(_key("src").alias("s"), _key("tgt").alias("t"))


@query("u5_purged_dictionary", with_ctes(TEXT_PAIR, CACHE, LONG, NUMERIC) + """
SELECT h FROM cache WHERE h NOT IN (SELECT h FROM missing WHERE len(miss) > 0)""")
def purged(spark, sf):
    flagged = A.numeric_preservation(A.translation_pairs(long_pairs(spark, sf))).filter("flagged")
    return TR.purge(cache(spark, sf), flagged).select("h")


@query("q22_retry_until_clean", with_ctes(TEXT_PAIR, CACHE, LONG) + f"""
, known AS (SELECT h, target AS tgt, {tokens_sql('src')} AS toks FROM cache JOIN (SELECT substr(sha1(src), 1, 16) AS h, min(src) AS src FROM long GROUP BY 1) USING (h)),
bad AS (SELECT count(*) AS n FROM known WHERE len(list_filter(toks, lambda t: NOT contains(replace(tgt, '.', ','), replace(t, '.', ',')))) > 0)
SELECT CASE WHEN n > 0 THEN 2 ELSE 1 END AS attempts, CAST(n AS INTEGER) AS first_flagged, CAST(0 AS BIGINT) AS left FROM bad""".replace("AS left FROM bad", 'AS "left" FROM bad'))
def retry(spark, sf):
    """Targets that lost numbers are answered again; the second answer repeats the source."""
    strings = long_pairs(spark, sf).groupBy(_key("src").alias("h")).agg(F.min("src").alias("src"))

    def check(known):
        return A.numeric_preservation(known.join(strings, "h").select("h", "src", F.col("target").alias("tgt"))).filter("flagged")

    def answer(removed):
        return removed.select("h").join(strings, "h").select("h", F.col("src").alias("target"))

    clean, log = TR.retry_flagged(cache(spark, sf), check, answer, layers=["numeric_preservation"])
    left = check(clean).agg(cnt()).select(F.lit(len(log)).alias("attempts"), F.lit(log[0]["flagged"]).alias("first_flagged"), F.col("n").alias("left"))
    return left


# ---- classification by our own rules -----------------------------------------------------------------------

RULES = CL.Rules(
    classes=[
        (r"\b(?:wand|wall|mur)\b", "Walls", "Wall", "wall partition"),
        (r"\bring\b|\bbolt\b|schraub", "Fasteners", "Fastener", "bolt nut"),
        (r"\bstein|\bstone|\bpiedra", "Masonry", "Masonry", "stone block"),
        (r"widget|gadget|gear", "Equipment", "Component", "part"),
        (r"\b(?:the|with)\b", "General", "Proxy", "any"),
        (r"\b(?:der|die|das)\b", "Allgemein", "Proxy", "alle"),
    ],
    materials=[(r"stein|stone", "Stone"), (r"\bred\b|\bblue\b", "Paint"), (r"\bthe\b", "Mixed"), (r"ung\b", "Concrete")],
    disciplines=[(r"src1\d?\b", "Structure"), (r"src[2-5]\b", "Services"), (r"\bde\b", "Civil")],
    work_types=[(r"\bver", "Repair"), (r"ing\b", "Installation"), (r"ción\b", "Finish")],
    targets=[(r"\bon\b", "Slab"), (r"\bin\b", "Space"), (r"\bder\b", "Wall"), (r"\bthe\b", "Slab"), (r"\bsobre\b|\bun\b", "Roof")],
)


def _docs(spark, sf):
    return table(spark, sf, "documents").select("doc_id", "text", "lang", "source", F.lit("100 m2").alias("unit"))


def _edge(pattern: str) -> str:
    """\\b for an engine that only knows ASCII words: spell out the neighbours."""
    p = pattern.replace("\\b(?:", "(?:^|[^\\p{L}\\p{N}_])(?:")
    out, i = "", 0
    while i < len(p):
        if p.startswith("\\b", i):
            before = p[i - 1] if i else " "
            starts_word = i + 2 < len(p) and (p[i + 2].isalnum() or p[i + 2] == "\\") and not (before.isalnum() or before in ")?d")
            out += "(?:^|[^\\p{L}\\p{N}_])" if starts_word else "(?:$|[^\\p{L}\\p{N}_])"
            i += 2
        else:
            out += p[i]
            i += 1
    return "(?i)" + out


def first_sql(c: str, rules, part: int = 1) -> str:
    cases = " ".join(f"WHEN regexp_matches({c}, {q(_edge(r[0]))}) THEN {q(r[part])}" for r in rules)
    return f"CASE {cases} END"


def all_sql(c: str, rules) -> str:
    items = ", ".join(f"CASE WHEN regexp_matches({c}, {q(_edge(p))}) THEN {q(v)} END" for p, v in rules)
    return f"array_to_string(list_filter([{items}], lambda v, i: v IS NOT NULL AND NOT list_contains([{items}][1:i - 1], v)), ',')"


_CTX = "(text || ' | ' || lang || ' | ' || source)"


@query("c1_first_match_class", f"""
SELECT doc_id, {first_sql(_CTX, RULES.classes, 1)} AS ost_category, {first_sql(_CTX, RULES.classes, 2)} AS ifc_class, coalesce({first_sql(_CTX, RULES.classes, 3)}, '') AS aliases
FROM documents""")
def classes(spark, sf):
    out = CL.enrich(_docs(spark, sf), RULES, "text", "unit", "lang", "source")
    return out.select("doc_id", "ost_category", "ifc_class", "aliases")


@query("c2_material_class", f"SELECT doc_id, {first_sql('text', RULES.materials)} AS material FROM documents")
def materials(spark, sf):
    return _docs(spark, sf).select("doc_id", CL.first_match(F.col("text"), RULES.materials).alias("material"))


@query("c3_unit_type", """
SELECT p_partkey, u AS unit, CASE WHEN u LIKE '%м3%' OR u LIKE '%m³%' OR u LIKE '%Куб%' THEN 'Volume' WHEN u LIKE '%м 2%' OR u LIKE '%m2%' THEN 'Area'
  WHEN u LIKE '% т' OR u LIKE '%Кг%' THEN 'Mass' WHEN u LIKE '%шт' THEN 'Count' WHEN u LIKE '%м' OR u LIKE '%метр%' THEN 'Linear' END AS unit_type
FROM (SELECT p_partkey, p_size || ' ' || ['м3', 'м 2', 'm2', 'm³', 'т', 'Кг', 'шт', 'м', 'пог. метр', 'pcs', 'Куб. единица'][p_partkey % 11 + 1] AS u FROM part)""")
def unit_types(spark, sf):
    names = ["м3", "м 2", "m2", "m³", "т", "Кг", "шт", "м", "пог. метр", "pcs", "Куб. единица"]
    unit = F.concat_ws(" ", F.col("p_size").cast("string"),
                       F.element_at(F.array(*[F.lit(n) for n in names]), (F.col("p_partkey") % 11 + 1).cast("int")))
    return table(spark, sf, "part").select("p_partkey", unit.alias("unit"), CL.unit_type(unit).alias("unit_type"))


@query("c4_discipline", f"SELECT doc_id, {first_sql(_CTX, RULES.disciplines)} AS discipline FROM documents")
def disciplines(spark, sf):
    text = CL.context_text("text", "lang", "source")
    return _docs(spark, sf).select("doc_id", CL.first_match(text, RULES.disciplines).alias("discipline"))


@query("c5_work_type", f"SELECT doc_id, {first_sql('text', RULES.work_types)} AS work_type FROM documents")
def work_types(spark, sf):
    return _docs(spark, sf).select("doc_id", CL.first_match(F.col("text"), RULES.work_types).alias("work_type"))


@query("c6_all_matching_targets", f"SELECT doc_id, {all_sql('text', RULES.targets)} AS targets FROM documents")
def targets(spark, sf):
    return _docs(spark, sf).select("doc_id", F.array_join(CL.all_matches(F.col("text"), RULES.targets), ",").alias("targets"))


@query("c7_enrichment", f"""
SELECT doc_id, {first_sql(_CTX, RULES.classes, 2)} AS ifc_class, {first_sql(_CTX, RULES.materials)} AS material_class, 'Area' AS unit_type,
       {first_sql(_CTX, RULES.disciplines)} AS discipline, {first_sql(_CTX, RULES.work_types)} AS work_type, {all_sql('text', RULES.targets)} AS applies_to FROM documents""")
def enrichment(spark, sf):
    out = CL.enrich(_docs(spark, sf), RULES, "text", "unit", "lang", "source")
    return out.select("doc_id", "ifc_class", "material_class", "unit_type", "discipline", "work_type",
                      F.array_join("applies_to_classes", ",").alias("applies_to"))


_RATE_CTX = "(coalesce(resource_name, '') || ' | ' || section_name || ' | ' || collection_name)"


@query("c8_rates_with_coverage", with_ctes(WI) + f""",
f AS (SELECT * FROM wi QUALIFY row_number() OVER (PARTITION BY rate_code ORDER BY ord) = 1),
c AS (SELECT rate_code, CASE WHEN resource_name IS NOT NULL THEN {first_sql(_RATE_CTX, RULES.classes, 2)} END AS ifc_class FROM f),
k AS (SELECT 'R' || o_orderkey AS rate_code, 'Known' AS ifc_class FROM orders WHERE o_orderstatus = 'P')
SELECT count(*) AS rates, {s4('count(coalesce(k.ifc_class, c.ifc_class)) * 100.0::DOUBLE / count(*)', 'with_class_pct')},
       {s4('count(k.rate_code) * 100.0::DOUBLE / count(*)', 'propagated_pct')},
       (SELECT sum(n) FROM (SELECT count(DISTINCT resource_name) AS n FROM wi GROUP BY rate_code))::BIGINT AS names FROM c LEFT JOIN k USING (rate_code)""")
def rates(spark, sf):
    known = table(spark, sf, "orders").filter("o_orderstatus = 'P'").select(
        F.concat(F.lit("R"), F.col("o_orderkey").cast("string")).alias("rate_code"), F.lit("Known").alias("ifc_class"),
        F.struct(F.col("o_orderkey")).alias("ord"))
    out = CL.rates_for_embedding(
        work_items(spark, sf), RULES, ["resource_name", "rate_unit", "section_name", "collection_name"], ["resource_name"],
        "resource_name", "rate_unit", "section_name", "collection_name", known)
    names = F.sum(F.coalesce(F.size("resource_name_list"), F.lit(0))).alias("names")
    return CL.coverage(out, names).select("rates", x4("with_class_pct", "with_class_pct"), x4("propagated_pct", "propagated_pct"), "names")
