"""Queries for text functions and the life cycle of translations."""

from __future__ import annotations

from pyspark.sql import functions as F

from costweave.functions import text as T
from costweave.operators import translation as TR
from costweave.operators.ordering import numbered
from costweave.plans.registry import query
from costweave.plans.views import LOWER, TEXT_PAIR, TEXTS, UPPER, s4, table, text_pairs, texts, with_ctes, x4

SQL_QUOTE = "'"


def q(s: str) -> str:
    return SQL_QUOTE + s.replace("'", "''") + SQL_QUOTE


def word_pattern(words: list[str]) -> str:
    """Whole-word pattern for an engine whose \\b only knows ASCII letters."""
    return rf"(?i)(^|[^\p{{L}}\p{{N}}_])(?:{'|'.join(words)})($|[^\p{{L}}\p{{N}}_])"


# ---- strings to classify: words of all texts, and specifications built from every part ----------------

def strings(spark, sf):
    words = texts(spark, sf).select(F.explode(F.split("v", "[ \n]+")).alias("w"))
    p = table(spark, sf, "part")
    size, key = F.col("p_size").cast("string"), F.col("p_partkey").cast("string")
    specs = F.array(
        F.concat(size, F.lit(" kVA")), F.concat(F.lit("DN-"), key), F.concat(size, F.lit("x"), key),
        F.col("p_name"), F.upper("p_name"), F.concat(size, F.lit(" Komplett")), F.concat(size, F.lit(",5-7 m3/h")),
        F.concat(F.col("p_brand"), F.lit(", "), F.col("p_type")), F.concat(F.lit(" "), F.lower(F.split_part("p_name", F.lit(" "), F.lit(2))), F.lit(" ")),
        F.concat(F.upper("p_name"), F.lit(" "), key, F.lit(" EXTRA LONG CODE")), F.concat(size, F.lit(" KV")), F.concat(F.lit("pn "), size))
    return words.unionByName(p.select(F.explode(specs).alias("w"))).distinct()


STRINGS = with_ctes(TEXTS, """strings AS (
  SELECT DISTINCT w FROM (
    SELECT unnest(string_split_regex(v, '[ \\n]+')) AS w FROM texts
    UNION ALL SELECT unnest([p_size || ' kVA', 'DN-' || p_partkey, p_size || 'x' || p_partkey, p_name, upper(p_name), p_size || ' Komplett',
      p_size || ',5-7 m3/h', p_brand || ', ' || p_type, ' ' || lower(split_part(p_name, ' ', 2)) || ' ',
      upper(p_name) || ' ' || p_partkey || ' EXTRA LONG CODE', p_size || ' KV', 'pn ' || p_size]) FROM part))""")

_U = T.any_of(T.UNITS + T.EXTRA_UNITS)
_U4 = T.any_of(T.UNITS)


def _m(pattern: str, flags: str = "") -> str:
    return f"regexp_matches(w, {q(f'{flags}^(?:{pattern})$')})"


PASSTHROUGH = " OR ".join([
    "w = ''", _m(T.NUMBER_CHARS), _m(rf"\s*(?:{_U})\s*"), _m(rf"{T.NUMBER_RANGE}(?:{_U})(?:\s*[/×x]\s*(?:{_U}))*\s*"),
    _m(T.PIPE_SPEC, "(?i)"), _m(T.RATING, "(?i)"),
    f"lower(trim(w)) IN ({', '.join(q(w) for w in T.LOANWORDS)})",
    _m(rf"\s*\d+\s+(?:{T.any_of(T.LOANWORDS)})\s*", "(?i)"),
    f"(length(w) <= 30 AND {_m(T.CODE_CHARS)})",
    f"(length(w) <= 200 AND {_m(T.CODE_LIST_CHARS)} AND regexp_matches(w, {q(r'[0-9,;/-]')}))",
])
PASSTHROUGH_SHORT = " OR ".join([
    _m(T.NUMBER_CHARS), _m(rf"{T.NUMBER_PRODUCT}(?:{_U4})(?:\s*[/×x]\s*(?:{_U4}))*\s*"),
    f"(length(w) <= 30 AND {_m(T.SHORT_CODE_CHARS)})"])


@query("x3_passthrough_values", STRINGS + f"SELECT w, ({PASSTHROUGH}) AS passthrough FROM strings")
def passthrough(spark, sf):
    return strings(spark, sf).select("w", T.is_passthrough(F.col("w")).alias("passthrough"))


@query("x4_passthrough_short", STRINGS + f"SELECT w, ({PASSTHROUGH_SHORT}) AS passthrough FROM strings")
def passthrough_short(spark, sf):
    return strings(spark, sf).select("w", T.is_passthrough_short(F.col("w")).alias("passthrough"))


# ---- scalar functions over whole texts ---------------------------------------------------------------

@query("x1_string_key", "SELECT doc_id, substr(sha1(text), 1, 16) AS h FROM documents")
def keys(spark, sf):
    return table(spark, sf, "documents").select("doc_id", T.hash16(F.col("text")).alias("h"))


@query("x2_row_to_text", """
SELECT p_partkey, concat_ws(' | ', 'p_name: ' || p_name, CASE WHEN p_size > 10 THEN 'kind: ' || p_type END, 'p_brand: ' || p_brand) AS text
FROM part""")
def row_text(spark, sf):
    p = table(spark, sf, "part").withColumn(
        "kind", F.when(F.col("p_size") > 10, F.col("p_type")).when(F.col("p_size") > 5, "  "))
    return p.select("p_partkey", T.row_to_text(["p_name", "kind", "p_brand"]).alias("text"))


_LETTERS = r"regexp_replace(tgt, '[^\p{L}]', '', 'g')"


@query("x5_script_share", with_ctes(TEXT_PAIR) + rf"""
SELECT doc_id, {s4('CASE WHEN n = 0 THEN 1 ELSE latin / n END', 'latin_share')},
       CASE WHEN greatest(latin, cyr) = 0 THEN '' WHEN cyr >= latin THEN 'CYRILLIC' ELSE 'LATIN' END AS dominant
FROM (SELECT doc_id, length({_LETTERS}) AS n, length(regexp_replace({_LETTERS}, '[^\p{{Latin}}]', '', 'g'))::DOUBLE AS latin,
             length(regexp_replace({_LETTERS}, '[^\p{{Cyrillic}}]', '', 'g'))::DOUBLE AS cyr FROM text_pair)""")
def scripts(spark, sf):
    tgt = F.col("tgt")
    return text_pairs(spark, sf).select(
        "doc_id", x4(T.script_share(tgt, ["LATIN"]), "latin_share"), T.dominant_script(tgt).alias("dominant"))


def tokens_sql(c: str) -> str:
    """Digits that touch a letter cannot start or end a number; blank them, then take what is left."""
    letter = "[A-Za-zА-Яа-я]"
    clean = f"regexp_replace(regexp_replace({c}, '({letter})[0-9]', '\\1#', 'g'), '[0-9]({letter})', '#\\1', 'g')"
    return f"list_filter(regexp_extract_all({clean}, '[0-9]+(?:[.,][0-9]+)?'), lambda t: length(t) > 1)"


@query("x6_numeric_tokens", f"SELECT doc_id, array_to_string({tokens_sql('text')}, ' ') AS tokens, len({tokens_sql('text')}) AS n FROM documents")
def tokens(spark, sf):
    t = T.numeric_tokens(F.col("text"))
    return table(spark, sf, "documents").select(
        "doc_id", F.array_join(t, " ").alias("tokens"), F.size(t).cast("long").alias("n"))


@query("x7_decimal_separator", "SELECT doc_id, sha1(replace(text, '.', ',')) AS h FROM documents")
def decimals(spark, sf):
    return table(spark, sf, "documents").select("doc_id", F.sha1(T.normalise_decimal(F.col("text"))).alias("h"))


KINDS = ["de_strict", "de_loose", "de_sv", "de_tr", "de_bg", "en_latin", "en_nonlatin"]
_ASCII_SHARE = r"(length(regexp_replace(w, '[^A-Za-z]', '', 'g'))::DOUBLE / nullif(length(regexp_replace(w, '[^\p{L}]', '', 'g')), 0))"
_DE = f"regexp_matches(w, {q(word_pattern(T.GERMAN_WORDS))})"
_EN = f"regexp_matches(w, {q(word_pattern(T.ENGLISH_WORDS))})"
_UML = "regexp_matches(w, '[äöüÄÖÜß]')"
LEFTOVER = f"""coalesce(CASE kind WHEN 'de_strict' THEN {_UML} WHEN 'de_loose' THEN {_UML} AND {_DE} WHEN 'de_sv' THEN w LIKE '%ß%'
  WHEN 'de_tr' THEN regexp_matches(w, '[äÄß]') WHEN 'de_bg' THEN {_ASCII_SHARE} > 0.6 AND ({_DE} OR {_UML})
  WHEN 'en_latin' THEN {_EN} AND NOT ({PASSTHROUGH}) WHEN 'en_nonlatin' THEN {_ASCII_SHARE} > 0.7 AND {_EN} AND NOT ({PASSTHROUGH}) END, false)"""


@query("x8_leftover_language", f"""
SELECT doc_id, kind, {LEFTOVER} AS leftover FROM (
  SELECT doc_id, text AS w, unnest([{', '.join(q(k) for k in KINDS)}]) AS kind FROM documents)""")
def leftovers(spark, sf):
    rows = table(spark, sf, "documents").select(
        "doc_id", "text", F.explode(F.array(*[F.lit(k) for k in KINDS])).alias("kind"))
    return rows.select("doc_id", "kind", T.is_leftover(F.col("text"), F.col("kind")).alias("leftover"))


# Codes from every part: a position, maybe an inline tag, a unit and a language suffix.
_TAGS = ["КАП", "MAJ", "", "INB", "建筑工", "XY"]
_UNITS = ["м3", "kg", "", "m", "шт"]
_LANGS = ["TRABAJO", "СТР", "", "BAU", "CON"]


def codes(spark, sf):
    def pick(values, c):
        return F.element_at(F.array(*[F.lit(v) for v in values]), (c % len(values) + 1).cast("int"))

    return table(spark, sf, "part").select("p_partkey", F.concat(
        F.lit("KA_"), F.upper(F.left("p_name", F.lit(4))), pick(_TAGS, F.col("p_partkey")),
        pick(_UNITS, F.col("p_size")), pick(_LANGS, F.floor(F.col("p_partkey") / 6))).alias("rate_code"))


def _pick_sql(values: list[str], c: str) -> str:
    return f"[{', '.join(q(v) for v in values)}][({c}) % {len(values)} + 1]"


def _cut_sql(c: str, suffixes: list[str], keep: int = 0) -> str:
    cases = " ".join(
        f"WHEN ends_with({c}, {q(s)}) AND length({c}) - {len(s)} >= {keep} THEN left({c}, length({c}) - {len(s)})"
        for s in sorted(suffixes, key=len, reverse=True))
    return f"CASE {cases} ELSE {c} END"


CODES = f"""codes AS (SELECT p_partkey, 'KA_' || upper(left(p_name, 4)) || {_pick_sql(_TAGS, 'p_partkey')} || {_pick_sql(_UNITS, 'p_size')}
       || {_pick_sql(_LANGS, 'CAST(floor(p_partkey / 6.0) AS BIGINT)')} AS rate_code FROM part),
base AS (SELECT p_partkey, rate_code, CASE WHEN contains(b, '_') AND length(last) > 4
                THEN left(b, length(b) - length(last)) || {_cut_sql('last', T.INLINE_TAGS, 4)} ELSE b END AS base_code
  FROM (SELECT *, list_last(string_split(b, '_')) AS last
        FROM (SELECT *, {_cut_sql('a', T.UNIT_SUFFIXES)} AS b FROM (SELECT *, {_cut_sql('rate_code', T.LANGUAGE_SUFFIXES)} AS a FROM codes))))"""


@query("x9_base_code", with_ctes(CODES) + "SELECT p_partkey, rate_code, base_code FROM base")
def base_codes(spark, sf):
    return codes(spark, sf).withColumn("base_code", T.base_code(F.col("rate_code")))


@query("j7_cross_language_codes", with_ctes(CODES) + """,
known AS (SELECT base_code, arg_max(p_type, p_partkey) AS ifc_class FROM base JOIN part USING (p_partkey) WHERE p_size <= 25 GROUP BY 1)
SELECT p_partkey, coalesce(k.ifc_class, p_brand) AS ifc_class, k.ifc_class IS NOT NULL AS propagated
FROM base JOIN part USING (p_partkey) LEFT JOIN known k USING (base_code)""")
def cross_language(spark, sf):
    p = table(spark, sf, "part")
    coded = codes(spark, sf).join(p, "p_partkey")
    classified = coded.filter("p_size <= 25").select("rate_code", F.col("p_partkey").alias("ord"), F.col("p_type").alias("ifc_class"))
    items = coded.select("p_partkey", "rate_code", F.col("p_brand").alias("ifc_class"))
    return TR.propagate(items, classified, ["ifc_class"]).select("p_partkey", "ifc_class", "propagated")


_DE_SUFFIX = "ung|heit|keit|nis|chaft|tum|lich|isch|enn|tech|maschine|gerät|werkzeug|werk"
_DE_WORDS = "der|die|das|den|dem|des|ein|mit|von|für|zur|zum|aus|auf|über|unter|durch|als|und|oder"
_EN_SUFFIX = "ing|tion|ment|ness|able|less|ful|ish"
_EN_WORDS = ("the|of|with|and|or|for|by|from|to|in|on|at|into|using|over|under|plate|sheet|tube|pipe|valve|pump|motor|"
             "tank|wire|cable|mesh|drill|machine|installation")


@query("x10_language_markers", rf"""
WITH w AS (SELECT doc_id, unnest(string_split_regex(text, '[^\p{{L}}\p{{N}}\p{{M}}_]+')) AS w FROM documents)
SELECT doc_id, bool_or(regexp_matches(w, '[äöüÄÖÜß]|^(?:{_DE_WORDS})$|^.+(?:{_DE_SUFFIX})$')) AS de,
       bool_or(regexp_matches(w, '(?i)^(?:{_EN_WORDS})$|^.+(?:{_EN_SUFFIX})$')) AS en FROM w GROUP BY 1""")
def markers(spark, sf):
    return table(spark, sf, "documents").select(
        "doc_id", T.has_markers(F.col("text"), "de").alias("de"), T.has_markers(F.col("text"), "en").alias("en"))


@query("x15_point_ids", """
SELECT p_partkey, substr(s, 1, 8) || '-' || substr(s, 9, 4) || '-' || substr(s, 13, 4) || '-' || substr(s, 17, 4) || '-' || substr(s, 21, 12) AS id
FROM (SELECT p_partkey, sha1(p_type || '|' || p_partkey) AS s FROM part)""")
def point_ids(spark, sf):
    return table(spark, sf, "part").select(
        "p_partkey", T.uuid_from(F.col("p_type"), F.col("p_partkey").cast("string")).alias("id"))


@query("s13_cell_truncation", """
SELECT doc_id, length(c) AS n, right(c, 14) AS tail FROM (
  SELECT doc_id, CASE WHEN length(t) > 32700 THEN left(t, 32700) || '...[truncated]' ELSE t END AS c
  FROM (SELECT doc_id, repeat(text, 3) AS t FROM documents))""")
def cells(spark, sf):
    cell = T.cell_text(F.repeat("text", F.lit(3)))
    return table(spark, sf, "documents").select(
        "doc_id", F.length(cell).cast("long").alias("n"), F.right(cell, F.lit(14)).alias("tail"))


# ---- distinct strings, pending, dictionaries -----------------------------------------------------------

STRS = """strs AS (SELECT substr(sha1(v), 1, 16) AS h, min(v) AS v, count(*) AS freq, min(ROW(col_ord, a, b)) AS seen FROM texts WHERE length(trim(v)) > 0 GROUP BY 1)"""
# The dictionary so far: the edited form of all documents, some without an answer and some under a key that no text has.
CACHE = """cache AS (SELECT substr(sha1(src || CASE WHEN length(src) % 7 = 0 THEN '?' ELSE '' END), 1, 16) AS h,
  min(CASE WHEN length(src) % 11 = 0 THEN '' ELSE tgt END) AS target FROM text_pair GROUP BY 1)"""


def cache(spark, sf):
    target = F.when(F.length("src") % 11 == 0, "").otherwise(F.col("tgt"))
    key = F.concat("src", F.when(F.length("src") % 7 == 0, "?").otherwise(""))
    return text_pairs(spark, sf).groupBy(T.hash16(key).alias("h")).agg(F.min(target).alias("target"))


@query("u3_distinct_strings", with_ctes(TEXTS, STRS) + "SELECT h, length(v) AS n_chars, seen[1] AS first_col, seen[2] AS first_row FROM strs")
def distinct_strings(spark, sf):
    return TR.distinct_strings(texts(spark, sf)).select(
        "h", F.length("v").cast("long").alias("n_chars"), F.col("first_seen.col_ord").alias("first_col"),
        F.col("first_seen.row_ord.a").alias("first_row"))


@query("a16_string_frequency", with_ctes(TEXTS) + "SELECT substr(sha1(v), 1, 16) AS h, count(*) AS freq FROM texts WHERE length(trim(v)) > 0 GROUP BY 1")
def frequency(spark, sf):
    return TR.distinct_strings(texts(spark, sf)).select("h", "freq")


@query("j8_pending_strings", with_ctes(TEXTS, STRS, TEXT_PAIR, CACHE) + "SELECT h, freq FROM strs WHERE h NOT IN (SELECT h FROM cache)")
def pending(spark, sf):
    return TR.pending_strings(TR.distinct_strings(texts(spark, sf)), cache(spark, sf)).select("h", "freq")


@query("w5_frequency_split", with_ctes(TEXTS, STRS, TEXT_PAIR, CACHE) + """
SELECT h, CASE WHEN row_number() OVER (ORDER BY freq DESC, seen) <= 200 THEN 'head' ELSE 'tail' END AS part
FROM strs WHERE h NOT IN (SELECT h FROM cache)""")
def frequency_split(spark, sf):
    rows = TR.pending_strings(TR.distinct_strings(texts(spark, sf)), cache(spark, sf))
    return TR.split_by_frequency(rows, 200).select("h", "part")


@query("j1_translation_remap", with_ctes(TEXT_PAIR, CACHE) + """
SELECT doc_id, substr(sha1(CASE WHEN length(c.target) > 0 THEN c.target ELSE text END), 1, 16) AS h,
       CASE WHEN d.source IN ('src1', 'src2', 'src3') THEN 'Quelle ' || right(d.source, 1) ELSE d.source END AS source
FROM documents d LEFT JOIN cache c ON c.h = substr(sha1(text), 1, 16)""")
def remap(spark, sf):
    d = table(spark, sf, "documents")
    names = d.filter(F.col("source").isin("src1", "src2", "src3")).groupBy(T.hash16(F.col("source")).alias("h")).agg(
        F.concat(F.lit("Quelle "), F.right(F.min("source"), F.lit(1))).alias("target"))
    out = TR.apply_translations(d, ["text", "source"], cache(spark, sf).unionByName(names))
    return out.select("doc_id", T.hash16(F.col("text")).alias("h"), "source")


@query("j9_reverse_lookup", with_ctes(TEXTS, STRS, TEXT_PAIR, CACHE) + "SELECT h, length(target) AS n_target, length(v) AS n_source FROM cache JOIN strs USING (h)")
def reverse_lookup(spark, sf):
    out = TR.resolve_sources(cache(spark, sf), TR.distinct_strings(texts(spark, sf)))
    return out.select("h", F.length("target").cast("long").alias("n_target"), F.length("source").cast("long").alias("n_source"))


@query("q21_cache_sweep", with_ctes(TEXTS, STRS, TEXT_PAIR, CACHE) + """
SELECT h, length(v) AS n_source FROM cache JOIN strs USING (h) WHERE regexp_matches(target, '[äöüÄÖÜß]')""")
def cache_sweep(spark, sf):
    out = TR.suspicious_targets(cache(spark, sf), TR.distinct_strings(texts(spark, sf)),
                                lambda c: F.rlike(c, F.lit(T.GERMAN_LETTERS)))
    return out.select("h", F.length("source").cast("long").alias("n_source"))


@query("u4_dictionary_merge", with_ctes(TEXT_PAIR, CACHE) + """
SELECT h, substr(sha1(coalesce(n.target, c.target)), 1, 16) AS t FROM cache c
FULL JOIN (SELECT substr(sha1(text), 1, 16) AS h, min('n' || text) AS target FROM conversations GROUP BY 1
           UNION ALL SELECT substr(sha1(text), 1, 16), min('n' || text) FROM documents GROUP BY 1) n USING (h)""")
def merge(spark, sf):
    talk = table(spark, sf, "conversations").select("text")
    newer = talk.unionByName(table(spark, sf, "documents").select("text")).groupBy(T.hash16(F.col("text")).alias("h")).agg(F.min(F.concat(F.lit("n"), "text")).alias("target"))
    out = TR.merge_dictionaries(cache(spark, sf), newer, ["h"], "target")
    return out.select("h", T.hash16(F.col("target")).alias("t"))


@query("j10_pivot_dictionary", """
WITH d AS (SELECT p_name || ' ' || p_partkey AS en, p_type || ' ' || p_size AS de, p_partkey AS ord,
  CASE WHEN p_size % 5 = 0 THEN '' WHEN p_size % 7 = 0 THEN p_name || ' ' || p_partkey ELSE 'T' || p_brand END AS tgt FROM part)
SELECT de AS src_term, tgt AS tgt_term FROM (SELECT * FROM d QUALIFY row_number() OVER (PARTITION BY de ORDER BY ord) = 1)
WHERE trim(tgt) <> '' AND tgt <> en""")
def pivot_dictionary(spark, sf):
    p = table(spark, sf, "part")
    en = F.concat_ws(" ", "p_name", F.col("p_partkey").cast("string"))
    source = p.select(en.alias("en"), F.concat_ws(" ", "p_type", F.col("p_size").cast("string")).alias("term"), F.col("p_partkey").alias("ord"))
    target = F.when(F.col("p_size") % 5 == 0, "").when(F.col("p_size") % 7 == 0, en).otherwise(F.concat(F.lit("T"), "p_brand"))
    return TR.compose_through_pivot(source, p.select(en.alias("en"), target.alias("term"), F.col("p_partkey").alias("ord")))


# ---- glossary -------------------------------------------------------------------------------------------
# Terms are the distinct words of the benchmark texts, ordered by first item and spelling.

def glossary(spark, sf):
    words = table(spark, sf, "benchmark").select("item_id", F.explode(F.split(F.lower("text"), r"[^\p{L}]+")).alias("w"))
    first = words.filter(F.length("w") > 0).groupBy("w").agg(F.min("item_id").alias("item"))
    placed = numbered(first, [], ["item", "w"], "ord", block=F.col("item"))
    return placed.select("ord", F.col("w").alias("src_term"), F.translate("w", LOWER, UPPER).alias("tgt_term"))


GLOSSARY = r"""glossary AS (SELECT w AS term, min(item_id) AS item FROM (
  SELECT item_id, unnest(string_split_regex(lower(text), '[^\p{L}]+')) AS w FROM benchmark) WHERE length(w) > 0 GROUP BY 1)"""


@query("j11_glossary_terms_in_batches", with_ctes(GLOSSARY) + """
SELECT batch, term FROM (SELECT DISTINCT CAST(floor(doc_id / 25.0) AS BIGINT) AS batch, term, item FROM documents JOIN glossary ON contains(lower(text), term))
QUALIFY row_number() OVER (PARTITION BY batch ORDER BY item, term) <= 30""")
def glossary_batches(spark, sf):
    docs = table(spark, sf, "documents").select(
        F.col("doc_id").alias("id"), F.floor(F.col("doc_id") / 25).alias("batch"), F.col("text").alias("v"))
    return TR.batch_glossary(docs, glossary(spark, sf)).select("batch", F.col("src_term").alias("term"))


@query("w7_capped_glossary", with_ctes(TEXT_PAIR) + """
, p AS (SELECT src, tgt, 0 AS c, doc_id AS a FROM text_pair WHERE src <> tgt
        UNION ALL SELECT source, source || lang, 1, doc_id FROM text_pair),
f AS (SELECT src, arg_min(tgt, ROW(c, a)) AS tgt, min(ROW(c, a)) AS seen FROM p GROUP BY 1)
SELECT substr(sha1(src), 1, 16) AS s, substr(sha1(tgt), 1, 16) AS t FROM f ORDER BY seen LIMIT 500""")
def capped_glossary(spark, sf):
    tp = text_pairs(spark, sf)
    pairs = tp.filter("src <> tgt").select("src", "tgt", F.lit(0).alias("col_ord"), F.col("doc_id").alias("row_ord")).unionByName(
        tp.select(F.col("source").alias("src"), F.concat("source", "lang").alias("tgt"), F.lit(1).alias("col_ord"),
                  F.col("doc_id").alias("row_ord")))
    out = TR.glossary_from_pairs(pairs, 500)
    return out.select(T.hash16(F.col("src")).alias("s"), T.hash16(F.col("tgt")).alias("t"))


# ---- numbered answers: each document is a batch, its lines are the inputs ------------------------------
# Every fifth line stays unanswered, marks take turns, and one late line answers number 1 again.

def _answers(spark, sf):
    docs = table(spark, sf, "documents")
    inputs = docs.select(F.col("doc_id").alias("batch"), F.posexplode(F.split("text", "\n")).alias("pos", "source")).select(
        "batch", (F.col("pos") + 1).alias("idx"), "source")
    marks = F.array(F.lit(". "), F.lit(") "), F.lit(" - "), F.lit(":"))

    def line(x, i):
        number = (i + 1).cast("string")
        return F.when(i % 5 == 4, F.concat(F.lit("note "), x)).otherwise(
            F.concat(F.lit("  "), number, F.element_at(marks, (i % 4 + 1).cast("int")), F.translate(x, LOWER, UPPER)))

    raw = F.concat(F.array_join(F.transform(F.split("text", "\n"), line), "\n"), F.lit("\n1) again\n0. none\n999999. far"))
    return docs.select(F.col("doc_id").alias("batch"), raw.alias("raw")), inputs


@query("x14_numbered_answers", r"""
WITH i AS (SELECT doc_id AS batch, unnest(string_split(text, chr(10))) AS source, generate_subscripts(string_split(text, chr(10)), 1) AS idx FROM documents),
lines AS (
  SELECT batch, idx AS pos, CASE WHEN idx % 5 = 0 THEN 'note ' || source ELSE '  ' || idx || ['. ', ') ', ' - ', ':'][(idx - 1) % 4 + 1] || translate(source, 'abcdefghijklmnopqrstuvwxyz', 'ABCDEFGHIJKLMNOPQRSTUVWXYZ') END AS line FROM i
  UNION ALL SELECT doc_id, 1000000000, '1) again' FROM documents),
p AS (SELECT batch, pos, regexp_extract(line, '^\s*([0-9]+\s*(?:\.|\)| -|:))', 1) AS head,
             TRY_CAST(regexp_extract(line, '^\s*([0-9]+)\s*(?:\.|\)| -|:)', 1) AS INTEGER) AS idx,
             trim(regexp_extract(line, '(?s)^\s*[0-9]+\s*(?:\.|\)| -|:)(.*)$', 1)) AS answer FROM lines),
l AS (SELECT batch, idx, arg_max(answer, pos) AS answer FROM p WHERE idx IS NOT NULL AND length(head) <= 6 GROUP BY 1, 2)
SELECT i.batch, CAST(i.idx AS INTEGER) AS idx, substr(sha1(CASE WHEN length(answer) > 0 THEN answer ELSE source END), 1, 16) AS target
FROM i LEFT JOIN l ON l.batch = i.batch AND l.idx = i.idx""")
def numbered_answers(spark, sf):
    responses, inputs = _answers(spark, sf)
    return TR.parse_numbered(responses, inputs).select("batch", "idx", T.hash16(F.col("target")).alias("target"))
