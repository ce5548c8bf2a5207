"""Audit layers for translated text. A layer returns every checked item with ``flagged``; reports,
statistics and purging build on that."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from costweave.functions.text import (
    LANGUAGE_SCRIPTS, dominant_script, hash16, is_leftover, is_passthrough, is_passthrough_short, marker_count,
    normalise_decimal, numeric_tokens, script_share,
)
from costweave.functions.vectors import cosine
from costweave.operators.ordering import cap_per_group
from costweave.operators.translation import terms_in_texts
from costweave.session import cut_lineage

FLAG_COLS = ["layer", "col", "hash", "source_value", "target_value", "reason", "severity"]
MIN_SHARE = 0.15
COMPACT_LANGS = ["ja", "ko", "zh", "th"]


def _checked(df: DataFrame, layer: str, flagged: Column, reason: Column, severity: str, col: Column, h: Column,
             source: Column, target: Column) -> DataFrame:
    return df.select(
        F.lit(layer).alias("layer"), col.alias("col"), h.alias("hash"), source.alias("source_value"),
        target.alias("target_value"), F.when(flagged, reason).alias("reason"), F.lit(severity).alias("severity"),
        flagged.alias("flagged"))


def translation_pairs(long: DataFrame) -> DataFrame:
    """Distinct (h, src, tgt): both present and different; the first row in column order wins per key.

    ``long`` has src, tgt, col_ord and row_ord.
    """
    usable = long.filter((F.length("src") > 0) & (F.length("tgt") > 0) & (F.col("src") != F.col("tgt")))
    first = usable.groupBy(hash16(F.col("src")).alias("h"), "src")
    return first.agg(F.min_by("tgt", F.struct("col_ord", "row_ord")).alias("tgt"))


def script_block(strings: DataFrame, lang: str) -> DataFrame:
    """Distinct target strings with too few letters of the language's scripts. ``strings``: h, v, col."""
    scripts = LANGUAGE_SCRIPTS.get(lang)
    if not scripts:
        return strings.limit(0).transform(lambda d: _checked(
            d, "script_block", F.lit(False), F.lit(""), "error", F.lit(""), F.col("h"), F.lit(""), F.col("v")))
    v = F.col("v")
    rows = strings.filter((F.length(F.trim("v")) > 0) & ~is_passthrough_short(v)).withColumn(
        "_share", script_share(v, scripts))
    dominant = dominant_script(v)
    reason = F.concat(F.lit("only "), F.bround(F.col("_share") * 100, 0).cast("int").cast("string"),
                      F.lit(f"% chars in {'+'.join(scripts)}, dominant="),
                      F.when(dominant == "", "none").otherwise(dominant))
    return _checked(rows, "script_block", F.col("_share") < MIN_SHARE, reason, "error", F.col("col"), F.col("h"),
                    F.lit(""), v)


def sister_leakage(strings: DataFrame, lang: str = "bg", sister: str = "ru") -> DataFrame:
    """Target strings with at least two markers of the sister language and none of their own."""
    rows = strings.filter(F.length(F.trim("v")) > 0).withColumns({
        "_theirs": marker_count(F.col("v"), sister), "_own": marker_count(F.col("v"), lang)})
    reason = F.concat(F.lit(f"{sister} markers="), F.col("_theirs").cast("string"), F.lit(f" {lang} markers="),
                      F.col("_own").cast("string"))
    return _checked(rows, f"{sister}_leakage", (F.col("_theirs") >= 2) & (F.col("_own") == 0), reason, "error",
                    F.col("col"), F.col("h"), F.lit(""), F.col("v"))


def glossary_consistency(pairs: DataFrame, glossary: DataFrame) -> DataFrame:
    """Pairs whose source has a glossary term (three characters or more) but whose target lacks its translation.

    Terms are looked for on both sides and the findings joined by key, so no text is copied per term.
    One row per pair with a term: ``checks`` counts rules up to and including the first violation.
    """
    rules = glossary.filter(F.length("src_term") >= 3)
    wanted = terms_in_texts(pairs, rules, "h", "src", "ord", "src_term")
    kept = terms_in_texts(pairs, rules, "h", "tgt", "ord", "tgt_term").withColumn("_kept", F.lit(True))
    judged = wanted.join(kept, ["text_id", "term_id"], "left")
    place = F.row_number().over(W.partitionBy("text_id").orderBy("term_id"))
    placed = judged.select("text_id", "term_id", "_kept", place.alias("_place"))
    broken = F.col("_kept").isNull()
    verdict = placed.groupBy("text_id").agg(
        F.min(F.when(broken, F.col("term_id"))).alias("term_id"),
        F.coalesce(F.min(F.when(broken, F.col("_place"))), F.max("_place")).cast("long").alias("checks"))
    rows = verdict.join(rules.select(F.col("ord").alias("term_id"), "src_term", "tgt_term"), "term_id", "left").join(
        pairs.withColumnRenamed("h", "text_id"), "text_id")
    reason = F.concat(F.lit("glossary requires '"), F.col("tgt_term"), F.lit("' for '"), F.lower("src_term"), F.lit("'"))
    return rows.select(
        F.lit("glossary_consistency").alias("layer"), F.lit("*").alias("col"), F.col("text_id").alias("hash"),
        F.col("src").alias("source_value"), F.col("tgt").alias("target_value"),
        F.when(F.col("term_id").isNotNull(), reason).alias("reason"), F.lit("warn").alias("severity"),
        F.col("term_id").isNotNull().alias("flagged"), "checks")


def numeric_preservation(pairs: DataFrame) -> DataFrame:
    """Pairs with numbers in the source; flagged when one of them is not in the target."""
    rows = pairs.withColumn("_nums", numeric_tokens(F.col("src"))).filter(F.size("_nums") > 0)
    target = normalise_decimal(F.col("tgt"))
    missing = F.filter("_nums", lambda t: ~F.contains(target, normalise_decimal(t)))
    rows = rows.withColumn("_missing", missing)
    reason = F.concat(F.lit("missing numeric tokens: "), F.array_join("_missing", ", "))
    return _checked(rows, "numeric_preservation", F.size("_missing") > 0, reason, "error", F.lit("*"), F.col("h"),
                    F.col("src"), F.col("tgt"))


def length_sanity(pairs: DataFrame, lang: str) -> DataFrame:
    """Pairs whose length ratio is outside [0.3, 3], or [0.1, 2] for compact scripts."""
    low, high = (0.1, 2.0) if lang in COMPACT_LANGS else (0.3, 3.0)
    rows = pairs.filter((F.length("src") >= 5) & (F.length("tgt") >= 1)).withColumn(
        "_ratio", F.length("tgt") / F.length("src"))
    reason = F.concat(F.lit("len ratio="), F.format_string("%.2f", "_ratio"), F.lit(f" outside [{low}, {high}]"))
    return _checked(rows, "length_sanity", (F.col("_ratio") < low) | (F.col("_ratio") > high), reason, "warn",
                    F.lit("*"), F.col("h"), F.col("src"), F.col("tgt"))


def round_trip(pairs: DataFrame, source_vectors: DataFrame, back_vectors: DataFrame, threshold: float = 0.7) -> DataFrame:
    """Pairs whose source vector and back-translated vector are too far apart. Vectors: (h, vector)."""
    rows = (
        pairs.join(source_vectors.select("h", F.col("vector").alias("_a")), "h")
        .join(back_vectors.select("h", F.col("vector").alias("_b")), "h")
        .withColumn("_cos", cosine(F.col("_a"), F.col("_b")))
    )
    reason = F.concat(F.lit("backtrans cosine="), F.format_string("%.2f", "_cos"), F.lit(f" < {threshold}"))
    return _checked(rows, "round_trip", F.col("_cos") < threshold, reason, "error", F.lit("*"), F.col("h"),
                    F.col("src"), F.col("tgt"))


def layer_stats(checked: DataFrame) -> DataFrame:
    """Checked and flagged counts and the flagged percentage per layer."""
    n = F.sum("checks") if "checks" in checked.columns else F.count(F.lit(1))
    return checked.groupBy("layer").agg(n.alias("checked"), F.count_if("flagged").alias("flagged")).withColumn(
        "pct", F.try_divide(F.col("flagged") * 100.0, F.col("checked")))


def audit_text(long: DataFrame, lang: str, glossary: DataFrame | None = None,
               vectors: tuple[DataFrame, DataFrame] | None = None) -> DataFrame:
    """All layers over aligned text. ``long``: col, col_ord, row_ord, src, tgt. One row per check.

    The distinct pairs serve several layers, so they are written once to the shared folder (a job).
    """
    targets = (
        long.filter(F.length(F.trim("tgt")) > 0)
        .groupBy(hash16(F.col("tgt")).alias("h"), F.col("tgt").alias("v"))
        .agg(F.min_by("col", F.struct("col_ord", "row_ord")).alias("col"))
    )
    pairs = cut_lineage(translation_pairs(long))
    layers = [script_block(targets, lang), numeric_preservation(pairs), length_sanity(pairs, lang)]
    if lang == "bg":
        layers.append(sister_leakage(targets))
    if vectors is not None:
        layers.append(round_trip(pairs, *vectors))
    layers = [d.withColumn("checks", F.lit(1).cast("long")) for d in layers]
    if glossary is not None:
        layers.append(glossary_consistency(pairs, glossary))
    out = layers[0]
    for d in layers[1:]:
        out = out.unionByName(d)
    return out


def report_sample(checked: DataFrame, per_layer: int = 50) -> DataFrame:
    """At most ``per_layer`` flagged rows of each layer for a report."""
    return cap_per_group(checked.filter("flagged"), ["layer"], per_layer, ["hash"]).select(*FLAG_COLS)


def passes(checked: DataFrame) -> DataFrame:
    """Only the script layer is a hard failure."""
    return checked.agg((F.count_if(F.col("flagged") & (F.col("layer") == "script_block")) == 0).alias("passed"),
                       F.count_if("flagged").alias("flagged_count"))


def verbatim_leftovers(pairs_long: DataFrame) -> DataFrame:
    """Distinct values that equal their source and are not language-independent."""
    same = pairs_long.filter((F.length("tgt") > 0) & (F.col("src") == F.col("tgt"))).select("tgt").distinct()
    return same.filter(~is_passthrough(F.col("tgt")))


def residual_language(pairs_long: DataFrame, kind: Column) -> DataFrame:
    """Source strings whose target still shows the source language; first such target per source.

    The check runs on distinct (src, tgt) pairs. ``pairs_long``: src, tgt, col_ord, row_ord.
    """
    distinct = (
        pairs_long.filter((F.length("src") > 0) & (F.length("tgt") > 0))
        .withColumn("_kind", kind)
        .groupBy("src", "tgt", "_kind")
        .agg(F.min(F.struct("col_ord", "row_ord")).alias("at"))
    )
    bad = distinct.filter(is_leftover(F.col("tgt"), F.col("_kind")))
    return bad.groupBy("src").agg(F.min_by("tgt", "at").alias("tgt"))
