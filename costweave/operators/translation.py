"""Life cycle of translated text: distinct strings, what is pending, merging and applying translations."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

try:
    import ahocorasick
except ImportError:  # the equi-join serves every glossary then
    ahocorasick = None

from costweave.functions.joins import null_safe_join
from costweave.functions.sizing import BROADCAST_BYTES, bounded_batches, is_bounded
from costweave.functions.text import base_code, hash16
from costweave.operators.ordering import cap_per_group


def unpivot_text(df: DataFrame, cols: Sequence[str], order: str) -> DataFrame:
    """(col, col_ord, row_ord, v) for the non-blank values of the columns."""
    cells = [F.struct(F.lit(c).alias("col"), F.lit(i).alias("col_ord"), F.col(c).alias("v")) for i, c in enumerate(cols)]
    long = df.select(F.col(order).alias("row_ord"), F.explode(F.array(*cells)).alias("_c")).select("_c.*", "row_ord")
    return non_blank(long)


def non_blank(long: DataFrame) -> DataFrame:
    return long.filter(F.length(F.trim("v")) > 0)


def distinct_strings(long: DataFrame) -> DataFrame:
    """One row per distinct string: key ``h``, value, occurrences and where it was first seen.

    Strings that share a key stay apart.
    """
    return non_blank(long).groupBy(hash16(F.col("v")).alias("h"), "v").agg(
        F.count(F.lit(1)).alias("freq"), F.min(F.struct("col_ord", "row_ord")).alias("first_seen"))


def pending_strings(strings: DataFrame, cache: DataFrame, marker: Callable[[Column], Column] | None = None) -> DataFrame:
    """Strings without a translation; with ``marker`` only those it accepts."""
    rows = strings if marker is None else strings.filter(marker(F.col("v")))
    return rows.join(cache.select("h"), "h", "left_anti")


def head_of(pending: DataFrame, n: int) -> DataFrame:
    """The n most frequent pending strings (ties by first occurrence): a bounded sort."""
    return pending.orderBy(F.col("freq").desc(), "first_seen").limit(n)


def split_by_frequency(pending: DataFrame, n: int) -> DataFrame:
    """Pending strings marked ``head`` (the n most frequent) or ``tail`` (all others)."""
    head = head_of(pending, n).select("h", F.lit(True).alias("_in"))
    joined = pending.join(head, "h", "left")
    return joined.withColumn("part", F.when(F.col("_in"), "head").otherwise("tail")).drop("_in")


def apply_translations(df: DataFrame, cols: Sequence[str], cache: DataFrame, newest: str | None = None) -> DataFrame:
    """Replace values by their translation; without one, or with an empty one, the value stays.

    Rows of ``df`` are neither multiplied nor merged: a key that the dictionary holds more than once counts once, with
    the target of the largest ``newest`` or, without such a column, the smallest target. The joins carry no hint, so
    adaptive execution broadcasts a dictionary that its measured size allows and splits hot strings otherwise.
    """
    target = F.min("target") if newest is None else F.max_by("target", F.struct(newest, "target"))
    known = cache.filter((F.length("target") > 0) & F.col("h").isNotNull()).groupBy("h").agg(target.alias("target"))
    out = df
    for i, c in enumerate(cols):
        lookup = known.select(F.col("h").alias(f"_h{i}"), F.col("target").alias(f"_t{i}"))
        out = out.join(lookup, hash16(F.col(c)) == F.col(f"_h{i}"), "left")
    return out.select(*[F.coalesce(f"_t{cols.index(c)}", c).alias(c) if c in cols else F.col(c) for c in df.columns])


def resolve_sources(cache: DataFrame, strings: DataFrame) -> DataFrame:
    """Cache rows with their source string; keys that match no string are dropped."""
    return cache.join(strings.select("h", F.col("v").alias("source")), "h", "inner")


def suspicious_targets(cache: DataFrame, strings: DataFrame, marker: Callable[[Column], Column]) -> DataFrame:
    """Cached targets that the marker accepts, with their source string."""
    return resolve_sources(cache.filter(marker(F.col("target"))), strings)


def merge_dictionaries(base: DataFrame, newer: DataFrame, keys: Sequence[str], value: str) -> DataFrame:
    """Union of two dictionaries; on a shared key the newer value wins."""
    both = base.select(*keys, F.struct(value).alias("_v"), F.lit(0).alias("_age")).unionByName(
        newer.select(*keys, F.struct(value).alias("_v"), F.lit(1).alias("_age")))
    return both.groupBy(*keys).agg(F.max_by("_v", "_age").alias("_v")).select(*keys, f"_v.{value}")


def purge(cache: DataFrame, flagged: DataFrame) -> DataFrame:
    """Cache without the keys flagged as errors; rows that an audit checked and did not flag purge nothing."""
    return cache.join(flagged_errors(flagged).select(F.col("hash").alias("h")).distinct(), "h", "left_anti")


def flagged_errors(checked: DataFrame, layers: Sequence[str] | None = None) -> DataFrame:
    """The rows of an audit that are flagged as errors, of all layers or of those named."""
    rows = checked.filter(F.col("severity") == "error")
    if "flagged" in checked.columns:
        rows = rows.filter("flagged")
    return rows if layers is None else rows.filter(F.col("layer").isin(*layers))


def compose_through_pivot(en_source: DataFrame, en_target: DataFrame) -> DataFrame:
    """source -> target from en -> source and en -> target dictionaries.

    Both carry en, term and ord. The inverse keeps the first English term per source term; blank
    terms, and targets equal to the English term, are dropped.
    """
    inverse = (
        en_source.filter(F.length(F.trim("term")) > 0)
        .groupBy(F.col("term").alias("src_term"))
        .agg(F.min_by("en", "ord").alias("en"))
    )
    usable = en_target.filter((F.length(F.trim("term")) > 0) & (F.col("term") != F.col("en")))
    return inverse.join(usable.select("en", F.col("term").alias("tgt_term")), "en", "inner").select("src_term", "tgt_term")


# ---- glossary terms inside texts ------------------------------------------------------------------

GRAM = 3
AUTOMATON_TERMS = 50_000


def _grams(chars: Column, size: int) -> Column:
    """All pieces of ``size`` characters of a text given as an array of characters."""
    def piece(c, i):
        return F.concat(c, *[F.get(chars, i + k) for k in range(1, size)])

    return F.filter(F.transform(chars, piece), lambda g: g.isNotNull())


def terms_in_texts(texts: DataFrame, terms: DataFrame, text_id: str, text: str, term_id: str, term: str,
                   automaton_terms: int = AUTOMATON_TERMS) -> DataFrame:
    """(text_id, term_id), once each, for every term contained in a text, ignoring case. Ids of texts may repeat.

    A glossary of measured, bounded size becomes one automaton that reads every text once, inside
    Arrow batches. A larger one takes an equi-join, see ``_terms_by_rarest_piece``. Neither compares
    each text with each term.
    """
    low_texts = texts.select(F.col(text_id).alias("text_id"), F.lower(text).alias("_text"))
    low_terms = terms.select(F.col(term_id).alias("term_id"), F.lower(term).alias("_term")).filter(F.length("_term") > 0)
    if ahocorasick is not None:
        if is_bounded(low_terms.select("_term"), automaton_terms, BROADCAST_BYTES):
            return _terms_by_automaton(low_texts, low_terms, low_terms.collect()).distinct()
    return _terms_by_rarest_piece(low_texts, low_terms).distinct()


def _terms_by_automaton(low_texts: DataFrame, low_terms: DataFrame, known: list) -> DataFrame:
    by_text: dict[str, list[int]] = {}
    for i, row in enumerate(known):
        by_text.setdefault(row["_term"], []).append(i)
    words = list(by_text.items())
    id_type = low_texts.schema["text_id"].dataType.simpleString()

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        machine = ahocorasick.Automaton()
        for word, numbers in words:
            machine.add_word(word, numbers)
        if words:
            machine.make_automaton()
        for batch in batches:
            rows, nums = [], []
            for row, value in enumerate(batch.column("_text") if words else ()):
                # One text at a time becomes a Python string; a batch of long texts is never held twice.
                text = value.as_py()
                if text is None:
                    continue
                found = set()
                for _, numbers in machine.iter(text):
                    found.update(numbers)
                rows.extend([row] * len(found))
                nums.extend(found)
            yield pa.RecordBatch.from_arrays(
                [batch.column("text_id").take(pa.array(rows, pa.int64())), pa.array(nums, pa.int32())], names=["text_id", "_no"])

    bounded_batches(low_texts.sparkSession)
    hits = low_texts.mapInArrow(scan, f"text_id {id_type}, _no int")
    numbers = low_texts.sparkSession.createDataFrame(
        [(i, row["term_id"]) for i, row in enumerate(known)],
        T.StructType([T.StructField("_no", T.IntegerType()), T.StructField("term_id", low_terms.schema["term_id"].dataType)]))
    return hits.join(F.broadcast(numbers), "_no").select("text_id", "term_id")


def _terms_by_rarest_piece(low_texts: DataFrame, low_terms: DataFrame) -> DataFrame:
    """A term can only be in a text that has the term's rarest three-character piece (or the whole
    term, if shorter). Texts and terms meet on that piece and are then verified. How rare a piece
    is comes from the texts themselves."""

    def chars(c: str) -> Column:
        return F.filter(F.split(c, ""), lambda x: x != "")

    def all_grams(df: DataFrame, keep: Sequence[str], c: str) -> DataFrame:
        # the characters become a column first, so they are split once and not per piece
        split = df.select(*keep, chars(c).alias("_chars"))
        sizes = F.array(*[_grams(F.col("_chars"), k) for k in range(1, GRAM + 1)])
        return split.select(*keep, F.explode(F.array_distinct(F.flatten(sizes))).alias("_gram"))

    pieces = all_grams(low_terms, ["term_id", "_term"], "_term").filter(
        F.length("_gram") == F.least(F.length("_term"), F.lit(GRAM)))
    text_grams = all_grams(low_texts, ["text_id"], "_text").join(
        pieces.select("_gram").distinct(), "_gram", "left_semi")
    frequency = text_grams.groupBy("_gram").agg(F.count(F.lit(1)).alias("_df"))
    probe = (
        pieces.join(frequency, "_gram", "left")
        .groupBy("term_id", "_term")
        .agg(F.min_by("_gram", F.struct(F.coalesce("_df", F.lit(0)), F.col("_gram"))).alias("_gram"))
    )
    candidates = text_grams.join(probe, "_gram", "inner")
    whole = F.col("_term") == F.col("_gram")
    sure = candidates.filter(whole).select("text_id", "term_id")
    verified = candidates.filter(~whole).select("text_id", "term_id", "_term").join(low_texts, "text_id").filter(
        F.contains("_text", "_term"))
    return sure.unionByName(verified.select("text_id", "term_id"))


def batch_glossary(batched: DataFrame, glossary: DataFrame, cap: int = 30) -> DataFrame:
    """For each batch of texts, the glossary terms found in any of them, at most ``cap`` in glossary order.

    ``batched`` has batch and v; ``glossary`` has ord, src_term, tgt_term.
    """
    hits = terms_in_texts(batched, glossary, "batch", "v", "ord", "src_term")
    per_batch = hits.select(F.col("text_id").alias("batch"), F.col("term_id").alias("ord")).distinct()
    return cap_per_group(per_batch, ["batch"], cap, ["ord"]).join(glossary, "ord", "inner")


# ---- answers that come back as numbered lists --------------------------------------------------------

LINE_BREAKS = "\r\n|[\n\r\u000b\u000c\u001c\u001d\u001e\u0085  ]"
ALL_MARKS = (".", ")", " -", ":")


def parse_numbered(responses: DataFrame, inputs: DataFrame, marks: Sequence[str] = ALL_MARKS) -> DataFrame:
    """Match numbered answer lines to the inputs they answer.

    ``responses(batch, raw)``, ``inputs(batch, idx, source)`` with idx from 1. A line counts when a
    number and a mark stand in its first six characters. The last line of a number wins; an input
    without an answer, or with an empty one, falls back to its own text.
    """
    mark = "|".join("\\" + m if len(m) == 1 else m for m in marks)
    pattern = rf"(?sU)^\s*(([0-9]+)\s*(?:{mark}))(.*)$"
    lines = responses.select("batch", F.posexplode(F.split("raw", LINE_BREAKS)).alias("pos", "line"))
    found = lines.select(
        "batch", "pos",
        F.regexp_extract("line", pattern, 1).alias("head"),
        F.regexp_extract("line", pattern, 2).try_cast("int").alias("idx"),
        F.regexp_replace(F.regexp_extract("line", pattern, 3), r"(?U)^\s+|\s+$", "").alias("answer"),
    ).filter(F.col("idx").isNotNull() & (F.length("head") <= 6))
    last = found.groupBy("batch", "idx").agg(F.max_by("answer", "pos").alias("answer"))
    joined = null_safe_join(inputs, last, ["batch", "idx"], "left")
    answer = F.when(F.length("answer") > 0, F.col("answer")).otherwise(F.col("source"))
    return joined.select("batch", "idx", "source", answer.alias("target"))


def glossary_from_pairs(pairs: DataFrame, cap: int = 2_000) -> DataFrame:
    """First ``cap`` entries in column-then-row order, one per source string; the first one wins.

    ``pairs`` has src, tgt, col_ord and row_ord.
    """
    first = pairs.groupBy("src").agg(
        F.min_by("tgt", F.struct("col_ord", "row_ord")).alias("tgt"), F.min(F.struct("col_ord", "row_ord")).alias("at"))
    return first.orderBy("at").limit(cap).select("src", "tgt", "at")


# ---- codes across languages --------------------------------------------------------------------------

def propagate(items: DataFrame, classified: DataFrame, cols: Sequence[str], order: str = "ord") -> DataFrame:
    """Copy classes from the items of another language with the same base code.

    ``classified`` has rate_code, ``order`` and the columns; on a shared base code the last row wins.
    Items without a match keep their own values. ``propagated`` tells which happened.
    """
    latest = classified.groupBy(base_code(F.col("rate_code")).alias("_base")).agg(
        F.max_by(F.struct(*cols), order).alias("_from"))
    joined = items.withColumn("_code", base_code(F.col("rate_code"))).join(latest, F.col("_code") == F.col("_base"), "left")
    hit = F.col("_base").isNotNull()
    out = [F.when(hit, F.col(f"_from.{c}")).otherwise(F.col(c)).alias(c) if c in cols else F.col(c) for c in items.columns]
    return joined.select(*out, hit.alias("propagated"))


def retry_flagged(
    cache: DataFrame,
    audit: Callable[[DataFrame], DataFrame],
    translate: Callable[[DataFrame], DataFrame],
    max_attempts: int = 3,
    layers: Sequence[str] = ("script_block",),
) -> tuple[DataFrame, list[dict]]:
    """Audit, purge and translate again until nothing is flagged in ``layers`` or the attempts are used up.

    ``audit`` maps a cache(h, target) to flagged rows, ``translate`` maps the purged keys to new cache
    rows. Runs one job per attempt; only the number of flagged rows comes back. Each round's cache is
    written to the shared folder so that the plan does not grow.
    """
    from costweave.session import cut_lineage

    log = []
    for attempt in range(1, max_attempts + 1):
        flagged = cut_lineage(audit(cache))
        flagged = flagged_errors(flagged, layers)
        n = flagged.select("hash").distinct().count()
        log.append({"attempt": attempt, "flagged": n})
        if n == 0 or attempt == max_attempts:
            break
        kept = purge(cache, flagged)
        removed = cache.join(kept.select("h"), "h", "left_anti")
        cache = cut_lineage(merge_dictionaries(kept, translate(removed), ["h"], "target"))
    return cache, log
