"""Text column expressions: keys, language-independent values, scripts, numbers, language markers.

Patterns carry (?U) so that \\w, \\d, \\s and \\b follow Unicode, and (?d) so that $ only stops
before a final newline.
"""

from __future__ import annotations

import re
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

# ---- fixed values ------------------------------------------------------------------------------
# Word lists and patterns that decide results; they must stay as they are.

UNITS = [
    "kVA", "kW", "MW", "GW", "Wh", "kWh", "MWh", "V", "A", "mA", "Hz", "kHz", "MHz", "kg", "g", "mg", "t", "kt",
    "Mt", "m", "cm", "mm", "km", "nm", "pm", "m²", "m³", "cm²", "cm³", "mm²", "mm³", "m2", "m3", "cm2", "cm3",
    "mm2", "mm3", "m3/h", "m2/h", "m3/s", "l", "L", "ml", "cl", "dl", "hl", "h", "min", "s", "ms", "kN", "MN",
    "Pa", "kPa", "MPa", "GPa", "bar", "°C", "°F", "K", "%", "ppm", "Bq", "Sv", "rpm", "Nm", "Wb", "T", "DN", "PN",
    "PE", "PVC", "ABS", "PP", "HDPE",
]
EXTRA_UNITS = ["PEX", "kgf", "tonf"]
LOANWORDS = [
    "set", "unit", "ha", "starter", "tripod", "streif", "channel.km", "lap", "lapis", "m farm", "100 ecm",
    "half-set", "100 knots", "camera", "cabin", "press", "stand", "horizontal", "vertical", "manipulator",
    "brander", "patchuk", "nr", "pcs", "pcs.", "stk", "stk.", "no.", "ea", "ea.", "dm", "dm2", "dm3", "komplett",
    "foto", "installation", "system", "punkt", "nummer", "sektion", "ring", "kanal", "stativ", "knoten", "rez",
    "etui", "gips", "sand", "mullit",
]
NUMBER_CHARS = r"[\d\s.,/x*×²³%·\-:_+()]+"
CODE_CHARS = r"[A-Z0-9][A-Z0-9\-/×x*.,;:()\s]*"
SHORT_CODE_CHARS = r"[A-Z0-9][A-Z0-9\-/×x*.,\s]*"
CODE_LIST_CHARS = r"[A-Z0-9][A-Za-z0-9\-/×x*.,;:()\s\"']*"
PIPE_SPEC = r"\s*(?:DN|Du|PN|PE|HD|LD)\s*\-?\s*\d+(?:\s*[xх×*/]\s*\d+)?(?:\s*mm)?\s*"
RATING = (r"\s*\d+(?:[.,]\d+)?(?:\s*[xх×*/\-]\s*\d+(?:[.,]\d+)?)?\s*"
          r"(?:kV|MV|kVA|MVA|kW|MW|HP|PS|t/day|t/h|m3/day|km/h|rpm)\s*")
NUMBER_RANGE = r"\s*\d+(?:[.,]\d+)?(?:\s*[\-–]\s*\d+(?:[.,]\d+)?)?(?:\s*[xх×*]\s*\d+(?:[.,]\d+)?)*\s*"
NUMBER_PRODUCT = r"\s*\d+(?:[.,]\d+)?(?:\s*[xх×*]\s*\d+(?:[.,]\d+)?)*\s*"

GERMAN_LETTERS = "[äöüÄÖÜß]"
GERMAN_ONLY_FOR_TURKISH = "[äÄß]"
GERMAN_WORDS = [
    "der", "die", "das", "ein", "eine", "mit", "von", "für", "fur", "zur", "zum", "bei", "aus", "auf", "über",
    "uber", "unter", "durch", "als", "und", "oder", "nach", "vor", "Stehbolzen", "Schweißen", "Schweissen",
    "Anlage", "Schraube", "Maschine", "Werkzeug", "Material", "Beton",
]
ENGLISH_WORDS = [
    "the", "of", "with", "for", "from", "to", "in", "on", "by", "and", "or", "using", "over", "under",
    "including", "excluding", "installation", "equipment", "machine", "pipe", "valve", "cable", "wire", "sheet",
    "set", "unit", "stand", "press", "filter",
]
LANGUAGE_MARKERS = {
    "de": r"(?U)[äöüÄÖÜß]|\b(?:der|die|das|den|dem|des|ein|mit|von|für|zur|zum|aus|auf|über|unter|durch|als|und|oder)\b|"
          r"\b\w+(?:ung|heit|keit|nis|chaft|tum|lich|isch|enn|tech|maschine|gerät|werkzeug|werk)\b",
    "en": r"(?Ui)\b(?:the|of|with|and|or|for|by|from|to|in|on|at|into|using|over|under)\b|"
          r"\b\w+(?:ing|tion|ment|ness|able|less|ful|ish)\b|"
          r"\b(?:plate|sheet|tube|pipe|valve|pump|motor|tank|wire|cable|mesh|drill|machine|installation)\b",
    "ru": r"(?Ui)сс|ё|[а-я]ый\b|[а-я]ого\b|[а-я]ые\b|[а-я]ться\b|жн[а-я]",
    "bg": r"(?Ui)ще|щ[ае]|ъ|[а-я]ия\b|[а-я]ите\b|[а-я]ват\b",
}
# Scripts a target language may be written in.
LANGUAGE_SCRIPTS = {
    "bg": ["CYRILLIC"], "ru": ["CYRILLIC"], "ja": ["HIRAGANA", "KATAKANA", "CJK"], "ko": ["HANGUL", "CJK"],
    "th": ["THAI"], "zh": ["CJK"], "ar": ["ARABIC"], "he": ["HEBREW"], "hi": ["DEVANAGARI"],
    **{lang: ["LATIN"] for lang in ["en", "de", "fr", "es", "pt", "it", "nl", "sv", "cs", "pl", "hr", "ro", "tr",
                                    "vi", "id"]},
}
SCRIPT_CLASSES = {
    "CYRILLIC": r"\p{IsCyrillic}", "LATIN": r"\p{IsLatin}", "HANGUL": r"\p{IsHangul}", "THAI": r"\p{IsThai}",
    "HIRAGANA": r"\p{IsHiragana}", "KATAKANA": r"\p{IsKatakana}", "CJK": r"\p{IsHan}", "ARABIC": r"\p{IsArabic}",
    "HEBREW": r"\p{IsHebrew}", "DEVANAGARI": r"\p{IsDevanagari}",
}
LANGUAGE_SUFFIXES = ["СТР", "CON", "BAU", "TRA", "TRABAJO", "RAB", "OBR", "VOI", "LAU", "OPE", "LAB", "OBE", "PRA",
                     "PIE", "LUC"]
UNIT_SUFFIXES = ["м3", "m3", "м2", "m2", "м", "m", "т", "t", "кг", "kg", "шт", "pc", "pcs"]
INLINE_TAGS = ["КАП", "ПУС", "MAJ", "COM", "MIN", "REM", "REP", "MOD", "EKS", "EXP", "INB", "GRU", "RÉN", "REF", "निर",
               "प्र", "उपक", "建筑工", "调试工", "设备大", "أعم", "إصل"]
# ---- end of fixed values -------------------------------------------------------------------------


def any_of(words: Sequence[str]) -> str:
    """Alternation of literal words, longest first."""
    return "|".join(re.escape(w) for w in sorted(words, key=len, reverse=True))


def hash16(c: Column) -> Column:
    """String key: the first 16 hex digits of SHA-1 over UTF-8."""
    return F.substring(F.sha1(c), 1, 16)


def row_to_text(cols: Sequence[str]) -> Column:
    """``col: value`` pairs joined by a spaced bar; null and blank values are skipped."""
    return F.concat_ws(" | ", *[
        F.when(F.length(F.trim(F.col(c).cast("string"))) > 0, F.concat(F.lit(f"{c}: "), F.col(c).cast("string")))
        for c in cols])


def _like(c: Column, body: str, flags: str = "Ud") -> Column:
    return F.rlike(c, F.lit(f"(?{flags})^(?:{body})$"))


def passthrough_rules(c: Column) -> list[Column]:
    """The ten rules, any of which makes a value language-independent."""
    unit = any_of(UNITS + EXTRA_UNITS)
    return [
        c == "",
        _like(c, NUMBER_CHARS),
        _like(c, rf"\s*(?:{unit})\s*"),
        _like(c, rf"{NUMBER_RANGE}(?:{unit})(?:\s*[/×x]\s*(?:{unit}))*\s*"),
        _like(c, PIPE_SPEC, "Udi"),
        _like(c, RATING, "Udi"),
        F.lower(F.regexp_replace(c, r"(?U)^\s+|\s+$", "")).isin(LOANWORDS),
        _like(c, rf"\s*\d+\s+(?:{any_of(LOANWORDS)})\s*", "Udi"),
        (F.length(c) <= 30) & _like(c, CODE_CHARS),
        (F.length(c) <= 200) & _like(c, CODE_LIST_CHARS) & F.rlike(c, F.lit(r"(?U)[\d,;\-/]")),
    ]


def is_passthrough(c: Column) -> Column:
    """Numbers, units, specifications, loanwords and codes: values that need no translation."""
    return F.coalesce(reduce(lambda a, b: a | b, passthrough_rules(c)), F.lit(False))


def is_passthrough_short(c: Column) -> Column:
    """The three-rule version used by the text audit: numbers, number with unit, codes up to 30 characters."""
    unit = any_of(UNITS)
    return F.coalesce(
        _like(c, NUMBER_CHARS)
        | _like(c, rf"{NUMBER_PRODUCT}(?:{unit})(?:\s*[/×x]\s*(?:{unit}))*\s*")
        | ((F.length(c) <= 30) & _like(c, SHORT_CODE_CHARS)),
        F.lit(False))


def _count(c: Column, char_class: str) -> Column:
    return F.length(F.regexp_replace(c, f"[^{char_class}]", ""))


def letter_count(c: Column) -> Column:
    return _count(c, r"\p{L}")


def script_share(c: Column, scripts: Sequence[str]) -> Column:
    """Share of letters that belong to the scripts; 1.0 without letters."""
    classes = "".join(SCRIPT_CLASSES[s] for s in scripts)
    hits = F.length(F.regexp_replace(F.regexp_replace(c, r"[^\p{L}]", ""), f"[^{classes}]", ""))
    return F.coalesce(F.try_divide(hits, letter_count(c)), F.lit(1.0))


def dominant_script(c: Column) -> Column:
    """Script with the most letters, '' without letters; ties go to the first in list order."""
    names = F.array(*[F.lit(s) for s in SCRIPT_CLASSES])

    def pick(counts: Column) -> Column:
        best = F.array_max(counts)
        return F.when(best == 0, "").otherwise(F.get(names, (F.array_position(counts, best) - 1).cast("int")))

    def count_all(letters: Column) -> Column:
        return F.array(*[F.length(F.regexp_replace(letters, f"[^{cls}]", "")) for cls in SCRIPT_CLASSES.values()])

    # transform() over one element binds a value that is used several times
    counts = F.transform(F.array(F.regexp_replace(c, r"[^\p{L}]", "")), count_all)
    return F.get(F.transform(counts, pick), F.lit(0))


def numeric_tokens(c: Column) -> Column:
    """Numbers that touch no letter; single digits without a separator are dropped."""
    found = F.regexp_extract_all(c, F.lit(r"(?U)(?<![A-Za-zА-Яа-я])\d+(?:[.,]\d+)?(?![A-Za-zА-Яа-я])"), F.lit(0))
    return F.filter(found, lambda t: F.length(t) > 1)


def normalise_decimal(c: Column) -> Column:
    return F.translate(c, ".", ",")


def ascii_letter_share(c: Column) -> Column:
    """Share of letters that are ASCII; null without letters."""
    return F.try_divide(_count(c, "A-Za-z"), letter_count(c))


def is_leftover(c: Column, kind: Column) -> Column:
    """Does a translated value still look like its source language? ``kind`` names the rule of the pair."""
    umlaut = F.rlike(c, F.lit(GERMAN_LETTERS))
    german = F.rlike(c, F.lit(rf"(?Ui)\b(?:{'|'.join(GERMAN_WORDS)})\b"))
    english = F.rlike(c, F.lit(rf"(?Ui)\b(?:{'|'.join(ENGLISH_WORDS)})\b"))
    share = F.coalesce(ascii_letter_share(c), F.lit(0.0))
    rule = (
        F.when(kind == "de_strict", umlaut)
        .when(kind == "de_loose", umlaut & german)
        .when(kind == "de_sv", F.rlike(c, F.lit("ß")))
        .when(kind == "de_tr", F.rlike(c, F.lit(GERMAN_ONLY_FOR_TURKISH)))
        .when(kind == "de_bg", F.rlike(c, F.lit("[A-Za-zÀ-ÿ]")) & (share > 0.6) & (german | umlaut))
        .when(kind == "en_latin", english & ~is_passthrough(c))
        .when(kind == "en_nonlatin", (share > 0.7) & english & ~is_passthrough(c))
    )
    return F.coalesce(rule, F.lit(False))


def has_markers(c: Column, lang: str) -> Column:
    return F.coalesce(F.rlike(c, F.lit(LANGUAGE_MARKERS[lang])), F.lit(False))


def marker_count(c: Column, lang: str) -> Column:
    return F.regexp_count(c, F.lit(LANGUAGE_MARKERS[lang]))


def base_code(c: Column) -> Column:
    """Rate code without language suffix, unit suffix and inline tag, equal across languages.

    One suffix of each list is cut, the longest that fits. The tag is cut only from a last ``_`` part
    of more than four characters that keeps at least four.
    """
    code = F.coalesce(c, F.lit(""))
    code = F.regexp_replace(code, rf"(?:{any_of(LANGUAGE_SUFFIXES)})\z", "")
    code = F.regexp_replace(code, rf"(?:{any_of(UNIT_SUFFIXES)})\z", "")
    last = F.substring_index(code, "_", -1)
    tag = F.regexp_extract(last, rf"(?s)^.{{4,}}?((?:{any_of(INLINE_TAGS)}))\z", 1)
    cut = F.contains(code, F.lit("_")) & (F.length(last) > 4) & (F.length(tag) > 0)
    return F.when(cut, F.left(code, F.length(code) - F.length(tag))).otherwise(code)


def cell_text(c: Column, limit: int = 32_700, marker: str = "...[truncated]") -> Column:
    """Cut text that is too long for a spreadsheet cell and mark the cut."""
    return F.when(F.length(c) > limit, F.concat(F.left(c, F.lit(limit)), F.lit(marker))).otherwise(c)


def uuid_from(*parts: Column) -> Column:
    """Deterministic id in UUID shape from the parts."""
    digest = F.sha1(F.concat_ws("|", *parts))
    cuts = [(1, 8), (9, 4), (13, 4), (17, 4), (21, 12)]
    return F.concat_ws("-", *[F.substring(digest, a, n) for a, n in cuts])
