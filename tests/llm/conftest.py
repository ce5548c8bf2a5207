import pytest

CLASH = ("score", "predicted", "class", "digest", "bands", "id", "component", "rank", "pivot", "wrapper", "host", "body", "sample", "ids", "place")


@pytest.fixture(scope="session")
def odd(spark):
    """Documents with nulls in every column, empty, blank and very long texts, repeated rows and clashing columns."""
    rows = [
        (1, None, "en", "a", None), (2, "", "en", None, 0), (3, " \n\t ", None, "a", 4), (4, "one", "en", "a", 3),
        (None, "no key at all here now", None, None, None), (5, "word " * 60_000 + "ende", "de", "b", 1),
        (6, "x" * 300_000, "en", "b", 1), (7, "the same text of a few plain words", "en", "b", 1),
        (7, "the same text of a few plain words", "en", "b", 1), (8, "the same text of a few plain words", "fr", "b", 1),
        (9, "12 34 %% 56 !!", "es", "b", 1), (10, "Ünïcödé 日本語 ß ́ \U0001f600", "de", "b", 1)]
    frame = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    return frame.selectExpr("*", *(f"'x' AS `{c}`" for c in CLASH))


@pytest.fixture(scope="session")
def none(odd):
    return odd.where("false")
