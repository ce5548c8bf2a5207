"""Nulls, ties, duplicates, empty inputs and planted defects."""

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from costweave import schema as S
from costweave.functions import numeric as N
from costweave.functions import text as T
from costweave.operators import catalog, classify, compare, estimate, filters, gates, pricing, profile
from costweave.operators import translation as TR
from costweave.operators.search import embed_texts, hash_embedder
from costweave.sources import readers, writers

ITEM = ("rate_code string, resource_code string, resource_name string, resource_unit string, collection_name string, collection_code string, "
        "department_name string, section_name string, is_labor boolean, is_material boolean, is_machine boolean, resource_quantity double, "
        "resource_price_per_unit_current double, resource_cost double, total_cost_per_position double, currency string, rate_unit string, ord int")


def item(ord_, rate="R1", code="P1", name="n", labor=None, material=None, machine=None, qty=2.0, price=10.0, cost=20.0, total=100.0):
    return (rate, code, name, "kg", "c", "cc", "d", "s", labor, material, machine, qty, price, cost, total, "EUR", "m3", ord_)


@pytest.fixture(scope="module")
def items(spark):
    return spark.createDataFrame([
        item(0, name=None, material=True), item(1, name="first", labor=True, price=30.0), item(2, rate="R2", name="later", price=None),
        item(3, code=None), item(4, rate="R2", code="P2", machine=True, qty=None), item(5, rate="R2", code="P2", machine=True)], ITEM)


def test_catalog(items):
    rows = {r["resource_code"]: r for r in catalog.resource_catalog(items, "EUR").collect()}
    assert set(rows) == {"P1", "P2"}
    p1 = rows["P1"]
    assert (p1["name"], p1["type"], p1["price_variants"], p1["usage_count"], p1["used_in_work_items"]) == ("first", "Labour", 2, 3, 2)
    assert p1["price_median"] == 20.0 and rows["P2"]["type"] == "Equipment"


def test_catalog_of_nothing(items):
    assert catalog.resource_catalog(items.limit(0), "EUR").collect() == []


def test_catalog_keeps_resource_without_price(items):
    only = items.withColumn("resource_price_per_unit_current", F.lit(None).cast("double"))
    row = catalog.resource_catalog(only, "EUR").first()
    assert row["price_median"] is None and row["price_variants"] == 0


def test_last_override_wins_even_if_null(spark, items):
    over = spark.createDataFrame(
        [("P1", 5.0, None, 0), ("P1", 7.0, 3.0, 1), ("P2", 9.0, 4.0, 0), ("P2", None, None, 1)],
        "resource_code string, unit_price double, labor_rate_per_hr double, ord int")
    out = {r["ord"]: r for r in pricing.apply_price_overrides(items, over).collect()}
    assert out[0]["resource_price_per_unit_current"] == 7.0 and out[0]["resource_cost"] == 14.0
    assert out[4]["resource_price_per_unit_current"] is None and out[4]["resource_cost"] is None
    assert out[3]["resource_price_per_unit_current"] == 10.0
    rates = pricing.apply_labour_overrides(items.withColumn("labor_rate_per_hr", F.lit(1.0)), over)
    assert {r["ord"]: r["labor_rate_per_hr"] for r in rates.collect()} == {0: 3.0, 1: 3.0, 2: 3.0, 3: 1.0, 4: 4.0, 5: 4.0}


def test_cascade_keeps_norms_and_scales_by_type(items):
    out = {r["ord"]: r for r in pricing.reprice(items, 2.0, 3.0, 5.0, "USD", 0.5).collect()}
    assert [out[i]["total_cost_per_position"] for i in (0, 1, 3, 5)] == [150.0, 100.0, 250.0, 250.0]
    assert out[0]["resource_quantity"] == 2.0 and out[0]["currency"] == "USD" and out[0]["rate_unit_copy"] == "m3"
    assert out[1]["resource_cost"] == 2.0 * 30.0


def _tracks(spark, rows):
    return spark.createDataFrame(rows, "region string, iso string, currency string, source_iso string, source_currency string")


def test_factors(spark):
    fx = spark.createDataFrame([("EUR", 1.0), ("USD", 1.25), ("PLN", 4.0)], "currency string, per_eur double")
    wage = spark.createDataFrame([("A", 2.0), ("B", 3.0)], "iso string, value double")
    ppp = spark.createDataFrame([("A", 1.0)], "iso string, value double")
    tracks = _tracks(spark, [("x", "A", "USD", "B", "PLN"), ("y", "B", "PLN", "A", "USD"), ("z", "Q", "???", "A", "???")])
    out = {r["region"]: r for r in pricing.track_factors(tracks, fx, wage, ppp).collect()}
    assert out["x"]["fx"] * out["y"]["fx"] == pytest.approx(1.0)
    assert out["x"]["labour"] == pytest.approx(2 / 3 * 1.25 / 4) and out["x"]["material"] == out["x"]["fx"]
    assert out["z"]["fx"] == 1.0 and out["z"]["labour"] == 1.0
    unknown = _tracks(spark, [("x", "A", "USD", "B", "nope")])
    with pytest.raises(PySparkException):
        pricing.track_factors(unknown, fx, wage, ppp).collect()


def test_round_pretty_is_half_even(spark):
    df = spark.createDataFrame([(x,) for x in [0.5, 1.5, 99.4, 125.0, 999.0, 1250.0, 99_950.0, 123_500.0, 1_235_000.0]], "x double")
    assert [r[0] for r in df.select(N.round_pretty(F.col("x"))).collect()] == [0, 2, 99, 120, 1000, 1200, 100_000, 124_000, 1_240_000]


def test_histogram_closes_last_bin(spark):
    df = spark.createDataFrame([(float(i),) for i in range(101)], "x double")
    out = {r["bin"]: r["n"] for r in profile.histogram(df, "x", 10).collect()}
    assert out[9] == 11 and sum(out.values()) == 101
    same = spark.createDataFrame([(3.0,)] * 4, "x double")
    assert [(r["bin"], r["n"]) for r in profile.histogram(same, "x", 10).collect()] == [(5, 4)]


@pytest.mark.parametrize("value,want", [
    ("", True), ("12.5 x 3", True), ("kg", True), ("12 kVA", True), ("2,5-2,9 kW", True), ("DN-200", True), ("pn 16", True),
    ("220 kv", True), (" Komplett ", True), ("10 Knoten", True), ("PE-2105MA", True), ("ABC", True),
    ("S-100, SK-100, S-104", True), ("Beton", False), ("kilo gramm", False), ("A plain sentence", False), ("A" * 31, False)])
def test_passthrough(spark, value, want):
    assert spark.range(1).select(T.is_passthrough(F.lit(value))).first()[0] is want


def test_passthrough_of_null(spark):
    assert spark.range(1).select(T.is_passthrough(F.lit(None).cast("string"))).first()[0] is False


@pytest.mark.parametrize("text,want", [
    ("1,6 m3", ["1,6"]), ("m123", ["23"]), ("12.5m", ["12"]), ("IPE300 20x30", ["00"]), ("7 bolts 12", ["12"]),
    ("no", [])])
def test_numeric_tokens(spark, text, want):
    import re

    reference = [t for t in re.findall(r"(?<![A-Za-zА-Яа-я])\d+(?:[.,]\d+)?(?![A-Za-zА-Яа-я])", text) if len(t) > 1]
    got = spark.range(1).select(T.numeric_tokens(F.lit(text))).first()[0]
    assert got == reference and (want is None or got == want)


@pytest.mark.parametrize("code,want", [
    ("KA_ABCDTRABAJO", "KA_ABCD"), ("KA_ABCDм3", "KA_ABCD"), ("KA_ABCDkgCON", "KA_ABCD"), ("KA_KAMEКАП", "KA_KAME"),
    ("KA_ABCКАП", "KA_ABCКАП"), ("NOTAGКАП", "NOTAGКАП"), ("KA_KAMEMAJm2BAU", "KA_KAME")])
def test_base_code(spark, code, want):
    assert spark.range(1).select(T.base_code(F.lit(code))).first()[0] == want


@pytest.mark.parametrize("kind,text,want", [
    ("de_strict", "Höhe", True), ("de_strict", "Hohe", False), ("de_loose", "Höhe", False), ("de_loose", "Höhe über", True),
    ("de_sv", "Straße", True), ("de_tr", "göl", False), ("de_tr", "Länge", True), ("de_bg", "Anlage mit", True), ("de_bg", "плоча mit", False),
    ("en_latin", "set of tools", True), ("en_latin", "set", False), ("en_nonlatin", "machine room", True), ("en_nonlatin", "機械 machine 機械機械機械機械機械", False),
    ("unknown", "the", False)])
def test_leftovers(spark, kind, text, want):
    assert spark.range(1).select(T.is_leftover(F.lit(text), F.lit(kind))).first()[0] is want


def test_numbered_answers(spark):
    inputs = spark.createDataFrame([(1, i, f"s{i}") for i in range(1, 6)], "batch int, idx int, source string")
    raw = "1. one\nnoise\n 2) two\n3 - three\n2) again\n5:\n9. out of range\n123456. too far"
    out = TR.parse_numbered(spark.createDataFrame([(1, raw)], "batch int, raw string"), inputs)
    assert [r["target"] for r in out.orderBy("idx").collect()] == ["one", "again", "three", "s4", "s5"]


def test_merge_and_pivot(spark):
    d = "k string, v string"
    out = TR.merge_dictionaries(spark.createDataFrame([("a", "1"), ("b", "2")], d), spark.createDataFrame([("b", "3"), ("c", None)], d), ["k"], "v")
    assert {r["k"]: r["v"] for r in out.collect()} == {"a": "1", "b": "3", "c": None}
    e = "en string, term string, ord int"
    src = spark.createDataFrame([("wall", "Wand", 0), ("partition", "Wand", 1), ("door", "Tür", 2)], e)
    tgt = spark.createDataFrame([("wall", "muro", 0), ("partition", "tramezzo", 1), ("door", "door", 2)], e)
    assert [tuple(r) for r in TR.compose_through_pivot(src, tgt).collect()] == [("Wand", "muro")]


@pytest.mark.parametrize("spread", [False, True])
def test_alignment_with_repeated_and_null_keys(spark, spread):
    cols = "rate_code string, resource_code string, ord int"
    s = spark.createDataFrame([("R", None, 0), ("R", None, 1), ("R", "P", 2)], cols)
    t = spark.createDataFrame([("R", None, 5), ("R", "P", 6), ("R", "P", 7)], cols)
    out = compare.align_positions(s, t, ["rate_code", "resource_code"], spread=spread).collect()
    pairs = {(r["resource_code"], r["occ"]): (r["s"] and r["s"]["ord"], r["t"] and r["t"]["ord"]) for r in out}
    assert pairs == {(None, 1): (0, 5), (None, 2): (1, None), ("P", 1): (2, 6), ("P", 2): (None, 7)}


def _gate(items, target, name, **options):
    return {r["name"]: r["passed"] for r in gates.run_gates(items, target, "EUR", 1.0, ["resource_name"], **options).collect()}[name]


DEFECTS = {
    "code_stability": lambda d: d.withColumn("rate_code", F.concat("rate_code", F.lit("x"))),
    "norms_immutability": lambda d: d.withColumn("resource_quantity", F.coalesce("resource_quantity", F.lit(-1.0))),
    "no_nan_in_prices": lambda d: d.withColumn("total_cost_per_position", F.when(F.col("ord") > 0, F.col("total_cost_per_position"))),
    "currency_consistency": lambda d: d.withColumn("currency", F.when(F.col("ord") == 0, "USD").otherwise("EUR")),
    "sanity_ranges": lambda d: d.withColumn("resource_cost", F.col("resource_cost") * 1000),
    "translation_completeness": lambda d: d,
}


@pytest.mark.parametrize("name", sorted(DEFECTS))
def test_gates_find_their_defect(items, name):
    clean = items.withColumn("resource_name", F.concat(F.lit("x"), "resource_name"))
    assert _gate(items, clean, name) is True
    assert _gate(items, DEFECTS[name](items if name == "translation_completeness" else clean), name) is False


def test_skipped_gate_passes(items):
    assert _gate(items, items.withColumn("currency", F.lit("USD")), "currency_consistency", skip=["currency_consistency"]) is True


def test_schema_parity(spark, items):
    def check(target):
        return gates.schema_parity(spark, target.schema, items.schema, items.schema).first()["passed"]

    assert check(items) and check(items.withColumn("us_labor_class", F.lit("a")))
    assert not check(items.drop("ord")) and not check(items.withColumn("new", F.lit(1)))
    assert not check(items.withColumn("ord", F.col("ord").cast("string")))


def test_normalise(spark):
    raw = spark.createDataFrame([("R", "1.5", float("nan")), ("S", "n/a", 2.0)],
                                "rate_code string, resource_price_per_unit_eur_current string, resource_cost double")
    out = S.normalise(raw)
    assert [(r["resource_price_per_unit_current"], r["resource_cost"]) for r in out.collect()] == [(1.5, None), (None, 2.0)]
    assert set(S.canonical_schema().fieldNames()) <= set(out.columns)


def test_common_codes_is_intersection(spark):
    df = spark.createDataFrame([("a", "x"), ("a", "y"), ("b", "x"), (None, "x"), (None, "y"), ("a", "x")], "rate_code string, track string")
    assert [r[0] for r in compare.common_codes(df, 2).collect()] == ["a"]
    with pytest.raises(ValueError):
        compare.union_tracks({"x": df})


def test_verdict_is_tri_state(spark):
    df = spark.createDataFrame([(None, None, 1), (True, None, 1), (True, False, 1), (True, True, 0)], "a boolean, b boolean, matches int")
    assert [r[0] for r in df.select(estimate.verdict(["a", "b"])).collect()] == [False, True, False, False]


def test_unmatched_line_keeps_its_text(spark):
    lines = spark.createDataFrame([(1, "wall", 2.0, "m2"), (2, "door", 1.0, "pcs")], "line_id int, description string, quantity double, unit string")
    best = spark.createDataFrame([(1, "C1", "Wall", "m3", 10.555)], "line_id int, rate_code string, rate_name string, rate_unit string, unit_rate double")
    out = {r["description"]: r for r in estimate.with_total_row(estimate.price_lines(lines, best)).collect()}
    assert (out["door"]["rate"], out["door"]["unit"], out["Wall"]["unit"]) == (0.0, "pcs", "m3") and out["TOTAL"]["amount"] == 21.11
    empty = estimate.with_total_row(estimate.price_lines(lines.limit(0), best)).collect()
    assert len(empty) == 1 and empty[0]["amount"] == 0.0


def test_units(spark):
    df = spark.createDataFrame([(5.0, "t", "kg"), (200.0, "m2", "100 m2"), (1.0, "m", "m2"), (3.0, "odd", "odd"), (1.0, None, "kg")], "q double, u string, r string")
    out = [(r["converted"], r["unit_mismatch"]) for r in estimate.convert_quantity(df, "q", "u", "r").collect()]
    assert out == [(5000.0, False), (2.0, False), (None, True), (3.0, False), (None, True)]


def test_parse_items(spark):
    df = spark.createDataFrame([(1, '```json\n[{"description": "wall", "quantity": 3}, {"description": "x", "unit": "m"}]\n```'), (2, "not json")], "id int, raw string")
    out = [tuple(r) for r in estimate.parse_work_items(df, "id", "raw").orderBy("id", "item").collect()]
    assert out == [(1, 1, "wall", 3.0, "pcs"), (1, 2, "x", 1.0, "m")]


def test_edits(spark):
    lines = spark.createDataFrame([(1, 1.0), (2, 2.0), (3, 3.0)], "line_id int, quantity double")
    edits = spark.createDataFrame([(1, "set", 5.0, 0), (1, "set", 6.0, 1), (2, "remove", None, 0), (4, "add", 4.0, 0), (5, "set", 5.0, 0)],
                                  "line_id int, op string, quantity double, ord int")
    out = sorted(tuple(r) for r in estimate.apply_edits(lines, edits).collect())
    assert out == [(1, 6.0, True), (3, 3.0, False), (4, 4.0, True)]


def test_first_rule_wins_and_name_is_needed(spark):
    rules = classify.Rules(classes=[("wall", "A", "B", "x"), ("w", "C", "D", "y")], targets=[("wall", "W"), ("w", "V"), ("all", "W")])
    df = spark.createDataFrame([("Wall", "s"), ("window", "s"), ("", "wall"), (None, "wall")], "n string, s string").withColumn("u", F.lit("м2"))
    out = [(r["ifc_class"], r["applies_to_classes"], r["unit_type"]) for r in classify.enrich(df, rules, "n", "u", "s", "s").collect()]
    assert out == [("B", ["W", "V"], "Area"), ("D", ["V"], "Area"), (None, [], "Area"), (None, [], "Area")]


def test_substring_filter_is_literal_and_null_safe(spark):
    df = spark.createDataFrame([("a.B",), ("axb",), (None,)], "c string")
    assert [r[0] for r in df.filter(filters.contains_text("c", "A.b")).collect()] == ["a.B"]


def test_embedding_retries(spark, tmp_path):
    marker = str(tmp_path / "failed-once")
    real = hash_embedder(4)

    def shaky(texts):
        import os

        if not os.path.exists(marker):
            open(marker, "w").close()
            raise RuntimeError("busy")
        return real(texts)

    df = spark.createDataFrame([(1, "a b"), (2, " "), (3, "a b")], "id int, t string").coalesce(1)
    out = {r["id"]: r["vector"] for r in embed_texts(df, "id", "t", shaky, wait=0.01).collect()}
    assert set(out) == {1, 3} and out[1] == out[3] == real(["a b"])[0]


def test_failed_replacement_keeps_the_table(spark, tmp_path):
    path = str(tmp_path / "t")
    writers.replace_table(spark, spark.range(3), path)
    with pytest.raises(PySparkException):
        writers.replace_table(spark, spark.range(5).select(F.raise_error(F.lit("broken")).cast("long").alias("id")), path)
    assert spark.read.parquet(path).count() == 3


def test_readers(spark, tmp_path):
    bad = str(tmp_path / "bad")
    writers.write_csv(spark.createDataFrame([("a", "1")], "description string, quantity string"), bad)
    with pytest.raises(ValueError):
        readers.read_boq(spark, bad)
    with pytest.raises(ValueError):
        readers.load_any(spark, "x.xlsx")
    (tmp_path / "d.json").write_text('{"map": {"h1": "eins", "h2": "zwei"}, "meta": {}}', encoding="utf-8")
    rows = readers.read_dictionary(spark, str(tmp_path / "d.json"), "en", "de")
    assert sorted((r["h"], r["target"], r["tgt_lang"]) for r in rows.collect()) == [("h1", "eins", "de"), ("h2", "zwei", "de")]
    over = str(tmp_path / "over")
    writers.write_csv(spark.createDataFrame([("P1", "2.5"), ("P1", "x")], "resource_code string, unit_price string").coalesce(1), over)
    assert [r["unit_price"] for r in readers.read_overrides(spark, over).orderBy("ord").collect()] == [2.5, None]


def test_every_track_is_repriced_as_one_track_is(spark):
    items = spark.createDataFrame(
        [("S", "a", True, None, 2.0, 10.0, 20.0, 100.0, "m"), ("S", "b", None, True, None, 4.0, 8.0, 50.0, "t"), ("S", None, False, False, 3.0, None, 9.0, 7.0, "m"),
         ("Z", "a", True, False, 1.0, 1.0, 1.0, 1.0, "m")],
        "track string, resource_code string, is_labor boolean, is_material boolean, resource_quantity double, "
        "resource_price_per_unit_current double, resource_cost double, total_cost_per_position double, rate_unit string")
    factors = spark.createDataFrame([("X", "S", "USD", 0.5, 2.0, 3.0, 5.0), ("Y", "S", "CHF", None, 1.0, 1.5, 2.0)],
                                    "region string, source_track string, currency string, location_factor double, labour double, material double, equipment double")
    overrides = spark.createDataFrame([("b", 9.0, 1), ("b", 11.0, 2)], "resource_code string, unit_price double, ord int")
    got = pricing.reprice_tracks(items, factors, overrides, "2026-01-01", metadata=True)
    for region, _, currency, location, *three in factors.collect():
        one = pricing.reprice(items.filter("track = 'S'"), *three, currency, location or 1.0, overrides, "2026-01-01", metadata=True)
        part = got.filter(F.col("track") == region).select(*one.columns).drop("track")
        assert sorted(map(str, part.collect())) == sorted(map(str, one.drop("track").collect()))
    own = overrides.withColumn("track", F.lit("Y"))
    prices = {(r.track, r.resource_code): r.resource_price_per_unit_current for r in pricing.reprice_tracks(items, factors, own).collect()}
    assert prices[("Y", "b")] == 11.0 and prices[("X", "b")] == 4.0 * 3.0 * 0.5
