"""The plans for large or skewed inputs give the same rows as the simple ones."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from costweave.operators import filters as FL
from costweave.operators import translation as TR
from costweave.operators.ordering import numbered, top_with_ties
from costweave.operators.quantiles import exact_quantiles
from costweave.operators.search import top_k_batch


@pytest.fixture(scope="module")
def skewed(spark):
    """One key holds a third of the rows, values repeat, are negative, huge or null; one key is null."""
    rng = random.Random(7)
    rows = []
    for i in range(6_000):
        key = "hot" if i % 3 == 0 else (None if i % 50 == 1 else f"k{rng.randint(0, 40)}")
        value = rng.choice([rng.uniform(-5, 5), 1e9 * rng.random(), float(rng.randint(0, 3)), None])
        rows.append((i, key, value))
    return spark.createDataFrame(rows, "id int, k string, v double").repartition(16).cache()


def test_quantiles_by_refinement(skewed):
    probs = {"q10": 0.1, "q50": 0.5, "q95": 0.95, "lo": 0.0, "hi": 1.0}
    got, want = (
        {r["k"]: r for r in exact_quantiles(skewed, ["k"], "v", probs, "upper", refine=r).collect()} for r in (True, False))
    assert got.keys() == want.keys()
    local = skewed.filter("v is not null").toPandas()
    for key in want:
        values = np.sort(local[local["k"].isna() if key is None else local["k"] == key]["v"].to_numpy())
        assert got[key]["upper"] == want[key]["upper"] == values[len(values) // 2]
        for name, p in probs.items():
            assert got[key][name] == pytest.approx(np.quantile(values, p))
            assert want[key][name] == pytest.approx(np.quantile(values, p))


def test_global_quantile_by_refinement(skewed):
    got = exact_quantiles(skewed, [], "v", {"m": 0.5}, refine=True).first()["m"]
    assert got == pytest.approx(np.median(skewed.filter("v is not null").toPandas()["v"]))


def test_numbering_in_blocks(skewed):
    plain = numbered(skewed, ["k"], ["id"])
    blocks = numbered(skewed, ["k"], ["id"], block=F.floor(F.col("id") / 100))
    assert sorted(map(str, plain.collect())) == sorted(map(str, blocks.collect()))
    whole = numbered(skewed, [], ["id"], block=F.floor(F.col("id") / 100)).select("id", "rn")
    assert all(r["rn"] == r["id"] + 1 for r in whole.collect())


def test_ties_need_no_window(skewed):
    values = sorted((r["v"] for r in skewed.filter("v is not null").collect()), reverse=True)
    for n in (1, 5, 4_000):
        assert top_with_ties(skewed, "v", n).count() == sum(v >= values[n - 1] for v in values)


def test_terms_by_join_equals_automaton(spark):
    texts = spark.createDataFrame(
        [(1, "The red Ring of the bridge"), (2, "ßtraße über Höhe"), (3, ""), (4, None), (5, "aa" * 50)], "id int, v string")
    terms = spark.createDataFrame(
        [(0, "ring"), (1, "ridg"), (2, "e"), (3, "üb"), (4, "HÖHE"), (5, "aaa"), (6, "not there"), (7, "ring"), (8, "")],
        "ord int, t string")
    fast = TR.terms_in_texts(texts, terms, "id", "v", "ord", "t")
    joined = TR.terms_in_texts(texts, terms, "id", "v", "ord", "t", automaton_terms=0)
    local_texts = [(r["id"], (r["v"] or "").lower()) for r in texts.collect()]
    want = sorted((i, r["ord"]) for i, v in local_texts for r in terms.collect() if r["t"] and r["t"].lower() in v)
    assert sorted(tuple(r) for r in fast.collect()) == want
    assert sorted(tuple(r) for r in joined.collect()) == want


def test_batch_search_grid_equals_broadcast(spark):
    rng = np.random.default_rng(3)
    base = rng.normal(size=(60, 8))
    base[20:40] = base[0]  # a third of all vectors are copies
    base[41] = 0
    df = spark.createDataFrame([(i, [float(x) for x in v]) for i, v in enumerate(base)], "id int, vector array<double>")
    queries = df.withColumnRenamed("id", "qid")
    wide = top_k_batch(queries, df, 4, skip_same=True)
    grid = top_k_batch(queries, df, 4, skip_same=True, query_bytes=8 * 8 * 13)
    unit = np.divide(base, np.linalg.norm(base, axis=1, keepdims=True), out=np.zeros_like(base),
                     where=np.linalg.norm(base, axis=1, keepdims=True) > 0)
    sims = np.round(unit @ unit.T, 12)
    want = set()
    for q in range(60):
        best = sorted((i for i in range(60) if i != q), key=lambda i: (-sims[q, i], i))[:4]
        want |= {(q, i, r + 1) for r, i in enumerate(best)}
    for out in (wide, grid):
        assert {(r["qid"], r["id"], r["rank"]) for r in out.collect()} == want


def test_requests_without_pairing(spark):
    rng = random.Random(1)
    items = [(i, rng.choice("ab"), float(rng.randint(0, 30))) for i in range(300)]
    asks = [(i, rng.choice("abc"), rng.choice([None, float(rng.randint(0, 30))]), rng.choice([None, 25.0]), rng.choice([None, 3]))
            for i in range(40)]
    out = FL.answer_requests(
        spark.createDataFrame(items, "id int, g string, cost double"),
        spark.createDataFrame(asks, "request_id int, g string, min_cost double, max_cost double, limit int"), "id", ["g"], "cost")
    want = set()
    for rid, g, low, high, limit in asks:
        fit = sorted((c, i) for i, ig, c in items if ig == g and (low is None or c >= low) and (high is None or c <= high))
        want |= {(rid, r + 1, i) for r, (_, i) in enumerate(fit[:limit or 5])}
    assert {(r["request_id"], r["rank"], r["id"]) for r in out.collect()} == want


def test_translations_neither_multiply_nor_merge_rows(spark):
    df = spark.createDataFrame([(1, "a", "b"), (1, "c", None), (3, " ", "c")], "id int, x string, y string")
    words = spark.createDataFrame([("a", "A", 2), ("a", "Z", 1), ("b", "", 1), ("c", "C", 1), ("c", "B", 2), (None, "N", 1)], "v string, target string, age int")
    from costweave.functions.text import hash16

    cache = words.select(hash16(F.col("v")).alias("h"), "target", "age")
    for limit in ("-1", "10m"):
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
        try:
            smallest = TR.apply_translations(df, ["x", "y"], cache).orderBy("id", "x").collect()
            newest = TR.apply_translations(df, ["x", "y"], cache, "age").orderBy("id", "x").collect()
        finally:
            spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        assert smallest == [(1, "A", "b"), (1, "B", None), (3, " ", "B")]
        assert newest == [(1, "A", "b"), (1, "B", None), (3, " ", "B")]


def test_only_flagged_rows_purge(spark):
    cache = spark.createDataFrame([("h1", "x"), ("h2", "y")], "h string, target string")
    checked = spark.createDataFrame([("h1", "error", False), ("h2", "error", True)], "hash string, severity string, flagged boolean")
    assert [r.h for r in TR.purge(cache, checked).collect()] == ["h1"]


def test_results_do_not_depend_on_partitions(spark, sf):
    import __spark_entry__ as entry

    names = ["a1_resource_catalog", "w1_first_row_per_rate", "u6_wide_comparison", "j4_positional_alignment"]
    before = spark.conf.get("spark.sql.shuffle.partitions")
    results = []
    try:
        for n in ("1", "200"):
            spark.conf.set("spark.sql.shuffle.partitions", n)
            results.append([sorted(map(str, entry.queries()[q](spark, sf).collect())) for q in names])
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert results[0] == results[1]


QUANTILE_QUERIES = ["a1_resource_catalog", "a4_numeric_summary", "a9_box_stats", "f8_outlier_clip", "x12_upper_median",
                    "q24_price_deviations", "e5_functional_suite", "j4_positional_alignment", "q3_norm_changes"]


@pytest.mark.parametrize("name", QUANTILE_QUERIES)
def test_large_input_plans_give_the_same_rows(spark, sf, name, monkeypatch):
    import __spark_entry__ as entry

    small = sorted(map(str, entry.queries()[name](spark, sf).collect()))
    monkeypatch.setattr("costweave.operators.quantiles.VALUES_PER_TASK", 0)
    assert sorted(map(str, entry.queries()[name](spark, sf).collect())) == small


def test_narrow_values_beside_outliers(spark):
    """Nearly all values fall into one bin of the first level."""
    rng = random.Random(5)
    values = [1.0 + rng.random() * 1e-4 for _ in range(3_000)] + [-1e12, 1e12]
    df = spark.createDataFrame([(v,) for v in values], "v double")
    got = exact_quantiles(df, [], "v", {"q": 0.37}, "u", refine=True).first()
    ordered = sorted(values)
    assert got["q"] == pytest.approx(np.quantile(values, 0.37), rel=1e-15) and got["u"] == ordered[len(ordered) // 2]


def test_scans_of_several_files_align_over_all_rows(spark, tmp_path):
    from costweave.sources.readers import align_scans

    spark.range(100).selectExpr("id", "id * 2 AS x").repartitionByRange(4, "id").sortWithinPartitions("id").write.parquet(f"{tmp_path}/a")
    spark.range(70).selectExpr("id AS y", "id AS x").repartitionByRange(3, "y").sortWithinPartitions("y").write.parquet(f"{tmp_path}/b")
    rows = align_scans(spark.read.parquet(f"{tmp_path}/a"), spark.read.parquet(f"{tmp_path}/b"))
    assert rows.columns == ["position", "id", "x", "y"]
    assert sorted((r.position, r.id, r.x, r.y) for r in rows.collect()) == [(i, i, 2 * i, i) for i in range(70)]


def test_first_row_of_a_key_whatever_the_batches(spark, tmp_path):
    from costweave.operators.search import hash_embedder, read_first
    from costweave.streaming import incremental

    rows = spark.createDataFrame([("t", "k", "first", 1), ("t", "k", "second", 2), ("t", "l", "only", 3)], "track string, rate_code string, rate_final_name string, ord int")
    found = []
    for n in (1, 1000):
        source = f"{tmp_path}/s{n}"
        for o in (3, 2, 1):
            rows.filter(F.col("ord") == o).coalesce(1).write.mode("append").parquet(source)
        incremental.start(spark, source, rows.schema, f"{tmp_path}/t{n}", f"{tmp_path}/c{n}", hash_embedder(4), files_per_batch=n).awaitTermination()
        found.append(sorted((r.rate_code, r.text) for r in read_first(spark, f"{tmp_path}/t{n}", "ord").collect()))
    assert found[0] == found[1] and "first" in found[0][0][1]


def test_profile_has_every_column(spark):
    from costweave.operators.profile import column_profile, null_counts

    df = spark.sql("SELECT 1 AS a, DATE'2024-01-02' AS d, TIMESTAMP'2024-01-02 03:04:05' AS t, array(1, 2) AS l, struct(1 AS x) AS s, CAST(NULL AS binary) AS b")
    out = column_profile(df)
    got = {r["col"]: r for r in out.collect()}
    assert set(got) == set(df.columns) and got["d"]["samples"] == "2024-01-02" and got["l"]["samples"] == "[1,2]"
    assert got["b"]["nulls"] == 1 and tuple(null_counts(out).first()) == (1, 5)


def test_search_without_vectors(spark):
    from costweave.operators.search import top_k_batch

    rows = spark.createDataFrame([(1, [1.0, 0.0]), (2, None), (3, [0.5, None])], "id int, vector array<double>")
    asks = spark.createDataFrame([(9, [1.0, 1.0])], "qid int, vector array<double>")
    assert [(r.qid, r.id) for r in top_k_batch(asks, rows, 5).collect()] == [(9, 1)]
    assert top_k_batch(asks.filter("false"), rows, 5).count() == 0
    assert top_k_batch(asks, rows.filter("false"), 5).count() == 0


def test_metric_blocks_prune_clustered_vectors(spark):
    from costweave.operators.search import _usable, metric_search

    rng = np.random.default_rng(8)
    centres = rng.normal(size=(24, 16))
    base = np.concatenate([c + 0.02 * rng.normal(size=(40, 16)) for c in centres])
    base[100:140] = base[99]  # a group of copies
    df = spark.createDataFrame([(i, [float(x) for x in v]) for i, v in enumerate(base)], "id int, vector array<double>")
    asks = df.where("id % 7 = 0").withColumnRenamed("id", "qid")
    hits, visited = metric_search(_usable(asks, "qid", "vector", "qid"), _usable(df, "id", "vector", "id"), 5, skip_same=True,
                                  rows_per_centre=16)
    unit = base / np.linalg.norm(base, axis=1, keepdims=True)
    sims = np.round(unit @ unit.T, 12)
    want = set()
    for q in range(0, len(base), 7):
        best = sorted((i for i in range(len(base)) if i != q), key=lambda i: (-sims[q, i], i))[:5]
        want |= {(q, i, r + 1) for r, i in enumerate(best)}
    assert {(r["qid"], r["id"], r["rank"]) for r in hits.collect()} == want
    blocks = visited.select("block").distinct().count()
    # Each query visits a few blocks of its own cluster, not every block.
    assert visited.count() <= 4 * asks.count() and blocks > 4
    small = top_k_batch(asks, df, 5, skip_same=True, query_bytes=8 * 16 * 7)
    assert {(r["qid"], r["id"], r["rank"]) for r in small.collect()} == want


def test_numbering_by_splitters_spreads_a_hot_value(spark):
    from pyspark.sql import Window

    rows = [(i, "hot" if i % 10 else f"k{i % 7}", 1.5 if i % 10 else float(i), f"t{i:05d}") for i in range(3000)]
    df = spark.createDataFrame(rows, "id long, k string, price double, label string")
    for keys, order in (([], ["price", "id"]), (["k"], ["price", "id"]), (["k"], ["label"])):
        got = numbered(df, keys, order, "rn")
        want = df.withColumn("rn", F.row_number().over(Window.partitionBy(*keys).orderBy(*order)).cast("long"))
        assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.select(*got.columns).collect()))
    spread = df.repartitionByRange(8, "k", "price", "id").withColumn("b", F.spark_partition_id())
    # The value on nine rows of ten is numbered by several ranges, no task holds it whole.
    assert spread.where("k = 'hot'").select("b").distinct().count() > 1


def test_queries_travel_once_per_cell_not_once_per_block(spark):
    from costweave.operators.search import MetricBlocks, _usable, metric_search

    rng = np.random.default_rng(3)
    base = rng.normal(size=(600, 12)).astype(np.float32)
    rows = [(i, [float(x) for x in v]) for i, v in enumerate(base)]
    rows += rows[:40] + [(None, rows[5][1])]  # repeated rows, and one without an id
    df = spark.createDataFrame(rows, "id long, vector array<float>")
    c, q = _usable(df, "id", "vector", "id"), _usable(df, "id", "vector", "qid")
    index = MetricBlocks.build(c.filter("id IS NOT NULL"), 8 * 12 * 200, 4)
    told = q.filter("qid IS NOT NULL").withColumn("threshold", F.lit(None).cast("double"))
    cells = index.cells["cell"].nunique()
    assert index.visits(told).count() == told.count() * len(index.blocks) and len(index.blocks) > 10 * cells
    assert index._asking(told, 2).count() == told.count() * cells
    hits, _ = metric_search(q, c.filter("id IS NOT NULL"), 3, skip_same=True, query_bytes=8 * 12 * 200, rows_per_centre=4)
    unit = np.array([v for _, v in rows]) / np.linalg.norm([v for _, v in rows], axis=1, keepdims=True)
    sims = np.round(unit @ unit.T, 12)
    ids, want = [i for i, _ in rows], []
    for qid in range(600):
        own = [a for a in range(len(ids)) if ids[a] == qid]
        pooled = [(-sims[a, b], ids[b]) for a in own for _ in own for b in range(640) if ids[b] != qid]
        want += [(qid, i, r + 1) for r, (_, i) in enumerate(sorted(pooled)[:3])]
    assert sorted((r["qid"], r["id"], r["rank"]) for r in hits.collect()) == sorted(want)


def test_vectors_are_written_once_not_once_per_cell(spark):
    from costweave.operators.search import MetricBlocks, _usable

    rng = np.random.default_rng(6)
    df = spark.createDataFrame([(i, [float(x) for x in v]) for i, v in enumerate(rng.normal(size=(600, 12)))], "id long, vector array<double>")
    index = MetricBlocks.build(_usable(df, "id", "vector", "id"), 8 * 12 * 50, 4)
    asks = _usable(df, "id", "vector", "qid").withColumn("threshold", F.lit(None).cast("double"))
    cells = index.cells["cell"].nunique()
    pieces = index._query_pieces(asks, 2).collect()
    # Every query visits every cell, and still stands in one piece; so does every row of the corpus.
    assert cells > 10 and index._asking(asks, 2).count() == 600 * cells and all(len(p["cells"]) == cells for p in pieces)
    assert sorted(i for p in pieces for i in p["qids"]) == list(range(600))
    stored = index.pieces.collect()
    assert sorted(i for p in stored for i in p["ids"]) == list(range(600)) and all(len(p["vectors"]) == 8 * 12 * len(p["ids"]) for p in stored)


def test_alignment_ranks_only_hot_keys(spark, monkeypatch):
    from costweave.operators import compare

    def rows(n, extra):
        made = [("hot" if i % 2 else f"r{i % 40}", None if i % 3 else "p", i, float(i + extra), "x" * 50) for i in range(n)]
        return spark.createDataFrame(made, "rate_code string, resource_code string, ord int, cost double, note string")

    s, t, keys = rows(900, 0), rows(700, 1), ["rate_code", "resource_code"]
    met = compare.align_positions(s, t, keys, spread=False, cols=["cost"])
    assert met.schema["s"].dataType.fieldNames() == ["cost"]
    want = sorted(map(str, met.select(*keys, "occ", "s", "t").collect()))
    assert sorted(map(str, compare.align_positions(s, t, keys, spread=True, cols=["cost"]).select(*keys, "occ", "s", "t").collect())) == want
    seen, plain = [], compare.numbered

    def watched(df, *rest):
        seen.append(df.select("rate_code").distinct().count())
        return plain(df, *rest)

    monkeypatch.setattr(compare, "numbered", watched)
    assert sorted(map(str, compare.align_positions(s, t, keys, cols=["cost"]).select(*keys, "occ", "s", "t").collect())) == want
    assert not seen  # no key is hot: one shuffle, nothing is written
    monkeypatch.setattr(compare, "BUCKET_ROWS", 100)
    assert sorted(map(str, compare.align_positions(s, t, keys, cols=["cost"]).select(*keys, "occ", "s", "t").collect())) == want
    assert seen == [1, 1]


def test_overrides_are_looked_up_before_the_fan_out(spark, monkeypatch):
    from costweave.operators import pricing as P

    items = spark.createDataFrame([("A", "p", 2.0, 10.0, 20.0, 1.0, True, None), ("A", None, None, 5.0, 7.0, 1.0, None, True)],
                                  "track string, resource_code string, resource_quantity double, resource_price_per_unit_current double, "
                                  "resource_cost double, labor_rate_per_hr double, is_labor boolean, is_material boolean")
    factors = spark.createDataFrame([(t, "A", "USD", None, f, 2 * f, 3 * f) for t, f in (("X", 2.0), ("Y", 3.0))],
                                    "region string, source_track string, currency string, location_factor double, labour double, material double, equipment double")
    overrides = spark.createDataFrame([("p", 9.0, 4.0, 1), ("p", None, 8.0, 0)], "resource_code string, unit_price double, labor_rate_per_hr double, ord int")
    met, plain = [], P._with_overrides
    monkeypatch.setattr(P, "_with_overrides", lambda df, o, v: met.append(df.columns) or plain(df, o, v))
    cols = ["track", "resource_price_per_unit_current", "resource_cost", "labor_rate_per_hr"]
    got = sorted(map(tuple, P.reprice_tracks(items, factors, overrides).select(*cols).collect()))
    assert met and not any("_target" in c for c in met)
    assert got == [("X", 9.0, 18.0, 4.0), ("X", 20.0, 28.0, 4.0), ("Y", 9.0, 18.0, 4.0), ("Y", 30.0, 42.0, 6.0)]


def test_constants_of_a_site_are_settled_by_all_pages(spark):
    """A text that the pages behind the wrapper share, but another page of the same form does not, is no boilerplate."""
    from costweave.llm.wrappers import extract

    def page(i: int, line: str) -> str:
        return f"<html><body><h1>Home</h1><h2>{line}</h2><p>story {i}</p></body></html>"

    def told(rows):
        return spark.createDataFrame([(i, "http://h.org/a", t) for i, t in rows], "page_id long, url string, html string")

    def by_class(df):
        return df.withColumn("h", F.xxhash64("html")).withColumn("c", F.pmod("h", F.lit(6)))

    usual = told([(i, page(i, "by the editors")) for i in range(40)])
    least = by_class(usual).groupBy("c").agg(F.min("h").alias("least"))
    # Pages that differ, none of them among the six that the form is learnt from.
    other = told([(100 + i, page(100 + i, f"by author {i}")) for i in range(30)])
    other = by_class(other).join(least, "c").where("h > least").select("page_id", "url", "html")
    got = {r["page_id"]: r["text"] for r in extract(usual.unionByName(other)).collect()}
    others = [i for i in got if i >= 100]
    assert others and "Home" not in got[0] and got[0] == "by the editors\nstory 0"
    assert all(got[i] == f"by author {i - 100}\nstory {i}" for i in others)


def test_language_thresholds_come_from_all_texts_held_out(spark, monkeypatch):
    """The least scores are quantiles over every text that was not trained on, also beyond ``per_label``."""
    from costweave.llm import langid

    words = {"en": "the house is red and the road is long and they are there", "de": "das Haus ist rot und die Strasse ist sehr schmal geworden"}
    docs = spark.createDataFrame([(i, f"{words[lang]} {i}", lang) for i in range(1_500) for lang in words], "doc_id long, text string, lang string")
    network, least = langid.fit_rejecting(docs, per_label=200, tail=0.01)
    held = docs.where(F.pmod(F.xxhash64("text", F.lit(13)), F.lit(5)) == 0).toPandas()
    names, scores = langid.Judge(network)(held["text"].tolist())
    for lang in words:
        own = [s for s, n, want in zip(scores, names, held["lang"]) if n == want == lang]
        assert len(own) > 200
        assert least[lang, 0] == pytest.approx(min(langid.ENOUGH, float(np.quantile(own, 0.01, method="lower"))), abs=1e-12)


def test_lower_quantiles_are_values(skewed):
    rows = [r["v"] for r in skewed.where("k = 'hot' AND v IS NOT NULL").collect()]
    for refine in (True, False):
        got = exact_quantiles(skewed, ["k"], "v", {}, refine=refine, lower={"low": 0.3}).where("k = 'hot'").first()["low"]
        assert got == np.quantile(rows, 0.3, method="lower")


def test_quantiles_do_not_gather_a_large_group(spark, skewed):
    """Without Spark's own broadcasts, the values of a group still meet their few groups without a sort or a shuffle."""
    old = {c: spark.conf.get(c) for c in ("spark.sql.autoBroadcastJoinThreshold",)}
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        for refine in (True, False):
            plan = exact_quantiles(skewed, ["k"], "v", {"m": 0.5}, refine=refine)._jdf.queryExecution().sparkPlan().toString()
            assert "SortMergeJoin" not in plan and "BroadcastHashJoin" in plan
    finally:
        for c, v in old.items():
            spark.conf.set(c, v)


def test_sizes_deal_codes_and_files_over_more_parts(spark, monkeypatch, tmp_path):
    from costweave.functions import sizing
    from costweave.operators.compare import code_difference

    spark.range(2_000).selectExpr("concat('a', id) AS a", "concat('b', id % 7) AS b").write.parquet(str(tmp_path / "t"))
    t = spark.read.parquet(str(tmp_path / "t"))
    s = t.where("a <> 'a5'").unionByName(t.where("a = 'a6'").selectExpr("'zz' AS a", "CAST(NULL AS string) AS b"))
    want = {r["col"]: r[1:] for r in code_difference(t, s, ["a", "b"]).collect()}
    assert sizing.parts_for(t) == 1
    monkeypatch.setattr(sizing, "PART_BYTES", 1_000)
    assert sizing.parts_for(t) > 4 and sizing.parts_for(t, 10**6) == 10**6
    assert sizing.parts_for(spark.createDataFrame([(1,)], "a int").rdd.toDF(), 3) == 3
    assert {r["col"]: r[1:] for r in code_difference(t, s, ["a", "b"]).collect()} == want == {"a": (1, 1), "b": (0, 0)}


def test_scanned_texts_keep_their_ids_and_nulls(spark):
    """Ids of any type, null and repeated texts pass the automaton in batches of bounded bytes."""
    texts = spark.createDataFrame([("x", "Stone wall"), (None, "STONE"), ("y", None), ("x", "wall")], "id string, v string")
    terms = spark.createDataFrame([(1, "stone"), (2, "wall")], "ord int, t string")
    got = sorted(map(str, TR.terms_in_texts(texts, terms, "id", "v", "ord", "t").collect()))
    assert got == ["Row(text_id='x', term_id=1)", "Row(text_id='x', term_id=2)", "Row(text_id=None, term_id=1)"]
    assert int(spark.conf.get("spark.sql.execution.arrow.maxBytesPerBatch")) <= 4 * 1024**2


def test_gathered_quantiles_and_catalog_equal_the_spread_ones(spark, monkeypatch):
    from costweave.operators import catalog

    rows = spark.createDataFrame(
        [(i, f"R{i % 7}" if i % 11 else None, f"P{i % 5}" if i % 13 else None, None if i % 5 == 3 else float((i * 37) % 23),
          None if i % 2 else "x", float(i), i % 3 == 0) for i in range(400)],
        "ord int, rate_code string, resource_code string, resource_price_per_unit_current double, resource_name string, "
        "resource_cost double, is_labor boolean").withColumns(
        {"is_material": F.lit(None).cast("boolean"), "is_machine": F.lit(True), "resource_quantity": F.col("resource_cost")})
    probs = {"q": 0.5, "r": 0.9}
    args = (rows, ["resource_code"], "resource_price_per_unit_current", probs, "up")
    near = exact_quantiles(*args, lower={"low": 0.3}, rows_if_near=400)
    assert sorted(near.collect(), key=str) == sorted(exact_quantiles(*args, lower={"low": 0.3}).collect(), key=str)
    found = catalog.resource_catalog(rows, "EUR").collect()
    assert len(found) == 5 and {r.used_in_work_items for r in found} == {7}
    monkeypatch.setattr(catalog, "VALUES_PER_TASK", 1)
    assert catalog.resource_catalog(rows, "EUR").collect() == found
