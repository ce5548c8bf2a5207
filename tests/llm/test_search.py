"""Vector searches against brute force, with ties, copies, zero, null and short vectors."""

import math
import random

from costweave.llm import mtree, rpforest

SCHEMA = "vec_id long, embedding array<float>, score string, rank string, pivot string"


def frame(spark, vectors):
    return spark.createDataFrame([(k, v, "x", "y", "z") for k, v in vectors], SCHEMA)


def made(seed, n, dim=6):
    r = random.Random(seed)
    hot = [r.choice((-1.0, 0.5, 2.0)) for _ in range(dim)]
    rows = [(i, list(hot) if i % 3 == 0 else [r.choice((-0.75, -0.25, 0.0, 0.5, 1.0)) for _ in range(dim)]) for i in range(n)]
    rows += [(n, None), (n + 1, [1.0, None]), (n + 2, [float("nan")] * dim), (n + 3, [float("inf")] * dim), (None, [1.0] * dim),
             (n + 4, [0.0] * dim), (n + 5, [1.0]), (4, rows[4][1])]
    return rows


def valid(rows):
    out = {}
    for k, v in rows:
        if k is not None and v is not None and all(x is not None and math.isfinite(x) for x in v):
            out[k] = v
    return out


def brute(rows, score, k=5, every=50):
    out = []
    for q in rows:
        if q % every == 0:
            found = sorted(((-score(rows[q], rows[c]), c) for c in rows if c != q))[:k]
            out += [(q, i + 1, c, -s) for i, (s, c) in enumerate(found)]
    return sorted(out)


def test_mtree_equals_brute_force(spark, monkeypatch):
    whole = lambda v: [math.floor(256.0 * x) for x in v]
    rows = made(1, 1200)
    want = brute(valid(rows), lambda a, b: sum(x * y for x, y in zip(whole(a), whole(b), strict=False)))
    for page in (2048, 64):
        monkeypatch.setattr(mtree, "PAGE", page)
        monkeypatch.setattr(mtree, "BLOCK", 7)
        got = sorted((r.query_id, r.rank, r.vec_id, r.score) for r in mtree.top_k(frame(spark, rows)).collect())
        assert got == want


def test_few_rows_and_none(spark):
    rows = frame(spark, [(0, [1.0, 0.0]), (3, [0.5, 0.5]), (50, [1.0, 0.0])])
    for search in (mtree.top_k, rpforest.nearest):
        got = [(r.query_id, r.rank, r.vec_id) for r in search(rows).orderBy("query_id", "rank").collect()]
        assert got == [(0, 1, 50), (0, 2, 3), (50, 1, 0), (50, 2, 3)]
        assert search(rows.where("false")).count() == 0
        assert search(rows.where("vec_id = 3")).count() == 0


def test_no_page_is_left_out_that_bounds_admit(spark):
    r = random.Random(3)
    rows = {i: [r.gauss(0, 1) for _ in range(16)] for i in range(3000)}
    got = mtree.top_k(spark.createDataFrame([(k, v) for k, v in rows.items()], "vec_id long, embedding array<double>"))
    whole = {k: [math.floor(256 * x) for x in v] for k, v in rows.items()}
    want = brute(whole, lambda a, b: sum(x * y for x, y in zip(a, b, strict=True)))
    assert sorted((r.query_id, r.rank, r.vec_id, r.score) for r in got.collect()) == want


def cosine(a, b):
    n = min(len(a), len(b))
    return sum(x * y for x, y in zip(a[:n], b[:n], strict=True)) / math.sqrt(sum(x * x for x in a) * sum(y * y for y in b))


def test_forest_recall_and_exact_scores(spark, monkeypatch):
    r = random.Random(4)
    rows = {i: [r.gauss(0, 1) for _ in range(24)] for i in range(4000)}
    found = rpforest.nearest(spark.createDataFrame(list(rows.items()), "vec_id long, embedding array<double>")).collect()
    want = brute(rows, cosine)
    best = {(q, c): s for q, _, c, s in want}
    assert sum((r.query_id, r.vec_id) in best for r in found) >= 0.9 * len(want) and len(found) == len(want)
    assert all(abs(r.score - cosine(rows[r.query_id], rows[r.vec_id])) < 1e-12 for r in found)
    for a, b in zip(found, sorted(found, key=lambda r: (r.query_id, r.rank)), strict=True):
        assert b.rank >= 1


def test_forest_with_copies_and_odd_rows(spark, monkeypatch):
    monkeypatch.setattr(rpforest, "PAGE", 50)
    rows = made(5, 900)
    kept = {k: v for k, v in valid(rows).items() if any(v)}
    got = sorted((r.query_id, r.rank, r.vec_id, round(r.score, 9)) for r in rpforest.nearest(frame(spark, rows), share=99.0).collect())
    want = [(q, i, c, round(s, 9)) for q, i, c, s in brute(kept, lambda a, b: round(cosine(a, b), 12))]
    assert [g[:2] + g[3:] for g in got] == [w[:2] + w[3:] for w in want]
    hot = [w for w in want if w[0] % 3 == 0]
    assert {w for w in hot} <= set(got)
