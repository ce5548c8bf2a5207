"""Components equal brute force, sketches fill and estimate, and large groups lose no link."""

import itertools
import random

import numpy as np

from costweave.llm import minhash


def brute(rows, words=5, percent=75):
    """Components of (key, text) rows by comparing all pairs of sets."""
    def shingles(text):
        found = (text or "").encode().translate(bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))).split()
        n = min(words, len(found))
        return {tuple(found[i:i + n]) for i in range(len(found) - n + 1)} if found else set()

    sets = [(k, shingles(t)) for k, t in rows]
    root = {k: k for k, _ in rows if k is not None}

    def find(k):
        while root[k] != k:
            k = root[k]
        return k

    for (a, x), (b, y) in itertools.combinations([s for s in sets if s[0] is not None and s[1]], 2):
        if 100 * len(x & y) >= percent * len(x | y):
            low, high = sorted((find(a), find(b)))
            root[high] = low
    return sorted(((k, len(s), None if k is None else find(k), k is None or find(k) == k) for k, s in sets), key=str)


def run(df):
    return sorted(((r.doc_id, r.n_shingles, r.component_id, r.kept) for r in minhash.near_duplicates(df).collect()), key=str)


def test_odd_rows(odd, none):
    assert run(odd) == brute([(r.doc_id, r.text) for r in odd.collect()])
    assert minhash.near_duplicates(none).count() == 0
    kept = [r.doc_id for r in minhash.drop_near_duplicates(odd).collect()]
    assert sorted(kept, key=str) == sorted([1, 2, 3, 4, None, 5, 6, 7, 9, 10], key=str)
    assert minhash.drop_near_duplicates(odd).columns == odd.columns


def test_copies_chains_and_versions(spark):
    r = random.Random(5)
    vocabulary = [f"w{i}" for i in range(5000)]
    rows, key = [], itertools.count(1000, -1)
    for n in (6, 40, 200):
        base = r.choices(vocabulary, k=n)
        rows += [(next(key), " ".join(base).upper() if i % 2 else " ".join(base)) for i in range(8)]
        for _ in range(25):  # versions of the base, and of each other along a chain
            base = list(base) if r.random() < 0.5 else base
            copy = list(base)
            for _ in range(max(1, n // 60)):
                copy[r.randrange(n)] = r.choice(vocabulary)
            rows.append((next(key), "\t".join(copy)))
            base = copy
    passage = r.choices(vocabulary, k=60)  # shared by many, which does not make them duplicates
    rows += [(next(key), " ".join(passage + r.choices(vocabulary, k=r.randint(10, 60)))) for _ in range(120)]
    assert run(spark.createDataFrame(rows, "doc_id long, text string").repartition(4)) == brute(rows)


def test_one_block_per_bucket_or_many(spark, monkeypatch):
    r = random.Random(6)
    base = [f"v{i}" for i in range(120)]
    rows = []
    for i in range(150):
        copy = list(base)
        for _ in range(2):
            copy[r.randrange(120)] = f"z{r.randrange(10**6)}"
        rows.append((i, " ".join(copy)))
    monkeypatch.setattr(minhash, "BLOCK", 2000)
    assert run(spark.createDataFrame(rows, "doc_id long, text string")) == brute(rows)


def test_sketch_fills_and_estimates():
    r = np.random.default_rng(1)
    for n in (1, 2, 7, 33, 500, 20_000):
        s = minhash.sketch(np.unique(r.integers(0, 2**63, n).astype(np.uint64)))
        assert s.max() < 2**64 - 1
    errors = []
    for _ in range(200):
        x = r.integers(0, 2**63, 300).astype(np.uint64)
        errors.append((minhash.sketch(np.unique(x[:250])) == minhash.sketch(np.unique(x[50:]))).mean() - 200 / 300)
    assert abs(np.mean(errors)) < 0.01 and np.std(errors) < 0.05


def test_components_of_a_path(spark):
    links = spark.createDataFrame([(i + 1, i) for i in range(100, 160)] + [(9, 3), (9, 5)], "a long, b long")
    found = {r.id: r.component for r in minhash.components(links).collect()}
    assert found == {**{i: 100 for i in range(101, 161)}, 5: 3, 9: 3}
    assert minhash.components(links.where("false")).count() == 0
