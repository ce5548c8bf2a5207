"""Ranked lexical search equals a brute-force scoring of every document, with and without pruned blocks."""

import math
import random
import re
from collections import Counter

from costweave.llm import lexical

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
FOLD = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def terms(text):
    return TERM.findall((text or "").translate(FOLD))


def brute(docs, items, k=10):
    rows = [(d, terms(t)) for d, t in docs]
    n_rows, n_terms = sum(1 for _, ts in rows if ts), sum(len(ts) for _, ts in rows)
    df = Counter(t for _, ts in rows for t in set(ts))
    out = []
    for item in {i for i, _ in items}:
        wanted = {t for i, x in items if i == item for t in terms(x)}
        scored = []
        for r, (d, ts) in enumerate(rows):
            tf, m = Counter(ts), 10 + (90 * len(ts) * n_rows) // max(n_terms, 1)
            s = sum(math.floor(1000 * math.log((2 * n_rows + 2) / (2 * df[t] + 1))) * ((10**9 * tf[t]) // (1000 * tf[t] + 8 * m))
                    for t in wanted if t in tf)
            if s > 0:
                scored.append((-s, d is None, d or 0, r, d, s))
        out += [(item, rank + 1, d, s) for rank, (*_, d, s) in enumerate(sorted(scored)[:k])]
    return sorted(out, key=str)


def run(docs, items, **kw):
    index = lexical.build_index(docs, **{k: v for k, v in kw.items() if k == "rows_per_block"})
    rows = lexical.search(index, items, **{k: v for k, v in kw.items() if k != "rows_per_block"}).collect()
    return sorted(((r.item_id, r.rank, r.doc_id, r.score) for r in rows), key=str)


def test_odd_rows(spark, odd, none):
    items = spark.createDataFrame(
        [(1, "the same text"), (2, None), (3, ""), (1, "ende WORD"), (4, "Ünïcödé 日本語"), (5, "12 34 zz"), (None, "one")],
        "item_id long, text string").selectExpr("*", "'x' AS score", "'x' AS rank", "'x' AS term")
    got = run(odd, items)
    assert got == brute([(r.doc_id, r.text) for r in odd.collect()], [(r.item_id, r.text) for r in items.collect()])
    assert run(none, items) == [] and run(odd, items.where("false")) == []


def test_pruned_blocks_are_exact(spark):
    rnd = random.Random(3)
    vocab = [f"w{i}" for i in range(300)]
    docs = [(i, " ".join(rnd.choice(vocab[: 20 + i % 280]) for _ in range(rnd.randint(0, 80)))) for i in range(400)]
    docs += [(400 + i, docs[i][1]) for i in range(0, 40, 3)]
    items = [(j, " ".join(rnd.choice(vocab) for _ in range(rnd.randint(1, 6)))) for j in range(25)]
    frame = spark.createDataFrame(docs, "doc_id long, text string")
    queries = spark.createDataFrame(items, "item_id long, text string")
    want = brute(docs, items)
    assert run(frame, queries, rows_per_block=4) == want
    assert run(frame, queries, rows_per_block=4, probe=1, k=3) == brute(docs, items, k=3)
    assert run(frame, queries) == want
