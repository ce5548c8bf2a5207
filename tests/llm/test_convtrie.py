"""The conversation trie equals a brute-force trie of the rebuilt conversations."""

import hashlib
import math
import random
import zlib
from collections import defaultdict

from costweave.llm import convtrie


def splice(c):
    return c - int(math.fmod(c, 5)), zlib.crc32(str(c).encode()) % 9


def brute(rows, spliced=True):
    by = defaultdict(list)
    for c, t, r, x in rows:
        if c is not None:
            by[c].append((t, r or "", x or ""))
    seq = {c: [(r, x) for t, r, x in sorted(v, key=lambda z: (z[0] is not None, z[0] or 0, z[1].encode(), z[2].encode()))]
           for c, v in by.items()}
    rebuilt = {}
    for c in seq:
        b, h = splice(c) if spliced else (c, 0)
        rebuilt[c] = seq.get(b, [])[:h] + seq[c][h:]
    nodes = defaultdict(list)
    for c, s in rebuilt.items():
        for d in range(len(s) + 1):
            nodes[tuple(s[:d])].append(c)

    def children(p):
        return [q for q in nodes if len(q) == len(p) + 1 and q[: len(p)] == p]

    out = []
    for pre, members in nodes.items():
        d = len(pre)
        sub = [p for p in nodes if len(p) >= d and p[:d] == pre]
        ends = ",".join(str(c) for c in sorted(c for c in members if len(rebuilt[c]) == d))
        out.append((min(members), d, min(nodes[pre[:-1]]) if d else None, len(members), len(children(pre)),
                    sum(1 for p in sub if not children(p)), sum((len(nodes[p]) - 1) * len(p[-1][1].encode()) for p in sub if p),
                    hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=str)


def run(frame, spliced=True):
    result = convtrie.prefix_tree(frame, splice=convtrie.grouped_splice() if spliced else None)
    return sorted((tuple(r) for r in result.collect()), key=str)


def test_odd_rows(spark):
    rows = [(0, 0, "user", "hi"), (0, 1, "assistant", "hello there"), (0, None, "system", "be brief"), (0, 2, None, None),
            (1, 0, "user", "hi"), (1, 0, "user", "hi"), (2, 5, "user", "x" * 100_000), (3, 1, "user", "Ünïcödé 日本語"),
            (4, 0, "user", "hi"), (5, 0, "user", "other"), (7, 3, "user", "a"), (7, 3, "assistant", "a"), (None, 0, "user", "hi"),
            (10, None, None, None), (12, 0, "user", "hi"), (12, 1, "assistant", "hello there"), (13, 9, "user", "late")]
    frame = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").selectExpr(
        "*", "'x' AS c", "'x' AS d", "'x' AS k1", "'x' AS pos", "'x' AS len", "'x' AS bytes")
    assert run(frame) == brute(rows)
    assert run(frame, spliced=False) == brute(rows, spliced=False)
    assert run(frame.where("false")) == []


def test_shared_prefixes(spark):
    rnd = random.Random(5)
    rows = []
    for c in range(120):
        base = rnd.choice([[], ["a"], ["a", "b"], ["a", "b", "c", "d"], ["q"] * 12])
        turns = base[: rnd.randint(0, len(base))] + [rnd.choice("abcz") for _ in range(rnd.randint(0, 4))]
        rows += [(c, i, "user" if i % 2 == 0 else "assistant", t) for i, t in enumerate(turns)]
        if not turns:
            rows.append((c, None, None, None))
    frame = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    assert run(frame) == brute(rows)
