"""Approximate nearest neighbours by cosine through a forest of random-projection trees.

A tree's nodes split by a random direction (the difference of two vectors of the sample below the node) at the median.
The splits are fitted on a bounded sample, and every row is routed to a leaf of every tree. A query walks all trees
through one priority queue: it takes the node with the largest margin so far, in whatever tree, until the leaves it
has reached hold ``share`` times as many rows as the table. All rows of these leaves are ranked by their exact cosine.

Leaves are stored in pages of bounded size, so a leaf of many equal vectors is split over tasks. With 16 trees and a
share of 1.2 the test data, which are nearly uniform in 64 dimensions, give a recall of 0.98 at 5 neighbours.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from costweave.llm.vectors import best_of_each, clean, matrix, stacked
from costweave.session import cut_lineage

SAMPLE, LEAF_OF_SAMPLE, PAGE, BLOCK = 16_384, 128, 4096, 512


@dataclass
class Forest:
    """``planes`` is (trees, 2**depth - 1, dim), ``offsets`` (trees, 2**depth - 1); node n has children 2n + 1 and 2n + 2."""

    planes: np.ndarray
    offsets: np.ndarray
    depth: int

    @classmethod
    def fit(cls, x: np.ndarray, trees: int, seed: int = 17) -> Forest:
        depth, r = int(np.log2(max(1, len(x) // LEAF_OF_SAMPLE))), np.random.default_rng(seed)
        planes, offsets = np.zeros((trees, 2**depth - 1, x.shape[1])), np.zeros((trees, 2**depth - 1))
        for t in range(trees):
            node = np.zeros(len(x), int)
            for n in range(2**depth - 1):
                own = x[node == n]
                if len(own) > 1:
                    a, b = r.choice(len(own), 2, replace=False)
                    way = own[a] - own[b]
                    way = way if way.any() else r.normal(size=x.shape[1])
                    planes[t, n] = way / np.sqrt((way * way).sum())
                    offsets[t, n] = np.median(own @ planes[t, n])
                node[node == n] = 2 * n + 1 + (own @ planes[t, n] > offsets[t, n])
        return cls(planes, offsets, depth)

    def leaves(self, x: np.ndarray) -> np.ndarray:
        """(rows, trees): the leaf of each row in each tree, from 0."""
        out = np.empty((len(x), len(self.planes)), np.int64)
        for t in range(len(self.planes)):
            node = np.zeros(len(x), np.int64)
            for _ in range(self.depth):
                node = 2 * node + 1 + ((x * self.planes[t][node]).sum(axis=1) > self.offsets[t][node])
            out[:, t] = node - (2**self.depth - 1)
        return out

    def visit(self, q: np.ndarray, sizes: np.ndarray, wanted: float) -> list[tuple[int, int]]:
        """(tree, leaf) in the order of the shared queue until the leaves hold ``wanted`` rows."""
        margins = self.planes @ q - self.offsets
        inner, out, held = 2**self.depth - 1, [], 0
        queue = [(-np.inf, t, 0) for t in range(len(self.planes))]
        while queue and held < wanted:
            margin, t, n = heapq.heappop(queue)
            if n >= inner:
                if sizes[t, n - inner]:
                    out.append((t, n - inner))
                    held += sizes[t, n - inner]
                continue
            m = margins[t, n]
            heapq.heappush(queue, (max(margin, m), t, 2 * n + 1))
            heapq.heappush(queue, (max(margin, -m), t, 2 * n + 2))
        return out


def nearest(vectors: DataFrame, key: str = "vec_id", vector: str = "embedding", k: int = 5, every: int = 50, trees: int = 16,
            share: float = 1.2) -> DataFrame:
    """(query_id, rank, vec_id, score): for each row whose key is divisible by ``every``, the ``k`` nearest others found.

    The score is the cosine in doubles; ties go to the smaller key. A query whose leaves hold fewer than ``k`` others
    goes on until it has them or all rows. Rows with a null key, a null or zero vector or a component that is null or not finite take no part; a
    repeated key stands once, with its smallest vector; shorter vectors count as filled up with zeros. An empty table
    gives no row.
    """
    rows = cut_lineage(clean(vectors, key, vector, zero=False))
    total, dim = rows.agg(F.count(F.lit(1)), F.max(F.size("v"))).first()
    dim = max(1, dim or 1)
    sample = rows.orderBy(F.xxhash64("id"), "id").limit(SAMPLE).select("v").toArrow()["v"].combine_chunks()
    unit = lambda x: x / np.sqrt((x * x).sum(axis=1, keepdims=True))
    forest = Forest.fit(unit(matrix(sample, dim)) if len(sample) else np.zeros((1, dim)), trees)
    # Vectors of floats stay floats on their way; scores are computed in doubles.
    kind = "<f4" if vectors.schema[vector].dataType.elementType.simpleString() == "float" else "<f8"
    given = vectors.sparkSession.sparkContext.broadcast(forest)

    def route(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                x = matrix(batch.column("v"), dim)
                yield pa.RecordBatch.from_arrays(
                    [batch.column("id").cast(pa.int64()), pa.array([r.tobytes() for r in x.astype(kind)], pa.binary()),
                     pa.array(given.value.leaves(unit(x)).tolist(), pa.list_(pa.int32()))], names=["id", "x", "leaves"])

    routed = cut_lineage(rows.mapInArrow(route, "id long, x binary, leaves array<int>"))
    placed = routed.select("id", "x", F.posexplode("leaves").alias("tree", "leaf"))
    counts = placed.groupBy("tree", "leaf").agg(F.count(F.lit(1)).alias("n"))
    sizes = np.zeros((trees, 2**forest.depth), np.int64)
    for r in counts.collect():  # at most trees * 2**depth rows
        sizes[r["tree"], r["leaf"]] = r["n"]

    def page(group: pa.Table) -> pa.Table:
        return pa.table({"tree": group["tree"].slice(0, 1), "leaf": group["leaf"].slice(0, 1), "ids": [group["id"].to_pylist()],
                         "x": [b"".join(group["x"].to_pylist())]})

    chunk = F.pmod(F.xxhash64("id"), F.ceil(F.col("n") / PAGE))
    pages = placed.join(F.broadcast(counts), ["tree", "leaf"]).withColumn("chunk", chunk).select(
        "tree", "leaf", "chunk", "id", "x").groupBy("tree", "leaf", "chunk").applyInArrow(page, "tree int, leaf int, ids array<long>, x binary")
    queries = routed.where(F.col("id") % every == 0).select("id", "x")
    blocks = max(1, -(-queries.count() // BLOCK))

    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, raw in zip(batch.column("id").to_pylist(), batch.column("x").to_pylist(), strict=True):
                q = np.frombuffer(raw, kind).astype(float)
                # One tree's leaves are disjoint: k + 1 rows of each tree hold k others.
                seen = given.value.visit(q / np.sqrt((q * q).sum()), sizes, max(share * total, trees * (k + 1)))
                yield pa.RecordBatch.from_arrays(
                    [pa.array([i] * len(seen), pa.int64()), pa.array([raw] * len(seen), pa.binary()),
                     pa.array([s[0] for s in seen], pa.int32()), pa.array([s[1] for s in seen], pa.int32())], names=["id", "x", "tree", "leaf"])

    def block(group: pa.Table) -> pa.Table:
        return pa.table({"tree": group["tree"].slice(0, 1), "leaf": group["leaf"].slice(0, 1), "queries": [group["id"].to_pylist()],
                         "q": [b"".join(group["x"].to_pylist())]})

    def rerank(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                x, q = (np.frombuffer(row[n], kind).reshape(-1, dim).astype(float) for n in ("x", "q"))
                ids, own = np.array(row["ids"]), np.array(row["queries"])
                size, length = np.sqrt((x * x).sum(axis=1)), np.sqrt((q * q).sum(axis=1))
                rough = (q / length[:, None]) @ (x / size[:, None]).T
                rough[own[:, None] == ids[None, :]] = -np.inf
                out = []
                for i in range(len(q)):
                    last = np.partition(rough[i], -k)[-k] if len(ids) > k else -2.0
                    some = np.flatnonzero(rough[i] >= max(last - 1e-9, -2.0))
                    # Row by row in one order of summing, so that equal vectors get equal scores.
                    scores = (x[some] * q[i]).sum(axis=1) / (size[some] * length[i])
                    best = np.lexsort((ids[some], -scores))[:k]
                    out += [(own[i], ids[some[b]], scores[b]) for b in best]
                if out:
                    a, b, s = zip(*out, strict=True)
                    yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64()), pa.array(s, pa.float64())], names=["query_id", "vec_id", "score"])

    asked = queries.mapInArrow(walk, "id long, x binary, tree int, leaf int").withColumn("block", F.pmod(F.xxhash64("id"), F.lit(blocks)))
    packed = asked.groupBy("tree", "leaf", "block").applyInArrow(block, "tree int, leaf int, queries array<long>, q binary")
    found = packed.join(pages, ["tree", "leaf"]).mapInArrow(rerank, "query_id long, vec_id long, score double")
    return best_of_each(found.groupBy("query_id", "vec_id").agg(F.max("score").alias("score")), k)
