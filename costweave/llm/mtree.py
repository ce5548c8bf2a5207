"""Exact top-k by inner product through an M-tree.

Vectors are integers, floor(256 x). The tree has the routing objects of its root (chosen from a bounded sample, each
far from the others), below them pages of at most about ``PAGE`` vectors, and in a page leaf nodes of about ``LEAF``.
A node stores its covering radius and its distance to its parent's routing object, a vector its distance to its leaf's.
Distances are Euclidean; for a query q and a node with routing object c and radius r, no inner product below it
exceeds <q, c> + |q| r, and as |c - p| is stored, <q, c> itself need not be computed where <q, p> + |q| (|c - p| + r) is
already too small.

Queries go in blocks. Each first searches the pages of its most promising routing object, which gives a score to beat,
and then only those routing objects whose bound reaches that score; in a page, leaf nodes are visited best first.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from costweave.llm.vectors import best_of_each, clean, matrix, nth, stacked
from costweave.session import cut_lineage

PAGE, LEAF, ROUTING, SAMPLE, BLOCK = 2048, 64, 64, 4096, 512


def whole_numbers(x: np.ndarray) -> np.ndarray:
    return np.floor(256.0 * x).astype(np.int64)


def apart(x: np.ndarray, n: int) -> np.ndarray:
    """Indices of up to ``n`` rows, each as far as possible from those before it; equal rows are taken once."""
    chosen, near = [0], ((x - x[0]).astype(float) ** 2).sum(axis=1)
    while len(chosen) < n and near.max() > 0:
        chosen.append(int(near.argmax()))
        near = np.minimum(near, ((x - x[chosen[-1]]).astype(float) ** 2).sum(axis=1))
    return np.array(chosen)


def distances(x: np.ndarray, centres: np.ndarray) -> np.ndarray:
    a, b = x.astype(float), centres.astype(float)
    return np.sqrt(np.maximum((a * a).sum(1)[:, None] + (b * b).sum(1)[None, :] - 2 * a @ b.T, 0))


def build_page(x: np.ndarray, parent: np.ndarray) -> dict[str, np.ndarray]:
    """Leaf nodes over the rows of a page: the order of its rows, and by node size, centre, radius and parent distance."""
    centres = x[np.linspace(0, len(x) - 1, -(-len(x) // LEAF)).astype(int)]
    d = distances(x, centres)
    leaf = d.argmin(axis=1)
    order = np.argsort(leaf, kind="stable")
    near = d[np.arange(len(x)), leaf]
    sizes = np.bincount(leaf, minlength=len(centres))
    radius = np.zeros(len(centres))
    np.maximum.at(radius, leaf, near)
    used = sizes > 0
    return {"order": order, "near": near[order], "sizes": sizes[used], "centres": centres[used], "radius": radius[used],
            "parent": distances(centres[used], parent[None, :])[:, 0]}


def search_page(q: np.ndarray, own: int, least: float, page: dict, k: int) -> list[tuple[int, int]]:
    """(score, id) of up to ``k`` rows of the page with scores of ``least`` or more, the query's own row left out."""
    length = float(np.sqrt((q.astype(float) ** 2).sum()))
    slack = 1e-6 + 1e-9 * length * page["longest"]
    far = float(q @ page["pivot"]) + length * (page["parent"] + page["radius"]) + slack
    nodes = np.flatnonzero(far >= least)
    if not len(nodes):
        return []
    toward = (page["centres"][nodes] @ q).astype(float)
    bound = toward + length * page["radius"][nodes] + slack
    best: list[tuple[int, int]] = []
    for at in np.argsort(-bound):
        if bound[at] < least:
            break
        rows = slice(page["first"][nodes[at]], page["first"][nodes[at] + 1])
        some = np.flatnonzero(toward[at] + length * page["near"][rows] + slack >= least) + rows.start
        scores, ids = page["x"][some] @ q, page["ids"][some]
        good = (scores >= least) & (ids != own)
        if good.any():
            best = sorted([*best, *zip(scores[good].tolist(), ids[good].tolist(), strict=True)], key=lambda s: (-s[0], s[1]))[:k]
            if len(best) == k:
                least = max(least, best[-1][0])
    return best


def top_k(vectors: DataFrame, key: str = "vec_id", vector: str = "embedding", k: int = 5, every: int = 50) -> DataFrame:
    """(query_id, rank, vec_id, score): for each row whose key is divisible by ``every``, its ``k`` best other rows.

    Ties go to the smaller key; with fewer candidates all are returned. Rows with a null key, a null vector or a
    component that is null or not finite take no part; a repeated key stands once, with its smallest vector; shorter
    vectors count as filled up with zeros. An empty table gives no row. Inner products must fit 64 bits.
    """
    spark = vectors.sparkSession
    rows = cut_lineage(clean(vectors, key, vector, zero=True))
    dim = max(1, rows.agg(F.max(F.size("v"))).first()[0] or 1)
    sample = rows.orderBy(F.xxhash64("id"), "id").limit(SAMPLE).select("v").toArrow()["v"].combine_chunks()
    pivots = whole_numbers(matrix(sample, dim)) if len(sample) else np.zeros((1, dim), np.int64)
    pivots = pivots[apart(pivots, ROUTING)]

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                x = whole_numbers(matrix(batch.column("v"), dim))
                d = distances(x, pivots)
                own = d.argmin(axis=1)
                yield pa.RecordBatch.from_arrays(
                    [batch.column("id").cast(pa.int64()), pa.array(own, pa.int32()), pa.array(d[np.arange(len(x)), own]),
                     pa.array([r.tobytes() for r in x], pa.binary())], names=["id", "pivot", "distance", "x"])

    assigned = cut_lineage(rows.mapInArrow(assign, "id long, pivot int, distance double, x binary"))
    shape = {r["pivot"]: r for r in assigned.groupBy("pivot").agg(F.count(F.lit(1)).alias("n"), F.max("distance").alias("r")).collect()}
    reach = np.array([shape[p]["r"] if p in shape else -np.inf for p in range(len(pivots))])
    chunks = [-(-shape[p]["n"] // PAGE) if p in shape else 1 for p in range(len(pivots))]

    def build(group: pa.Table) -> pa.Table:
        pivot, x = group["pivot"][0].as_py(), stacked(group["x"], "<i8", dim)
        made = build_page(x, pivots[pivot])
        order = made["order"]
        lists = [[v.tolist()] for v in (group["id"].to_numpy()[order], made["sizes"], made["radius"], made["parent"], made["near"])]
        return pa.table([[pivot], *lists, [x[order].tobytes()], [made["centres"].tobytes()]],
                        schema=pa.schema([("pivot", pa.int32()), ("ids", pa.list_(pa.int64())), ("sizes", pa.list_(pa.int64())),
                                          *((n, pa.list_(pa.float64())) for n in ("radius", "parent", "near")), ("x", pa.binary()), ("centres", pa.binary())]))

    pages = cut_lineage(
        assigned.withColumn("chunk", F.pmod(F.xxhash64("id"), nth(chunks, "pivot"))).groupBy("pivot", "chunk").applyInArrow(
            build, "pivot int, ids array<long>, sizes array<long>, radius array<double>, parent array<double>, near array<double>, x binary, centres binary"))

    queries = assigned.where(F.col("id") % every == 0).select("id", "x")
    blocks = max(1, -(-queries.count() // BLOCK))

    def bounds(x: np.ndarray) -> np.ndarray:
        with np.errstate(invalid="ignore"):
            return (x @ pivots.T).astype(float) + np.sqrt((x.astype(float) ** 2).sum(1))[:, None] * reach + 1e-3

    def first(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                best = np.where(np.isfinite(reach), bounds(stacked(batch.column("x"), "<i8", dim)), -np.inf).argmax(axis=1)
                yield pa.RecordBatch.from_arrays(
                    [batch.column("id"), batch.column("x"), pa.array(best, pa.int32()), pa.array([-np.inf] * len(best))],
                    names=["id", "x", "pivot", "least"])

    def others(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                x, least = stacked(batch.column("x"), "<i8", dim), batch.column("least").to_numpy()
                b = np.where(np.isfinite(reach), bounds(x), -np.inf)
                b[np.arange(len(x)), b.argmax(axis=1)] = -np.inf
                row, pivot = np.nonzero(np.isfinite(b) & (b >= least[:, None]))
                picked = batch.take(pa.array(row))
                yield pa.RecordBatch.from_arrays(
                    [picked.column("id"), picked.column("x"), pa.array(pivot, pa.int32()), picked.column("least")], names=["id", "x", "pivot", "least"])

    def block(group: pa.Table) -> pa.Table:
        return pa.table({"pivot": group["pivot"].slice(0, 1), "queries": [group["id"].to_pylist()], "least": [group["least"].to_pylist()],
                         "q": [b"".join(group["x"].to_pylist())]})

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                x = np.frombuffer(row["x"], "<i8").reshape(-1, dim)
                page = {"x": x, "ids": np.array(row["ids"]), "centres": np.frombuffer(row["centres"], "<i8").reshape(-1, dim),
                        "first": np.concatenate([[0], np.cumsum(row["sizes"])]), "pivot": pivots[row["pivot"]],
                        "longest": float(np.sqrt((x.astype(float) ** 2).sum(1).max()))}
                page |= {n: np.array(row[n]) for n in ("radius", "parent", "near")}
                out = []
                for q, own, least in zip(np.frombuffer(row["q"], "<i8").reshape(-1, dim), row["queries"], row["least"], strict=True):
                    out += [(own, i, s) for s, i in search_page(q, own, least, page, k)]
                if out:
                    yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*out, strict=True)], names=["query_id", "vec_id", "score"])

    searched = lambda asked: (
        asked.withColumn("block", F.pmod(F.xxhash64("id"), F.lit(blocks))).groupBy("pivot", "block")
        .applyInArrow(block, "pivot int, queries array<long>, least array<double>, q binary").join(pages, "pivot")
        .mapInArrow(search, "query_id long, vec_id long, score long"))
    asked = "id long, x binary, pivot int, least double"
    near = cut_lineage(best_of_each(searched(queries.mapInArrow(first, asked)), k))
    beat = near.where(F.col("rank") == k).select(F.col("query_id").alias("id"), F.col("score").cast("double").alias("least"))
    rest = searched(queries.join(beat, "id", "left").select("id", "x", F.coalesce("least", F.lit(float("-inf"))).alias("least")).mapInArrow(others, asked))
    return best_of_each(near.select("query_id", "vec_id", "score").unionByName(rest), k)
