"""Near duplicates by fast similarity sketching, banding and exact verification.

1. A text's set is its distinct shingles of ``words`` words (fewer words: the whole sequence as one). Its sketch has
   one coordinate per bin. In the first ``bins`` rounds every shingle is placed in a bin that the round's hash picks;
   in the next ``bins`` rounds, round i places all shingles in bin i. A bin keeps its smallest hash of the earliest
   round that reaches it, so every coordinate fills after twice ``bins`` rounds at most, and agreement of sketches is
   concentrated about the Jaccard similarity. Texts of equal sets form a class; classes go on through their smallest id.
2. Runs of ``rows`` coordinates are hashed into bands. In each bucket (band, hash) every class is a candidate of the
   smallest id there: that is linear in the bucket, whatever its size. A class is first held against the smallest of
   these, and against the others only where that left them in different components.
3. A bucket of three or more may hold links beside those to its smallest id. Classes of a bucket that are known to be
   connected need no comparison. All that are not in the bucket's largest component are held against the whole bucket
   on their full sets, in blocks of bounded size, and a block gives at most one link for each two components it joins:
   a group of texts that come near the threshold without reaching it gives no row. Equal buckets of several bands are
   compared once.
4. Candidates of step 2 whose sketches agree far less than the threshold asks for are left out, all others are
   confirmed on the full sets. Components follow by alternating large-star and small-star steps.

A link of similarity s is missed only if no band agrees: with 32 bands of 4 at most 5 in a million at 0.75, none to
speak of above 0.8. Exact copies are never missed.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from costweave.llm.tables import text_rows
from costweave.session import cut_lineage

GOLDEN = 0x9E3779B97F4A7C15
#: Shingles of the sets in a block.
BLOCK = 1 << 19


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection on 64 bits that spreads every input bit."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def seeds(n: int) -> np.ndarray:
    return mix(np.arange(1, n + 1, dtype=np.uint64) * np.uint64(GOLDEN))


def shingles(text: str | None, words: int = 5) -> np.ndarray:
    """The sorted distinct hashes of a text's shingles; ASCII letters are lower-cased, ASCII white space separates."""
    found = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not found:
        return np.empty(0, np.uint64)
    h = np.fromiter(map(xxhash.xxh3_64_intdigest, found), np.uint64, len(found))
    n, weights = min(words, len(found)), seeds(words) | np.uint64(1)
    s = np.full(len(found) - n + 1, n * GOLDEN % 2**64, np.uint64)
    for j in range(n):
        s += h[j:len(found) - n + 1 + j] * weights[j]
    return np.unique(mix(s))


def sketch(x: np.ndarray, bins: int = 128) -> np.ndarray:
    """The fast similarity sketch of a non-empty set of 64-bit hashes; ``bins`` is a power of two up to 128."""
    rounds, seed = 2 * bins, seeds(2 * bins)
    best = np.full(bins, 2**64 - 1, np.uint64)
    step = max(1, 2048 // len(x))
    for low in range(0, rounds, step):
        i = np.arange(low, min(low + step, rounds), dtype=np.uint64)[:, None]
        h = mix(x[None, :] ^ seed[low:low + step][:, None])
        bin_of = np.where(i < bins, h & np.uint64(bins - 1), i - np.minimum(i, np.uint64(bins)))
        np.minimum.at(best, bin_of.ravel().astype(np.int64), ((i << np.uint64(56)) | (h >> np.uint64(8))).ravel())
        if best.max() < 2**64 - 1:
            break
    return best


def band_keys(s: np.ndarray, bands: int, rows: int) -> np.ndarray:
    grid = s[: bands * rows].reshape(bands, rows)
    return mix((grid * (seeds(rows) | np.uint64(1))).sum(axis=1, dtype=np.uint64) + seeds(bands)).view(np.int64)


def marks(s: np.ndarray) -> bytes:
    """One byte of each coordinate."""
    return (mix(s) & np.uint64(255)).astype(np.uint8).tobytes()


def _sketches(docs: DataFrame, key: str, text: str, words: int, bands: int, rows: int, bins: int) -> DataFrame:
    kind = docs.schema[key].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for keys, texts in text_rows(batch, key, text):
                n, digest, keyed, mark = [], [], [], []
                for t in texts:
                    x = shingles(t, words)
                    n.append(len(x))
                    digest.append(hashlib.blake2b(x.tobytes(), digest_size=16).digest() if len(x) else None)
                    s = sketch(x, bins) if len(x) else None
                    keyed.append(band_keys(s, bands, rows).tolist() if len(x) else [])
                    mark.append(marks(s) if len(x) else None)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(keys, batch.schema.field(key).type), pa.array(n, pa.int64()), pa.array(digest, pa.binary()),
                     pa.array(keyed, pa.list_(pa.int64())), pa.array(mark, pa.binary())],
                    names=[key, "n_shingles", "digest", "bands", "marks"])

    return docs.select(key, text).mapInArrow(run, f"`{key}` {kind}, n_shingles long, digest binary, bands array<long>, marks binary")


def _wanted_bits(ids: DataFrame, bits: int) -> np.ndarray:
    """A table of ``bits`` bits, with those set that the ids hash to; its size does not depend on the ids."""
    words = ids.select(F.pmod(F.xxhash64("id"), F.lit(bits)).alias("place")).selectExpr(
        "cast(place div 64 as int) AS w", "shiftleft(1L, cast(place % 64 AS int)) AS x")
    table = np.zeros(bits // 64, np.int64)
    for batch in words.groupBy("w").agg(F.bit_or("x").alias("x")).toArrow().to_batches():
        table[batch.column("w").to_numpy()] = batch.column("x").to_numpy()
    return table.view(np.uint64)


def _sets(docs: DataFrame, ids: DataFrame, key: str, text: str, words: int, bits: int = 1 << 24) -> DataFrame:
    """(id, set) of the texts with these ids. The bit table keeps most other texts out of the shuffle."""
    kind = docs.schema[key].dataType.simpleString()
    given = docs.sparkSession.sparkContext.broadcast(_wanted_bits(ids, bits))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = given.value
        for batch in batches:
            place = batch.column("place").to_numpy()
            hit = (table[place // 64] >> (place % 64).astype(np.uint64)) & np.uint64(1)
            for keys, texts in text_rows(batch.filter(pa.array(hit == 1)), key, text):
                yield pa.RecordBatch.from_arrays(
                    [pa.array(keys, batch.schema.field(key).type),
                     pa.array([shingles(t, words).view(np.int64) for t in texts], pa.list_(pa.int64()))], names=["id", "set"])

    placed = docs.where(F.col(key).isNotNull()).select(key, text, F.pmod(F.xxhash64(key), F.lit(bits)).alias("place"))
    return placed.mapInArrow(run, f"id {kind}, set array<long>").join(ids, "id", "left_semi")


def _bytes(column: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.uint8).reshape(len(column), -1)


def _promising(pairs: DataFrame, classes: DataFrame, percent: int, least: float) -> DataFrame:
    """Pairs (a, b) whose set sizes allow the threshold and whose sketches come near it."""
    side = lambda n: classes.select(F.col("id").alias(n), F.col("n_shingles").alias(f"n_{n}"), F.col("marks").alias(f"m_{n}"))
    both = pairs.join(side("a"), "a").join(side("b"), "b").where(
        100 * F.least("n_a", "n_b") >= percent * F.greatest("n_a", "n_b"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                equal = _bytes(batch.column("m_a")) == _bytes(batch.column("m_b"))
                yield batch.select(["a", "b"]).filter(pa.array(equal.mean(axis=1) >= least))

    return both.select("a", "b", "m_a", "m_b").mapInArrow(run, pairs.select("a", "b").schema)


def _confirmed(pairs: DataFrame, docs: DataFrame, key: str, text: str, words: int, percent: int) -> DataFrame:
    """The written pairs that reach the threshold on their full sets."""
    sets = cut_lineage(_sets(docs, pairs.select(F.explode(F.array("a", "b")).alias("id")).distinct(), key, text, words))
    common = F.size(F.array_intersect("set_a", "set_b"))
    return (
        pairs.join(sets.select(F.col("id").alias("a"), F.col("set").alias("set_a")), "a")
        .join(sets.select(F.col("id").alias("b"), F.col("set").alias("set_b")), "b")
        .withColumn("common", common)
        .where(100 * F.col("common") >= percent * (F.size("set_a") + F.size("set_b") - F.col("common")))
        .select("a", "b").distinct())


def _beside(entries: DataFrame, classes: DataFrame, reached: DataFrame, docs: DataFrame, key: str, text: str, words: int,
            percent: int) -> DataFrame:
    """Links between classes of one bucket that are in different components, at most one for each two components and block."""
    buckets = entries.groupBy("bucket").agg(
        F.count(F.lit(1)).alias("m"), F.min("id").alias("first"), F.sum(F.xxhash64("id").cast("decimal(20,0)")).alias("content"))
    chosen = buckets.groupBy("m", "first", "content").agg(F.min("bucket").alias("bucket")).select("bucket")
    size = classes.groupBy("id").agg(F.max("n_shingles").alias("n_shingles"))
    own = entries.join(chosen, "bucket").join(reached.withColumnRenamed("component", "root"), "id", "left").withColumn(
        "root", F.coalesce("root", "id")).join(size, "id")
    by_root = own.groupBy("bucket", "root").agg(F.count(F.lit(1)).alias("n"), F.sum("n_shingles").alias("w"))
    main = by_root.groupBy("bucket").agg(
        F.max(F.struct("n", "root")).alias("most"), F.max_by("w", F.struct("n", "root")).alias("most_w"), F.sum("w").alias("all_w"),
        F.count(F.lit(1)).alias("roots")).where("roots > 1")
    own = cut_lineage(own.join(main, "bucket").select(
        "bucket", "id", "root", (F.col("root") != F.col("most.root")).alias("odd"), (F.col("all_w") - F.col("most_w")).alias("odd_w"), "all_w"))
    sets = _sets(docs, own.select("id").distinct(), key, text, words)
    own = own.join(sets, "id")
    blocks = lambda n: F.ceil(F.col(n) / BLOCK).cast("int")
    spread = lambda n, salt: F.pmod(F.xxhash64("id", F.lit(salt)), blocks(n)).cast("int")
    numbers = lambda n: F.explode(F.sequence(F.lit(0), blocks(n) - 1))
    columns = ["bucket", "i", "j", "left", "id", "root", "set"]
    left = own.where("odd").withColumn("left", F.lit(True)).withColumn("i", spread("odd_w", 1)).withColumn("j", numbers("all_w"))
    right = own.withColumn("left", F.lit(False)).withColumn("i", numbers("odd_w")).withColumn("j", spread("all_w", 2))
    units = left.select(columns).unionByName(right.select(columns))
    kind = classes.schema["id"].dataType.simpleString()

    def compare(rows: pa.Table) -> pa.Table:
        is_left = rows["left"].to_numpy()
        ids, roots = rows["id"].to_pylist(), rows["root"].to_pylist()
        sets = [np.sort(v.values.to_numpy()) for v in rows["set"]]
        a, b = np.flatnonzero(is_left), np.flatnonzero(~is_left)
        kinds = [rows.schema.field("id").type] * 2
        out: list[tuple] = []
        if len(a) and len(b):
            code = {r: i for i, r in enumerate(dict.fromkeys(roots))}
            codes = np.array([code[r] for r in roots])
            sizes = np.array([len(sets[i]) for i in b])
            values, owner = np.concatenate([sets[i] for i in b]), np.repeat(np.arange(len(b)), sizes)
            order = np.argsort(values, kind="stable")
            values, owner = values[order], owner[order]
            for i in a:
                low, high = np.searchsorted(values, sets[i], "left"), np.searchsorted(values, sets[i], "right")
                n = high - low
                at = np.repeat(low - np.cumsum(n) + n, n) + np.arange(n.sum())
                common = np.bincount(owner[at], minlength=len(b))
                alike = 100 * common >= percent * (len(sets[i]) + sizes - common)
                for j in b[alike & (codes[b] != codes[i])]:
                    if codes[i] != codes[j]:
                        out.append((max(ids[i], ids[j]), min(ids[i], ids[j])))
                        codes[codes == codes[j]] = codes[i]
        return pa.table([pa.array([p[s] for p in out], kinds[s]) for s in (0, 1)], names=["a", "b"])

    return units.groupBy("bucket", "i", "j").applyInArrow(compare, f"a {kind}, b {kind}").distinct()


def components(links: DataFrame) -> DataFrame:
    """(id, component) of the ids in ``links`` (a, b with a > b) that reach a smaller one; the component is the smallest."""

    def lowest(edges: DataFrame) -> DataFrame:
        return edges.join(edges.groupBy("node").agg(F.min("near").alias("low")), "node")

    def state(edges: DataFrame):
        return edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("node", "near").cast("decimal(20,0)"))).first()

    def edge(node: str, near: str):
        return F.col(node).alias("node"), F.col(near).alias("near")

    edges = cut_lineage(links.where("a > b").select(*edge("a", "b")).distinct())
    seen = state(edges)
    while True:
        # Every neighbour above its centre points to the centre's lowest, and then what a node points to points to the lowest of these.
        large = lowest(edges.unionByName(edges.select(*edge("near", "node")))).where("near > node")
        small = lowest(large.select(F.col("near").alias("node"), F.least("node", "low").alias("near")).distinct())
        edges = cut_lineage(small.select(*edge("node", "low")).unionByName(small.where("near != low").select(*edge("near", "low"))).distinct())
        now = state(edges)
        if now == seen:
            return edges.groupBy(F.col("node").alias("id")).agg(F.min("near").alias("component"))
        seen = now


def _between(pairs: DataFrame, reached: DataFrame) -> DataFrame:
    """Pairs whose ends are in different components, with these as x and y."""
    side = lambda n, root: reached.select(F.col("id").alias(n), F.col("component").alias(root))
    return (
        pairs.join(side("a", "x"), "a", "left").join(side("b", "y"), "b", "left")
        .select("a", "b", F.coalesce("x", "a").alias("x"), F.coalesce("y", "b").alias("y")).where("x != y"))


def _extended(reached: DataFrame, links: DataFrame) -> DataFrame:
    """The components after more links: only components are joined, not their members."""
    higher = components(_between(links, reached).select(F.greatest("x", "y").alias("a"), F.least("x", "y").alias("b"))).select(
        F.col("id").alias("component"), F.col("component").alias("higher"))
    new = links.select(F.explode(F.array("a", "b")).alias("id")).distinct().join(reached, "id", "left_anti").withColumn("component", F.col("id"))
    return cut_lineage(reached.unionByName(new).join(higher, "component", "left").select("id", F.coalesce("higher", "component").alias("component")))


def near_duplicates(docs: DataFrame, key: str = "doc_id", text: str = "text", words: int = 5, percent: int = 75,
                    bands: int = 32, rows: int = 4) -> DataFrame:
    """(key, n_shingles, component_id, kept) for every row.

    Texts are linked when 100 * intersection >= ``percent`` * union. Null, empty and blank texts have no shingle, link
    with nothing and are kept. A row with a null key is never linked: its component is null and it is kept. Repeated
    rows fall into one component and are all kept if theirs is its smallest key. Other columns are not read.
    """
    bins = bands * rows
    if bins != 128:
        raise ValueError("bands * rows must be 128")
    least = max(0.0, percent / 100 - 0.2)
    made = cut_lineage(_sketches(docs, key, text, words, bands, rows, bins))
    linked = made.where(F.col("digest").isNotNull() & F.col(key).isNotNull())
    first = linked.groupBy("digest").agg(F.min(key).alias("id"))
    alike = first.select("digest", F.col("id").alias(key))
    classes = linked.join(alike, ["digest", key]).select(F.col(key).alias("id"), "digest", "n_shingles", "bands", "marks").dropDuplicates(["id", "digest"])
    classes = cut_lineage(classes)
    entries = classes.select("id", F.explode("bands").alias("bucket"))
    starts = entries.groupBy("bucket").agg(F.count(F.lit(1)).alias("m"), F.min("id").alias("b")).where("m > 1")
    several = cut_lineage(entries.join(starts, "bucket").select("bucket", "id", "m", "b"))
    star = cut_lineage(several.where("id != b").select(F.col("id").alias("a"), "b").distinct())
    confirm = lambda pairs: cut_lineage(_confirmed(pairs, docs, key, text, words, percent))
    lowest = star.groupBy("a").agg(F.min("b").alias("b"))
    reached = cut_lineage(components(confirm(cut_lineage(_promising(lowest, classes, percent, least)))))
    pairs = cut_lineage(_promising(_between(star.join(lowest, ["a", "b"], "left_anti"), reached).select("a", "b"), classes, percent, least))
    if not pairs.isEmpty():
        reached = _extended(reached, confirm(pairs))
    more = cut_lineage(_beside(several.where("m > 2").select("bucket", "id"), classes, reached, docs, key, text, words, percent))
    if not more.isEmpty():
        reached = _extended(reached, more)
    whole = first.join(reached, "id", "left").select("digest", F.coalesce("component", "id").alias("component_id"))
    return made.select(key, "n_shingles", F.when(F.col(key).isNotNull(), F.col("digest")).alias("digest")).join(
        whole, "digest", "left").select(
        key, "n_shingles", F.coalesce("component_id", key).alias("component_id"),
        F.coalesce(F.col(key) == F.coalesce("component_id", key), F.lit(True)).alias("kept"))


def drop_near_duplicates(docs: DataFrame, key: str = "doc_id", text: str = "text", words: int = 5, percent: int = 75) -> DataFrame:
    """The rows, with all their columns, of one document of each component, the one of the smallest key.

    Of rows that repeat a key one stays (that of the smallest text); rows with a null key all stay. Columns named
    ``__key``, ``__one`` and ``__place`` are reserved.
    """
    found = near_duplicates(docs, key, text, words, percent).where(F.col(key).isNotNull())
    stays = found.groupBy(F.col(key).alias("__key")).agg(F.bool_or("kept").alias("__one")).where("__one").select("__key")
    place = F.row_number().over(Window.partitionBy("__key").orderBy(text))
    named = docs.where(F.col(key).isNotNull())
    one = named.join(stays, named[key] == stays["__key"]).withColumn("__place", place).where("__place = 1")
    return one.select(*docs.columns).unionAll(docs.where(F.col(key).isNull()))
