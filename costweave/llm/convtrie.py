"""A prefix trie of conversations by truncation peeling.

A conversation is the sequence of its turns (role, text) in order of ``turn`` (null first, then role and text, so
that equal turn numbers have a defined order); a null role or text is empty. A depth-d node is a distinct sequence
of first d turns, the root (d = 0) the empty one; a conversation is a member of every node that it starts with, and
a node's subtree includes the node itself.

Peeling: every conversation is cut back turn by turn, from its full length down to the empty prefix, and every cut
is regrouped by the identity of what is left. Grouping the cuts of depth d merges the conversations that end at d
with the longer ones whose peeled remainder survives there, and discovers and counts each node in the same pass:
members, the smallest member (the node's ``conv_id``), the parent (what is left after stripping one more turn) and
the conversations ending there. All depths are peeled together in one grouping, so the number of jobs does not grow
with the length of the longest conversation.

Prefix identity: turn i of a conversation has four 30-bit hashes of (i, role, text); a prefix is named by the four
running sums, computed by a running window per conversation. Two different prefixes of one length share a name with
a probability of about 2^-120; no text is shuffled after the turns are hashed.

Sums over a subtree (childless nodes, saved bytes) need no walk down the tree: each node's own value is booked on
the row of its smallest member at its depth, and a member's suffix sums from depth d down hold exactly the values of
the nodes below d that it is the smallest member of. Summing these suffixes over a node's members gives its subtree.

``ends_sha256`` hashes the decimal ids of the conversations that end at a node, ascending, joined by commas. They are
streamed in sorted order through one running SHA-256 per node, so a node's list is never held in memory.

Defined results: rows with a null conversation id take no part; repeated rows are repeated turns; a conversation of
no turns is a member of the root only; texts of any length are hashed whole; an empty table gives no node.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from costweave.session import cut_lineage

KEY = ["k1", "k2", "k3", "k4"]
PARENT = ["p1", "p2", "p3", "p4"]
EMPTY_SHA = hashlib.sha256(b"").hexdigest()


def _part(i: int, position: Column) -> Column:
    """Hash ``i`` of a turn at a position, 30 bits, non-negative."""
    return F.shiftrightunsigned(F.xxhash64(F.lit(i), position, F.col("t1"), F.col("t2")), 34)


def ordered_turns(conversations: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role",
                  text: str = "text") -> DataFrame:
    """(c, pos, t1, t2, bytes): each turn's 0-based position, its content hash and the UTF-8 bytes of its text."""
    rows = conversations.where(F.col(conv).isNotNull()).select(
        F.col(conv).cast("long").alias("c"), F.col(turn).cast("long").alias("t"),
        F.coalesce(F.col(role).cast("string"), F.lit("")).alias("r"), F.coalesce(F.col(text).cast("string"), F.lit("")).alias("x"))
    order = Window.partitionBy("c").orderBy(F.col("t").asc_nulls_first(), "r", "x")
    return rows.select("c", (F.row_number().over(order) - 1).cast("long").alias("pos"),
                       F.xxhash64("r", "x").alias("t1"), F.xxhash64(F.lit(-1), "r", "x").alias("t2"),
                       F.octet_length("x").cast("long").alias("bytes"))


def rebuilt(turns: DataFrame, splice) -> DataFrame:
    """Turns of every conversation after ``splice(c) -> (base, h)``: the base's first h turns, then c's own after its h.

    ``turns`` is (c, pos, t1, t2, bytes); the result has the same columns and a length ``len`` per conversation.
    """
    lens = turns.groupBy("c").agg(F.count(F.lit(1)).alias("own"))
    base, h = splice(F.col("c"))
    convs = lens.select("c", "own", base.alias("b"), h.alias("h"))
    convs = convs.join(lens.select(F.col("c").alias("b"), F.col("own").alias("base_len")), "b", "left").select(
        "c", "b", "h", "own", F.least("h", F.coalesce("base_len", F.lit(0))).alias("taken"))
    convs = convs.withColumn("len", F.col("taken") + F.greatest(F.col("own") - F.col("h"), F.lit(0)))
    head = convs.select("c", "b", "h", "len").join(
        turns.select(F.col("c").alias("b"), "pos", "t1", "t2", "bytes"), "b").where("pos < h").select(
        "c", "pos", "t1", "t2", "bytes", "len")
    tail = turns.join(convs.select("c", "h", "taken", "len"), "c").where("pos >= h").select(
        "c", (F.col("pos") - F.col("h") + F.col("taken")).alias("pos"), "t1", "t2", "bytes", "len")
    return head.unionByName(tail), convs.select("c", "len")


def prefix_tree(conversations: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role",
                text: str = "text", splice=None) -> DataFrame:
    """(conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256) of every node.

    ``splice`` maps a conversation id to (base id, number of the base's turns that replace its own first ones);
    without it every conversation stands as it is.
    """
    turns = ordered_turns(conversations, conv, turn, role, text)
    splice = splice or (lambda c: (c, F.lit(0)))
    spliced, convs = rebuilt(turns, splice)
    spliced = cut_lineage(spliced)
    convs = cut_lineage(convs)
    running = Window.partitionBy("c").orderBy("pos").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    hashed = spliced.select("c", "pos", "bytes", "len", *(_part(i, F.col("pos")).alias(f"h{i}") for i in range(1, 5)))
    summed = hashed.select("c", "pos", "bytes", "len", *(F.col(f"h{i}") for i in range(1, 5)),
                           *(F.sum(f"h{i}").over(running).alias(f"k{i}") for i in range(1, 5)))
    deep = summed.select("c", (F.col("pos") + 1).alias("d"), "len", "bytes", *KEY,
                         *((F.col(f"k{i}") - F.col(f"h{i}")).alias(f"p{i}") for i in range(1, 5)))
    root = convs.select("c", F.lit(0).cast("long").alias("d"), "len", F.lit(0).cast("long").alias("bytes"),
                        *(F.lit(0).cast("long").alias(k) for k in KEY), *(F.lit(None).cast("long").alias(p) for p in PARENT))
    cuts = cut_lineage(deep.unionByName(root))

    nodes = cuts.groupBy("d", *KEY).agg(
        F.count(F.lit(1)).alias("n_convs"), F.min("c").alias("conv_id"), F.first("bytes").alias("bytes"),
        *(F.first(p).alias(p) for p in PARENT))
    children = nodes.where("d > 0").groupBy((F.col("d") - 1).alias("d"), *(F.col(p).alias(k) for p, k in zip(PARENT, KEY))).agg(
        F.count(F.lit(1)).alias("n_children"))
    nodes = cut_lineage(nodes.join(children, ["d", *KEY], "left").withColumn("n_children", F.coalesce("n_children", F.lit(0)))
                        .withColumn("own_saved", (F.col("n_convs") - 1) * F.col("bytes"))
                        .withColumn("own_leaf", (F.col("n_children") == 0).cast("long")))

    # Each node's own values stand on the row of its smallest member; suffix sums carry them up that member's path.
    booked = cuts.select("c", "d", *KEY).join(
        nodes.select(F.col("conv_id").alias("c"), "d", "own_saved", "own_leaf"), ["c", "d"], "left")
    below = Window.partitionBy("c").orderBy(F.col("d").desc()).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    suffix = booked.select("d", *KEY, F.sum(F.coalesce("own_saved", F.lit(0))).over(below).alias("saved"),
                           F.sum(F.coalesce("own_leaf", F.lit(0))).over(below).alias("leaves"))
    subtree = suffix.groupBy("d", *KEY).agg(F.sum("saved").alias("saved_tokens"), F.sum("leaves").alias("n_leaves"))

    parents = nodes.select((F.col("d") + 1).alias("d"), *(F.col(k).alias(p) for k, p in zip(KEY, PARENT)),
                           F.col("conv_id").alias("parent_conv_id"))
    ends = ended_hashes(cuts.where("d = len").select("d", *KEY, "c"))
    return (nodes.join(subtree, ["d", *KEY]).join(parents, ["d", *PARENT], "left").join(ends, ["d", *KEY], "left")
            .select("conv_id", F.col("d").alias("depth"), "parent_conv_id", F.col("n_convs").cast("long"),
                    F.col("n_children").cast("long"), F.col("n_leaves").cast("long"), F.col("saved_tokens").cast("long"),
                    F.coalesce("ends_sha256", F.lit(EMPTY_SHA)).alias("ends_sha256")))


def ended_hashes(ended: DataFrame) -> DataFrame:
    """(d, k1..k4, ends_sha256) from (d, k1..k4, c): ids streamed in ascending order through one hash per node."""
    names = ["d", *KEY]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, digest, first = None, None, True
        for batch in batches:
            keys = list(zip(*(batch.column(n).to_pylist() for n in names), strict=True))
            ids = batch.column("c").to_pylist()
            out_keys, out_sha = [], []
            for key, c in zip(keys, ids, strict=True):
                if key != current:
                    if current is not None:
                        out_keys.append(current)
                        out_sha.append(digest.hexdigest())
                    current, digest, first = key, hashlib.sha256(), True
                digest.update((b"" if first else b",") + str(c).encode())
                first = False
            if out_keys:
                yield _rows(out_keys, out_sha, names)
        if current is not None:
            yield _rows([current], [digest.hexdigest()], names)

    schema = "d long, k1 long, k2 long, k3 long, k4 long, ends_sha256 string"
    return ended.repartition(*names).sortWithinPartitions(*names, "c").mapInArrow(run, schema)


def _rows(keys: list[tuple], shas: list[str], names: list[str]) -> pa.RecordBatch:
    columns = [pa.array([k[i] for k in keys], pa.int64()) for i in range(len(names))]
    return pa.RecordBatch.from_arrays([*columns, pa.array(shas, pa.string())], names=[*names, "ends_sha256"])


def grouped_splice(group: int = 5, most: int = 9):
    """Conversation c takes the first crc32(decimal c) % ``most`` turns of conversation c - c % ``group``."""
    def splice(c: Column) -> tuple[Column, Column]:
        return c - c % F.lit(group), (F.crc32(c.cast("string").cast("binary")) % F.lit(most)).cast("long")
    return splice
