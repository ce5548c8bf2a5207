"""Ranked lexical search by per-term geometric blocking.

Index, over every row of the corpus:

* A row's terms are the maximal runs of characters outside ASCII punctuation, blanks and controls (``TERM``), with
  A-Z lower-cased; a null text has none. ``n`` counts a row's terms with repeats, ``N`` the rows with a term, ``L``
  all terms of all rows, ``df`` the rows holding a term and ``tf`` its occurrences in a row.
* One pass over the texts, inside the tasks that read them, counts each row's terms and writes the postings
  (term, row, tf, n) with terms named by 64-bit hashes; each batch also writes its share of N and L, so no shuffle
  and no second reading of the texts is needed. A posting's impact is the integer contribution of the term to the
  row's score (w times g, see :func:`_part`), so a row's score for a query is the sum of its impacts over the query's
  distinct terms.
* Rows are clustered by similarity: the cluster of a row is its min-wise hash (the smallest term hash, equal for two
  rows with the probability of their Jaccard similarity) folded onto ``ceil(N / rows_per_block)`` clusters. The
  posting list of every term is cut into blocks, one per cluster, and each cluster keeps the coordinatewise maximum
  of its rows' impact vectors (one entry per term present in the cluster). The summary of a block (t, c) is that of
  its cluster: it bounds every row of the block, at one entry per (cluster, term) instead of one per (block, term).

Search, for a batch of queries at once:

1. A query's bound on a cluster is the sum of the cluster's summary over the query's terms; it is at least the score
   of every row in that cluster.
2. The ``probe`` clusters of largest bound are scored exactly; the ``k``-th best score found there (1 if fewer
   than ``k`` rows score) is a threshold that the final ``k``-th score can only exceed.
3. A block is skipped only when its exact bound is below that threshold. In the other blocks rows are found through
   the essential terms only (those that the threshold cannot do without, as in max-score evaluation), then scored
   exactly on all the query's terms, and the ``k`` best kept, equal scores by ascending id, then by row. Nothing is
   approximate.

Defined results: a null or empty text has no term and never ranks; a null or empty query ranks nothing; queries
sharing an id are one query whose terms are the union, a null id included; rows sharing a doc_id are separate
documents; very long texts are indexed whole; an empty corpus or an empty query table gives no rows; only rows with score above 0 are
returned. Reserved names do not matter: the operator selects the columns it is given by name and renames them.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from costweave.session import cut_lineage

# Fixed values that decide results: the term pattern and the case folding.
TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
# End of fixed values.
TERM_RE, FOLD = re.compile(TERM), str.maketrans(UPPER, LOWER)

#: Rows a cluster holds on average; the number of clusters grows with the corpus.
ROWS_PER_BLOCK = 512
#: Clusters of largest bound scored first to find each query's threshold.
PROBE = 8
#: Distinct query terms, and (query, term) pairs, that may be sent to every task.
BROADCAST_TERMS = 1 << 20
#: (query, cluster, term) rows of the blocks to score that may be sent to every task.
BROADCAST_BLOCKS = 1 << 21


def terms_of(text: str | None) -> list[str]:
    """The terms of a text, A-Z lower-cased; none for null."""
    return TERM_RE.findall(text.translate(FOLD)) if text else []


def term_hash(term: str) -> int:
    """A term's 64-bit name, signed; two different terms share one with a probability of 2^-64."""
    return xxhash.xxh3_64_intdigest(term.encode("utf-8", "surrogatepass")) - (1 << 63)


def _part(n_rows: int, n_terms: int) -> Column:
    """g = (10^9 tf) div (1000 tf + 8 m) with m = 10 + (90 n N) div L, in 64-bit integers; the impact is w * g."""
    m = f"(10L + (90L * n * {n_rows}L) div {max(n_terms, 1)}L)"
    return F.expr(f"(1000000000L * tf) div (1000L * tf + 8L * {m})")


def _weight(n_rows: int) -> Column:
    return F.floor(F.lit(1000.0) * F.log(F.lit(2.0 * n_rows + 2.0) / (F.lit(2.0) * F.col("df") + 1))).cast("long")


class Index:
    """Postings (term, mh, row, doc_id, tf, n), written once, and the summaries (cluster, term, most) of the clusters:
    ``most`` is the largest length-normalised part g of the term's impact in the cluster, so the coordinatewise
    maximum of the impacts is ``w(term) * most`` (w does not depend on the row)."""

    def __init__(self, postings: DataFrame, summaries: DataFrame, n_rows: int, n_terms: int, clusters: int):
        self.postings, self.summaries = postings, summaries
        self.n_rows, self.n_terms, self.clusters = n_rows, n_terms, clusters

    def cluster(self) -> Column:
        return F.pmod(F.col("mh"), F.lit(self.clusters))


def _postings(rows: DataFrame) -> DataFrame:
    """(term, mh, row, doc_id, tf, n) of every row with a term, and one row per batch with null term: its N and L."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cols = {n: [] for n in ("term", "mh", "row", "doc_id", "tf", "n")}
            with_terms = all_terms = 0
            named: dict[str, int] = {}
            for row, doc, text in zip(*(batch.column(i).to_pylist() for i in range(3)), strict=True):
                found = terms_of(text)
                if not found:
                    continue
                counts = Counter(found)
                hashes = [named.get(t) or named.setdefault(t, term_hash(t)) for t in counts]
                with_terms, all_terms = with_terms + 1, all_terms + len(found)
                cols["term"] += hashes
                cols["tf"] += counts.values()
                cols["mh"] += [min(hashes)] * len(hashes)
                cols["row"] += [row] * len(hashes)
                cols["doc_id"] += [doc] * len(hashes)
                cols["n"] += [len(found)] * len(hashes)
            for name, value in (("term", None), ("mh", None), ("row", None), ("doc_id", None), ("tf", all_terms), ("n", with_terms)):
                cols[name].append(value)
            yield pa.RecordBatch.from_arrays([pa.array(cols[n], pa.int64()) for n in cols], names=list(cols))

    return rows.mapInArrow(run, "term long, mh long, row long, doc_id long, tf long, n long")


def build_index(docs: DataFrame, key: str = "doc_id", text: str = "text", rows_per_block: int = ROWS_PER_BLOCK) -> Index:
    """Index every row of ``docs``: one pass over the texts writes the postings, one aggregation the summaries."""
    rows = docs.select(F.monotonically_increasing_id().alias("row"), F.col(key).cast("long").alias("doc_id"),
                       F.col(text).cast("string").alias("text"))
    written = cut_lineage(_postings(rows))
    got = written.where("term IS NULL").agg(F.sum("n").alias("rows"), F.sum("tf").alias("terms")).first()
    n_rows, n_terms = int(got["rows"] or 0), int(got["terms"] or 0)
    clusters = max(1, -(-n_rows // rows_per_block))
    postings = written.where("term IS NOT NULL")
    index = Index(postings, None, n_rows, n_terms, clusters)
    # The largest g of each term in each cluster; partial maxima are taken in every task before the shuffle.
    index.summaries = cut_lineage(postings.groupBy(index.cluster().alias("cluster"), "term").agg(
        F.max(_part(n_rows, n_terms)).alias("most")))
    return index


def _query_terms(queries: DataFrame, key: str, text: str) -> DataFrame:
    """(item, term): the distinct terms of each query id."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            items, found = [], []
            for item, t in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                ts = {term_hash(x) for x in terms_of(t)}
                items += [item] * len(ts)
                found += ts
            yield pa.RecordBatch.from_arrays([pa.array(items, pa.int64()), pa.array(found, pa.int64())], names=["item", "term"])

    rows = queries.select(F.col(key).cast("long").alias("item"), F.col(text).cast("string").alias("text"))
    return rows.mapInArrow(run, "item long, term long").distinct()


def _top(scored: DataFrame, group: str, k: int, by: list[Column], spread: str | None = None) -> DataFrame:
    """The ``k`` first rows of each group in order ``by``; with ``spread``, first within (group, spread % 256)."""
    if spread is not None:
        part = Window.partitionBy(group, F.pmod(F.col(spread), F.lit(256))).orderBy(*by)
        scored = scored.withColumn("__r", F.row_number().over(part)).where(F.col("__r") <= k).drop("__r")
    return scored.withColumn("__r", F.row_number().over(Window.partitionBy(group).orderBy(*by))).where(F.col("__r") <= k)


def search(index: Index, queries: DataFrame, key: str = "item_id", text: str = "text", k: int = 10,
           probe: int = PROBE) -> DataFrame:
    """(item_id, rank, doc_id, score) of the ``k`` best rows of every query, exactly; see the module text."""
    terms = cut_lineage(_query_terms(queries, key, text))
    # Query ids, a null one included, are numbered once so that every later join is on a non-null key.
    named = cut_lineage(terms.select("item").distinct().withColumn("qi", F.monotonically_increasing_id()))
    q = terms.join(named, terms["item"].eqNullSafe(named["item"])).select(F.col("qi").alias("item"), "term")
    # Postings of the queried terms only: the distinct terms of a batch of queries are few, and their count is checked
    # before they are sent to every task; beyond the bound they meet the postings by a shuffle.
    asked = q.select("term").distinct()
    asked = _small(asked, BROADCAST_TERMS)
    hit = cut_lineage(index.postings.join(asked, "term").select(
        "term", index.cluster().alias("cluster"), "row", "doc_id", _part(index.n_rows, index.n_terms).alias("g")))
    weights = hit.groupBy("term").agg(F.count(F.lit(1)).alias("df")).select("term", _weight(index.n_rows).alias("w"))
    # A term in nearly every row weighs 0 and adds nothing to any score.
    q = cut_lineage(q.join(weights, "term").where("w > 0"))
    # Each query term's bound in each cluster; the summaries stay where they are written when the query terms are few.
    blocks = cut_lineage(index.summaries.join(_small(q, BROADCAST_TERMS), "term").select(
        "item", "cluster", "term", "w", (F.col("w") * F.col("most")).alias("most")))
    bounds = cut_lineage(blocks.groupBy("item", "cluster").agg(F.sum("most").alias("bound")).where("bound > 0"))

    def same_item(left: DataFrame, right: DataFrame, how: str = "inner") -> DataFrame:
        return left.join(right, "item", how)

    def scores(chosen: DataFrame) -> DataFrame:
        """Exact scores of the rows of the chosen (item, cluster) blocks.

        With a threshold, a row is found only through an essential term of its block: the terms of a block, taken
        from the smallest bound up, are inessential while their bounds add up to less than the threshold, so a row
        holding none but these scores below it and cannot be among the best. The full score of each row found is
        then summed over all the query's terms.
        """
        wanted = blocks.join(chosen, ["item", "cluster"])
        if "threshold" in chosen.columns:
            up = Window.partitionBy("item", "cluster").orderBy("most", "term").rowsBetween(
                Window.unboundedPreceding, Window.currentRow)
            wanted = wanted.withColumn("essential", F.sum("most").over(up) >= F.col("threshold"))
        else:
            wanted = wanted.withColumn("essential", F.lit(True))
        wanted = cut_lineage(wanted.select("item", "cluster", "term", "w", "essential"))
        # One pass over the postings of the queried terms: a row counts if one of its terms is essential.
        hits = hit.join(_small(wanted, BROADCAST_BLOCKS), ["term", "cluster"])
        scored = hits.groupBy("item", "cluster", "row", "doc_id").agg(
            F.sum(F.col("w") * F.col("g")).alias("score"), F.max(F.col("essential").cast("int")).alias("found"))
        return scored.where("found = 1 AND score > 0").drop("found")

    order = [F.col("score").desc(), F.col("doc_id").asc_nulls_last(), F.col("row")]
    first = _top(bounds, "item", probe, [F.col("bound").desc(), F.col("cluster")], spread="cluster").select("item", "cluster")
    found = _top(scores(first), "item", k, order, spread="cluster")
    threshold = found.groupBy("item").agg(
        F.when(F.count(F.lit(1)) >= k, F.min("score")).otherwise(F.lit(1)).alias("threshold"))
    kept = same_item(bounds, threshold, "left").select(
        "item", "cluster", "bound", F.coalesce("threshold", F.lit(1)).alias("threshold")).where("bound >= threshold").drop("bound")
    best = _top(scores(kept), "item", k, order, spread="cluster")
    return best.join(named.select(F.col("qi").alias("item"), F.col("item").alias("item_id")), "item").select(
        "item_id", F.col("__r").cast("int").alias("rank"), "doc_id", F.col("score").cast("long").alias("score"))


def _small(df: DataFrame, rows: int) -> DataFrame:
    """``df`` marked for broadcast when its counted rows are at most ``rows``; otherwise it is joined by a shuffle."""
    return F.broadcast(df) if df.count() <= rows else df


def rank_documents(docs: DataFrame, queries: DataFrame, k: int = 10) -> DataFrame:
    """Index ``docs`` (doc_id, text) and rank them for every row of ``queries`` (item_id, text)."""
    return search(build_index(docs), queries, k=k)
