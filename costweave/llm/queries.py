"""One query per operator over its whole table, with SQL where SQL can state the result."""

from __future__ import annotations

import functools
from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from costweave.llm import (convtrie, jaccard_join, langid, lexical, minhash, mtree, packing, rpforest, segmentations,
                           token_counts, toxicity, warc, wrappers)
from costweave.llm.tables import remainder, small_batches, table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}
WORD_VOCABULARY, PIECE_VOCABULARY = "word_bpe_49k.json", "piece_bpe_32k.model"


def query(name: str, sql: str | None = None):
    def register(fn):
        @functools.wraps(fn)
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            small_batches(spark)
            return fn(spark, sf_dir)

        QUERIES[name] = run
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return register


@query("op1_toxicity")
def toxicity_of_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    held_out = remainder(F.col("doc_id"), 3) == 1
    labels = table(spark, sf_dir, "labels").where(~held_out)
    scored = toxicity.toxicity_scores(table(spark, sf_dir, "documents"), labels)
    return scored.select("doc_id", F.coalesce(held_out, F.lit(False)).alias("held_out"), "score", "predicted")


@query("op2_packing")
def packed_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(table(spark, sf_dir, "documents"), public_tokenizers.path(WORD_VOCABULARY))


@query("op3_warc", """
WITH p AS (SELECT page_id, COALESCE(html, '') AS h FROM pages),
d AS (SELECT page_id, strlen(h)::BIGINT AS n, sha1(h) AS s, max(page_id) OVER (PARTITION BY h) AS m FROM p)
SELECT page_id, n AS payload_bytes,
  array_to_string([substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
    1 + ((CAST('0x' || substr(s, (5 * i) // 4 + 1, 2) AS INTEGER) >> (3 - (5 * i) % 4)::INTEGER) & 31), 1) FOR i IN range(0, 32)], '') AS payload_digest,
  CASE WHEN page_id = m THEN 'response' ELSE 'revisit' END AS record_type, CASE WHEN page_id <> m THEN m END AS refers_to
FROM d""")
def archived_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.round_trip(table(spark, sf_dir, "pages")).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


@query("op4_wrappers")
def main_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return wrappers.extract(table(spark, sf_dir, "pages"))


@query("op5_mtree", """
WITH v AS (
  SELECT vec_id, [CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT) FOR x IN embedding] AS e FROM embeddings
  WHERE embedding IS NOT NULL AND len([1 FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0),
s AS (
  SELECT q.vec_id AS query_id, c.vec_id, list_sum([q.e[i] * c.e[i] FOR i IN range(1, len(q.e) + 1)])::BIGINT AS score
  FROM v q JOIN v c ON c.vec_id <> q.vec_id WHERE q.vec_id % 50 = 0),
r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s)
SELECT query_id, rank::INTEGER AS rank, vec_id, score FROM r WHERE rank <= 5""")
def highest_inner_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mtree.top_k(table(spark, sf_dir, "embeddings"))


@query("op6_rpforest")
def nearest_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rpforest.nearest(table(spark, sf_dir, "embeddings"))


@query("op7_segmentations")
def sampled_segmentations(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path(PIECE_VOCABULARY)
    return segmentations.decode(segmentations.encode_samples(table(spark, sf_dir, "documents"), path, ["doc_id"]), path)


@query("op7_turn_segmentations")
def sampled_segmentations_of_turns(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path(PIECE_VOCABULARY)
    turns = table(spark, sf_dir, "conversations")
    return segmentations.decode(segmentations.encode_samples(turns, path, ["conv_id", "turn"]), path)


@query("op8_token_counts")
def tokens_of_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.count_tokens(table(spark, sf_dir, "documents"), public_tokenizers.path(PIECE_VOCABULARY))


@query("op9_minhash", r"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^\x20\x09-\x0D]+') AS ws FROM documents),
s AS (
  SELECT doc_id, list_distinct(CASE WHEN len(ws) = 0 THEN []
    WHEN len(ws) < 5 THEN [array_to_string(ws, ' ')]
    ELSE [array_to_string(ws[i:i + 4], ' ') FOR i IN range(1, len(ws) - 3)] END) AS ss FROM w),
n AS (SELECT doc_id, COALESCE(len(ss), 0) AS n FROM s),
e AS (SELECT doc_id, unnest(ss) AS sh FROM s),
p AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM e a JOIN e b ON a.sh = b.sh AND a.doc_id <> b.doc_id GROUP BY 1, 2),
l AS (SELECT a, b FROM p JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * c >= 75 * (x.n + y.n - c)),
r AS (SELECT doc_id AS id, doc_id AS c FROM documents UNION SELECT r.id, l.b FROM r JOIN l ON l.a = r.c),
m AS (SELECT id, min(c) AS c FROM r GROUP BY id)
SELECT n.doc_id, n.n::BIGINT AS n_shingles, m.c AS component_id, n.doc_id = m.c AS kept FROM n JOIN m ON m.id = n.doc_id""")
def near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_duplicates(table(spark, sf_dir, "documents"))


@query("op10_langid")
def languages_of_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    held_out = remainder(F.col("doc_id"), 4) == 2
    network = langid.fit(docs.where(~held_out))
    return langid.identify(docs, network).select("doc_id", F.coalesce(held_out, F.lit(False)).alias("held_out"), "lang_pred", "score")


@query("op11_lexical", r"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id,
    regexp_extract_all(translate(COALESCE(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                       '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS ts FROM documents),
n AS (SELECT r, doc_id, len(ts)::BIGINT AS n FROM d WHERE len(ts) > 0),
g AS (SELECT count(*)::BIGINT AS nn, sum(n)::BIGINT AS ll FROM n),
o AS (SELECT r, unnest(ts) AS t FROM d),
tf AS (SELECT r, t, count(*)::BIGINT AS tf FROM o GROUP BY r, t),
df AS (SELECT t, count(*)::BIGINT AS df FROM tf GROUP BY t),
qt AS (SELECT item_id, unnest(regexp_extract_all(translate(COALESCE(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
          'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS t FROM benchmark),
q AS (SELECT DISTINCT item_id, t FROM qt),
s AS (
  SELECT q.item_id, n.doc_id, n.r, sum(
    CAST(floor(1000 * ln((2 * g.nn + 2)::DOUBLE / (2 * df.df + 1)::DOUBLE)) AS BIGINT)
    * ((1000000000 * tf.tf) // (1000 * tf.tf + 8 * (10 + (90 * n.n * g.nn) // g.ll)))) AS score
  FROM q JOIN tf ON tf.t = q.t JOIN df ON df.t = q.t JOIN n ON n.r = tf.r CROSS JOIN g
  GROUP BY q.item_id, n.doc_id, n.r),
k AS (SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id NULLS LAST, r) AS rank FROM s WHERE score > 0)
SELECT item_id, rank::INTEGER AS rank, doc_id, score::BIGINT AS score FROM k WHERE rank <= 10""")
def ranked_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexical.rank_documents(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query("op12_conversation_trie", r"""
WITH RECURSIVE t AS (
  SELECT conv_id AS c, COALESCE(role, '') AS r, COALESCE(text, '') AS x,
    row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, COALESCE(role, ''), COALESCE(text, '')) - 1 AS p
  FROM conversations WHERE conv_id IS NOT NULL),
ids AS (SELECT DISTINCT c, CAST(c AS VARCHAR) AS s FROM t),
crc(c, s, j, v) AS (
  SELECT c, s, 0, 4294967295::BIGINT FROM ids
  UNION ALL
  SELECT c, s, j + 1, xor(u >> 1, CASE WHEN u & 1 = 1 THEN 3988292384 ELSE 0 END) FROM (
    SELECT c, s, j, CASE WHEN j % 8 = 0 THEN xor(v, ascii(substr(s, j // 8 + 1, 1))) ELSE v END AS u
    FROM crc WHERE j < 8 * strlen(s))),
cv AS (SELECT c, c - c % 5 AS b, xor(v, 4294967295) % 9 AS h FROM crc WHERE j = 8 * strlen(s)),
bl AS (SELECT c, count(*) AS n FROM t GROUP BY c),
rb AS (
  SELECT cv.c, t.p AS pos, t.r, t.x FROM cv JOIN t ON t.c = cv.b AND t.p < cv.h
  UNION ALL
  SELECT cv.c, t.p - cv.h + least(cv.h, COALESCE(bl.n, 0)) AS pos, t.r, t.x
  FROM cv JOIN t ON t.c = cv.c AND t.p >= cv.h LEFT JOIN bl ON bl.c = cv.b),
seqs AS (
  SELECT cv.c, COALESCE(list({'r': rb.r, 'x': rb.x} ORDER BY rb.pos) FILTER (WHERE rb.pos IS NOT NULL),
                        []::STRUCT(r VARCHAR, x VARCHAR)[]) AS ts
  FROM cv LEFT JOIN rb ON rb.c = cv.c GROUP BY cv.c),
cuts0 AS (SELECT c, ts, unnest(range(0, len(ts) + 1)) AS d FROM seqs),
cuts AS (SELECT c, d, ts[1:d] AS pre, len(ts) AS n FROM cuts0),
nodes AS (SELECT d, pre, count(*) AS n_convs, min(c) AS conv_id,
  CASE WHEN d = 0 THEN 0 ELSE strlen(pre[d].x) END AS bytes FROM cuts GROUP BY d, pre),
ch AS (SELECT d - 1 AS d, pre[1:d - 1] AS pre, count(*) AS k FROM nodes WHERE d > 0 GROUP BY 1, 2),
full_nodes AS (SELECT nodes.*, COALESCE(ch.k, 0) AS n_children FROM nodes LEFT JOIN ch ON ch.d = nodes.d AND ch.pre = nodes.pre),
sub AS (
  SELECT a.d, a.pre, sum((b.n_convs - 1) * b.bytes) AS saved, sum(CASE WHEN b.n_children = 0 THEN 1 ELSE 0 END) AS leaves
  FROM full_nodes a JOIN full_nodes b ON b.d >= a.d AND b.pre[1:a.d] = a.pre GROUP BY a.d, a.pre),
ends AS (SELECT d, pre, sha256(string_agg(CAST(c AS VARCHAR), ',' ORDER BY c)) AS e FROM cuts WHERE d = n GROUP BY d, pre)
SELECT a.conv_id, a.d::BIGINT AS depth, p.conv_id AS parent_conv_id, a.n_convs::BIGINT AS n_convs,
  a.n_children::BIGINT AS n_children, sub.leaves::BIGINT AS n_leaves, sub.saved::BIGINT AS saved_tokens,
  COALESCE(ends.e, sha256('')) AS ends_sha256
FROM full_nodes a JOIN sub ON sub.d = a.d AND sub.pre = a.pre
LEFT JOIN full_nodes p ON p.d = a.d - 1 AND p.pre = a.pre[1:a.d - 1] AND a.d > 0
LEFT JOIN ends ON ends.d = a.d AND ends.pre = a.pre""")
def conversation_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return convtrie.prefix_tree(table(spark, sf_dir, "conversations"), splice=convtrie.grouped_splice())


@query("op13_jaccard_join", r"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(COALESCE(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^\x20\x09-\x0D]+') AS ws FROM documents),
s AS (
  SELECT doc_id, list_distinct(CASE WHEN len(ws) = 0 THEN []
    WHEN len(ws) < 4 THEN [array_to_string(ws, ' ')]
    ELSE [array_to_string(ws[i:i + 3], ' ') FOR i IN range(1, len(ws) - 2)] END) AS ss FROM w),
n AS (SELECT doc_id, COALESCE(len(ss), 0) AS n FROM s),
e AS (SELECT doc_id, unnest(ss) AS sh FROM s WHERE doc_id IS NOT NULL),
p AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM e a JOIN e b ON a.sh = b.sh AND a.doc_id <> b.doc_id GROUP BY 1, 2),
l AS (SELECT a, b FROM p JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * c >= 85 * (x.n + y.n - c)),
r AS (SELECT doc_id AS id, doc_id AS c FROM documents WHERE doc_id IS NOT NULL UNION SELECT r.id, l.b FROM r JOIN l ON l.a = r.c),
m AS (SELECT id, min(c) AS c FROM r GROUP BY id)
SELECT n.doc_id, n.n::BIGINT AS n_shingles, m.c AS component_id FROM n LEFT JOIN m ON m.id = n.doc_id""")
def jaccard_linked(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.jaccard_components(table(spark, sf_dir, "documents"))
