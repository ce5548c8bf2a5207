"""Queries for scans, sinks and the incremental job. Sinks write the whole tables to the shared folder."""

from __future__ import annotations

from pyspark.sql import functions as F

from costweave.functions.sizing import parts_for
from costweave.operators.search import hash_embedder, read_first
from costweave.plans.registry import query
from costweave.plans.views import WI, WI_TRACKS, s4, table, with_ctes, work_items, work_items_by_track, x4
from costweave.session import scratch_path
from costweave.sources import readers as R
from costweave.sources import writers as WR
from costweave.streaming import incremental


def cnt():
    return F.count(F.lit(1)).alias("n")



@query("s1_parquet_scan", """
SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, l_quantity, l_extendedprice, l_discount, l_tax, l_returnflag, l_linestatus,
       CAST(l_shipdate AS DATE) AS l_shipdate FROM lineitem""")
def scan(spark, sf):
    return R.read_items(spark, f"{sf}/lineitem.parquet").withColumn("l_shipdate", F.to_date("l_shipdate"))


@query("s2_pruned_scan", "SELECT doc_id, lang, source FROM documents")
def pruned(spark, sf):
    return R.read_items(spark, f"{sf}/documents.parquet", ["doc_id", "lang", "source", "no_such_column"])


@query("s3_boq_csv", """
SELECT p_name AS description, CASE WHEN p_size = 13 THEN NULL ELSE p_size + 0.5 END::DOUBLE AS quantity, p_brand AS unit, count(*) AS n FROM part GROUP BY 1, 2, 3""")
def boq_csv(spark, sf):
    path = scratch_path(spark, "boq")
    quantity = F.when(F.col("p_size") == 13, "n/a").otherwise(F.concat(F.lit(" "), F.col("p_size").cast("string"), F.lit(".5 ")))
    WR.write_csv(table(spark, sf, "part").select(
        F.concat(F.lit("  "), "p_name").alias("description"), quantity.alias("quantity"), F.col("p_brand").alias("unit")), path)
    return R.read_boq(spark, path).groupBy("description", "quantity", "unit").agg(cnt())


@query("s4_scan_by_extension", "SELECT o_orderkey, o_orderstatus FROM orders ORDER BY o_orderkey LIMIT 1000")
def by_extension(spark, sf):
    return R.load_any(spark, f"{sf}/orders.parquet", 1000, ["o_orderkey"]).select("o_orderkey", "o_orderstatus")


@query("s6_discovered_tracks", with_ctes(WI_TRACKS) + "SELECT DISTINCT track FROM wi_tracks")
def discovered(spark, sf):
    path = scratch_path(spark, "tracks")
    WR.write_parquet(work_items_by_track(spark, sf).select("track", "rate_code"), path, ["track"])
    return R.discover_tracks(spark, path)


@query("s7_json_dictionary", """
SELECT DISTINCT substr(sha1(text), 1, 16) AS h, length(text) AS n FROM documents""")
def json_dictionary(spark, sf):
    from costweave.functions.text import hash16

    path = scratch_path(spark, "dictionary")
    d = table(spark, sf, "documents")
    WR.write_json(d.select(F.create_map(hash16(F.col("text")), F.col("text")).alias("map")), path)
    rows = R.read_dictionary(spark, path, lines=True)
    return rows.select("h", F.length("target").cast("long").alias("n")).distinct()


@query("s8_parquet_sink", with_ctes(WI_TRACKS) + f"""
SELECT track, rate_code, count(*) AS n, {s4('sum(total_cost_per_position)', 'cost')} FROM wi_tracks GROUP BY 1, 2""")
def parquet_sink(spark, sf):
    path = scratch_path(spark, "sink")
    WR.write_parquet(work_items_by_track(spark, sf).select("track", "rate_code", "total_cost_per_position"), path, ["track"],
                     sort_within=["rate_code"])
    return spark.read.parquet(path).groupBy("track", "rate_code").agg(cnt(), x4(F.sum("total_cost_per_position"), "cost"))


@query("s9_csv_sink", "SELECT doc_id, lang, sha1(text) AS h FROM documents")
def csv_sink(spark, sf):
    path = scratch_path(spark, "csv")
    WR.write_csv(table(spark, sf, "documents").select("doc_id", "lang", "text"), path)
    back = spark.read.option("header", True).option("multiLine", True).option("escape", '"').schema(
        "doc_id bigint, lang string, text string").csv(path)
    return back.select("doc_id", "lang", F.sha1("text").alias("h"))


@query("s10_replaced_table", "SELECT lang, 2 * count(*) AS n, sum(n_chars)::BIGINT * 2 AS chars FROM documents GROUP BY 1")
def replaced(spark, sf):
    path = scratch_path(spark, "replaced")
    d = table(spark, sf, "documents").select("doc_id", "lang", "n_chars")
    WR.replace_table(spark, d, path)
    old = spark.read.parquet(path)
    WR.replace_table(spark, old.unionByName(old), path)
    return spark.read.parquet(path).groupBy("lang").agg(cnt(), F.sum("n_chars").alias("chars"))


@query("s11_preview", with_ctes(WI) + f"""
SELECT rate_code, resource_name, {s4('resource_cost', 'resource_cost')} FROM wi ORDER BY ord LIMIT 10""")
def preview(spark, sf):
    out = R.preview(work_items(spark, sf), ["rate_code", "resource_name", "no_such_column", "resource_cost"], 10, ["ord"])
    return out.withColumn("resource_cost", x4("resource_cost"))


@query("s12_row_order", "SELECT source, min(doc_id) AS first_doc, count(*) AS n FROM documents GROUP BY 1")
def row_order(spark, sf):
    rows = R.read_items(spark, f"{sf}/documents.parquet", ["doc_id", "source"], row_order=True)
    return rows.groupBy("source").agg(F.min_by("doc_id", "ord").alias("first_doc"), cnt())


@query("st1_incremental_points", """
SELECT substr(s, 1, 8) || '-' || substr(s, 9, 4) || '-' || substr(s, 13, 4) || '-' || substr(s, 17, 4) || '-' || substr(s, 21, 12) AS id, lang, h
FROM (SELECT sha1(lang || '|' || doc_id) AS s, lang, sha1('text: ' || text || ' | source: ' || source) AS h FROM documents WHERE length(trim(text)) > 0)""")
def incremental_points(spark, sf):
    source, target, state = (scratch_path(spark, n) for n in ("files", "points", "state"))
    rows = table(spark, sf, "documents").select(
        "doc_id", "lang", "text", "source", F.struct("doc_id").alias("ord"))
    files = parts_for(rows, 4)
    rows.repartition(files, "doc_id").write.parquet(source)
    for _ in range(2):  # the second start finds nothing new
        run = incremental.start(spark, source, rows.schema, target, state, hash_embedder(8), "doc_id", "lang", ["text", "source"],
                                files_per_batch=files // 2)
        run.awaitTermination()
    return read_first(spark, target, "ord").select("id", "lang", F.sha1("text").alias("h"))
