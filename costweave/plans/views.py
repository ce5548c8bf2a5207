"""The work-item shapes that queries run on, derived from the star-schema tables, and their SQL twins."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from costweave.functions.numeric import fixed
from costweave.functions.sizing import spread_scan

ORD = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice", "l_shipdate"]


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spread_scan(spark.read.parquet(f"{sf}/{name}.parquet"))


def work_items(spark: SparkSession, sf: str) -> DataFrame:
    """``wi``: one resource line per lineitem, with the names used by the operators."""
    li, o, p = (table(spark, sf, t) for t in ("lineitem", "orders", "part"))
    rows = li.join(o, F.col("l_orderkey") == F.col("o_orderkey")).join(p, F.col("l_partkey") == F.col("p_partkey"))
    return rows.select(
        F.concat(F.lit("R"), F.col("l_orderkey").cast("string")).alias("rate_code"),
        F.when(F.col("l_partkey") % 50 != 0, F.concat(F.lit("P"), F.col("l_partkey").cast("string"))).alias(
            "resource_code"),
        F.when(F.col("l_linenumber") != 7, F.col("p_name")).alias("resource_name"),
        F.col("p_brand").alias("resource_unit"),
        F.col("p_type").alias("collection_name"),
        F.left("p_type", F.lit(3)).alias("collection_code"),
        F.col("o_orderpriority").alias("department_name"),
        F.year("o_orderdate").cast("string").alias("section_name"),
        F.concat_ws(" ", "o_orderpriority", F.col("o_orderkey").cast("string")).alias("rate_final_name"),
        F.when(F.col("o_orderstatus") == "F", "100 m2").when(F.col("o_orderstatus") == "O", "m3").otherwise("t").alias(
            "rate_unit"),
        F.when(F.col("l_quantity") != 1, F.col("p_type") == "PROMO").alias("is_labor"),
        F.col("p_type").isin("STANDARD", "ECONOMY").alias("is_material"),
        (F.col("p_type") == "LARGE").alias("is_machine"),
        F.when(F.col("l_discount") != 0.10, F.col("l_quantity")).alias("resource_quantity"),
        (F.col("l_extendedprice") / F.col("l_quantity")).alias("resource_price_per_unit_current"),
        F.col("l_extendedprice").alias("resource_cost"),
        F.col("o_totalprice").alias("total_cost_per_position"),
        (F.col("l_quantity") * F.col("l_discount")).alias("labor_hours_construction_workers"),
        F.lit("EUR").alias("currency"),
        F.struct(*ORD).alias("ord"),
        F.col("l_orderkey"), F.col("l_partkey"),
    )


WI = """wi AS (
  SELECT 'R' || l_orderkey AS rate_code,
         CASE WHEN l_partkey % 50 = 0 THEN NULL ELSE 'P' || l_partkey END AS resource_code,
         CASE WHEN l_linenumber = 7 THEN NULL ELSE p_name END AS resource_name,
         p_brand AS resource_unit, p_type AS collection_name, substr(p_type, 1, 3) AS collection_code,
         o_orderpriority AS department_name, CAST(year(o_orderdate) AS VARCHAR) AS section_name,
         o_orderpriority || ' ' || o_orderkey AS rate_final_name,
         CASE o_orderstatus WHEN 'F' THEN '100 m2' WHEN 'O' THEN 'm3' ELSE 't' END AS rate_unit,
         CASE WHEN l_quantity = 1 THEN NULL ELSE p_type = 'PROMO' END AS is_labor,
         p_type IN ('STANDARD', 'ECONOMY') AS is_material, p_type = 'LARGE' AS is_machine,
         CASE WHEN l_discount = 0.10 THEN NULL ELSE l_quantity END AS resource_quantity,
         l_extendedprice / l_quantity AS resource_price_per_unit_current,
         l_extendedprice AS resource_cost, o_totalprice AS total_cost_per_position,
         l_quantity * l_discount AS labor_hours_construction_workers, 'EUR' AS currency,
         ROW(l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice, l_shipdate) AS ord,
         l_orderkey, l_partkey
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN part ON l_partkey = p_partkey)"""


def work_items_by_track(spark: SparkSession, sf: str) -> DataFrame:
    """``wi_tracks``: the same parts priced in five regions."""
    li, s, n, r, p = (table(spark, sf, t) for t in ("lineitem", "supplier", "nation", "region", "part"))
    rows = (
        li.join(s, F.col("l_suppkey") == F.col("s_suppkey"))
        .join(n, F.col("s_nationkey") == F.col("n_nationkey"))
        .join(r, F.col("n_regionkey") == F.col("r_regionkey"))
        .join(p, F.col("l_partkey") == F.col("p_partkey"))
    )
    return rows.select(
        F.col("r_name").alias("track"),
        F.col("l_partkey").cast("string").alias("rate_code"),
        F.col("p_name").alias("rate_final_name"),
        F.col("l_extendedprice").alias("total_cost_per_position"),
        F.col("p_brand").alias("rate_unit"),
        F.struct(*ORD).alias("ord"),
        F.col("l_quantity").alias("resource_quantity"),
        F.col("l_partkey"), F.col("n_name"),
    )


WI_TRACKS = """wi_tracks AS (
  SELECT r_name AS track, CAST(l_partkey AS VARCHAR) AS rate_code, p_name AS rate_final_name,
         l_extendedprice AS total_cost_per_position, p_brand AS rate_unit,
         ROW(l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice, l_shipdate) AS ord,
         l_quantity AS resource_quantity, l_partkey, n_name
  FROM lineitem JOIN supplier ON l_suppkey = s_suppkey JOIN nation ON s_nationkey = n_nationkey
       JOIN region ON n_regionkey = r_regionkey JOIN part ON l_partkey = p_partkey)"""

LOWER = "abcdefghijklmnopqrstuvwxyz"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
TRACKS = ["AFRICA", "AMERICA", "ASIA", "EUROPE", "MIDDLE EAST"]


def text_pairs(spark: SparkSession, sf: str) -> DataFrame:
    """``text_pair``: every document with a deterministic edit standing in for its translation."""
    d = table(spark, sf, "documents")
    t, kind = F.col("text"), F.col("doc_id") % 10
    target = (
        F.when(kind == 0, t)
        .when(kind == 1, F.left(t, F.floor(F.length(t) / 2).cast("int")))
        .when(kind == 2, F.translate(t, "0123456789", ""))
        .when(kind == 3, F.repeat(t, 4))
        .when(kind == 4, F.translate(t, "abcdefghijklmnoprstuvz", "абцдефгхийклмнопрстувз"))
        .otherwise(F.translate(t, LOWER, UPPER))
    )
    return d.select("doc_id", "lang", "source", t.alias("src"), target.alias("tgt"))


TEXT_PAIR = """text_pair AS (
  SELECT doc_id, lang, source, text AS src,
         CASE doc_id % 10 WHEN 0 THEN text WHEN 1 THEN substr(text, 1, CAST(floor(length(text) / 2.0) AS BIGINT))
           WHEN 2 THEN translate(text, '0123456789', '') WHEN 3 THEN repeat(text, 4)
           WHEN 4 THEN translate(text, 'abcdefghijklmnoprstuvz', 'абцдефгхийклмнопрстувз')
           ELSE translate(text, 'abcdefghijklmnopqrstuvwxyz', 'ABCDEFGHIJKLMNOPQRSTUVWXYZ') END AS tgt
  FROM documents)"""


def texts(spark: SparkSession, sf: str) -> DataFrame:
    """Two text columns in column order: documents (0) and conversation turns (1), with row order."""
    d = table(spark, sf, "documents").select(
        F.lit(0).alias("col_ord"), F.struct(F.col("doc_id").alias("a"), F.lit(0).cast("long").alias("b")).alias("row_ord"),
        F.col("text").alias("v"))
    c = table(spark, sf, "conversations").select(
        F.lit(1).alias("col_ord"), F.struct(F.col("conv_id").alias("a"), F.col("turn").alias("b")).alias("row_ord"),
        F.col("text").alias("v"))
    return d.unionByName(c)


TEXTS = """texts AS (
  SELECT 0 AS col_ord, doc_id AS a, CAST(0 AS BIGINT) AS b, text AS v FROM documents
  UNION ALL SELECT 1, conv_id, turn, text FROM conversations)"""


def with_ctes(*ctes: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n"


def x4(c: Column | str, name: str | None = None) -> Column:
    """Value at four places, the same in both engines."""
    out = fixed(F.col(c) if isinstance(c, str) else c)
    return out.alias(name) if name else out


def s4(expr: str, name: str | None = None) -> str:
    out = f"CAST(floor(({expr}) * 10000.0 + 0.500001) AS DOUBLE) / 10000.0"
    return f"{out} AS {name}" if name else out
