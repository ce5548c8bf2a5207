"""Reading work items, bills of quantities, price lists and dictionaries."""

from __future__ import annotations

from collections.abc import Sequence
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from costweave.schema import present

def path_exists(spark: SparkSession, path: str) -> bool:
    jvm_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return jvm_path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(jvm_path)


def with_row_order(df: DataFrame) -> DataFrame:
    """Add ``ord`` = (file, row in file): the order "first" means for a plain Parquet scan."""
    return df.select("*", F.struct(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.row_index").alias("row")).alias("ord"))


def with_positions(df: DataFrame, position: str = "position") -> DataFrame:
    """Number the rows of a scan from 0 over all its files, in the order of their names.

    Only one count per file is gathered; rows get theirs from the file's start and their place in it.
    """
    rows = with_row_order(df)
    counts = rows.groupBy(F.col("ord.file").alias("_file")).agg(F.count(F.lit(1)).alias("_n"))
    before = W.orderBy("_file").rowsBetween(W.unboundedPreceding, -1)
    starts = counts.select("_file", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start"))
    return rows.join(starts, F.col("ord.file") == F.col("_file")).withColumn(
        position, F.col("_start") + F.col("ord.row")).drop("ord", "_file", "_start")


def align_scans(left: DataFrame, right: DataFrame, position: str = "position") -> DataFrame:
    """Two scans side by side by position; rows beyond the shorter one are left out, as are clashing names of the right."""
    new = [c for c in right.columns if c not in left.columns]
    return with_positions(left, position).join(with_positions(right, position).select(position, *new), position)


def read_items(spark: SparkSession, path: str, cols: Sequence[str] | None = None, row_order: bool = False) -> DataFrame:
    """Parquet scan; ``cols`` prunes to those present, ``row_order`` adds ``ord``."""
    df = spark.read.parquet(path)
    if row_order:
        df = with_row_order(df)
    if cols is None:
        return df
    keep = present(df, cols)
    return df.select(*keep, *(["ord"] if row_order else []))


def load_any(spark: SparkSession, path: str, max_rows: int | None = None, order: Sequence[str] = ()) -> DataFrame:
    """Parquet or CSV by extension; anything else is an error. ``max_rows`` takes the first rows in ``order``."""
    if path.endswith(".parquet"):
        df = spark.read.parquet(path)
    elif path.endswith(".csv"):
        df = spark.read.option("header", True).csv(path)
    else:
        raise ValueError(f"neither .parquet nor .csv: {path}")
    if max_rows is None:
        return df
    return (df.orderBy(*order) if order else df).limit(max_rows)


def require_columns(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    missing = sorted(set(cols) - set(df.columns))
    if missing:
        raise ValueError(f"missing required columns: {missing}")
    return df


def read_boq(spark: SparkSession, path: str) -> DataFrame:
    """Bill of quantities with trimmed text and parsed quantities; the three columns are required.

    The header is checked before the rows are read with a fixed schema.
    """
    header = spark.read.option("header", True).csv(path)
    require_columns(header, ["description", "quantity", "unit"])
    return header.select(
        F.trim("description").alias("description"),
        F.trim("quantity").try_cast("double").alias("quantity"),
        F.trim("unit").alias("unit"))


def read_overrides(spark: SparkSession, path: str) -> DataFrame:
    """Price override list with its row order; resource_code is required."""
    df = require_columns(spark.read.option("header", True).csv(path), ["resource_code"])
    out = [F.col("resource_code")]
    for c in ("unit_price", "labor_rate_per_hr"):
        if c in df.columns:
            out.append(F.col(c).try_cast("double").alias(c))
    order = F.struct(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"),
                     F.monotonically_increasing_id().alias("row"))
    return df.select(*out, order.alias("ord"))


def read_dictionary(spark: SparkSession, path: str, src_lang: str | None = None, tgt_lang: str | None = None,
                    lines: bool = False) -> DataFrame:
    """Translations from JSON of the form {"map": {key: text}}: one row per key.

    With ``lines`` a file holds one such object per line and is read in splits. Otherwise a file is one
    object, which one task reads whole: for the small files of the original caches only.
    """
    schema = T.StructType([T.StructField("map", T.MapType(T.StringType(), T.StringType()))])
    rows = spark.read.schema(schema).option("multiLine", not lines).json(path).select(F.explode("map").alias("h", "target"))
    if src_lang and tgt_lang:
        rows = rows.select(F.lit(src_lang).alias("src_lang"), F.lit(tgt_lang).alias("tgt_lang"), "h", "target")
    return rows


def discover_tracks(spark: SparkSession, path: str, key: str = "track") -> DataFrame:
    """Sorted track names from the folder names of a partitioned table, empty folders too; no file is opened."""
    root = spark._jvm.org.apache.hadoop.fs.Path(path)
    found = root.getFileSystem(spark._jsc.hadoopConfiguration()).listStatus(root)
    folders = [f.getPath().getName() for f in found if f.isDirectory()]
    names = sorted(unquote(n.removeprefix(f"{key}=")) for n in folders if n.startswith(f"{key}="))
    return spark.createDataFrame([(n,) for n in names], f"`{key}` string")


def preview(df: DataFrame, cols: Sequence[str], n: int = 10, order: Sequence[str] = ()) -> DataFrame:
    """First n rows of those columns that exist."""
    ordered = df.orderBy(*order) if order else df
    return ordered.select(*present(df, cols)).limit(n)
