"""Writing tracks, reports and dictionaries."""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from costweave.functions.text import cell_text


def write_parquet(df: DataFrame, path: str, partition_by: Sequence[str] = (), mode: str = "overwrite",
                  sort_within: Sequence[str] = ()) -> None:
    """Zstd Parquet, one folder per partition value.

    Rows are rebalanced by the partition columns: adaptive execution merges small tracks into one
    task and splits a track that holds a third of all rows over many. Sorted files allow skipping.
    """
    out = df
    if partition_by:
        out = out.hint("rebalance", *[F.col(c) for c in partition_by])
    if sort_within:
        out = out.sortWithinPartitions(*partition_by, *sort_within)
    writer = out.write.mode(mode).option("compression", "zstd")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)


def write_csv(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """UTF-8 CSV with a header; quotes are doubled and line breaks kept inside quotes."""
    df.write.mode(mode).option("header", True).option("encoding", "UTF-8").option("escape", '"').option(
        "quoteAll", True).csv(path)


def write_spreadsheet_csv(df: DataFrame, path: str) -> None:
    """CSV whose text cells fit a spreadsheet."""
    texts = {f.name for f in df.schema.fields if f.dataType.simpleString() == "string"}
    write_csv(df.select(*[cell_text(F.col(c)).alias(c) if c in texts else F.col(c) for c in df.columns]), path)


def write_json(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    df.write.mode(mode).json(path)


def replace_table(spark: SparkSession, df: DataFrame, path: str) -> None:
    """Replace a Parquet table so that a failed write leaves the old one in place.

    The new table is written beside the old one and takes its name only when complete. ``df`` may be
    derived from the old table.
    """
    tag = uuid.uuid4().hex
    staged, retired = f"{path}.new-{tag}", f"{path}.old-{tag}"
    df.write.option("compression", "zstd").parquet(staged)
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path
    fs = hadoop_path(path).getFileSystem(spark._jsc.hadoopConfiguration())
    had_old = fs.exists(hadoop_path(path))
    if had_old and not fs.rename(hadoop_path(path), hadoop_path(retired)):
        raise OSError(f"could not set aside {path}")
    if not fs.rename(hadoop_path(staged), hadoop_path(path)):
        if had_old:
            fs.rename(hadoop_path(retired), hadoop_path(path))
        raise OSError(f"could not publish {path}")
    if had_old:
        fs.delete(hadoop_path(retired), True)
