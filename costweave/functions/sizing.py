"""Size checks that decide between a plan for small inputs and one that holds at any size."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Encoded Parquet grows several times when it is decoded into rows.
DECODE_FACTOR = 6
TASK_BYTES = 2 * 1024**3
BROADCAST_BYTES = 64 * 1024**2


def leaf_bytes(df: DataFrame) -> int:
    """Bytes of all inputs below ``df`` by the statistics of the scans (no job runs)."""
    leaves = df._jdf.queryExecution().optimizedPlan().collectLeaves()
    total = 0
    for i in range(leaves.size()):
        total += int(leaves.apply(i).stats().sizeInBytes())
    return total


def fits_one_task(df: DataFrame, limit: int = TASK_BYTES) -> bool:
    """True when even all input rows in one group would fit one task's memory."""
    return leaf_bytes(df) * DECODE_FACTOR <= limit


def is_bounded(df: DataFrame, max_rows: int, max_bytes: int) -> bool:
    """Count at most ``max_rows + 1`` rows and the length of their text (runs a job)."""
    texts = [F.coalesce(F.octet_length(f.name), F.lit(0)) for f in df.schema.fields if f.dataType.simpleString() == "string"]
    width = sum(texts, F.lit(16 * len(df.columns)))
    row = df.limit(max_rows + 1).agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.sum(width), F.lit(0)).alias("b")).first()
    return row["n"] <= max_rows and row["b"] <= max_bytes


#: Whole texts are long: batches between the JVM and Python are bounded by bytes far below Spark's default.
BATCH_BYTES = 4 * 1024**2


def bounded_batches(spark: SparkSession) -> None:
    """Bound the Arrow batches of the session by :data:`BATCH_BYTES`, so that a task holds few long texts at a time."""
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))


PART_BYTES = 32 * 1024**2
UNKNOWN_BYTES = 1 << 60


def parts_for(df: DataFrame, least: int = 1) -> int:
    """Into how many parts to deal rows so that a part stands for a bounded share of the inputs below ``df``, as stored;
    ``least`` where Spark has no statistics of an input, such as rows from the driver."""
    size = leaf_bytes(df)
    return least if size >= UNKNOWN_BYTES else max(least, -(-size // PART_BYTES))


SPLIT_BYTES = 1024**2
SPREAD_FROM = 4 * SPLIT_BYTES


def spread_scan(df: DataFrame) -> DataFrame:
    """Spread a scan over the cores when its files hold fewer splits than there are cores.

    A file with one row group is read by one task however large the cluster is. Scans that already
    have a split per core, and inputs of a few megabytes, are returned unchanged.
    """
    size = leaf_bytes(df)
    want = min(df.sparkSession.sparkContext.defaultParallelism, size // SPLIT_BYTES)
    if size < SPREAD_FROM or df._jdf.queryExecution().toRdd().getNumPartitions() >= want:
        return df
    return df.repartition(want)
