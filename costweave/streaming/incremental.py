"""Incremental embedding: new work-item files become text, vectors and a versioned upsert."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from costweave.functions.text import row_to_text, uuid_from
from costweave.operators.ordering import first_row
from costweave.operators.search import EmbedFn, embed_texts, write_version


def embed_batch(df: DataFrame, key: str, track: str, text_cols: Sequence[str], order: str, embed: EmbedFn,
                version: int) -> DataFrame:
    """Points of one batch: deterministic id, key, text, order, vector, version. The first row of a key stands for it."""
    rows = first_row(df, [track, key], order, [*text_cols, order])
    points = rows.select(uuid_from(F.col(track).cast("string"), F.col(key).cast("string")).alias("id"), track, key,
                         row_to_text(text_cols).alias("text"), order)
    vectors = embed_texts(points, "id", "text", embed)
    return points.join(vectors, "id", "inner").withColumn("version", F.lit(version).cast("long"))


def start(
    spark: SparkSession,
    source: str,
    schema: T.StructType,
    target: str,
    checkpoint: str,
    embed: EmbedFn,
    key: str = "rate_code",
    track: str = "track",
    text_cols: Sequence[str] = ("rate_final_name",),
    order: str = "ord",
    files_per_batch: int = 1_000,
) -> StreamingQuery:
    """Process all files not seen yet and stop. Each micro-batch writes its own version folder, so a
    replayed batch replaces itself. Points keep their order, and ``read_first`` gives the current ones: the
    first row of a key counts in whatever batch it comes, so the result does not depend on how files are
    cut into batches. A target belongs to one checkpoint, whose batch numbers are its versions."""

    def handle(batch: DataFrame, batch_id: int) -> None:
        points = embed_batch(batch, key, track, text_cols, order, embed, batch_id)
        write_version(points.drop("version"), target, batch_id)

    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch).parquet(source)
    return (
        stream.writeStream.foreachBatch(handle)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
