"""Reading the tables, and the small column helpers that the operators share."""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


#: Whole texts are long: batches between the JVM and Python are bounded by bytes far below the default, so that what
#: executors keep for them stays small.
BATCH_BYTES = 4 << 20


def small_batches(spark: SparkSession) -> None:
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def remainder(doc_id: Column, by: int) -> Column:
    """crc32 of the id as text, modulo ``by``; null for a null id."""
    return F.crc32(doc_id.cast("string").cast("binary")) % F.lit(by)


def remainder_of(doc_id: int | None, by: int) -> int | None:
    """The same as :func:`remainder`, inside a task."""
    return None if doc_id is None else zlib.crc32(str(doc_id).encode()) % by


def text_rows(batch: pa.RecordBatch, key: str, text: str, chars: int = 1_000_000) -> Iterator[tuple[list, list[str | None]]]:
    """Keys and texts of a batch in runs of about ``chars`` characters, so that one run's words fit in memory."""
    keys, texts, n = [], [], 0
    for k, t in zip(batch.column(key), batch.column(text), strict=True):
        t = t.as_py()
        keys.append(k.as_py())
        texts.append(t)
        n += len(t or "")
        if n >= chars:
            yield keys, texts
            keys, texts, n = [], [], 0
    if keys:
        yield keys, texts
