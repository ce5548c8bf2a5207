"""From raw documents to packed training sequences, stage by stage.

Each stage reads all that the one before it kept, as written; all but the last return the columns of ``documents``.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from costweave.llm import langid, minhash, packing, toxicity
from costweave.llm.queries import WORD_VOCABULARY
from costweave.llm.tables import small_batches, table
from costweave.session import cut_lineage


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a text in one of the languages that the corpus names are rejected."""
    small_batches(spark)
    network, least = langid.fit_rejecting(docs)
    return langid.keep_identified(docs, network, least=least)


def clean(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score as toxic are rejected; all labels serve to learn."""
    small_batches(spark)
    return toxicity.drop_toxic(docs, table(spark, sf_dir, "labels"))


def distinct(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates stays."""
    small_batches(spark)
    return minhash.drop_near_duplicates(docs)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents in sequences of at most 4096 tokens."""
    small_batches(spark)
    return packing.pack_documents(docs, public_tokenizers.path(WORD_VOCABULARY))


STAGES = [("language", language), ("toxicity", clean), ("near_duplicates", distinct), ("packing", packed)]
#: Learnt models decide two stages, so SQL cannot state the result; tests hold it against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = cut_lineage(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
