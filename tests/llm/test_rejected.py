"""The language stage rejects by the network's own outcome."""

import corpus_pipeline
from pyspark.sql import functions as F

SF = "/root/testdata/sf0.01"


def test_unlearnt_language_and_letter_junk_are_rejected(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").where("text IS NOT NULL")
    stranger = docs.where("lang = 'fr'").withColumn("lang", F.lit(None).cast("string"))
    junk = spark.createDataFrame([(-i, "qzx vbk wjq xkzv pqj zzk " * (4 + 10 * i), None, "planted", 100) for i in range(1, 4)], docs.schema)
    learnt = docs.where("lang <> 'fr'")
    given = learnt.unionByName(stranger).unionByName(junk)
    kept = corpus_pipeline.language(spark, given, SF)
    n = {r.lang: r["count"] for r in kept.groupBy("lang").count().collect()}
    assert kept.where("doc_id < 0").count() == 0
    assert n.get(None, 0) <= 0.1 * stranger.count(), n
    assert sum(v for k, v in n.items() if k) >= 0.99 * learnt.count(), n
