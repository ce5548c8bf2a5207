"""The pipeline against its stages done plainly on what each stage received."""

import corpus_pipeline

from costweave.llm import langid, toxicity
from costweave.session import cut_lineage

from test_minhash import brute

SF = "/root/testdata/sf0.001"


def test_stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    kept = docs
    for name, stage in corpus_pipeline.STAGES[:-1]:
        before, kept = kept, cut_lineage(stage(spark, kept, SF))
        assert kept.columns == docs.columns
        given, stays = before.collect(), {r.doc_id for r in kept.collect()}
        if name == "language":
            judge = langid.Judge(langid.fit(before))
            assert stays == {r.doc_id for r, n in zip(given, judge([r.text for r in given])[0], strict=True) if n != "und"}
        elif name == "toxicity":
            models, curve = toxicity.fit(before, spark.read.parquet(f"{SF}/labels.parquet"))
            scores = toxicity.Scorer(models.value, curve)([r.text for r in given])
            assert stays == {r.doc_id for r, s in zip(given, scores, strict=True) if s < 0.7}
            assert len(stays) > 0.8 * len(given)
        else:
            assert stays == {k for k, _, _, keep in brute([(r.doc_id, r.text) for r in given]) if keep}
    packed = corpus_pipeline.run(spark, SF)
    assert {r.doc_id for r in packed.select("doc_id").distinct().collect()} == stays
    assert corpus_pipeline.ORACLE_SQL is None


def test_no_rows(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").where("false")
    for _, stage in corpus_pipeline.STAGES:
        docs = cut_lineage(stage(spark, docs, SF))
        assert docs.count() == 0
