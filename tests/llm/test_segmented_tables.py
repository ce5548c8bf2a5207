"""op7 segments every document, and the turns of conversations by a query of its own."""

from costweave.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"


def test_every_document_is_segmented(spark):
    rows = QUERIES["op7_segmentations"](spark, SF)
    assert "doc_id" in rows.columns
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    first = {r.doc_id: r for r in rows.where("sample = 1").collect()}
    assert first.keys() == docs.keys()
    assert all(first[k].ids for k, t in docs.items() if t and t.strip())
    turns = QUERIES["op7_turn_segmentations"](spark, SF).where("sample = 1").count()
    assert turns == spark.read.parquet(f"{SF}/conversations.parquet").count()
