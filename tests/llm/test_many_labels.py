"""No label is left out of the network, however many there are."""

from costweave.llm import langid


def test_more_labels_than_the_bound(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    assert langid.fit(docs, per_label=40, most_labels=2).labels == ["de", "en", "es", "fr"]
