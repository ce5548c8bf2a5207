"""Toxicity and language: held-out accuracy, odd rows, and scores that follow from texts alone."""

import numpy as np

from costweave.llm import langid, toxicity
from costweave.llm.queries import QUERIES
from costweave.llm.tables import remainder_of

SF = "/root/testdata/sf0.01"


def test_toxicity_of_held_out_texts(spark):
    labels = {r.doc_id: r.toxic for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    rows = QUERIES["op1_toxicity"](spark, SF).collect()
    assert len(rows) == spark.read.parquet(f"{SF}/documents.parquet").count()
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.7) and r.held_out == (remainder_of(r.doc_id, 3) == 1) for r in rows)
    held = [r for r in rows if r.held_out and r.doc_id in labels]
    clean = [r for r in held if not labels[r.doc_id]]
    assert sum(r.predicted for r in clean) <= 0.03 * len(clean)
    toxic = [r for r in held if labels[r.doc_id]]
    order = np.array([[t.score > c.score for c in clean] for t in toxic]).mean()
    assert order > 0.9, order


def test_toxicity_models_against_plain_counting():
    texts, classes = ["bad words here", "good words here", "plain bad", None, ""], [1, 0, None, 0, 1]
    tables, slots = toxicity.Tables(), toxicity.Slots(most=3)
    words = toxicity.Words(texts, slots)
    tables.add(words, classes)
    assert words.counts.tolist() == [3, 3, 2, 0, 0] and tables.stems.sum(axis=1).tolist() == [3, 3]
    merged = toxicity.Tables()
    for b, data in tables.blocks():
        merged.merge(b, data)
        merged.merge(b, data)
    assert (merged.stems == 2 * tables.stems).all() and (merged.rests_of == tables.rests_of).all()
    d = toxicity.Models(tables).differences(words)
    assert d[0] > d[1] and d[3] == d[4] == 0
    counts = np.array([1, 1, 2, 10])
    taken = toxicity.discount(counts, 0.5)
    assert abs(np.minimum(counts, taken).sum() - 0.5 * counts.sum()) < 1e-6


def test_toxicity_of_odd_rows(spark, odd, none):
    labels = spark.createDataFrame([(4, 1), (4, 0), (7, 0), (None, 1), (8, None), (99, 1)], "doc_id long, toxic int")
    rows = toxicity.toxicity_scores(odd, labels).collect()
    assert len(rows) == odd.count() and all(0 <= r.score <= 1 for r in rows)
    assert len({r.score for r in rows if r.doc_id in (1, 2, 3)}) == 1
    assert len({r.score for r in rows if r.doc_id in (7, 8)}) == 1
    assert toxicity.toxicity_scores(none, labels).count() == 0
    assert len({r.score for r in toxicity.toxicity_scores(odd, labels.where("false")).collect()}) == 1
    assert toxicity.drop_toxic(odd, labels).columns == odd.columns


def test_language_of_held_out_texts(spark):
    docs = {r.doc_id: r for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    rows = QUERIES["op10_langid"](spark, SF).collect()
    held = [r for r in rows if r.held_out]
    assert all(r.held_out == (remainder_of(r.doc_id, 4) == 2) and 0 <= r.score <= 1 for r in rows)
    right = sum(r.lang_pred == docs[r.doc_id].lang for r in held) / len(held)
    assert right > 0.95, right


def test_windows_cover_every_byte_run():
    for n in (0, 1, 3, 4, 255, 256, 257, 509, 510, 5000):
        text = "".join(chr(33 + i % 90) for i in range(n))
        rows, raw = langid.windows(text), langid.as_bytes(text).tobytes()
        starts = langid.window_starts(n)
        seen = {i for s in starts for i in range(s, s + langid.WINDOW - 3)}
        assert set(range(max(0, n - 3))) <= seen
        assert all(r.tobytes().rstrip(b"\0") == raw[s:s + langid.WINDOW] for r, s in zip(rows, starts, strict=True))


def test_prepared_responses_equal_the_filters_sums():
    network = langid.Network(["a", "b"])
    network.prepare()
    x = np.concatenate([langid.windows("Some text, äöü and more of it. " * 20), langid.windows("ab")])
    for fast, slow in zip(network.responses(x), network.changing(x), strict=True):
        assert np.allclose(fast.max(axis=1), slow.max(axis=1), atol=1e-3)


def test_language_of_odd_rows(odd, none):
    network = langid.fit(odd, per_label=5)
    rows = {r.doc_id: r for r in langid.identify(odd, network).collect()}
    assert {rows[i].lang_pred for i in (1, 2, 3, 9)} == {"und"} and rows[1].score == 0
    assert rows[10].lang_pred in network.labels and rows[7].lang_pred == rows[8].lang_pred
    kept = langid.keep_identified(odd, network)
    assert kept.columns == odd.columns and kept.count() == odd.count() - 4
    assert langid.fit(none) is None and langid.identify(none, network).count() == 0
    assert {r.lang_pred for r in langid.identify(odd, None).collect()} == {"und"}


def test_toxicity_learns_from_every_label(spark, monkeypatch):
    """All labelled texts count, however many there are, joined or broadcast; the curve's sums stay on the executors."""
    texts = [(i, f"plain words number{i % 7}" + (" vile" if i % 3 == 0 else " calm")) for i in range(300)]
    docs = spark.createDataFrame(texts, "doc_id long, text string")
    labels = spark.createDataFrame([(i, int(i % 3 == 0)) for i in range(300)], "doc_id long, toxic int")
    tallied, plain = [], toxicity._tally
    monkeypatch.setattr(toxicity, "_tally", lambda d, t: tallied.append(plain(d, t)) or tallied[-1])
    curves = []
    for bounded in (True, False):
        monkeypatch.setattr(toxicity, "is_bounded", lambda *a, b=bounded: b)
        curves.append(toxicity.fit(docs, labels)[1])
    held = {r.doc_id for r in labels.where("pmod(xxhash64(doc_id, 11), 5) = 0").collect()}
    want = [sum(4 for i in range(300) if i not in held and (i % 3 == 0) == bool(c)) for c in (0, 1)]
    assert all(t.stems.sum(axis=1).tolist() == want for t in tallied) and (curves[0] == curves[1]).all()
    rows = spark.createDataFrame([(1, 0.8, 9), (0, -0.5, 4), (1, -0.1, 300), (0, 0.2, 1)], "class int, difference double, words long")
    w = toxicity.fit_curve(rows)
    x = toxicity._features(np.array([0.8, -0.5, -0.1, 0.2]), np.array([9.0, 4, 300, 1]))
    slope = x.T @ (1 / (1 + np.exp(-x @ w)) - np.array([1, 0, 1, 0])) + 1e-2 * w
    assert np.abs(slope).max() < 1e-6
