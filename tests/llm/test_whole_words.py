"""Toxicity reads words whole: against plain Kneser-Ney over strings, broadcast and joined."""

from collections import Counter

import numpy as np
import pytest

from costweave.llm import toxicity


def plain(texts, classes):
    """Differences of words by dictionaries of strings."""
    words = [toxicity.words_of(t) for t in texts]
    known = {w for ws in words for w in ws}
    rests = Counter(w[:4] for w in known)
    shared = sum(n + 0.5 for n in rests.values())
    share = []
    for c in (0, 1):
        of_word = Counter(w for ws, k in zip(words, classes, strict=True) if k == c for w in ws)
        of_stem = Counter()
        for w, n in of_word.items():
            of_stem[w[:4]] += n
        total, seen = sum(of_word.values()), Counter(of_word.values())
        d = (seen[1] + 0.5) / (seen[1] + 2 * seen[2] + 1)
        ds = toxicity.discount(np.array(list(of_stem.values())), toxicity.BACKOFF)
        stem = {s: max(of_stem[s] - ds, 0) / total + toxicity.BACKOFF * (n + 0.5) / shared for s, n in rests.items()}
        share.append({w: max(of_word[w] - d, 0) / total + d * len(of_word) / total * stem[w[:4]] / rests[w[:4]] for w in known})
    return {w: np.log1p(toxicity.MIXED * (share[1][w] / share[0][w] - 1)) for w in known}


TEXTS = ["pathetic worthless thing", "pathway worthwhile thing here", "plain pathetic words", "a pathway of words of words",
         "nothing labelled pathology", None, ""]
CLASSES = [1, 0, 1, 0, None, 0, 1]


def test_words_of_one_stem_differ():
    tables, slots = toxicity.Tables(), toxicity.Slots()
    tables.add(toxicity.Words(TEXTS, slots), CLASSES)
    models, want = toxicity.Models(tables), plain(TEXTS, CLASSES)
    asked = ["pathetic worthless", "pathway worthwhile", "pathology", "unheard"]
    d = models.differences(toxicity.Words(asked, toxicity.Slots()))
    assert d[0] > 0 > d[1] and d[0] > d[2] > d[1]
    for text, got in zip(asked[:3], d, strict=False):
        assert abs(got - np.mean([want[w] for w in text.split()])) < 1e-8


def test_scripts_without_blanks_are_read_to_their_end():
    assert toxicity.words_of("日本語の本 x日本y 字") == ["日本", "本語", "語の", "の本", "x", "日本", "y", "字"]
    assert toxicity.words_of("Ünïcödé日 words") == ["ünïcödé", "日", "words"]


def test_tables_have_a_word_once_whatever_their_number():
    """More words than the slots there once were, sent in blocks that tasks merge."""
    texts = [" ".join(f"{chr(97 + a)}{chr(97 + b)}{chr(97 + c)}{chr(97 + d)}{e}" for b in range(26) for c in range(26) for d in range(13) for e in "xyz")
             for a in range(11)]
    tables = toxicity.Tables()
    for text in texts:
        tables.add(toxicity.Words([text], toxicity.Slots()), [0])
    merged = toxicity.Tables()
    for b, data in tables.blocks():
        merged.merge(b, data)
    n = 11 * 26 * 26 * 13
    assert merged.rows().shape == (4, 3 * n) and (merged.rests_of == 3).all() and merged.stems.tolist() == [[3] * n, [0] * n]


@pytest.mark.parametrize("bound", [toxicity.MODEL_KEYS, 0])
def test_scores_are_alike_broadcast_and_joined(spark, monkeypatch, bound):
    rows = [(i, f"number{'abcdefg'[i % 7]} " * (i % 5 + 1) + ("pathetic" if i % 3 == 0 else "pathway")) for i in range(60)]
    rows += [(None, "pathetic"), (70, None), (71, ""), (72, "pathway pathway"), (72, "pathway pathway")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "'x' AS score")
    labels = spark.createDataFrame([(i, int(i % 3 == 0)) for i in range(60)], "doc_id long, toxic int")
    monkeypatch.setattr(toxicity, "MODEL_KEYS", bound)
    scores = toxicity.toxicity_scores(docs, labels).collect()
    kept = toxicity.drop_toxic(docs, labels)
    assert kept.columns == docs.columns and len(scores) == len(rows)
    assert sorted(str(r.doc_id) for r in kept.collect()) == sorted(str(r.doc_id) for r in scores if r.score < 0.7)
    assert all(r.predicted == (r.score >= 0.7) for r in scores) and len({r.score for r in scores if r.doc_id == 72}) == 1
    by_id = {r.doc_id: r.score for r in scores}
    assert by_id[None] > by_id[70] == by_id[71] > by_id[72] and all(by_id[i] > by_id[j] for i in range(0, 60, 3) for j in (70, 72))
    monkeypatch.setattr(toxicity, "MODEL_KEYS", toxicity.TASK_WORDS)
    other = {r.doc_id: r.score for r in toxicity.toxicity_scores(docs, labels).collect()}
    assert all(abs(other[k] - v) < 1e-9 for k, v in by_id.items())


def test_the_pipelines_stage_tells_words_of_one_stem_apart(spark, tmp_path):
    import corpus_pipeline

    spark.createDataFrame([(i, int(i % 3 == 0)) for i in range(90)], "doc_id long, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    docs = spark.createDataFrame([(i, ("pathetic " if i % 3 == 0 else "pathway ") * (3 + i % 4)) for i in range(120)], "doc_id long, text string")
    assert {r.doc_id for r in corpus_pipeline.clean(spark, docs, str(tmp_path)).collect()} == {i for i in range(120) if i % 3}
