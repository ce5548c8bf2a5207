"""Segmentations are distinct, reversible and drawn with the right probabilities; counts equal a plain search."""

import itertools
import math
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F

from costweave.llm import segmentations
from costweave.llm.token_counts import count_tokens, terminal_counts
from costweave.llm.unigram import Vocabulary, factors

PATH = public_tokenizers.path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def vocabulary():
    return Vocabulary(PATH)


def splits(text, vocabulary):
    """All (log-probability, ids) of a text, without factors."""
    if not text:
        return [(0.0, ())]
    out = []
    for end in range(1, len(text) + 1):
        for start, log, _ in vocabulary.edges(text[:end], end):
            if start == 0:
                ids = tuple(vocabulary.piece_ids(text[:end]))
                out += [(log + w, ids + rest) for w, rest in splits(text[end:], vocabulary)]
    return out


def test_all_segmentations_and_their_probabilities(vocabulary):
    parts, whole = segmentations.Factors(vocabulary).parts("an ex\n"), splits(" an ex\n", vocabulary)
    total = math.log(sum(math.exp(w) for w, _ in whole))
    found = segmentations.Factors(vocabulary)
    drawn = segmentations.sample(parts, len(whole) + 5, np.random.default_rng(1))
    assert {tuple(found.ids(parts, c)): round(log, 9) for log, _, c in drawn} == {ids: round(w - total, 9) for w, ids in whole}
    assert all(inclusion == 1 for _, inclusion, _ in drawn)


@pytest.mark.parametrize("most", [2048, 0])
def test_samples_follow_the_model(vocabulary, monkeypatch, most):
    monkeypatch.setattr(segmentations, "MOST", most)
    found = segmentations.Factors(vocabulary)
    text = "stone's ab"
    parts, whole = found.parts(text), splits(f" {text}", vocabulary)
    total = math.log(sum(math.exp(w) for w, _ in whole))
    share = {ids: math.exp(w - total) for w, ids in whole}
    first, sums, runs = Counter(), [], 1500
    for seed in range(runs):
        drawn = segmentations.sample(parts, 3, np.random.default_rng(seed))
        keys = [tuple(found.ids(parts, c)) for _, _, c in drawn]
        assert len(set(keys)) == 3
        first[keys[0]] += 1
        sums.append(sum(math.exp(log) / q * len(k) for (log, q, _), k in zip(drawn, keys, strict=True)))
    for ids, p in sorted(share.items(), key=lambda x: -x[1])[:4]:
        assert abs(first[ids] / runs - p) < 4 * math.sqrt(p * (1 - p) / runs) + 1e-3
    mean = sum(p * len(ids) for ids, p in share.items())
    assert abs(np.mean(sums) - mean) < 4 * np.std(sums) / math.sqrt(runs) + 0.01


def test_round_trip_of_odd_rows(odd, none, vocabulary):
    coded = segmentations.encode_samples(odd, PATH, ["doc_id", "lang"], k=2)
    rows = segmentations.decode(coded, PATH).collect()
    texts = {(r.doc_id, r.lang): r.text or "" for r in odd.collect()}
    assert all(r.decoded == texts[(r.doc_id, r.lang)] for r in rows)
    assert len({tuple(r.ids) for r in rows if r.doc_id == 7}) == 2
    again = segmentations.encode_samples(odd.repartition(5), PATH, ["doc_id", "lang"], k=2).collect()
    assert sorted(map(str, (r[:5] for r in again))) == sorted(map(str, (r[:5] for r in rows)))
    assert segmentations.encode_samples(none, PATH, ["doc_id"]).count() == 0
    assert segmentations.decode(coded.withColumn("ids", F.lit(None).cast("array<int>")), PATH).where("decoded IS NOT NULL").count() == 0


def best(word, vocabulary):
    score = [(0.0, 0)]
    for end in range(1, len(word) + 1):
        score.append(min(((score[s][0] - log, score[s][1] + n) for s, log, n in vocabulary.edges(word, end)), key=lambda x: x))
    return score[-1][1]


def test_counts_share_prefixes_and_equal_single_words(vocabulary):
    words = [" ".join(w) for w in itertools.product(["", "the", "then", "thé", "日本", "x" * 50, "\n\t"], repeat=2)]
    assert terminal_counts(words, vocabulary) == {w: best(w, vocabulary) for w in words}


def test_counts_of_texts(spark, sf, odd, none, vocabulary):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    got = {r.doc_id: r.n_tokens for r in count_tokens(docs, PATH, most=500).collect()}
    for r in docs.limit(40).collect():
        assert got[r.doc_id] == sum(best(f, vocabulary) for f in factors(r.text))
    rows = {r.doc_id: r for r in count_tokens(odd, PATH).collect()}
    assert rows[1].n_tokens == rows[2].n_tokens == 0 and rows[4].n_pretokens == 1 and rows[3].n_tokens > 0
    assert count_tokens(none, PATH).count() == 0


def test_a_run_of_texts_walks_one_graph(vocabulary):
    texts = ["internationalization of unbelievable words", None, "", "thé 日本 " + "unbelievably" * 12, "an ex\n", " an ex"]
    found = segmentations.Factors(vocabulary)
    together = segmentations.sample_all(found.all_parts(texts), 3, [np.random.default_rng(i) for i in range(len(texts))])
    # Edges are pieces, not segmentations: a word of 20 letters has hundreds of thousands of these.
    assert found.graph.edges <= sum(map(len, filter(None, texts))) * vocabulary.longest
    for i, (text, drawn) in enumerate(zip(texts, together, strict=True)):
        alone = segmentations.Factors(vocabulary)
        parts = alone.parts(text)
        again = segmentations.sample(parts, 3, np.random.default_rng(i))
        assert [(alone.ids(parts, c), round(log, 6)) for log, _, c in again] == [
            (found.graph.piece_ids(c)[0].tolist(), round(log, 6)) for log, _, c in drawn]
        assert {vocabulary.decode(alone.ids(parts, c)) for _, _, c in again} == {text or ""}
        assert len({tuple(alone.ids(parts, c)) for _, _, c in again}) == len(again) == (3 if text else 1)
