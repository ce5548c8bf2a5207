"""Pieces tile the documents and the sequences, ids are the tokenizer's, and nothing is padded."""

import random
import struct
import zlib

import public_tokenizers
import pytest
from tokenizers import Tokenizer

from costweave.llm import packing
from costweave.llm.packing import Doc, Packer, WordEncoder, pack_documents

PATH = public_tokenizers.path("word_bpe_49k.json")


def ids_of(tokenizer, text):
    ids = [*tokenizer.encode(text or "", add_special_tokens=False).ids, 2]
    return struct.pack(f"<{len(ids)}I", *ids)


def check(rows, documents):
    """``documents``: the ids of each row, by key; keys may repeat with equal texts."""
    by_sequence, covered = {}, {}
    for r in rows:
        ids = documents[r.doc_id][0]
        assert r.doc_tokens == len(ids) // 4
        assert r.ids_crc32 == zlib.crc32(ids[4 * r.start:4 * (r.start + r.length)])
        by_sequence.setdefault(r.sequence_id, []).append(r)
        covered.setdefault(r.doc_id, []).extend(range(r.start, r.start + r.length))
    for key, times in documents.items():
        assert sorted(covered.pop(key)) == sorted(list(range(len(times[0]) // 4)) * len(times))
    assert not covered
    for pieces in by_sequence.values():
        at = 0
        for p in sorted(pieces, key=lambda p: p.offset):
            assert p.offset == at and p.length > 0
            at += p.length
        assert at == pieces[0].context <= 4096 and at & (at - 1) == 0


def test_words_are_encoded_as_whole_texts_are():
    tokenizer, encoder, r = Tokenizer.from_file(PATH), WordEncoder(PATH, most=50), random.Random(1)
    texts = ["it's we'll I'D", "naïve Éé é éa", "<|endoftext|>x a<|startoftext|>", "日本語 テスト123", "x y\tz\r\nq", "ǅ ŉ ß ẞ ª º µ İ ΣΑΣ", ""]
    texts += ["".join(r.choice("aÉßİıŉ'sﬁ1 2%́Σ\n\tǅª") for _ in range(40)) for _ in range(400)]
    want = [tokenizer.encode(t, add_special_tokens=False).ids for t in texts]
    assert encoder.encode_all(texts) == [struct.pack(f"<{len(i)}I", *i) for i in want]
    assert encoder.encode(" ".join(texts), chars=50) == encoder.encode_all([" ".join(texts)])[0]


def test_whole_table(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    tokenizer = Tokenizer.from_file(PATH)
    documents = {}
    for r in docs.collect():
        documents.setdefault(r.doc_id, []).append(ids_of(tokenizer, r.text))
    rows = pack_documents(docs, PATH).collect()
    check(rows, documents)
    groups = {}
    for r in rows:
        groups.setdefault((r.step_group, r.context), 0)
        groups[(r.step_group, r.context)] += r.length
    assert len({g for g, _ in groups}) == len(groups) and max(groups.values()) <= 64 * 4096


def test_odd_rows(spark, odd, none):
    tokenizer = Tokenizer.from_file(PATH)
    documents = {}
    for r in odd.collect():
        documents.setdefault(r.doc_id, []).append(ids_of(tokenizer, r.text))
    check(pack_documents(odd.repartition(3), PATH, block_tokens=1000).collect(), documents)
    assert pack_documents(none, PATH).count() == 0
    with pytest.raises(ValueError):
        pack_documents(odd, PATH, tiers=(500, 4096))


def test_gaps_of_long_windows_take_shorter_documents_and_groups_are_balanced():
    r = random.Random(2)
    packer = Packer((8, 16, 32), 128)
    docs = [Doc(i, b"\0" * 4 * r.randint(1, 90)) for i in range(300)]
    made = packer.pack(docs[:150], False) + packer.pack(docs[150:], True)
    assert sum(sum(p[2] for p in pieces) for _, pieces in made) == sum(d.tokens for d in docs)
    assert all(sum(p[2] for p in pieces) == size for size, pieces in made)
    assert {size for size, _ in made} >= {16, 32} and any(len(pieces) > 1 for size, pieces in made if size == 32)
    groups, load = packer.groups(made), {}
    for g, (size, pieces) in zip(groups, made, strict=True):
        load.setdefault(size, {}).setdefault(g, []).append(sum(p[2] ** 2 for p in pieces))
    counts = [len(c) for c in load[32].values()]
    assert max(counts) - min(counts) <= 1 and max(counts) * 32 <= 128


def test_a_worker_learns_its_words_once():
    import public_tokenizers

    path = public_tokenizers.path("word_bpe_49k.json")
    encoder = packing.remembered(path)
    first = encoder.encode_all(["some words", None])
    assert packing.remembered(path) is encoder and {"some", "words"} <= set(encoder.words)
    assert first == packing.WordEncoder(path).encode_all(["some words", None])
