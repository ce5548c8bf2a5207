"""Hierarchical multi-length packing of tokenised documents.

Every task packs the documents of its own partition, so nothing is shuffled and no group is gathered. A document is
cut into full windows of the longest context size, and what remains is routed to the smallest context size ("tier")
that holds it. Tiers are packed from long to short: each window takes one document of its tier, and the gap behind it
is filled with whole documents of shorter tiers, the last of which is cut to fit. What a block leaves unfilled waits
for the next block; the end of a partition is cut into windows of decreasing powers of two, so no sequence is padded.
Sequences of one context size are then dealt to step groups of equal tokens and of nearly equal attention cost.
"""

from __future__ import annotations

import os
import string
import struct
import zlib
from bisect import bisect_right, insort
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import lru_cache

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame

from costweave.llm.tables import text_rows

PIECES = (
    "doc_id {key}, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long, "
    "context long, step_group long"
)
SIGNS = string.punctuation + string.digits


class WordEncoder:
    """Ids of whole texts as little-endian 32-bit bytes, from the encodings of distinct words.

    The tokenizer drops white space and never merges across it, so a text's ids are those of its words one after the
    other. It also splits letters from signs: a word that is letters and then ASCII signs is looked up as two. Letters
    of the Latin blocks are their own normal form, so they go to the tokenizer's model directly, in lower case and
    with each byte of theirs as the model's symbol; all else takes the whole tokenizer. The memory is emptied when it
    holds ``most`` words.
    """

    def __init__(self, path: str, most: int = 400_000):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer
        from tokenizers.pre_tokenizers import ByteLevel

        self.tokenizer, self.most = Tokenizer.from_file(path), most
        self.model, byte_level = self.tokenizer.model, ByteLevel(add_prefix_space=False, use_regex=False)
        letters = [chr(c) for c in range(0x80, 0x250)]
        self.symbols = str.maketrans({c: byte_level.pre_tokenize_str(c)[0][0] for c in letters if c.isalpha()})
        self.words: dict[str, bytes] = {"": b""}
        self.stems: dict[str, bytes] = {"": b""}
        self.tails: dict[str, bytes] = {"": b""}

    def _part(self, part: str) -> bytes | None:
        """The ids of letters of the Latin blocks, None for anything else."""
        part = part.lower()
        if not part.isascii():
            if max(part) >= "\u0250":
                return None
            part = part.translate(self.symbols)
        ids = [t.id for t in self.model.tokenize(part)]
        return struct.pack(f"<{len(ids)}I", *ids)

    def _learn(self, words: set[str]) -> None:
        if len(self.words) + len(words) > self.most:
            self.words = {"": b""}
        if len(self.stems) + len(self.tails) > self.most:
            self.stems, self.tails = {"": b""}, {"": b""}
        stems, tails, later = self.stems, self.tails, {}
        for w in words.difference(self.words):
            stem = w if w.isalpha() else w.rstrip(SIGNS)
            if not stem.isalpha():
                stem = ""
            tail = w[len(stem):]
            if stem not in stems:
                ids = self._part(stem)
                if ids is None:
                    stem, tail = "", w
                else:
                    stems[stem] = ids
            if tail in tails:
                self.words[w] = stems[stem] + tails[tail]
            else:
                later[w] = stem, tail
        missing = list({tail for _, tail in later.values()})
        for part, e in zip(missing, self.tokenizer.encode_batch_fast(missing, add_special_tokens=False), strict=True):
            tails[part] = struct.pack(f"<{len(e.ids)}I", *e.ids)
        for w, (stem, tail) in later.items():
            self.words[w] = stems[stem] + tails[tail]

    def encode_all(self, texts: list[str | None]) -> list[bytes]:
        cut = [(t or "").replace("\n", " ").split(" ") for t in texts]
        self._learn(set().union(*cut))
        return [b"".join(map(self.words.__getitem__, words)) for words in cut]

    def encode(self, text: str | None, chars: int = 1_000_000) -> bytes:
        """One very long text, in runs that end at a blank."""
        text, at, out = (text or "").replace("\n", " "), 0, []
        while at < len(text):
            end = text.find(" ", at + chars)
            end = len(text) if end < 0 else end
            out += self.encode_all([text[at:end]])
            at = end
        return b"".join(out)


@lru_cache(maxsize=1)
def remembered(path: str) -> WordEncoder:
    """The encoder of a Python worker, which serves one task after the other: its words are learnt once."""
    return WordEncoder(path)


@dataclass
class Doc:
    key: object
    ids: bytes

    @property
    def tokens(self) -> int:
        return len(self.ids) // 4


@dataclass
class Packer:
    """Pieces are (document, start, length); a sequence is a list of them."""

    tiers: tuple[int, ...]
    step_tokens: int
    waiting: list[tuple[Doc, int, int]] = field(default_factory=list)

    def pack(self, docs: list[Doc], last: bool) -> list[tuple[int, list]]:
        """(context, pieces) of the sequences that these documents and what waits fill exactly."""
        top, out = self.tiers[-1], []
        pools: dict[int, list[tuple[int, int, Doc, int]]] = {t: [] for t in self.tiers}

        def route(doc: Doc, start: int, length: int) -> None:
            tier = next(t for t in self.tiers if length <= t)
            insort(pools[tier], (length, next(order), doc, start), key=lambda x: x[:2])

        order = iter(range(1 << 60))
        for doc, start, length in [*self.waiting, *((d, 0, d.tokens) for d in docs)]:
            while length >= top:
                out.append((top, [(doc, start, top)]))
                start, length = start + top, length - top
            if length:
                route(doc, start, length)
        self.waiting = []
        for k in range(len(self.tiers) - 1, -1, -1):
            tier, pool = self.tiers[k], pools[self.tiers[k]]
            while pool:
                length, _, doc, start = pool.pop()
                window, gap = [(doc, start, length)], tier - length
                while gap:
                    fill = self._fill(pools, k, gap)
                    if fill is None:
                        break
                    length, _, doc, start = fill
                    if length > gap:
                        window.append((doc, start, gap))
                        route(doc, start + gap, length - gap)
                        gap = 0
                    else:
                        window.append((doc, start, length))
                        gap -= length
                if gap:
                    self.waiting += window
                else:
                    out.append((tier, window))
        if last:
            out += self._tail()
        return out

    def _fill(self, pools: dict, k: int, gap: int):
        """The longest document of this or a shorter tier that fits the gap, else one to be cut."""
        for tier in reversed(self.tiers[: k + 1]):
            if (at := bisect_right(pools[tier], gap, key=lambda x: x[0])) > 0:
                return pools[tier].pop(at - 1)
        for tier in self.tiers[: k + 1]:
            if pools[tier]:
                return pools[tier].pop(0)
        return None

    def _tail(self) -> list[tuple[int, list]]:
        """All that waits, cut into windows whose sizes are powers of two."""
        left, out = sum(n for _, _, n in self.waiting), []
        pieces = self.waiting[::-1]
        while left:
            size = min(self.tiers[-1], 1 << (left.bit_length() - 1))
            left, gap, window = left - size, size, []
            while gap:
                doc, start, length = pieces.pop()
                take = min(gap, length)
                window.append((doc, start, take))
                if take < length:
                    pieces.append((doc, start + take, length - take))
                gap -= take
            out.append((size, window))
        self.waiting = []
        return out

    def groups(self, sequences: list[tuple[int, list]]) -> list[int]:
        """A step group for each sequence: one context size, ``step_tokens`` tokens, and costs dealt to and fro."""
        of, first = [0] * len(sequences), 0
        by_size: dict[int, list[int]] = {}
        for i, (size, _) in enumerate(sequences):
            by_size.setdefault(size, []).append(i)
        for size, own in sorted(by_size.items()):
            n = -(-len(own) * size // self.step_tokens)
            own.sort(key=lambda i: (-sum(p[2] ** 2 for p in sequences[i][1]), i))
            for at, i in enumerate(own):
                turn, place = divmod(at, n)
                of[i] = first + (place if turn % 2 == 0 else n - 1 - place)
            first += n
        return of


def pack_documents(docs: DataFrame, tokenizer_path: str, key: str = "doc_id", text: str = "text", end_id: int = 2,
                   tiers: tuple[int, ...] = (512, 1024, 2048, 4096), block_tokens: int = 4_000_000,
                   step_tokens: int = 64 * 4096) -> DataFrame:
    """One row per piece of a document in a packed sequence.

    A document is its text's ids and then ``end_id``; null and empty texts are ``end_id`` alone. Repeated rows are
    packed as often as they occur, rows with a null key too; other columns are not read. An empty table gives no row.
    ``tiers`` are powers of two. Sequence and group numbers hold the partition's number, so they are unique.
    """
    if any(t & (t - 1) for t in tiers) or list(tiers) != sorted(tiers):
        raise ValueError("tiers must be increasing powers of two")
    kind = docs.schema[key].dataType.simpleString()
    names = [c.split()[0] for c in PIECES.format(key=kind).split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, packer = remembered(tokenizer_path), Packer(tuple(tiers), step_tokens)
        base = TaskContext.get().partitionId() << 36
        end, ended = end_id.to_bytes(4, "little"), {"sequence": base, "group": base}
        types = None

        def rows(docs: list[Doc], last: bool) -> Iterator[pa.RecordBatch]:
            sequences = packer.pack(docs, last)
            groups, out = packer.groups(sequences), []
            for (size, pieces), group in zip(sequences, groups, strict=True):
                offset = 0
                for doc, start, length in pieces:
                    crc = zlib.crc32(memoryview(doc.ids)[4 * start:4 * (start + length)])
                    out.append((doc.key, start, length, crc, doc.tokens, ended["sequence"], offset, size, ended["group"] + group))
                    offset += length
                ended["sequence"] += 1
            ended["group"] += max(groups, default=-1) + 1
            for at in range(0, len(out), 20_000):
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(zip(*out[at:at + 20_000], strict=True), types, strict=True)], names=names)

        block, held = [], 0
        for batch in batches:
            types = [batch.schema.field(key).type] + [pa.int64()] * 8
            for keys, texts in text_rows(batch, key, text):
                for k, ids in zip(keys, [encoder.encode(t) for t in texts] if len(texts) == 1 else encoder.encode_all(texts), strict=True):
                    block.append(Doc(k, ids + end))
                    held += block[-1].tokens
                if held >= block_tokens:
                    yield from rows(block, False)
                    block, held = [], 0
        if block or packer.waiting:
            yield from rows(block, True)

    return docs.select(key, text).mapInArrow(run, PIECES.format(key=kind).replace("doc_id", key, 1))
