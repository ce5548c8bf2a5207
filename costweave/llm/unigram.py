"""A unigram model over the pieces of a SentencePiece vocabulary.

The public vocabulary orders its pieces but has no probabilities, so a piece of rank r has one in proportion to
1 / (r + 2). A character that is no piece itself is written as the byte pieces of its UTF-8 form; a byte piece counts as
of the rank after the last. A text is read with a blank before it, as the vocabulary's own encoder reads it.
"""

from __future__ import annotations

import math
import re

#: A text's factors: blanks and then other characters. No piece reaches from one factor into the next.
FACTOR = re.compile(r" *[^ ]+| +\Z")


class Vocabulary:
    """Pieces with blanks in place of the sign that stands for them; ``by_id`` has the bytes that a piece stands for."""

    def __init__(self, path: str):
        from sentencepiece import SentencePieceProcessor

        model = SentencePieceProcessor(model_file=path)
        size = model.get_piece_size()
        normal = [i for i in range(size) if not (model.is_byte(i) or model.is_control(i) or model.is_unknown(i) or model.is_unused(i))]
        total = sum(1 / (r + 2) for r in range(len(normal) + 1))
        self.bytes = {int(model.id_to_piece(i)[3:-1], 16): i for i in range(size) if model.is_byte(i)}
        self.ids = {model.id_to_piece(i).replace("▁", " "): i for i in normal}
        self.logs = {model.id_to_piece(i).replace("▁", " "): -math.log((r + 2) * total) for r, i in enumerate(normal)}
        self.byte_log = -math.log((len(normal) + 2) * total)
        self.longest = max(map(len, self.ids), default=1)
        self.by_id = {i: p.encode() for p, i in self.ids.items()} | {i: bytes([b]) for b, i in self.bytes.items()}
        self.joined = {c for p in self.ids if len(p) > 1 for c in p}

    def edges(self, text: str, end: int) -> list[tuple[int, float, int]]:
        """(start, log-probability, pieces) of what may end at ``end``."""
        logs = self.logs
        found = [(i, logs[p], 1) for i in range(max(0, end - self.longest), end) if (p := text[i:end]) in logs]
        if not found or found[-1][0] != end - 1:
            n = len(text[end - 1].encode("utf-8", "surrogatepass"))
            found.append((end - 1, n * self.byte_log, n))
        return found

    def piece_ids(self, piece: str) -> list[int]:
        return [self.ids[piece]] if piece in self.ids else [self.bytes[b] for b in piece.encode("utf-8", "surrogatepass")]

    def decode(self, ids: list[int]) -> str:
        """The text of a sequence of ids; ids that stand for nothing are left out."""
        raw = b"".join(self.by_id.get(i, b"") for i in ids).decode("utf-8", "replace")
        return raw[1:] if raw.startswith(" ") else raw


def factors(text: str | None) -> list[str]:
    return FACTOR.findall(f" {text}") if text else []
