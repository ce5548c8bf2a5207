"""Language identification by a byte convolutional network.

Filters of several widths slide over the bytes of a window, each filter keeps its largest response, and a softmax over
these gives the languages' probabilities. A text is cut into windows of a fixed length that overlap by the widest
filter less one byte, so every byte run of the whole text is seen; its probabilities are the mean over its windows,
weighted by their bytes. The network is trained in numpy on windows of a bounded sample of labelled texts.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from costweave.llm.tables import text_rows
from costweave.operators.quantiles import exact_quantiles
from costweave.session import cut_lineage

WIDTHS, FILTERS, WINDOW = (2, 3, 4), 8, 256
STEP = WINDOW - max(WIDTHS) + 1
LETTER = re.compile(r"[^\W\d_]")
NEVER = -1e4
UNKNOWN = "und"
#: No text needs more than the first score, nor more than the second where few texts tell what clean ones score.
ENOUGH, FEW = 0.5, 0.25
#: The least score that a text needs, by label and size of the text.
Least = dict[tuple[str, int], float]


def as_bytes(text: str) -> np.ndarray:
    return np.frombuffer(text.lower().encode("utf-8", "surrogatepass"), np.uint8)


def window_starts(n: int) -> np.ndarray:
    """Where the windows of a text of ``n`` bytes begin."""
    return np.arange(0, max(1, n - max(WIDTHS) + 1), STEP)


def windows(text: str, only: np.ndarray | None = None) -> np.ndarray:
    """Rows of ``WINDOW`` bytes, filled up with zeros."""
    x = as_bytes(text)
    padded = np.concatenate([x, np.zeros(WINDOW, np.uint8)])
    starts = window_starts(len(x)) if only is None else only
    return np.lib.stride_tricks.sliding_window_view(padded, WINDOW)[starts]


class Network:
    """``conv[width]`` is (width, 256, FILTERS); byte 0 fills up windows and ends every run.

    With ``strangers``, a last class beside the labels stands for what is in none of them.
    """

    def __init__(self, labels: list[str], seed: int = 1, strangers: bool = False):
        r = np.random.default_rng(seed)
        self.labels = labels
        self.conv = {k: r.normal(0, 0.3, (k, 256, FILTERS)).astype(np.float32) for k in WIDTHS}
        self.dense = r.normal(0, 0.3, (len(WIDTHS) * FILTERS, len(labels) + strangers)).astype(np.float32)
        self.bias = np.zeros(len(labels) + strangers, np.float32)

    def __getstate__(self) -> dict:
        return {n: v for n, v in self.__dict__.items() if n not in ("head", "third", "tail")}

    def prepare(self) -> None:
        """Responses by pairs of neighbouring bytes: a filter of width k is a sum over such pairs and single bytes."""
        end = np.zeros((256, 1), np.float32)
        end[0] = NEVER
        first = [self.conv[k][0] + end for k in WIDTHS]
        second = [self.conv[k][1] + end for k in WIDTHS]
        pair = lambda a, b: (a[:, None, :] + b[None, :, :]).reshape(256 * 256, -1)
        self.head = pair(np.concatenate(first, 1), np.concatenate(second, 1))
        self.third = self.conv[3][2] + end
        self.tail = pair(self.conv[4][2] + end, self.conv[4][3] + end)

    def responses(self, x: np.ndarray) -> list[np.ndarray]:
        """By width, (windows, positions, FILTERS)."""
        wide = x.astype(np.int32)
        pairs = wide[:, :-1] * 256 + wide[:, 1:]
        head, f = self.head[pairs], FILTERS
        return [head[:, :, :f], head[:, :-1, f:2 * f] + self.third[wide[:, 2:]], head[:, :-2, 2 * f:] + self.tail[pairs[:, 2:]]]

    def outcome(self, peaks: np.ndarray) -> np.ndarray:
        z = np.maximum(peaks, 0) @ self.dense + self.bias
        e = np.exp(z - z.max(axis=1, keepdims=True))
        return e / e.sum(axis=1, keepdims=True)

    def probabilities(self, x: np.ndarray, at_once: int = 128) -> np.ndarray:
        out = [np.empty((0, len(self.bias)), np.float32)]
        for i in range(0, len(x), at_once):
            out.append(self.outcome(np.concatenate([r.max(axis=1) for r in self.responses(x[i:i + at_once])], axis=1)))
        return np.concatenate(out)

    def _weights(self) -> list[np.ndarray]:
        return [*(self.conv[k] for k in WIDTHS), self.dense, self.bias]

    def train(self, x: np.ndarray, y: np.ndarray, epochs: int = 6, batch: int = 64, rate: float = 0.01, seed: int = 2) -> None:
        """Adam on the cross entropy; a window's gradient reaches the bytes under its filters' largest responses."""
        r = np.random.default_rng(seed)
        moments = [(np.zeros_like(w), np.zeros_like(w)) for w in self._weights()]
        steps = 0
        for _ in range(epochs):
            order = r.permutation(len(x))
            for i in range(0, len(order), batch):
                rows = x[order[i:i + batch]]
                found = self.changing(rows)
                best = [f.argmax(axis=1) for f in found]
                peaks = np.concatenate([np.take_along_axis(f, b[:, None, :], 1)[:, 0] for f, b in zip(found, best, strict=True)], axis=1)
                p = self.outcome(peaks)
                p[np.arange(len(rows)), y[order[i:i + batch]]] -= 1
                p /= len(rows)
                back = (p @ self.dense.T) * (peaks > 0)
                grads = []
                for n, k in enumerate(WIDTHS):
                    g = np.zeros_like(self.conv[k])
                    part = back[:, n * FILTERS:(n + 1) * FILTERS]
                    for j in range(k):
                        byte = np.take_along_axis(rows, best[n] + j, axis=1)
                        np.add.at(g[j], (byte, np.arange(FILTERS)[None, :]), part)
                    grads.append(g)
                grads += [np.maximum(peaks, 0).T @ p, p.sum(axis=0)]
                steps += 1
                for w, g, (m, v) in zip(self._weights(), grads, moments, strict=True):
                    m += 0.1 * (g - m)
                    v += 0.001 * (g * g - v)
                    w -= rate * (m / (1 - 0.9**steps)) / (np.sqrt(v / (1 - 0.999**steps)) + 1e-8)
        self.prepare()

    def changing(self, x: np.ndarray) -> list[np.ndarray]:
        """The same responses while the filters still change."""
        end = np.zeros((256, 1), np.float32)
        end[0] = NEVER
        out = []
        for k in WIDTHS:
            n = x.shape[1] - k + 1
            total = (self.conv[k][0] + end)[x[:, :n]]
            for j in range(1, k):
                total = total + (self.conv[k][j] + end)[x[:, j:j + n]]
            out.append(total)
        return out


def _sample(docs: DataFrame, key: str, text: str, label: str, per_label: int, per_text: int, most_labels: int) -> tuple[np.ndarray, list[str]]:
    """Windows and labels of about ``per_label`` texts of each label, by a hash of the key."""
    learn = docs.where(F.col(label).isNotNull() & F.col(text).isNotNull())
    counts = learn.groupBy(label).count()
    per_label = max(1, per_label * most_labels // max(most_labels, counts.count()))
    place = F.pmod(F.xxhash64(key, F.lit(5)), F.lit(1 << 30))
    chosen = learn.select(key, text, label, place.alias("place")).join(F.broadcast(counts), label).where(
        F.col("place") * F.col("count") < per_label * (1 << 30))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for (label_of, place_of), texts in _runs(batch, label, text):
                names, places, rows = [], [], []
                for name, at, t in zip(label_of, place_of, texts, strict=True):
                    if LETTER.search(t):
                        starts = window_starts(len(as_bytes(t)))
                        only = starts if len(starts) <= per_text else starts[np.linspace(0, len(starts) - 1, per_text).astype(int)]
                        own = windows(t, only)
                        names += [name] * len(own)
                        places += [at] * len(own)
                        rows += [w.tobytes() for w in own]
                yield pa.RecordBatch.from_arrays([pa.array(names, pa.string()), pa.array(places, pa.int64()), pa.array(rows, pa.binary())], names=["label", "place", "bytes"])

    got = chosen.select(label, "place", text).mapInArrow(cut, "label string, place long, bytes binary").toArrow().sort_by(
        [("label", "ascending"), ("place", "ascending"), ("bytes", "ascending")])
    rows = np.frombuffer(b"".join(got["bytes"].to_pylist()), np.uint8).reshape(-1, WINDOW)
    return rows, got["label"].to_pylist()


def _runs(batch: pa.RecordBatch, label: str, text: str) -> Iterator[tuple[tuple[list, list], list]]:
    at = 0
    for names, texts in text_rows(batch, label, text):
        yield (names, batch.column("place").slice(at, len(names)).to_pylist()), texts
        at += len(names)


def fit(docs: DataFrame, key: str = "doc_id", text: str = "text", label: str = "lang", per_label: int = 1200,
        per_text: int = 4, most_labels: int = 256, strangers: bool = False) -> Network | None:
    """The network of a sample of the labelled rows, None if no labelled text has a letter.

    The sample is about ``per_label`` texts of each label, fewer of each where there are more than ``most_labels``
    labels, so that it stays as large as for so many; of each text it has ``per_text`` windows, spread over the whole text. A third of the windows is cut short, so that short texts are learnt.
    With ``strangers``, the network also learns a class of what is in no language (see :func:`_strangers`).
    """
    rows, names = _sample(docs, key, text, label, per_label, per_text, most_labels)
    if not len(rows):
        return None
    rows, r = rows.copy(), np.random.default_rng(3)
    for i in np.flatnonzero(r.random(len(rows)) < 1 / 3):
        rows[i, int(r.integers(8, 80)):] = 0
    labels = sorted(set(names))
    at = {name: i for i, name in enumerate(labels)}
    network, classes = Network(labels, strangers=strangers), np.array([at[name] for name in names])
    if strangers:
        more = _strangers(rows[r.permutation(len(rows))[:max(1, len(rows) // 2)]], r)
        rows, classes = np.concatenate([rows, more]), np.append(classes, [len(labels)] * len(more))
    network.train(rows, classes)
    return network


def _strangers(rows: np.ndarray, r: np.random.Generator) -> np.ndarray:
    """Windows as long as the given ones: by turns their bytes shuffled, random Latin letters, and letters of a random script."""
    out = rows.copy()
    for i, row in enumerate(out):
        n = int((row != 0).sum())
        if i % 3 == 0:
            row[:n] = r.permutation(row[row != 0])
        elif i % 3 == 1:
            row[:n] = r.choice(np.frombuffer(b"abcdefghijklmnopqrstuvwxyz    ", np.uint8), n)
        else:
            script = int(r.integers(0x100, 0x9F00))
            letters = "".join(" " if x < 8 else chr(script + x) for x in r.integers(0, 48, n).tolist())
            row[:n] = np.frombuffer(letters.encode()[:n], np.uint8)
    return out


class Judge:
    """A network in a task: the language and score of each text of a run."""

    def __init__(self, network: Network | None):
        self.network = network
        if network:
            network.prepare()

    def __call__(self, texts: list[str | None]) -> tuple[list[str], np.ndarray]:
        names, scores = [UNKNOWN] * len(texts), np.zeros(len(texts))
        found = [self.network is not None and t is not None and LETTER.search(t) is not None for t in texts]
        own = np.flatnonzero(found)
        if len(own):
            cut = [windows(texts[i]) for i in own]
            firsts = np.concatenate([[0], np.cumsum([len(c) for c in cut])[:-1]])
            rows = np.concatenate(cut)
            sizes = np.maximum((rows != 0).sum(axis=1), 1).astype(float)
            p = self.network.probabilities(rows) * sizes[:, None]
            p = np.add.reduceat(p, firsts) / np.add.reduceat(sizes, firsts)[:, None]
            p = p[:, :len(self.network.labels)]
            for i, best, score in zip(own, p.argmax(axis=1), p.max(axis=1), strict=True):
                names[i], scores[i] = self.network.labels[best], min(1.0, float(score))
        return names, scores


def identify(docs: DataFrame, network: Network | None, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, lang_pred, score) for every row.

    A null text, or one without a letter, is ``und`` with score 0, and so is every text when nothing was learnt. Equal
    probabilities go to the first label in alphabetical order. Repeated rows get equal results; a null key is kept;
    other columns are not read.
    """
    kind = docs.schema[key].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        judge = Judge(network)
        for batch in batches:
            for keys, texts in text_rows(batch, key, text):
                names, scores = judge(texts)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(keys, batch.schema.field(key).type), pa.array(names), pa.array(scores)], names=[key, "lang_pred", "score"])

    return docs.select(key, text).mapInArrow(run, f"`{key}` {kind}, lang_pred string, score double")


def _size(text: str | None) -> int:
    """0 for a text of one window, else 1: short texts score lower."""
    return int(len(as_bytes(text or "")) > WINDOW)


def fit_rejecting(docs: DataFrame, key: str = "doc_id", text: str = "text", label: str = "lang", per_label: int = 1200,
                  tail: float = 0.005, fewest: int = 20) -> tuple[Network | None, Least]:
    """A network with a class of strangers, and by label and size the least score of a text of that language.

    A fifth of the texts, by their hash so that copies stay together, is not trained on. The least score is the
    quantile ``tail`` of the scores of all of these texts of a label, those that were named rightly,
    and at most ``ENOUGH``; ``per_label`` bounds the texts that the network is trained on. A label with too few of them for this quantile takes four fifths of the quantile over all
    labels; where even all labels have fewer than ``fewest`` texts of a size, it is ``FEW``, and where they have fewer
    of both sizes together, nothing is rejected by its score.
    """
    held = F.pmod(F.xxhash64(text, F.lit(13)), F.lit(5)) == 0
    network = fit(docs.where(~held), key, text, label, per_label, strangers=True)
    if network is None:
        return None, {}
    learn = docs.where(held & F.col(label).isNotNull() & F.col(text).isNotNull()).select(label, text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        judge = Judge(network)
        for batch in batches:
            for own, texts in text_rows(batch, label, text):
                names, scores = judge(texts)
                rows = [(n, _size(t), s) for o, t, n, s in zip(own, texts, names, scores, strict=True) if n == o]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([r[i] for r in rows], kind) for i, kind in enumerate((pa.string(), pa.int32(), pa.float64()))],
                    names=["label", "size", "score"])

    # Only numbers and quantiles by label and size leave the tasks.
    got = cut_lineage(learn.mapInArrow(run, "label string, size int, score double"))
    counts = {(r["label"], r["size"]): r["n"] for r in got.groupBy("label", "size").agg(F.count(F.lit(1)).alias("n")).collect()}
    by_label = {(r["label"], r["size"]): r["low"] for r in exact_quantiles(got, ["label", "size"], "score", {}, lower={"low": tail}).collect()}
    by_size = {r["size"]: r["low"] for r in exact_quantiles(got, ["size"], "score", {}, lower={"low": tail}).collect()}
    least: Least = {}
    for size in (0, 1):
        of_size = sum(n for (_, s), n in counts.items() if s == size)
        shared = 0.8 * min(ENOUGH, by_size[size]) if of_size >= fewest else FEW if sum(counts.values()) >= fewest else 0.0
        for name in network.labels:
            enough = counts.get((name, size), 0) * tail >= 1
            least[name, size] = min(ENOUGH, by_label[name, size]) if enough else shared
    return network, least


def keep_identified(docs: DataFrame, network: Network | None, text: str = "text", least: Least | None = None) -> DataFrame:
    """The rows, with all their columns, whose text is in one of the learnt languages; nothing is shuffled.

    With ``least`` (see :func:`fit_rejecting`), a text that scores lower is in none of them.
    """
    bound = least or {}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        judge = Judge(network)
        for batch in batches:
            keep = []
            for _, texts in text_rows(batch, text, text):
                names, scores = judge(texts)
                keep += [n != UNKNOWN and s >= bound.get((n, _size(t)), 0.0) for n, s, t in zip(names, scores, texts, strict=True)]
            yield batch.filter(pa.array(keep, pa.bool_()))

    return docs.mapInArrow(run, docs.schema)
