"""Toxicity from class-conditional Kneser-Ney language models.

Every word counts whole, with its stem (its first four letters) as the order below: a class gives a word the share that
its counts give it, less an absolute discount that goes to the word's stem; a stem has the share that its counts give it,
less a discount that goes to a backoff shared by both classes: the number of distinct words of the stem anywhere in the
corpus, over which a stem's share is spread evenly. Two words of one stem are so told apart by what the labelled texts say
of each, an inflected or rare form of a toxic expression is judged by its stem, and what is rare in both classes adds
nothing. Scripts without blanks are read in overlapping pairs of characters. A toxic text is mostly ordinary words, so its
likelihood mixes the ordinary model with a small share of the toxic one; repeated ordinary passages then cannot outvote
what is toxic beside them. The two log-likelihoods are compared per word, and a logistic curve, fitted on labelled texts
that were held out of the counts, turns difference and length into a score. (Class counts of word pairs were tried on the
rows that may be learnt from; they add more noise than they find.)

Words are counted under 64 bits of their hash in tables that grow with the corpus: a task adds up its documents and sends
its table in blocks, the blocks of one hash range are merged as a stream and written. The distinct words cover all
documents, the class counts all labelled documents. What a word adds to a text depends on the word alone, in whole units;
these values are broadcast up to a counted size, more of them are joined to the distinct words of the texts.
"""

from __future__ import annotations

import re
from array import array
from collections.abc import Iterator
from itertools import chain
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from costweave.functions.sizing import BROADCAST_BYTES, is_bounded, parts_for
from costweave.llm.tables import text_rows
from costweave.session import cut_lineage

WORD = re.compile(r"[^\W\d_]+")
#: Letters of scripts that are written without blanks between words: Thai to Lao, Burmese, Khmer, Kana, Han.
UNSPACED = re.compile("[\u0e00-\u0eff\u1000-\u109f\u1780-\u17ff\u3040-\u30ff\u3400-\u4dbf\u4e00-\u9fff\uf900-\ufaff\U00020000-\U0003ffff]+")
STEM = 4
BLOCKS = 512
#: A task sends its counts and starts anew beyond so many words.
TASK_WORDS = 500_000
#: Values of more words and stems than this are not broadcast.
MODEL_KEYS = 4_000_000
#: More labels than this are not broadcast.
LABEL_ROWS = 1_000_000
#: The share of the stems' counts that the discounts take, the toxic share of a toxic text, and the length at which a longer text no longer counts for more.
BACKOFF, MIXED, MOST_WORDS = 0.03, 0.02, 200
#: What a word adds is a whole number of these, so that sums do not depend on their order.
VALUE_UNIT = 2.0 ** -32


def _hash(text: str) -> int:
    return xxhash.xxh3_64_intdigest(text.encode("utf-8", "surrogatepass"))


def words_of(text: str | None) -> list[str]:
    """The words of a whole text in lower case."""
    found = WORD.findall((text or "").lower())
    if not text or text.isascii() or not UNSPACED.search(text):
        return found
    out: list[str] = []
    for word in found:
        last = 0
        for run in UNSPACED.finditer(word):
            out += [word[last:run.start()]] * (run.start() > last)
            out += [word[i:i + 2] for i in range(run.start(), max(run.end() - 1, run.start() + 1))] if len(run[0]) > 1 else [run[0]]
            last = run.end()
        out += [word[last:]] * (len(word) > last)
    return out


class Slots(dict):
    """Numbers of words, with the hashes of each word and of its stem; beyond ``most`` words they are forgotten between runs."""

    def __init__(self, most: int = 150_000):
        super().__init__()
        self.most, self.words, self.stems = most, array("Q"), array("Q")

    def __missing__(self, word: str) -> int:
        self[word] = n = len(self.words)
        self.words.append(_hash(word))
        self.stems.append(_hash(word[:STEM]))
        return n

    def make_room(self) -> None:
        if len(self) >= self.most:
            self.clear()
            self.words, self.stems = array("Q"), array("Q")


class Words:
    """The words of a run of texts, one text after the other, as places among the hashes of the distinct ones."""

    def __init__(self, texts: list[str | None], slots: Slots):
        slots.make_room()
        found = [words_of(t) for t in texts]
        self.counts = np.fromiter(map(len, found), np.int64, len(found))
        numbers = np.fromiter(map(slots.__getitem__, chain.from_iterable(found)), np.int64, int(self.counts.sum()))
        used = np.flatnonzero(np.bincount(numbers, minlength=len(slots)))
        place = np.zeros(len(slots), np.int64)
        place[used] = np.arange(len(used))
        self.at = place[numbers]
        self.word, self.stem = (np.array(x, np.uint64).view(np.int64)[used] for x in (slots.words, slots.stems))


class Tables:
    """Counts of words by class, in the order of their hashes; a word that no labelled text holds has the counts 0."""

    def __init__(self) -> None:
        self._rows = np.zeros((4, 0), np.int64)  # word, stem, counts of class 0 and 1
        self._new: list[np.ndarray] = []

    def add(self, w: Words, classes: list[int | None]) -> None:
        kind = np.repeat(np.array([-1 if c is None else c for c in classes], np.int64), w.counts)
        self._take(np.stack([w.word, w.stem, *(np.bincount(w.at[kind == c], minlength=len(w.word)) for c in (0, 1))]))

    def _take(self, rows: np.ndarray) -> None:
        self._new.append(rows)
        if sum(x.shape[1] for x in self._new) > max(TASK_WORDS, self._rows.shape[1]):
            self.rows()

    def rows(self) -> np.ndarray:
        if self._new:
            x = np.concatenate([self._rows, *self._new], axis=1)
            x = x[:, np.argsort(x[0], kind="stable")]
            first = np.flatnonzero(np.concatenate([[True], x[0, 1:] != x[0, :-1]])[:x.shape[1]])
            self._rows = np.concatenate([x[:2, first], np.add.reduceat(x[2:], first, axis=1)]) if len(first) else x
            self._new = []
        return self._rows

    def _by_stem(self) -> tuple[np.ndarray, np.ndarray]:
        return np.unique(self.rows()[1], return_inverse=True)

    @property
    def stems(self) -> np.ndarray:
        """Counts of stems by class."""
        stems, at = self._by_stem()
        return np.stack([np.bincount(at, n, len(stems)).astype(np.int64) for n in self.rows()[2:]])

    @property
    def rests_of(self) -> np.ndarray:
        """Distinct words of stems."""
        stems, at = self._by_stem()
        return np.bincount(at, minlength=len(stems))

    def blocks(self) -> Iterator[tuple[int, bytes]]:
        """The words of each range of hashes; empty ones are left out."""
        rows = self.rows()
        ends = np.searchsorted(rows[0], [(b - BLOCKS // 2) * ((1 << 64) // BLOCKS) for b in range(1, BLOCKS)])
        for b, own in enumerate(np.split(rows, ends, axis=1)):
            if own.shape[1]:
                yield b, own.tobytes()

    def merge(self, b: int, data: bytes) -> None:
        self._take(np.frombuffer(data, np.int64).reshape(4, -1))


def _discount(seen: np.ndarray, n: np.ndarray, share: float) -> float:
    low, high = 0.0, float(seen.max(initial=1))
    for _ in range(60):
        mid = (low + high) / 2
        low, high = (mid, high) if (np.minimum(seen, mid) * n).sum() < share * (seen * n).sum() else (low, mid)
    return high


def discount(counts: np.ndarray, share: float) -> float:
    """The discount that takes ``share`` of all that is counted, when no count gives more than it has."""
    return _discount(*np.unique(counts[counts > 0], return_counts=True), share)


class Shares(NamedTuple):
    """What the models need of all counts; the first three by class.

    Both classes give the same share of their stems' counts to the shared backoff, though one has far fewer texts: each
    stem discount follows from that share. A word's discount is Ney's estimate from the words seen once and twice.
    """

    total: list[int]
    of_stem: list[float]
    of_word: list[float]
    kinds: list[int]  # distinct words
    shared: float

    @classmethod
    def of(cls, total, stem_discounts, once, twice, kinds, shared) -> Shares:
        return cls(total, stem_discounts, [(a + 0.5) / (a + 2 * b + 1) for a, b in zip(once, twice, strict=True)], kinds, shared)

    def stems(self, counts: np.ndarray, rests: np.ndarray) -> np.ndarray:
        return np.stack([
            np.maximum(counts[c] - self.of_stem[c], 0) / max(self.total[c], 1) + (BACKOFF if self.total[c] else 1) * (rests + 0.5) / self.shared
            for c in (0, 1)])

    def left(self, c: int) -> float:
        """The share of a class that its words leave to their stems."""
        return self.kinds[c] * self.of_word[c] / self.total[c] if self.total[c] else 1.0

    def words(self, counts: np.ndarray, stems: np.ndarray, rests: np.ndarray) -> np.ndarray:
        return np.stack([
            np.maximum(counts[c] - self.of_word[c], 0) / max(self.total[c], 1) + self.left(c) * stems[c] / rests for c in (0, 1)])

    @staticmethod
    def values(p: np.ndarray) -> np.ndarray:
        return np.rint(np.log1p(MIXED * (p[1] / p[0] - 1)) / VALUE_UNIT).astype(np.int64)

    def values_of_words(self, counts: np.ndarray, of_stem: np.ndarray, rests: np.ndarray) -> np.ndarray:
        return self.values(self.words(counts, self.stems(of_stem, rests), rests))

    def values_of_stems(self, counts: np.ndarray, rests: np.ndarray) -> np.ndarray:
        """Of words of these stems that no labelled text holds."""
        return self.values(self.words(np.zeros_like(counts), self.stems(counts, rests), rests))

    def value_of_others(self) -> int:
        return int(self.values_of_stems(np.zeros((2, 1)), np.ones(1))[0])


class Models:
    """What each word adds to the difference, by the hash of the word, or of its stem where no labelled text has the word."""

    def __init__(self, t: Tables):
        rows, (stems, at) = t.rows(), t._by_stem()
        counts, rests, n = t.stems, t.rests_of, rows[2:]
        shares = Shares.of(counts.sum(axis=1).tolist(), [discount(x, BACKOFF) for x in counts], (n == 1).sum(axis=1).tolist(),
                           (n == 2).sum(axis=1).tolist(), (n > 0).sum(axis=1).tolist(), float((rests + 0.5).sum()))
        known, seen = n.any(axis=0), counts.any(axis=0)
        self.keep((rows[0, known], shares.values_of_words(n[:, known], counts[:, at[known]], rests[at[known]])),
                  (stems[seen], shares.values_of_stems(counts[:, seen], rests[seen])), shares.value_of_others())

    @classmethod
    def gathered(cls, words: DataFrame, stems: DataFrame, other: int) -> Models:
        """From (key, value) rows of a counted, bounded number."""
        models = cls.__new__(cls)
        models.keep(*([x.column(c).to_numpy() for c in ("key", "value")] for x in (words.toArrow(), stems.toArrow())), other)
        return models

    def keep(self, words, stems, other: int) -> None:
        self.tables = [(k[order], v[order]) for k, v in (words, stems) for order in [np.argsort(k)]]
        self.other = other

    def differences(self, w: Words) -> np.ndarray:
        """Per text, the difference of log-likelihoods (toxic less ordinary) per word; 0 without words."""
        value = np.full(len(w.word), self.other, np.int64)
        for (keys, values), own in zip(self.tables[::-1], (w.stem, w.word), strict=True):
            if len(keys):
                at = np.minimum(np.searchsorted(keys, own), len(keys) - 1)
                value = np.where(keys[at] == own, values[at], value)
        ends = np.cumsum(w.counts)
        sums = np.concatenate([[0], np.cumsum(value[w.at])])
        return (sums[ends] - sums[ends - w.counts]) * VALUE_UNIT / np.maximum(w.counts, 1)


def _features(d: np.ndarray, n: np.ndarray) -> np.ndarray:
    return np.stack([np.ones_like(d), d * np.sqrt(np.minimum(n, MOST_WORDS))], axis=-1)


#: Sums are added up in whole units of this size, so that they do not depend on the order of rows or tasks.
UNIT = 2.0 ** -40


def fit_curve(held: DataFrame, steps: int = 40, ridge: float = 1e-2) -> np.ndarray:
    """Weights of a logistic regression over (class, difference, words), by Newton's method: each step is one
    aggregation of the gradient and the curvature, so the rows never leave the executors."""
    x = F.col("difference") * F.sqrt(F.least(F.col("words"), F.lit(MOST_WORDS)).cast("double"))
    rows = cut_lineage(held.select(F.col("class").cast("double").alias("y"), x.alias("x")))
    w = np.zeros(2)
    for _ in range(steps):
        z = F.greatest(F.lit(-30.0), F.least(F.lit(30.0), F.lit(float(w[0])) + F.lit(float(w[1])) * F.col("x")))
        p = 1 / (1 + F.exp(-z))
        terms = rows.select("x", (p - F.col("y")).alias("r"), (p * (1 - p)).alias("v"))
        cells = {"g0": F.col("r"), "g1": F.col("r") * F.col("x"), "h00": F.col("v"), "h01": F.col("v") * F.col("x"),
                 "h11": F.col("v") * F.col("x") * F.col("x")}
        t = terms.agg(*[F.sum(F.round(c / UNIT).cast("decimal(28,0)")).alias(n) for n, c in cells.items()]).first()
        t = {n: float(t[n] or 0) * UNIT for n in cells}
        grad = np.array([t["g0"], t["g1"]]) + ridge * w
        step = np.linalg.solve(np.array([[t["h00"], t["h01"]], [t["h01"], t["h11"]]]) + ridge * np.eye(2), grad)
        w = w - np.clip(step, -3, 3)
        if np.abs(step).max() < 1e-9:
            break
    return w


class Counted:
    """The written counts of all words and of their stems."""

    def __init__(self, words: DataFrame):
        self.words = words
        self.by_stem = cut_lineage(words.groupBy("stem").agg(
            F.sum("n0").alias("s0"), F.sum("n1").alias("s1"), F.count(F.lit(1)).alias("rests")))

    @property
    def stems(self) -> np.ndarray:
        """Counts of stems by class, gathered."""
        rows = self.by_stem.select("s0", "s1").toArrow()
        return np.stack([rows.column(c).to_numpy() for c in ("s0", "s1")])

    def shares(self) -> Shares:
        def count(when: str) -> list[Column]:
            return [F.count_if(F.expr(f"n{c} {when}")).alias(f"{when}{c}") for c in (0, 1)]

        t = self.words.agg(F.sum("n0"), F.sum("n1"), *count("= 1"), *count("= 2"), *count("> 0")).first()
        total, once, twice, kinds = ([int(x or 0) for x in t[i:i + 2]] for i in (0, 2, 4, 6))
        shared = self.by_stem.agg(F.sum("rests") + F.count(F.lit(1)) * 0.5).first()[0]
        seen = self.by_stem.select(F.inline(F.array(*(F.struct(F.lit(c).alias("c"), F.col(f"s{c}").alias("s")) for c in (0, 1))))).where("s > 0")
        # How many stems have a count: as many rows as there are different counts.
        kept = [(r["c"], r["s"], r["n"]) for r in seen.groupBy("c", "s").agg(F.count(F.lit(1)).alias("n")).collect()]
        stem_discounts = [_discount(*(np.array([r[i] for r in kept if r[0] == c], np.float64) for i in (1, 2)), BACKOFF) for c in (0, 1)]
        return Shares.of(total, stem_discounts, once, twice, kinds, float(shared or 1))

    def values(self) -> tuple[DataFrame, DataFrame, int]:
        """(key, value) of the words and of the stems in labelled texts, and the value of all other words."""
        shares = self.shares()

        def cells(batch: pa.RecordBatch, *names: str) -> np.ndarray:
            return np.stack([batch.column(n).to_numpy() for n in names])

        def of_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for x in batches:
                value = shares.values_of_words(cells(x, "n0", "n1"), cells(x, "s0", "s1"), cells(x, "rests")[0])
                yield pa.RecordBatch.from_arrays([x.column("word"), pa.array(value)], names=["key", "value"])

        def of_stems(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for x in batches:
                value = shares.values_of_stems(cells(x, "s0", "s1"), cells(x, "rests")[0])
                yield pa.RecordBatch.from_arrays([x.column("stem"), pa.array(value)], names=["key", "value"])

        words = self.words.where("n0 + n1 > 0").join(self.by_stem, "stem").select("word", "n0", "n1", "s0", "s1", "rests")
        stems = self.by_stem.where("s0 + s1 > 0").select("stem", "s0", "s1", "rests")
        schema = "key long, value long"
        return (*(cut_lineage(x.mapInArrow(f, schema)) for x, f in ((words, of_words), (stems, of_stems))), shares.value_of_others())


def _tally(docs: DataFrame, text: str) -> Counted:
    def batch_of(tables: Tables) -> Iterator[pa.RecordBatch]:
        for b, data in tables.blocks():
            yield pa.RecordBatch.from_pydict({"block": pa.array([b], pa.int32()), "data": pa.array([data], pa.binary())})

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tables, slots = Tables(), Slots()
        for batch in batches:
            for classes, texts in text_rows(batch, "class", text):
                tables.add(Words(texts, slots), classes)
                if tables.rows().shape[1] > TASK_WORDS:
                    yield from batch_of(tables)
                    tables = Tables()
        yield from batch_of(tables)

    def merged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tables = Tables()
        for batch in batches:
            for b, data in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                tables.merge(b, data.as_py())
        rows = tables.rows()
        for i in range(0, rows.shape[1], 100_000):
            yield pa.RecordBatch.from_arrays([pa.array(x[i:i + 100_000]) for x in rows], names=["word", "stem", "n0", "n1"])

    blocks = docs.select("class", text).mapInArrow(count, "block int, data binary").repartition(parts_for(docs, least=16), "block")
    return Counted(cut_lineage(blocks.mapInArrow(merged, "word long, stem long, n0 long, n1 long")))


class Joined:
    """Values of more words than are broadcast: the distinct words of the texts are joined to them."""

    def __init__(self, words: DataFrame, stems: DataFrame, other: int):
        self.words, self.stems, self.other = words, stems, other

    def differences(self, docs: DataFrame, text: str) -> DataFrame:
        """(digest, difference, words) of every text that has words; see :func:`_digest`."""

        def spell(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            slots = Slots()
            for batch in batches:
                for digests, texts in text_rows(batch, "digest", text, 200_000):
                    w = Words(texts, slots)
                    of = np.repeat(np.arange(len(texts)), w.counts)
                    both, n = np.unique(of * max(len(w.word), 1) + w.at, return_counts=True)
                    row, at = np.divmod(both, max(len(w.word), 1))
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(digests, pa.string()).take(pa.array(row)), pa.array(w.word[at]), pa.array(w.stem[at]), pa.array(n), pa.array(w.counts[row])],
                        names=["digest", "word", "stem", "n", "words"])

        spelt = docs.select(_digest(text).alias("digest"), text).mapInArrow(spell, "digest string, word long, stem long, n long, words long")
        of_word, of_stem = (x.select(F.col("key").alias(k), F.col("value").alias(f"of_{k}")) for x, k in ((self.words, "word"), (self.stems, "stem")))
        value = F.coalesce("of_word", "of_stem", F.lit(self.other))
        # Copies of a text add to both sums alike.
        return spelt.join(of_word, "word", "left").join(of_stem, "stem", "left").groupBy("digest").agg(
            (F.sum(value * F.col("n")) * VALUE_UNIT / F.sum("n")).alias("difference"), F.max("words").alias("words"))

    def scored(self, docs: DataFrame, text: str, curve: np.ndarray) -> DataFrame:
        """The rows of ``docs`` with the column ``__toxicity``."""
        x = F.col("difference") * F.sqrt(F.least(F.col("words"), F.lit(MOST_WORDS)).cast("double"))
        z = F.coalesce(F.lit(float(curve[0])) + F.lit(float(curve[1])) * x, F.lit(float(curve[0])))
        scores = self.differences(docs, text).select(F.col("digest").alias("__digest"), (1 / (1 + F.exp(-z))).alias("__toxicity"))
        none = float(1 / (1 + np.exp(-curve[0])))
        return docs.withColumn("__digest", _digest(text)).join(scores, "__digest", "left").drop("__digest").withColumn(
            "__toxicity", F.coalesce("__toxicity", F.lit(none)))


def _digest(text: str) -> Column:
    return F.md5(F.coalesce(F.col(text), F.lit("")).cast("binary"))


class Scorer:
    """Models and curve in a task: a score of 0 to 1 for each text of a run."""

    def __init__(self, models: Models, curve: np.ndarray):
        self.models, self.curve, self.slots = models, curve, Slots()

    def __call__(self, texts: list[str | None]) -> np.ndarray:
        w = Words(texts, self.slots)
        z = _features(self.models.differences(w), w.counts.astype(float)) @ self.curve
        return 1 / (1 + np.exp(-np.clip(z, -500, 500)))


def fit(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", label: str = "toxic") -> tuple[Broadcast | Joined, np.ndarray]:
    """The models, sent to all executors once or written to be joined, and the curve.

    ``labels`` holds the rows to learn from and nothing else, and all of them count; a key labelled twice counts as
    toxic if one label says so, null labels and keys are left out. A fifth of the labelled texts, by a hash of the key,
    fits the curve and is not counted. Where nothing was labelled, all scores are equal. Labels, and values of words, of
    a counted, bounded size are broadcast; more of them are joined by a shuffle.
    """
    known = labels.where(F.col(label).isNotNull() & F.col(key).isNotNull()).groupBy(key).agg(F.max(label).cast("int").alias("class"))
    known = known.withColumn("fit", F.pmod(F.xxhash64(key, F.lit(11)), F.lit(5)) == 0)
    if is_bounded(known, LABEL_ROWS, BROADCAST_BYTES):
        known = F.broadcast(known)
    marked = docs.select(key, text).join(known, key, "left")
    words, stems, other = _tally(marked.withColumn("class", F.when(~F.col("fit"), F.col("class"))), text).values()
    held = marked.where("fit AND class IN (0, 1)").select("class", text)
    if words.count() + stems.count() > MODEL_KEYS:
        joined = Joined(words, stems, other)
        of_text = held.select("class", _digest(text).alias("digest")).join(joined.differences(held, text), "digest", "left")
        return joined, fit_curve(of_text.select("class", F.coalesce("difference", F.lit(0.0)).alias("difference"), F.coalesce("words", F.lit(0)).alias("words")))
    given = docs.sparkSession.sparkContext.broadcast(Models.gathered(words, stems, other))

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model, slots = given.value, Slots()
        for batch in batches:
            for classes, texts in text_rows(batch, "class", text):
                w = Words(texts, slots)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(classes, pa.int32()), pa.array(model.differences(w)), pa.array(w.counts)], names=["class", "difference", "words"])

    return given, fit_curve(held.mapInArrow(compare, "class int, difference double, words long"))


def toxicity_scores(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text",
                    label: str = "toxic", threshold: float = 0.7) -> DataFrame:
    """(key, score, predicted) for every row of ``docs``; see :func:`fit` for ``labels``.

    Null and empty texts get the curve's value at no difference. Repeated rows are scored alike, and a null key is
    kept. Other columns are not read.
    """
    models, curve = fit(docs, labels, key, text, label)
    kind = docs.schema[key].dataType.simpleString()
    if isinstance(models, Joined):
        scored = models.scored(docs.select(key, text), text, curve)
        return scored.select(key, F.col("__toxicity").alias("score"), (F.col("__toxicity") >= threshold).cast("int").alias("predicted"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(models.value, curve)
        for batch in batches:
            for keys, texts in text_rows(batch, key, text):
                score = scorer(texts)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(keys, batch.schema.field(key).type), pa.array(score), pa.array((score >= threshold).astype(np.int32))],
                    names=[key, "score", "predicted"])

    return docs.select(key, text).mapInArrow(run, f"`{key}` {kind}, score double, predicted int")


def drop_toxic(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", label: str = "toxic",
               threshold: float = 0.7) -> DataFrame:
    """The rows, with all their columns, that score below ``threshold``; the texts are not shuffled unless :func:`fit` joins."""
    models, curve = fit(docs, labels, key, text, label)
    if isinstance(models, Joined):
        return models.scored(docs, text, curve).where(F.col("__toxicity") < threshold).select(docs.columns)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(models.value, curve)
        for batch in batches:
            scores = [s for _, texts in text_rows(batch, text, text) for s in scorer(texts)]
            yield batch.filter(pa.array([s < threshold for s in scores], pa.bool_()))

    return docs.mapInArrow(run, docs.schema)
