"""Sampling distinct segmentations of texts without replacement, by Gumbel top-k.

A text's lattice is a chain of factors between which no piece reaches. Every segmentation gets its log-probability plus
Gumbel noise, and the ``k`` largest are a sample without replacement. They are found best first, without listing the
segmentations: a node of the search is a set of segmentations with a common prefix, and its value is the largest
perturbed one in it. That value is known before the node is opened: the root's is one Gumbel draw about the log of the
lattice's whole mass. The segmentation that holds it is drawn from the model, piece by piece; at each of its pieces, the
other pieces that could stand there form a sibling, whose value is one Gumbel about its mass, conditioned on being below
the node's. The sibling of the largest value is opened next: one of its pieces is drawn, the pieces still left stay a
sibling. So a segmentation costs one draw per piece, however many segmentations its words have.

The positions of all distinct factors are nodes of one graph, and the texts of a run walk through it together.

With the (k + 1)-th value as threshold t, a segmentation of log-probability p was included with probability
1 - exp(-exp(p - t)), by which sums over all segmentations can be estimated without bias.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from costweave.llm.tables import text_rows
from costweave.llm.unigram import Vocabulary, factors

#: The masses in a factor of more characters than this follow position by position, in shorter ones over all factors at once.
MOST = 64
#: The edges that a task remembers over all its factors.
REMEMBERED = 2_000_000


class Graph:
    """Nodes are positions in distinct factors. The edges of a node, its pieces from long to short, follow one another.

    By node: ``first`` edge and ``rest``, the log of the mass from there to the factor's end. By edge: the node it leads
    ``to`` (-1: the end), the ``symbol`` of its piece, ``logp``, the log-probability given the node, ``others``, the log of
    what the node's other edges have, and ``upto``, the sum of probabilities up to it.
    """

    NODE = {"first": np.int32, "rest": np.float64}
    EDGE = {"to": np.int32, "symbol": np.int32, "logp": np.float64, "others": np.float64, "upto": np.float64}

    def __init__(self, vocabulary: Vocabulary):
        self.vocabulary = vocabulary
        # The pieces as a tree: a key is a state and a character's number, and leads to the state beyond.
        chars = sorted({c for p in vocabulary.ids for c in p})
        self.chars = np.full(0x110000, -1, np.int64)
        self.chars[[ord(c) for c in chars]] = np.arange(len(chars))
        number, tree, self.symbol_of = {c: i for i, c in enumerate(chars)}, {}, [-1]
        for symbol, piece in enumerate(vocabulary.ids):
            state = 0
            for c in piece:
                key = state * len(chars) + number[c]
                state = tree.setdefault(key, len(tree) + 1)
                if state == len(self.symbol_of):
                    self.symbol_of.append(-1)
            self.symbol_of[state] = symbol
        self.width, self.symbol_of = len(chars), np.array(self.symbol_of)
        self.keys = np.array(sorted(tree), np.int64)
        self.states = np.array([tree[k] for k in self.keys.tolist()], np.int64)
        self.logs = list(vocabulary.logs.values())
        self.n_ids, self.ids_of, self.n_chars = [1] * len(self.logs), list(vocabulary.ids.values()), list(map(len, vocabulary.ids))
        self.fallbacks: dict[int, int] = {}
        self.nodes = self.edges = 0
        for name, kind in (self.NODE | self.EDGE).items():
            setattr(self, name, np.zeros(1024, kind))

    def _fallback(self, code: int) -> int:
        """The symbol of a character that is no piece: its bytes' pieces."""
        if code not in self.fallbacks:
            ids = self.vocabulary.piece_ids(chr(code))
            self.fallbacks[code] = len(self.logs)
            self.logs.append(len(ids) * self.vocabulary.byte_log)
            self.n_ids.append(len(ids))
            self.n_chars.append(1)
            self.ids_of += ids
        return self.fallbacks[code]

    def _set(self, names: dict, at: int, **columns: np.ndarray) -> None:
        for name in names:
            have, new = getattr(self, name), columns[name]
            if at + len(new) > len(have):
                have = np.concatenate([have, np.zeros(max(len(have), len(new)), have.dtype)])
                setattr(self, name, have)
            have[at:at + len(new)] = new

    def learn(self, words: list[str]) -> list[int]:
        """New nodes for all positions of factors; those where the factors begin."""
        if not words:
            return []
        codes = np.frombuffer("".join(words).encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.int64)
        lengths = np.array([len(w) for w in words], np.int64)
        ends = np.cumsum(lengths)
        left = np.repeat(ends, lengths) - np.arange(len(codes))
        # The pieces from every position on, by one step in their tree after the other.
        at, state, numbers = np.arange(len(codes)), np.zeros(len(codes), np.int64), self.chars[codes]
        froms, symbols = [], []
        for size in range(1, self.vocabulary.longest + 1):
            on = left[at] >= size
            at, state = at[on], state[on]
            number = numbers[at + size - 1]
            key = state * self.width + number
            place = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
            on = (number >= 0) & (self.keys[place] == key)
            symbol = np.full(len(at), -1)
            symbol[on] = self.symbol_of[self.states[place[on]]]
            if size == 1:
                bare = np.flatnonzero(symbol < 0)
                unlike, which = np.unique(codes[at[bare]], return_inverse=True)
                symbol[bare] = np.array([self._fallback(int(c)) for c in unlike], np.int64)[which]
            is_piece = symbol >= 0
            froms.append(at[is_piece])
            symbols.append(symbol[is_piece])
            at, state = at[on], self.states[place[on]]
        # Nodes in the order of what is left, so that edges lead to lower ones; factors beyond MOST come after the rest.
        long = np.repeat(lengths > MOST, lengths)
        order = np.lexsort((left, long))
        node = np.empty(len(codes), np.int64)
        node[order] = np.arange(len(codes))
        counts = np.zeros(len(codes), np.int64)
        for f in froms:
            counts[node[f]] += 1
        starts, seen = np.cumsum(counts) - counts, counts.copy()
        src, to, of = np.repeat(np.arange(len(codes)), counts), np.empty(counts.sum(), np.int64), np.empty(counts.sum(), np.int64)
        for size, (f, symbol) in enumerate(zip(froms, symbols, strict=True), 1):
            own = node[f]
            seen[own] -= 1
            edge = starts[own] + seen[own]
            of[edge], to[edge] = symbol, np.where(left[f] > size, node[np.minimum(f + size, len(codes) - 1)], -1)
        self._add(left[order], int((~long).sum()), starts, src, to, of)
        return (self.nodes - len(codes) + node[ends - lengths]).tolist()

    def _add(self, left: np.ndarray, short: int, starts: np.ndarray, src: np.ndarray, to: np.ndarray, symbols: np.ndarray) -> None:
        """Append nodes and their edges: masses, then probabilities. The first ``short`` nodes are of short factors."""
        n, logs, rest = len(left), np.array(self.logs)[symbols], np.zeros(len(left) + 1)
        value, stops = np.empty(len(src)), np.append(starts[1:], len(src))
        # What is left grows by one from cut to cut, and edges lead to where less is left; rest[-1] is the end's.
        cuts = [*np.flatnonzero(np.diff(left[:short], prepend=0)).tolist(), short]
        for a, b in zip(cuts[:-1], cuts[1:], strict=True):
            span = slice(starts[a], stops[b - 1])
            value[span] = logs[span] + rest[to[span]]
            at = starts[a:b] - starts[a]
            top = np.maximum.reduceat(value[span], at)
            rest[a:b] = top + np.log(np.add.reduceat(np.exp(value[span] - np.repeat(top, stops[a:b] - starts[a:b])), at))
        if short < n:
            later, onward, weights = rest.tolist(), to.tolist(), logs.tolist()
            for i in range(short, n):
                own = [weights[e] + later[onward[e]] for e in range(starts[i], stops[i])]
                top = max(own)
                later[i] = top + math.log(sum(math.exp(x - top) for x in own))
            rest = np.array(later)
            span = slice(starts[short], None)
            value[span] = logs[span] + rest[to[span]]
        logp = np.minimum(value - rest[src], 0.0)
        share = np.exp(logp)
        top = np.flatnonzero(logp == np.repeat(np.maximum.reduceat(logp, starts), stops - starts))
        top = top[np.diff(src[top], prepend=-1) > 0]
        # What the likeliest edge leaves is added up without it: one minus its share would lose small rests.
        others, rests = 1.0 - share, share.copy()
        rests[top] = 0.0
        others[top] = np.add.reduceat(rests, starts)
        total = np.cumsum(share)
        upto = total - np.repeat(total[starts] - share[starts], stops - starts)
        upto[stops - 1] = np.inf
        with np.errstate(divide="ignore"):
            others = np.log(others)
        self._set(self.NODE, self.nodes, first=self.edges + starts, rest=rest[:-1])
        self._set(self.EDGE, self.edges, to=np.where(to < 0, -1, self.nodes + to), symbol=symbols, logp=logp, others=others, upto=upto)
        self.nodes, self.edges = self.nodes + n, self.edges + len(src)

    def beside(self, edge: int) -> range:
        """All edges of an edge's node."""
        node = int(np.searchsorted(self.first[:self.nodes], edge, "right")) - 1
        return range(int(self.first[node]), int(self.first[node + 1]) if node + 1 < self.nodes else self.edges)

    def walk(self, node: np.ndarray, at: np.ndarray, draws: np.ndarray, chosen: np.ndarray) -> None:
        """From all nodes, which stand at positions ``at``, to the ends of their parts; the edge taken at a position goes to ``chosen``."""
        sizes = np.array(self.n_chars)
        while len(node):
            edge, draw = self.first[node], draws[at]
            on = np.flatnonzero(self.upto[edge] <= draw)
            while len(on):
                edge[on] += 1
                on = on[self.upto[edge[on]] <= draw[on]]
            chosen[at] = edge
            node, at = self.to[edge], at + sizes[self.symbol[edge]]
            live = node >= 0
            node, at = node[live], at[live]

    def piece_ids(self, edges: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The ids of pieces, and how many each piece has."""
        counts, ids = np.array(self.n_ids), np.array(self.ids_of, np.int32)
        symbols = self.symbol[edges]
        n = counts[symbols]
        ends = np.cumsum(n)
        within = np.arange(ends[-1] if len(ends) else 0) - np.repeat(ends - n, n)
        return ids[np.repeat((np.cumsum(counts) - counts)[symbols], n) + within], n


@dataclass
class Parts:
    """A text as a chain of nodes of a graph, with the position of each and the number of characters."""

    graph: Graph
    nodes: np.ndarray
    starts: np.ndarray
    chars: int


class Factors:
    def __init__(self, vocabulary: Vocabulary):
        self.vocabulary = vocabulary
        self.graph, self.known = Graph(vocabulary), {}

    def all_parts(self, texts: list[str | None]) -> list[Parts]:
        if self.graph.edges > REMEMBERED:
            self.graph, self.known = Graph(self.vocabulary), {}
        cut = [factors(t) for t in texts]
        new = list(set().union(*cut).difference(self.known))
        self.known.update(zip(new, self.graph.learn(new), strict=True))
        out = []
        for own in cut:
            sizes = np.fromiter(map(len, own), np.int64, len(own))
            ends = np.cumsum(sizes)
            nodes = np.fromiter(map(self.known.__getitem__, own), np.int64, len(own))
            out.append(Parts(self.graph, nodes, ends - sizes, int(sizes.sum())))
        return out

    def parts(self, text: str | None) -> Parts:
        return self.all_parts([text])[0]

    def ids(self, parts: Parts, choices: np.ndarray) -> list[int]:
        return parts.graph.piece_ids(choices)[0].tolist()


def below(mass: np.ndarray, limit: float, clock: np.ndarray) -> np.ndarray:
    """Gumbels about the logs of masses, known to be below ``limit``; ``clock`` has an exponential draw for each."""
    return -np.logaddexp(-limit, np.log(clock) - mass)


class Search:
    """The best segmentations of one text: found ones, and the frontier of siblings not yet opened."""

    def __init__(self, parts: Parts, k: int, random: np.random.Generator):
        self.parts, self.k, self.random = parts, k, random
        self.found: list[tuple[float, np.ndarray]] = []
        self.frontier: list[tuple] = []
        self.pushed = 0
        # The segmentation to be drawn next: its value, the edges it begins with, their log-probability and their characters.
        self.value, self.begun, self.log, self.at = float(random.gumbel()), np.zeros(0, np.int64), 0.0, 0

    def push(self, value: float, edges: np.ndarray, at: int, log: float, without: tuple[int, ...]) -> None:
        if value > -math.inf:
            heapq.heappush(self.frontier, (-value, self.pushed, edges, at, log, without))
            self.pushed += 1

    def ways_on(self) -> tuple[np.ndarray, np.ndarray]:
        """The nodes and positions from which the rest is drawn."""
        parts, graph, begun = self.parts, self.parts.graph, self.begun
        if not len(begun):
            return parts.nodes, parts.starts
        at = self.at
        later = np.searchsorted(parts.starts, at)
        nodes, starts = parts.nodes[later:], parts.starts[later:]
        if (inside := graph.to[begun[-1]]) >= 0:
            nodes, starts = np.append(inside, nodes), np.append(at, starts)
        return nodes, starts

    def take(self, drawn: np.ndarray) -> None:
        """The segmentation that was to be drawn, by the edges after those it begins with."""
        graph, edges = self.parts.graph, np.concatenate([self.begun, drawn])
        logs = self.log + np.concatenate([[0.0], np.cumsum(graph.logp[drawn])])
        self.found.append((float(logs[-1]), edges))
        if len(drawn):
            held = below(logs[:-1] + graph.others[drawn], self.value, self.random.standard_exponential(len(drawn)))
            # Each sibling holds a segmentation of its value, so what is below the (k + 1)-th value cannot come up.
            some = np.arange(len(held)) if len(held) <= self.k + 1 else np.argpartition(-held, self.k + 1)[:self.k + 1]
            for i in some.tolist():
                self.push(float(held[i]), edges, len(self.begun) + i, float(logs[i]), (int(drawn[i]),))

    def open(self) -> bool:
        """Turn to the sibling of the largest value; False when there is none or no more is wanted."""
        if len(self.found) >= self.k or not self.frontier:
            return False
        value, _, edges, at, log, without = heapq.heappop(self.frontier)
        self.value, graph = -value, self.parts.graph
        left = [e for e in graph.beside(int(edges[at])) if e not in without]
        shares = np.exp(graph.logp[left])
        upto = np.cumsum(shares)
        i = min(int(np.searchsorted(upto, self.random.random() * upto[-1], "right")), len(left) - 1)
        rest = float(np.delete(shares, i).sum())
        if rest > 0:
            mass = np.array([log + math.log(rest)])
            self.push(float(below(mass, self.value, self.random.standard_exponential(1))[0]), edges, at, log, (*without, left[i]))
        self.begun, self.log = np.append(edges[:at], left[i]), log + float(graph.logp[left[i]])
        self.at = sum(map(graph.n_chars.__getitem__, graph.symbol[self.begun].tolist()))
        return True

    def result(self) -> list[tuple[float, float, np.ndarray]]:
        limit = -self.frontier[0][0] if self.frontier else -np.inf
        return [(log, float(-np.expm1(-np.exp(min(log - limit, 700.0)))), edges) for log, edges in self.found]


def sample_all(texts: list[Parts], k: int, randoms: list[np.random.Generator]) -> list[list[tuple[float, float, np.ndarray]]]:
    """(log-probability, inclusion probability, edges) of up to ``k`` different segmentations of each text of one graph,
    the best perturbed first. The draws of a text come from its own generator."""
    searches = [Search(p, k, r) for p, r in zip(texts, randoms, strict=True)]
    live = searches
    while live:
        begin = np.concatenate([[0], np.cumsum([s.parts.chars for s in live])]).tolist()
        ways = [s.ways_on() for s in live]
        draws = np.concatenate([s.random.random(s.parts.chars) for s in live])
        chosen = np.full(begin[-1], -1, np.int64)
        texts[0].graph.walk(np.concatenate([n for n, _ in ways]), np.concatenate([at + b for (_, at), b in zip(ways, begin, strict=False)]),
                            draws, chosen)
        for s, a, b in zip(live, begin[:-1], begin[1:], strict=True):
            own = chosen[a:b]
            s.take(own[own >= 0])
        live = [s for s in live if s.open()]
    return [s.result() for s in searches]


def sample(parts: Parts, k: int, random: np.random.Generator) -> list[tuple[float, float, np.ndarray]]:
    """:func:`sample_all` of one text."""
    return sample_all([parts], k, [random])[0]


@lru_cache(maxsize=1)
def remembered(model_path: str) -> Factors:
    """The factors of a Python worker, which serves one task after the other."""
    return Factors(Vocabulary(model_path))


def encode_samples(rows: DataFrame, model_path: str, keys: list[str], text: str = "text", k: int = 3, salt: int = 0) -> DataFrame:
    """(keys, sample, ids, log_prob, inclusion): up to ``k`` different segmentations of each text, numbered from 1.

    The random numbers of a row follow from its keys and ``salt`` alone, so they do not depend on how rows are dealt to
    tasks; rows with equal keys and texts, null keys too, get equal samples. A text with fewer segmentations has all of
    them, each with inclusion 1. A null or empty text has one, without ids. Other columns are not read.
    """
    seeded = rows.select(*keys, F.col(text).alias("__text"), F.xxhash64(*keys, F.lit(salt)).alias("__seed"))
    kinds = ", ".join(f"`{c}` {rows.schema[c].dataType.simpleString()}" for c in keys)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = remembered(model_path)
        for batch in batches:
            at = 0
            for seeds, texts in text_rows(batch, "__seed", "__text", 400_000):
                parts = found.all_parts(texts)
                drawn = sample_all(parts, k, [np.random.default_rng(seed % 2**64) for seed in seeds])
                row = [at + i for i, own in enumerate(drawn) for _ in own]
                every = [x for own in drawn for x in own]
                ids, sizes = found.graph.piece_ids(np.concatenate([edges for _, _, edges in every]))
                ends = np.concatenate([[0], np.cumsum(sizes)])[np.cumsum([0, *(len(edges) for _, _, edges in every)])]
                at += len(texts)
                yield pa.RecordBatch.from_arrays(
                    [*(batch.column(c).take(pa.array(row, pa.int64())) for c in keys),
                     pa.array([n + 1 for own in drawn for n in range(len(own))], pa.int32()),
                     pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(ids, pa.int32())),
                     pa.array([min(log, 0.0) for log, _, _ in every], pa.float64()),
                     pa.array([inclusion for _, inclusion, _ in every], pa.float64())],
                    names=[*keys, "sample", "ids", "log_prob", "inclusion"])

    return seeded.mapInArrow(run, f"{kinds}, sample int, ids array<int>, log_prob double, inclusion double")


def decode(rows: DataFrame, model_path: str, ids: str = "ids", text: str = "decoded") -> DataFrame:
    """The rows with the text that their ids stand for; null ids give null."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary = Vocabulary(model_path)
        # By id; ids that stand for nothing, the last entry's too, are left out.
        pieces = pa.array([vocabulary.by_id.get(i, b"") for i in range(max(vocabulary.by_id) + 2)], pa.binary())
        for batch in batches:
            coded = batch.column(ids)
            flat = coded.flatten().fill_null(-1).to_numpy(zero_copy_only=False).astype(np.int64)
            known = pieces.take(pa.array(np.where((flat >= 0) & (flat < len(pieces)), flat, len(pieces) - 1)))
            sizes = pc.fill_null(pc.list_value_length(coded), 0).to_numpy(zero_copy_only=False)
            lists = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(sizes)]), pa.int32()), known)
            raws = [raw.decode("utf-8", "replace") for raw in pc.binary_join(lists, b"").to_pylist()]
            texts = [None if not valid else raw[1:] if raw.startswith(" ") else raw
                     for raw, valid in zip(raws, coded.is_valid().to_pylist(), strict=True)]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(texts, pa.string())], names=[*batch.schema.names, text])

    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields if f.name != text)
    return rows.drop(text).mapInArrow(run, f"{kinds}, `{text}` string")
