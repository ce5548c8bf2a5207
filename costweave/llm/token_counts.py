"""Token counts of texts by dynamic programming over a trie of their distinct pre-tokens.

The tokens of a text are the most probable split of each of its pre-tokens (a run of blanks with the characters behind
it) under a unigram model. A task gathers the distinct pre-tokens of a run of texts and walks their trie depth first:
a node's forward score and number of pieces are computed once for all pre-tokens that share the prefix, and the number
at a pre-token's last node is kept for it. Counts of texts are then sums over their pre-tokens.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame

from costweave.llm.tables import text_rows
from costweave.llm.unigram import Vocabulary, factors


def terminal_counts(words: Iterable[str], vocabulary: Vocabulary) -> dict[str, int]:
    """The number of pieces of each word's best split; of equal scores, that with fewer pieces.

    Sorted words are the trie's leaves in depth-first order, and the lists hold the nodes of the current path.
    """
    counts: dict[str, int] = {}
    score, pieces, before = [0.0], [0], ""
    edges = vocabulary.edges
    for word in sorted(words):
        shared, most = 0, min(len(before), len(word))
        while shared < most and before[shared] == word[shared]:
            shared += 1
        del score[shared + 1:], pieces[shared + 1:]
        for end in range(shared + 1, len(word) + 1):
            best, fewest = -1e300, 0
            for start, log, n in edges(word, end):
                s, m = score[start] + log, pieces[start] + n
                if s > best or s == best and m < fewest:
                    best, fewest = s, m
            score.append(best)
            pieces.append(fewest)
        counts[word], before = pieces[-1], word
    return counts


def count_tokens(docs: DataFrame, model_path: str, key: str = "doc_id", text: str = "text", most: int = 400_000) -> DataFrame:
    """(key, n_pretokens, n_tokens) for every row.

    Null and empty texts have none. Repeated rows get equal counts, null keys are kept, other columns are not read. A
    task remembers up to ``most`` pre-tokens and then begins anew.
    """
    kind = docs.schema[key].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary, known = Vocabulary(model_path), {}
        for batch in batches:
            for keys, texts in text_rows(batch, key, text):
                cut = [factors(t) for t in texts]
                words = set().union(*cut)
                if len(known) + len(words) > most:
                    known = {}
                known.update(terminal_counts(words.difference(known), vocabulary))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(keys, batch.schema.field(key).type), pa.array(map(len, cut), pa.int64()),
                     pa.array([sum(map(known.__getitem__, c)) for c in cut], pa.int64())], names=[key, "n_pretokens", "n_tokens"])

    return docs.select(key, text).mapInArrow(run, f"`{key}` {kind}, n_pretokens long, n_tokens long")
