"""Token counts by a linear longest-match automaton.

Greedy longest-match word pieces, counted but never built. The vocabulary is a
trie with failure links: each state knows how many pieces are finished when it
cannot go on, and the state that holds the rest. A word is read once, letter by
letter. Words are the runs between ASCII white space; a word starts with the
vocabulary's word-start mark, so pieces at the start and inside a word differ.

Defined results: a null or wordless text has no words and no pieces; a word that
the vocabulary cannot spell counts as one unknown piece; words of any length are
read whole; repeated rows are counted one by one; empty tables give empty results.
"""

from __future__ import annotations

import json
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tastemill.llm.bpe import byte_letters
from tastemill.llm.common import default_vocabulary, per_text, slices

#: Words remembered by a worker, and their largest length.
CACHE, CACHE_BYTES = 1 << 18, 40


class LongestMatch:
    """The automaton of one vocabulary. ``mark`` starts every word; 0 is the empty state."""

    def __init__(self, vocabulary: Iterable[bytes], mark: bytes = b" "):
        self.mark = mark
        self.step: dict[int, int] = {}  # state * 256 + byte -> state
        parent, letter, token = [-1], [0], [False]
        for piece in vocabulary:
            state = 0
            for byte in piece:
                key = state << 8 | byte
                nxt = self.step.get(key)
                if nxt is None:
                    nxt = self.step[key] = len(parent)
                    parent.append(state)
                    letter.append(byte)
                    token.append(False)
                state = nxt
            if state:
                token[state] = True
        # Failure link of a state and the pieces popped on the way; -1 where the word cannot be spelled.
        self.fail, self.popped = [-1] * len(parent), [0] * len(parent)
        depth = [0] * len(parent)
        for s in range(1, len(parent)):
            depth[s] = depth[parent[s]] + 1
        for s in sorted(range(1, len(parent)), key=depth.__getitem__):
            if token[s]:
                self.fail[s], self.popped[s] = 0, 1
                continue
            at, count = self.fail[parent[s]], self.popped[parent[s]]
            while at >= 0:
                nxt = self.step.get(at << 8 | letter[s])
                if nxt is not None:
                    self.fail[s], self.popped[s] = nxt, count
                    break
                count += self.popped[at]
                at = self.fail[at]
        self.cache: dict[bytes, int] = {}

    def pieces(self, word: bytes) -> int:
        """Number of greedy pieces of one word; -1 if it cannot be spelled."""
        step, fail, popped = self.step, self.fail, self.popped
        state, count = 0, 0
        for byte in self.mark + word:
            nxt = step.get(state << 8 | byte)
            while nxt is None:
                count += popped[state]
                state = fail[state]
                if state < 0:
                    return -1
                nxt = step.get(state << 8 | byte)
            state = nxt
        while state:
            count += popped[state]
            state = fail[state]
            if state < 0:
                return -1
        return count

    def count(self, text: str) -> tuple[int, int, int]:
        """(words, pieces, words that cannot be spelled) of a text."""
        words = text.encode().split()  # bytes: splits at ASCII white space only
        cache, total, unknown = self.cache, 0, 0
        for word in words:
            n = cache.get(word)
            if n is None:
                n = self.pieces(word)
                if len(word) <= CACHE_BYTES:
                    if len(cache) >= CACHE:
                        cache.clear()
                    cache[word] = n
            if n < 0:
                unknown += 1
                n = 1
            total += n
        return len(words), total, unknown


_loaded: dict[str, LongestMatch] = {}


def automaton(path: str) -> LongestMatch:
    """The automaton of a byte-level vocabulary file."""
    if path not in _loaded:
        with open(path, encoding="utf-8") as file:
            vocabulary = json.load(file)["model"]["vocab"]
        letters = byte_letters()
        _loaded[path] = LongestMatch(bytes(letters[c] for c in piece) for piece in vocabulary)
    return _loaded[path]


def token_counts(
    docs: DataFrame, key: str = "doc_id", text: str = "text", vocabulary: str | None = None
) -> DataFrame:
    """(key, n_words, n_pieces, n_unknown) of every whole text."""
    path = vocabulary or default_vocabulary("byte_bpe_50k.json")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        machine = automaton(path)
        for part in slices(batches):
            found = list(zip(*map(machine.count, part.column(1).to_pylist()))) or [(), (), ()]
            yield pa.RecordBatch.from_arrays(
                [part.column(0), *(pa.array(c, pa.int64()) for c in found)],
                names=["key", "n_words", "n_pieces", "n_unknown"],
            )

    return per_text(docs, key, run, "n_words bigint, n_pieces bigint, n_unknown bigint", text)
