import json
import random

import pytest
from odd_tables import no_documents, odd_documents, odd_rows

from tastemill.llm import word_pieces
from tastemill.llm.bpe import byte_letters
from tastemill.llm.common import default_vocabulary


def greedy(word, vocabulary):
    """Pieces of a word by trying every length, longest first; None if it cannot be spelled."""
    at, count = 0, 0
    while at < len(word):
        end = next((e for e in range(min(len(word), at + 130), at, -1) if word[at:e] in vocabulary), None)
        if end is None:
            return None
        at, count = end, count + 1
    return count


@pytest.fixture(scope="module")
def vocabulary():
    letters = byte_letters()
    with open(default_vocabulary("byte_bpe_50k.json")) as file:
        return {bytes(letters[c] for c in k) for k in json.load(file)["model"]["vocab"]}


def test_small_vocabularies_with_and_without_dead_ends():
    rng = random.Random(7)
    for _ in range(300):
        words = {bytes(rng.choice(b"abc") for _ in range(rng.randint(1, 5))) for _ in range(rng.randint(1, 12))}
        words |= {b" " + w for w in words if rng.random() < 0.7}
        machine = word_pieces.LongestMatch(words)
        for _ in range(60):
            word = bytes(rng.choice(b"abcd" if rng.random() < 0.1 else b"abc") for _ in range(rng.randint(0, 14)))
            want = greedy(b" " + word, words)
            assert machine.pieces(word) == (-1 if want is None else want)


def test_real_vocabulary(vocabulary):
    machine = word_pieces.automaton(default_vocabulary("byte_bpe_50k.json"))
    rng = random.Random(8)
    for _ in range(3000):
        word = "".join(rng.choice("etaoinshrdlu中é.-_0AZ") for _ in range(rng.randint(1, 25))).encode()
        assert machine.pieces(word) == greedy(b" " + word, vocabulary)
    assert machine.count("a" * 200_000) == (1, machine.pieces(b"a" * 200_000), 0)


def test_odd_rows(spark, vocabulary):
    out = word_pieces.token_counts(odd_documents(spark)).collect()
    want = []
    for _, text, _ in odd_rows():
        words = (text or "").encode().split()
        want.append((len(words), sum(greedy(b" " + w, vocabulary) for w in words), 0))
    assert sorted((r.n_words, r.n_pieces, r.n_unknown) for r in out) == sorted(want)
    assert word_pieces.token_counts(no_documents(spark)).count() == 0
    assert word_pieces.LongestMatch([b" ", b"a"]).count("aa ab") == (2, 4, 1)
