import random

import numpy as np
import pytest
from odd_tables import no_documents, odd_documents, odd_rows
from tokenizers import Tokenizer

from tastemill.llm import bpe
from tastemill.llm.common import default_vocabulary


@pytest.fixture(scope="module")
def both():
    path = default_vocabulary("byte_bpe_50k.json")
    return bpe.tables(path), Tokenizer.from_file(path)


def texts():
    rng = random.Random(1)
    bits = ["a", "b", "th", "in", " ", "  ", "\n", "\t", "é", "ß", "中", "🙂", "1", "23", ".", "'s", "՘", "​"]
    bits += ["\x85", "\xa0", "<|endoftext|>", "<|", "A", "aaaaaaaa", "ὠ0", "한", "\x00", "\x1c", "_", "ſ", "'ll", "ᲀ"]
    out = ["".join(rng.choice(bits) for _ in range(rng.randint(0, 30))) for _ in range(4000)]
    out += ["".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(rng.randint(50, 3000))) for _ in range(60)]
    return out + ["", "a" * 5000, " " * 3000, "ab" * 3000, "." * 4000]


def test_ids_equal_the_tokenizer_and_decode_back(both):
    pairs, tokenizer = both
    for text, known in zip(texts(), tokenizer.encode_batch(texts(), add_special_tokens=False)):
        ids = pairs.encode(text)
        assert np.frombuffer(ids, "<u4").tolist() == known.ids, text[:60]
        assert pairs.decode(ids) == text == tokenizer.decode(known.ids, skip_special_tokens=False)


def test_every_character_is_split_as_the_tokenizer_does(both):
    pairs, tokenizer = both
    points = [chr(c) for c in range(0x30000) if not 0xD800 <= c < 0xE000]
    for start in range(0, len(points), 500):
        text = "".join(f"a{c}1{c} {c}" for c in points[start : start + 500])
        known = tokenizer.encode(text, add_special_tokens=False).ids
        assert np.frombuffer(pairs.encode(text), "<u4").tolist() == known
    for c in points[:0x3000]:
        assert np.frombuffer(pairs.encode(f"a{c}1{c}"), "<u4").tolist() == tokenizer.encode(f"a{c}1{c}").ids


def test_invalid_bytes_decode_to_replacements(both):
    pairs, tokenizer = both
    ids = np.array([pairs.id_of[b"\xe4"], pairs.id_of[b"a"]], dtype="<u4")
    assert pairs.decode(ids.tobytes()) == tokenizer.decode(ids.tolist(), skip_special_tokens=False) == "�a"


def test_odd_rows(spark, both):
    pairs, _ = both
    out = bpe.encode(odd_documents(spark)).collect()
    assert sorted(r.decoded for r in out) == sorted(t or "" for _, t, _ in odd_rows())
    counts = bpe.digests(odd_documents(spark)).collect()
    assert sorted(r.n_tokens for r in counts) == sorted(len(r.ids) // 4 for r in out)
    assert bpe.digests(no_documents(spark)).count() == 0
