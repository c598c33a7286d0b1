import random
import zlib

import numpy as np
import pytest
from odd_tables import documents, no_documents, odd_documents, odd_rows, prose
from tokenizers import Tokenizer

from tastemill.llm import packing
from tastemill.llm.common import default_vocabulary


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(default_vocabulary("word_bpe_49k.json"))


def ids_of(tokenizer, text):
    return np.array([*tokenizer.encode(text or "", add_special_tokens=False).ids, packing.END], dtype="<u4")


def test_ids_equal_the_tokenizer(tokenizer):
    rng = random.Random(6)
    bits = ["a", "Word", "ß", "É", "İ", "Σ", "é", "Å", "中", "1", "23", "!!", "'s", "<|endoftext|>", "<|"]
    bits += [" ", "\n", "\x1c", "\x85", "\xa0", " ", "don't", "ŉ", "ǅ", "\x00", "_", "ſ", "½", "²", "ﬁ"]
    texts = ["".join(rng.choice(bits) for _ in range(rng.randint(0, 20))) for _ in range(6000)]
    texts += [f"a{chr(c)}b {chr(c)}1" for c in range(0x3000) if not 0xD800 <= c < 0xE000]
    words = packing.word_ids(default_vocabulary("word_bpe_49k.json"))
    for text, known in zip(texts, tokenizer.encode_batch(texts, add_special_tokens=False)):
        assert np.frombuffer(words.encode(text), "<u4").tolist() == known.ids, repr(text)


def test_hilbert_curve_steps_to_neighbours():
    for dims, bits in ((2, 3), (3, 2), (4, 2)):
        side = 1 << bits
        points = np.stack(np.meshgrid(*[np.arange(side)] * dims, indexing="ij"), -1).reshape(-1, dims)
        keys = packing.hilbert(points, bits)
        assert sorted(keys.tolist()) == list(range(side**dims))
        walk = points[np.argsort(keys)]
        assert (np.abs(np.diff(walk, axis=0)).sum(axis=1) == 1).all()


def check(tokenizer, rows, pieces, sequence=packing.SEQUENCE):
    known = sorted((repr(i), ids_of(tokenizer, t).tobytes()) for i, t, _ in rows)
    total = sum(len(b) // 4 for _, b in known)
    by_place = sorted(pieces, key=lambda r: (r.sequence_id, r.offset))
    at, laid = 0, []
    for r in by_place:
        assert r.sequence_id * sequence + r.offset == at and r.offset + r.length <= sequence and r.length > 0
        assert zlib.crc32(r.ids) == r.ids_crc32 and len(r.ids) == 4 * r.length
        if r.start == 0:
            laid.append([repr(r.doc_id), b"", r.doc_tokens])
        assert laid[-1][0] == repr(r.doc_id) and len(laid[-1][1]) == 4 * r.start
        laid[-1][1] += r.ids
        at += r.length
    assert at == total
    assert all(len(b) == 4 * n for _, b, n in laid)
    assert sorted((i, b) for i, b, _ in laid) == known


@pytest.mark.parametrize("sequence", [2048, 16])
def test_odd_rows(spark, tokenizer, sequence):
    pieces = packing.pack(odd_documents(spark), sequence=sequence, with_ids=True).collect()
    check(tokenizer, odd_rows(), pieces, sequence)
    assert packing.pack(no_documents(spark)).count() == 0


def test_many_parts_and_a_third_of_equal_rows(spark, tokenizer, many_parts):
    rows = [(i, prose(50) if i % 3 == 0 else prose(5 + i % 40, i) + f" {i}", None) for i in range(600)]
    pieces = packing.pack(documents(spark, rows).repartition(7), with_ids=True).collect()
    check(tokenizer, rows, pieces)
    plain = packing.pack(documents(spark, rows))
    assert plain.columns == "doc_id start length ids_crc32 doc_tokens sequence_id offset".split()


def test_neighbours_on_the_curve_share_words(spark):
    rng = random.Random(9)
    topics = [[f"{a}{b}" for b in ("alpha", "beta", "gamma", "delta", "omega", "sigma")] for a in ("red", "sea", "oak", "ice")]
    rows = [(i, " ".join(rng.choice(topics[i % 4]) for _ in range(80)), None) for i in range(400)]
    pieces = packing.pack(documents(spark, rows)).filter("start = 0").orderBy("sequence_id", "offset").collect()
    same = sum(a.doc_id % 4 == b.doc_id % 4 for a, b in zip(pieces, pieces[1:]))
    assert same > 300  # a random order has about 100
