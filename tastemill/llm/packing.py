"""Packing along a space-filling curve.

Each document becomes a vector of hashed token ids, projected to a few
dimensions; its place on a Hilbert curve through that space is its sort key, so
documents that share words stand near each other. Laid end to end in that order
and cut every ``SEQUENCE`` ids, they fill every sequence but the last.

Ids are made once and written. Only (key, length) rows are range-sorted and
added up; then each document learns where it begins and cuts itself, so no task
ever holds more than its own documents.

Defined results: a null text is empty and is packed as its end id alone; repeated
rows are packed each; equal documents stand side by side; an empty table gives no
pieces; ties on the curve are ordered by row.
"""

from __future__ import annotations

import os
import re
import struct
import zlib
from collections.abc import Iterator
from math import erf

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tastemill.functions.ordered import OrderedSplit
from tastemill.llm.bpe import byte_letters
from tastemill.llm.common import default_vocabulary, map_batches, numbered, per_text, slices

SEQUENCE = 2048
END = 1
#: Hashed vector, dimensions of the curve, and bits of each.
WIDTH, DIMENSIONS, BITS = 256, 4, 8
#: Words remembered by a worker, and their largest length.
CACHE, CACHE_CHARS = 1 << 19, 32

#: Latin texts without control characters that Python's ``split`` takes for white space: there the tokenizer
#: reads words one by one, and lower case needs no further composing. Other texts go to it whole.
_PLAIN = re.compile("[\x00-\x1b\x20-\x84\x86-\x9f\xa1-\u012f\u0131-\u024f]*")
#: What the vocabulary's model is given at a time (fixed value, part of the vocabulary's definition).
PIECES = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"


class WordIds:
    """Ids of texts by the tokenizer of a file, word by word where that is the same."""

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # Spark runs one task per core already
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.model = self.tokenizer.model
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.split = regex.compile(PIECES)
        self.letter_of = {byte: letter for letter, byte in byte_letters().items()}
        self.cache: dict[str, bytes] = {}

    def _plain(self, text: str) -> bool:
        return _PLAIN.fullmatch(text) is not None and not any(s in text for s in self.special)

    def _whole(self, text: str) -> bytes:
        ids = self.tokenizer.encode(text, add_special_tokens=False).ids
        return np.array(ids, dtype="<u4").tobytes()

    def _piece(self, piece: str) -> bytes:
        steady = piece.isascii() and piece.isprintable()  # these bytes stand for themselves
        shown = piece if steady else "".join([self.letter_of[b] for b in piece.encode()])
        ids = [t.id for t in self.model.tokenize(shown)]
        return struct.pack(f"<{len(ids)}I", *ids)

    def _word(self, word: str) -> bytes:
        """A word that is not remembered; its pieces may be, since a piece of letters is also a word."""
        if word.isalpha():
            ids = self._piece(word)
        else:
            ids = b"".join([self.cache.get(p) or self._kept(p, self._piece(p)) for p in self.split.findall(word)])
        return self._kept(word, ids)

    def _kept(self, word: str, ids: bytes) -> bytes:
        if len(word) <= CACHE_CHARS:
            if len(self.cache) >= CACHE:
                self.cache.clear()
            self.cache[word] = ids
        return ids

    def encode(self, text: str) -> bytes:
        """Ids as little-endian unsigned 32-bit integers."""
        if not self._plain(text):
            return self._whole(text)
        words = text.lower().split()
        try:
            return b"".join(map(self.cache.__getitem__, words))
        except KeyError:
            return b"".join([self.cache.get(w) or self._word(w) for w in words])


_loaded: dict[str, WordIds] = {}


def word_ids(path: str) -> WordIds:
    if path not in _loaded:
        _loaded[path] = WordIds(path)
    return _loaded[path]


def hilbert(axes: np.ndarray, bits: int = BITS) -> np.ndarray:
    """Place on the Hilbert curve of integer points (rows of ``axes``), all rows at once.

    The axes are turned into the transposed index by Gray decoding with the
    rotations of each level undone, and its bits are then interleaved.
    """
    x = axes.astype(np.int64).T.copy()
    dims = len(x)
    q = 1 << (bits - 1)
    while q > 1:
        low = q - 1
        for i in range(dims):
            high = (x[i] & q) != 0
            swap = np.where(high, 0, (x[0] ^ x[i]) & low)
            x[0] = np.where(high, x[0] ^ low, x[0] ^ swap)
            x[i] ^= swap
        q >>= 1
    for i in range(1, dims):
        x[i] ^= x[i - 1]
    turn = np.zeros_like(x[0])
    q = 1 << (bits - 1)
    while q > 1:
        turn = np.where(x[dims - 1] & q, turn ^ (q - 1), turn)
        q >>= 1
    x ^= turn
    key = np.zeros_like(x[0])
    for b in range(bits - 1, -1, -1):
        for i in range(dims):
            key = key << 1 | (x[i] >> b & 1)
    return key


def _projection() -> np.ndarray:
    return np.random.default_rng(10).standard_normal((WIDTH, DIMENSIONS))


_NORMAL = np.array([0.5 * (1 + erf(z / np.sqrt(2))) for z in np.linspace(-4, 4, 1025)])


def curve_keys(ids_of: list[np.ndarray]) -> np.ndarray:
    """Hilbert keys of documents given as id arrays; a document without ids stands at the middle."""
    counts = np.zeros((len(ids_of), WIDTH))
    for row, ids in zip(counts, ids_of):
        hashed = (ids.astype(np.uint32) * np.uint32(0x9E3779B1)) >> np.uint32(24)
        row += np.bincount(hashed, minlength=WIDTH)
    weight = np.log1p(counts)
    weight /= np.maximum(np.linalg.norm(weight, axis=1, keepdims=True), 1e-9)
    place = np.clip((weight @ _projection() + 4) * 128, 0, 1024).astype(np.int64)
    cells = np.minimum((_NORMAL[place] * (1 << BITS)).astype(np.int64), (1 << BITS) - 1)
    return hilbert(cells)


def tokenised(docs: DataFrame, key: str = "doc_id", text: str = "text", vocabulary: str | None = None) -> DataFrame:
    """(key, n, curve, ids): ids with the end id as packed integers, two bytes each if the vocabulary allows."""
    path = vocabulary or default_vocabulary("word_bpe_49k.json")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = word_ids(path)
        width = _width(path)
        end = np.uint32(END).tobytes()
        for part in slices(batches):
            ids = [np.frombuffer(i + end, dtype="<u4") for i in map(words.encode, part.column(1).to_pylist())]
            yield pa.RecordBatch.from_arrays(
                [
                    part.column(0),
                    pa.array([len(i) for i in ids], pa.int64()),
                    pa.array(curve_keys([i[:-1] for i in ids])),
                    pa.array([i.astype(width).tobytes() for i in ids], pa.binary()),
                ],
                names=["key", "n", "curve", "ids"],
            )

    return per_text(docs, key, run, "n bigint, curve bigint, ids binary", text)


def _width(path: str) -> str:
    return "<u2" if word_ids(path).tokenizer.get_vocab_size() <= 1 << 16 else "<u4"


_PIECE = "start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint, sequence_id bigint, offset bigint"


def pack(
    docs: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    vocabulary: str | None = None,
    sequence: int = SEQUENCE,
    with_ids: bool = False,
) -> DataFrame:
    """(key, start, length, ids_crc32, doc_tokens, sequence_id, offset[, ids]): one row per piece.

    ``with_ids`` adds the piece's ids as packed 32-bit integers.
    """
    path = vocabulary or default_vocabulary("word_bpe_49k.json")
    rows = numbered(tokenised(docs, key, text, path), "row", "tokenised")
    order = OrderedSplit(rows.select("curve", "row", "n"), keys=[], order=["curve", "row"])
    begin = order.running_sum(F.col("n"), "begin", inclusive=False).result().select("row", "begin")
    placed = rows.select("row", F.col(key).alias("key"), "n", "ids").join(begin, "row")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        width = _width(path)
        for part in slices(batches):
            keys, columns = [], [[] for _ in range(6 + with_ids)]
            _, _, sizes, packed, begins = part.columns
            for i, (n, data, at) in enumerate(zip(sizes.to_pylist(), packed.to_pylist(), begins.to_pylist())):
                ids = np.frombuffer(data, dtype=width).astype("<u4")
                start = 0
                while start < n:
                    offset = (at + start) % sequence
                    length = min(n - start, sequence - offset)
                    piece = ids[start : start + length].tobytes()
                    values = (start, length, zlib.crc32(piece), n, (at + start) // sequence, offset)
                    keys.append(i)
                    for column, value in zip(columns, (*values, piece)):
                        column.append(value)
                    start += length
            arrays = [pa.array(c, pa.int64()) for c in columns[:6]]
            arrays += [pa.array(c, pa.binary()) for c in columns[6:]]
            names = ["key", *(f.split()[0] for f in _PIECE.split(", ")), *["ids"] * with_ids]
            yield pa.RecordBatch.from_arrays([part.column(1).take(pa.array(keys, pa.int64())), *arrays], names=names)

    kind = docs.schema[key].dataType.simpleString()
    schema = f"key {kind}, {_PIECE}" + ", ids binary" * with_ids
    pieces = map_batches(placed.select("row", "key", "n", "ids", "begin"), cut, schema)
    return pieces.withColumnRenamed("key", key)
