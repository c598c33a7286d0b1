"""Byte-pair encoding by backtracking over longest matches, and decoding by an offset table.

A piece of text (what the vocabulary's own pattern yields) is encoded in linear
time: an Aho-Corasick automaton over all tokens gives the longest token at each
place, and a table of compatible neighbours tells whether the merges of the
vocabulary would leave two tokens side by side. If not, the next shorter token
is tried, then the token before is taken back; a place found to be a dead end is
not entered again.

Defined results: null is the empty text (no ids, empty decoded text); the text
of the special token is one id, as in the tokenizer; texts of any length are
handled piece by piece; empty tables give empty results.
"""

from __future__ import annotations

import hashlib
import json
import struct
from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tastemill.llm.common import default_vocabulary, per_text, slices

#: Pattern of the byte-level pre-tokenizer (fixed value, part of the vocabulary's definition).
PIECES = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
#: Characters whose classes are the same in every Unicode version the libraries may use:
#: Latin, Greek and Cyrillic letters, general punctuation up to U+205E, kana, common ideographs, Hangul.
_STEADY = regex.compile("[\u0000-ԯ -⁞ぁ-ゖァ-ヺ一-龥가-힣]*")
#: Pieces remembered by a worker, and their largest length.
CACHE, CACHE_CHARS = 1 << 19, 48


def byte_letters() -> dict[str, int]:
    """The printable letter that stands for each byte in vocabulary files, by rule."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


class BytePairs:
    """Tables of one vocabulary file, built once in each Python worker."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        letters = byte_letters()
        model = spec["model"]
        raw = {token: bytes(letters[c] for c in token) for token in model["vocab"]}
        self.id_of = {raw[token]: i for token, i in model["vocab"].items()}
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        size = 1 + max(*self.id_of.values(), *self.special.values())
        self.bytes_of = [b""] * size
        for token, i in self.id_of.items():
            self.bytes_of[i] = token
        for token, i in self.special.items():
            self.bytes_of[i] = token.encode()

        self.merge: dict[tuple[int, int], tuple[int, int]] = {}
        self.parts: list[tuple[int, int] | None] = [None] * size
        self.rank = [-1] * size
        for rank, pair in enumerate(model["merges"]):
            left, right = pair if isinstance(pair, list) else pair.split(" ")
            a, b = self.id_of[raw[left]], self.id_of[raw[right]]
            joined = self.id_of[raw[left] + raw[right]]
            self.merge.setdefault((a, b), (rank, joined))
            if self.parts[joined] is None:
                self.parts[joined], self.rank[joined] = (a, b), rank

        # Tokens that merging their own bytes does not yield can never be in an encoding.
        whole = [t for t in self.id_of if self._reachable(self.id_of[t])]
        self.longest = ahocorasick.Automaton()
        for token in whole:
            self.longest.add_word(token.decode("latin-1"), (len(token) - 1, self.id_of[token]))
        self.longest.make_automaton()
        known = set(whole)
        self.shorter = [-1] * size
        for token in whole:
            for end in range(len(token) - 1, 0, -1):
                if token[:end] in known:
                    self.shorter[self.id_of[token]] = self.id_of[token[:end]]
                    break
        self.compatible: dict[tuple[int, int], bool] = {}

        self.size_of = [len(b) for b in self.bytes_of]
        lengths = np.array(self.size_of, dtype=np.int64)
        self.offsets = np.concatenate([[0], np.cumsum(lengths)])
        self.blob = np.frombuffer(b"".join(self.bytes_of), dtype=np.uint8)
        self.split = regex.compile(PIECES)
        self.stop = regex.compile("|".join(map(regex.escape, self.special))) if self.special else None
        self.cache: dict[str, bytes] = {}
        self._library = (path, None)

    def _reachable(self, token: int) -> bool:
        """Does merging the bytes of ``token`` end in ``token``? True if its two parts last until its own merge."""
        if self.parts[token] is None:
            return len(self.bytes_of[token]) == 1
        a, b = self.parts[token]
        return self._reachable(a) and self._reachable(b) and self._side_by_side(a, b, self.rank[token])

    def _side_by_side(self, a: int, b: int, before: int) -> bool:
        """Do ``a`` and ``b`` stay apart while all merges of a rank under ``before`` are made?

        The merges are undone from the last: whichever of the two was made later
        is opened at the border. A border pair that would have merged before the
        token next to it was complete shows that ``a, b`` cannot be left over.
        """
        limit = before
        while True:
            found = self.merge.get((a, b))
            if found is not None and found[0] < limit:
                return False
            # On a tie (both the same token) the left one is made first.
            if self.rank[a] > self.rank[b]:
                limit = self.rank[a]
                a = self.parts[a][1]
            elif self.parts[b] is not None:
                limit = self.rank[b] + 1
                b = self.parts[b][0]
            else:
                return True

    def fits(self, a: int, b: int) -> bool:
        """An entry of the pair table, filled as pairs are met; the merges decide it once and for all."""
        if len(self.compatible) >= CACHE:
            self.compatible.clear()
        fit = self.compatible[a, b] = self._side_by_side(a, b, len(self.parts) + 1)
        return fit

    def encode_bytes(self, data: bytes) -> list[int]:
        """Ids of one piece; linear in its length."""
        if data in self.id_of and self.longest.get(data.decode("latin-1"), None) is not None:
            return [self.id_of[data]]
        at = self._longest_at(data)
        shorter, size_of, fits, known = self.shorter, self.size_of, self.fits, self.compatible
        end_of = len(data)
        open_end = bytearray(b"\x01") * (end_of + 1)
        ids: list[int] = []
        pos, token, last = 0, at[0], -1
        while pos < end_of:
            while token >= 0:
                end = pos + size_of[token]
                if open_end[end]:
                    if last < 0:
                        break
                    fit = known.get((last, token))
                    if fit if fit is not None else fits(last, token):
                        break
                token = shorter[token]
            if token >= 0:
                ids.append(token)
                pos, last = end, token
                token = at[pos] if pos < end_of else -1
            else:
                open_end[pos] = 0
                token = ids.pop()
                pos -= size_of[token]
                last = ids[-1] if ids else -1
        return ids

    def _longest_at(self, data: bytes) -> list[int]:
        """The longest token that starts at each byte, in one pass of the automaton.

        ``iter`` gives every match by its end; the last one kept for a start is the longest.
        """
        at = [-1] * len(data)
        for end, (back, token) in self.longest.iter(data.decode("latin-1")):
            at[end - back] = token
        return at

    def _piece(self, piece: str) -> bytes:
        found = self.encode_bytes(piece.encode())
        ids = struct.pack(f"<{len(found)}I", *found)
        if len(piece) <= CACHE_CHARS:
            if len(self.cache) >= CACHE:
                self.cache.clear()
            self.cache[piece] = ids
        return ids

    def _ordinary(self, text: str) -> bytes:
        if _STEADY.fullmatch(text):
            pieces = self.split.findall(text)
        else:
            pieces = [text[a:b] for _, (a, b) in self._pre_tokenizer().pre_tokenize_str(text)]
        cache = self.cache
        try:
            return b"".join(map(cache.__getitem__, pieces))
        except KeyError:
            known = cache.get
            return b"".join([known(p) or self._piece(p) for p in pieces])

    def _pre_tokenizer(self):
        """The library's own splitter, for characters whose class depends on the Unicode version."""
        path, made = self._library
        if made is None:
            from tokenizers import Tokenizer

            made = Tokenizer.from_file(path).pre_tokenizer
            self._library = (path, made)
        return made

    def encode(self, text: str) -> bytes:
        """Ids as little-endian unsigned 32-bit integers."""
        if self.stop is None or not self.stop.search(text):
            return self._ordinary(text)
        out, at = [], 0
        for m in self.stop.finditer(text):
            out.append(self._ordinary(text[at : m.start()]))
            out.append(np.uint32(self.special[m.group()]).tobytes())
            at = m.end()
        out.append(self._ordinary(text[at:]))
        return b"".join(out)

    def decode(self, ids: bytes) -> str:
        """All bytes are gathered at once from the offset table."""
        tokens = np.frombuffer(ids, dtype="<u4").astype(np.int64)
        starts = self.offsets[tokens]
        lengths = self.offsets[tokens + 1] - starts
        ends = np.cumsum(lengths)
        total = int(ends[-1]) if len(ends) else 0
        places = np.arange(total, dtype=np.int64) + np.repeat(starts - (ends - lengths), lengths)
        return self.blob[places].tobytes().decode("utf-8", "replace")


_loaded: dict[str, BytePairs] = {}


def tables(path: str) -> BytePairs:
    if path not in _loaded:
        _loaded[path] = BytePairs(path)
    return _loaded[path]


def encode(docs: DataFrame, key: str = "doc_id", text: str = "text", vocabulary: str | None = None) -> DataFrame:
    """(key, ids, decoded): ids as packed 32-bit integers, and the text they decode to."""
    path = vocabulary or default_vocabulary("byte_bpe_50k.json")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pairs = tables(path)
        for part in slices(batches):
            ids = [pairs.encode(t) for t in part.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [part.column(0), pa.array(ids, pa.binary()), pa.array([pairs.decode(i) for i in ids], pa.string())],
                names=["key", "ids", "decoded"],
            )

    return per_text(docs, key, run, "ids binary, decoded string", text)


def digests(docs: DataFrame, key: str = "doc_id", text: str = "text", vocabulary: str | None = None) -> DataFrame:
    """(key, n_tokens, ids_sha256, decoded_sha256), made where the ids are, so they are not sent back."""
    path = vocabulary or default_vocabulary("byte_bpe_50k.json")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pairs = tables(path)
        for part in slices(batches):
            counts, ids_of, texts_of = [], [], []
            for t in part.column(1).to_pylist():
                ids = pairs.encode(t)
                counts.append(len(ids) // 4)
                ids_of.append(hashlib.sha256(ids).hexdigest())
                texts_of.append(hashlib.sha256(pairs.decode(ids).encode()).hexdigest())
            yield pa.RecordBatch.from_arrays(
                [part.column(0), pa.array(counts, pa.int64()), pa.array(ids_of), pa.array(texts_of)],
                names=["key", "n_tokens", "ids_sha256", "decoded_sha256"],
            )

    return per_text(docs, key, run, "n_tokens bigint, ids_sha256 string, decoded_sha256 string", text)


