"""Quality rules: document statistics scored by gradient-boosted trees.

Statistics are counted over every whole text. The trees are fitted on a bounded
sample of labelled documents and kept as flat node arrays, so a batch of rows
walks down all trees by numpy indexing. Features listed in ``DECREASING`` may
only lower the score as they grow.

Defined results: a null text has no words and fails the base rules; without any
labelled row the base rules decide alone; repeated rows are scored one by one;
a document with several labels is good if at least half of them say so.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tastemill.llm.common import per_text, slices
from tastemill.session import write_stage

#: Expected number of labelled rows the trees are fitted on.
SAMPLE = 20_000
ROUNDS, DEPTH, RATE, BINS = 40, 3, 0.2, 48
#: Documents below this chance of being good are dropped.
THRESHOLD = 0.5
WINDOW = 5

BASE = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
FEATURES = (
    "log_words",
    "word_length",
    "symbol_share",
    "dup_line_share",
    "repeat_share",
    "upper_share",
    "digit_share",
    "mark_share",
    "short_share",
    "bare_share",
    "line_words",
)
DECREASING = ("symbol_share", "dup_line_share", "repeat_share", "upper_share")

# The word pattern and the symbols of the base rules.
_WORD = re.compile("[^\x20\x09-\x0d]+")
_SYMBOLS = re.compile(r"[#*$%&|<>]")
_UPPER, _DIGIT = re.compile(r"[A-ZÀ-ÖØ-Þ]"), re.compile(r"[0-9]")
_MARK = re.compile(r"[!?;:()\[\]{}=+/\\@_~^-]")


def repeated_words(words: list[str]) -> int:
    """Words inside windows of five that occur twice or more in the text, the first one included.

    Windows are sorted by a hash; only windows with equal hashes are compared
    as words.
    """
    n = len(words) - WINDOW + 1
    if n < 2:
        return 0
    h = np.fromiter(map(hash, words), np.int64, len(words)).view(np.uint64)
    mixed = np.zeros(n, dtype=np.uint64)
    for i in range(WINDOW):
        mixed = mixed * np.uint64(0x9E3779B97F4A7C15) + h[i : i + n]
    order = np.argsort(mixed, kind="stable")
    same = mixed[order][1:] == mixed[order][:-1]
    if not same.any():
        return 0
    seen: dict[tuple, int] = {}
    twice: set[int] = set()
    candidates = np.zeros(n, dtype=bool)
    candidates[order[1:][same]] = candidates[order[:-1][same]] = True
    for i in np.flatnonzero(candidates).tolist():
        first = seen.setdefault(tuple(words[i : i + WINDOW]), i)
        if first != i:
            twice.update((first, i))
    edge = np.zeros(len(words) + 1, dtype=np.int64)
    starts = np.fromiter(twice, np.int64, len(twice))
    np.add.at(edge, starts, 1)
    np.add.at(edge, starts + WINDOW, -1)
    return int((np.cumsum(edge)[:-1] > 0).sum())


def statistics(text: str) -> tuple[list[int], list[float]]:
    """The base counts and the features of one text."""
    words = _WORD.findall(text)
    n, chars = len(words), sum(map(len, words))
    symbols = len(_SYMBOLS.findall(text))
    lines = [line for line in text.split("\n") if _WORD.search(line)]
    dups = len(lines) - len(set(lines))
    repeats = repeated_words(words)
    of_words, of_chars = max(n, 1), max(chars, 1)
    features = [
        float(np.log1p(n)),
        chars / of_words,
        symbols / of_chars,
        dups / max(len(lines), 1),
        repeats / of_words,
        len(_UPPER.findall(text)) / of_chars,
        len(_DIGIT.findall(text)) / of_chars,
        len(_MARK.findall(text)) / of_chars,
        sum(len(w) < 3 for w in words) / of_words,
        sum(len(w) == 1 and not w.isalnum() for w in words) / of_words,
        n / max(len(lines), 1),
    ]
    return [n, chars, symbols, dups, repeats], features


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for part in slices(batches):
        found = [statistics(t) for t in part.column(1).to_pylist()]
        base = np.array([f[0] for f in found], dtype=np.int64).reshape(-1, len(BASE))
        yield pa.RecordBatch.from_arrays(
            [part.column(0), *(pa.array(c) for c in base.T), pa.array([f[1] for f in found], pa.list_(pa.float64()))],
            names=["key", *BASE, "features"],
        )


def measure(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, base counts, features) of every whole text."""
    counts = ", ".join(f"{c} bigint" for c in BASE)
    return per_text(docs, key, _count, f"{counts}, features array<double>", text)


def base_failed() -> Column:
    return (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))


@dataclass
class Forest:
    """All trees as flat arrays: a node's feature (-1 for a leaf), border, left child and value."""

    feature: np.ndarray
    border: np.ndarray
    left: np.ndarray
    value: np.ndarray
    roots: np.ndarray
    start: float

    def margin(self, x: np.ndarray) -> np.ndarray:
        """Sum of the leaf values each row reaches; the right child follows the left."""
        node = np.repeat(self.roots[None, :], len(x), axis=0)
        rows = np.arange(len(x))[:, None]
        while True:
            f = self.feature[node]
            inner = f >= 0
            if not inner.any():
                return self.start + self.value[node].sum(axis=1)
            right = x[rows, np.maximum(f, 0)] > self.border[node]
            node = np.where(inner, self.left[node] + right, node)

    def chance(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.margin(x), -30, 30)))


def boost(
    x: np.ndarray, y: np.ndarray, decreasing: tuple[int, ...] = (), rounds: int = ROUNDS, depth: int = DEPTH
) -> Forest:
    """Logistic boosting over quantile bins.

    A split on a constrained feature must put the lower value on the right, and
    the middle of both values bounds everything below it, so no later split can
    turn the order round.
    """
    n, width = x.shape
    borders = [np.unique(np.quantile(x[:, j], np.linspace(0, 1, BINS + 1)[1:-1])) for j in range(width)]
    binned = np.stack([np.searchsorted(b, x[:, j], side="left") for j, b in enumerate(borders)], axis=1)
    rate = float(np.clip(y.mean(), 1e-3, 1 - 1e-3))
    start = float(np.log(rate / (1 - rate)))
    feature, border, left, value, roots = [], [], [], [], []
    margin = np.full(n, start)

    def leaf(g: float, h: float, low: float, high: float) -> float:
        return float(np.clip(-g / (h + 1.0), low, high))

    def grow(rows: np.ndarray, g: np.ndarray, h: np.ndarray, node: int, level: int, low: float, high: float) -> None:
        total_g, total_h = g[rows].sum(), h[rows].sum()
        best = (1e-6, -1, 0, 0.0, 0.0)
        if level < depth and len(rows) >= 20:
            for j in range(width):
                size = len(borders[j]) + 1
                gl = np.bincount(binned[rows, j], g[rows], size).cumsum()[:-1]
                hl = np.bincount(binned[rows, j], h[rows], size).cumsum()[:-1]
                if not len(gl):
                    continue
                gr, hr = total_g - gl, total_h - hl
                vl, vr = np.clip(-gl / (hl + 1), low, high), np.clip(-gr / (hr + 1), low, high)
                gain = gl**2 / (hl + 1) + gr**2 / (hr + 1) - total_g**2 / (total_h + 1)
                gain[(hl < 1) | (hr < 1)] = -1
                if j in decreasing:
                    gain[vr > vl] = -1
                k = int(gain.argmax())
                if gain[k] > best[0]:
                    best = (float(gain[k]), j, k, float(vl[k]), float(vr[k]))
        _, j, k, vl, vr = best
        if j < 0:
            value[node] = RATE * leaf(total_g, total_h, low, high)
            margin[rows] += value[node]
            return
        feature[node], border[node], left[node] = j, float(borders[j][k]), len(feature)
        for store, fill in ((feature, -1), (border, 0.0), (left, -1), (value, 0.0)):
            store.extend([fill, fill])
        goes_right = binned[rows, j] > k
        middle = (vl + vr) / 2
        bounds = ((middle, high), (low, middle)) if j in decreasing else ((low, high), (low, high))
        first = left[node]
        grow(rows[~goes_right], g, h, first, level + 1, *bounds[0])
        grow(rows[goes_right], g, h, first + 1, level + 1, *bounds[1])

    for _ in range(rounds):
        p = 1 / (1 + np.exp(-margin))
        roots.append(len(feature))
        for store, fill in ((feature, -1), (border, 0.0), (left, -1), (value, 0.0)):
            store.append(fill)
        grow(np.arange(n), p - y, p * (1 - p), roots[-1], 0, -4.0, 4.0)
    return Forest(
        np.array(feature), np.array(border), np.array(left), np.array(value), np.array(roots), start
    )


def fit(measured: DataFrame, labels: DataFrame, key: str = "doc_id", sample: int = SAMPLE) -> Forest | None:
    """Trees from labelled rows; a quarter of the ids is held out so that they can be tested.

    About ``sample`` rows are taken by a hash of the id, ordered by id, so the same rows give the same trees;
    of texts with one id the one with the smallest statistics counts.
    """
    taught = (
        labels.filter(F.col(key).isNotNull() & F.col("quality").isNotNull())
        .filter(F.crc32(F.col(key).cast("string").cast("binary")) % 4 != 2)
        .groupBy(key)
        .agg((F.avg("quality") >= 0.5).alias("good"))
    )
    total = taught.count()
    if not total:
        return None
    share = min(1.0, sample / total)
    place = F.pmod(F.xxhash64(F.lit("quality"), F.col(key)), F.lit(1 << 20)) / F.lit(1 << 20)
    rows = (
        measured.join(taught.filter(place < share), key)
        .groupBy(key)
        .agg(F.min("features").alias("features"), F.min("good").alias("good"))
        .orderBy(key)
        .collect()
    )
    good = np.array([r["good"] for r in rows], dtype=np.float64)
    if len(rows) == 0 or good.min() == good.max():
        return None
    x = np.array([r["features"] for r in rows], dtype=np.float64)
    return boost(x, good, tuple(FEATURES.index(f) for f in DECREASING))


def judge(docs: DataFrame, labels: DataFrame, key: str = "doc_id", threshold: float = THRESHOLD) -> DataFrame:
    """(key, base counts, base_failed, kept, chance) of every document."""
    measured = write_stage(measure(docs, key), "statistics")
    forest = fit(measured, labels, key)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in batches:
            flat = part.column(part.num_columns - 1).flatten().to_numpy(zero_copy_only=False)
            x = flat.reshape(-1, len(FEATURES))
            chance = np.ones(len(x)) if forest is None else forest.chance(x)
            yield pa.RecordBatch.from_arrays([*part.columns[:-1], pa.array(chance)], names=["key", *BASE, "chance"])

    kind = measured.schema[key].dataType.simpleString()
    counts = ", ".join(f"{c} bigint" for c in BASE)
    scored = measured.withColumnRenamed(key, "key").mapInArrow(run, f"key {kind}, {counts}, chance double")
    return scored.select(
        F.col("key").alias(key),
        *BASE,
        base_failed().alias("base_failed"),
        (~base_failed() & (F.col("chance") >= threshold)).alias("kept"),
        "chance",
    )
