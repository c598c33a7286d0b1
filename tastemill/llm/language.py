"""Language identification in two steps: the family, then pairs of languages in it.

A text becomes a vector of hashed letter triples. A multinomial model picks the
family; inside it, one linear support vector machine for every pair of
languages votes. Both are fitted by Spark ML on a sample of labelled rows whose
expected size is bounded (``PER_LANGUAGE`` rows a language, chosen by a hash of
the id); the prediction reads every whole text and nothing but the text.

Defined results: null texts and texts without a letter are ``und`` with score 0;
so is every text if nothing was learned (empty table, no labels); repeated rows
get equal results; rows with a null doc_id are predicted but never learned from;
if one language was learned, every text with a letter is that language.
"""

from __future__ import annotations

from collections.abc import Iterator, Mapping
from dataclasses import dataclass, field
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import LinearSVC, LogisticRegression
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tastemill.llm.common import map_batches, slices
from tastemill.session import write_stage

UNKNOWN = "und"
#: Expected number of rows of each language that a model is fitted on.
PER_LANGUAGE = 1000
#: Hashed letter triples in a vector.
WIDTH = 4096
#: Characters counted at a time.
CHUNK = 1 << 18

# Families of languages by ISO 639-1 code; any other label is a family of its own.
FAMILIES = {
    "germanic": ("af", "da", "de", "en", "fy", "is", "lb", "nl", "nn", "no", "sv", "yi"),
    "romance": ("ca", "es", "fr", "gl", "it", "la", "oc", "pt", "ro"),
    "slavic": ("be", "bg", "bs", "cs", "hr", "mk", "pl", "ru", "sk", "sl", "sr", "uk"),
    "indic": ("bn", "gu", "hi", "mr", "ne", "pa", "si", "ur"),
    "turkic": ("az", "kk", "ky", "tr", "tt", "ug", "uz"),
    "uralic": ("et", "fi", "hu"),
    "semitic": ("am", "ar", "he", "mt"),
    "dravidian": ("kn", "ml", "ta", "te"),
    "austronesian": ("id", "jv", "mg", "ms", "tl"),
}


def family_of(language: str, families: Mapping[str, tuple[str, ...]] = FAMILIES) -> str:
    return next((f for f, members in families.items() if language in members), f"only {language}")


def vector(text: str) -> np.ndarray:
    """Square roots of the counts of hashed letter triples, of length 1."""
    counts = np.zeros(WIDTH, dtype=np.int64)
    for start in range(0, max(len(text), 1), CHUNK):
        # Two letters over, so that no triple is lost between chunks.
        part = f" {text[start : start + CHUNK + 2].lower()} " if start == 0 else text[start : start + CHUNK + 2].lower()
        c = np.frombuffer(part.encode("utf-32-le"), dtype="<u4")
        if len(c) < 3:
            continue
        h = c[:-2] * np.uint32(0x9E3779B1) + c[1:-1] * np.uint32(0x85EBCA77) + c[2:] * np.uint32(0xC2B2AE3D)
        h = (h ^ (h >> np.uint32(15))) * np.uint32(0x27D4EB2F)
        counts += np.bincount(h >> np.uint32(20), minlength=WIDTH)
    root = np.sqrt(counts)
    return (root / max(np.sqrt(counts.sum()), 1.0)).astype(np.float32)


def has_letter(text: str | None) -> bool:
    return text is not None and any(map(str.isalpha, text))


def _vectors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for part in slices(batches):
        rows = [(lang, vector(t)) for lang, t in zip(*(c.to_pylist() for c in part.columns)) if has_letter(t)]
        yield pa.RecordBatch.from_arrays(
            [pa.array([r[0] for r in rows], pa.string()), pa.array([r[1] for r in rows], pa.list_(pa.float32()))],
            names=["lang", "vector"],
        )


@dataclass
class Linear:
    """One weight row and one intercept for each class."""

    classes: list[str]
    weights: np.ndarray
    intercepts: np.ndarray


@dataclass
class Model:
    families: dict[str, list[str]] = field(default_factory=dict)
    first: Linear | None = None
    #: The machine of (a, b) is positive for b.
    pairs: dict[tuple[str, str], tuple[np.ndarray, float]] = field(default_factory=dict)

    def predict(self, x: np.ndarray) -> tuple[list[str], np.ndarray]:
        """Language and score of every row of ``x``: the family's probability times the closest vote's."""
        names = list(self.families)
        if self.first is None:
            chance = np.ones((len(x), 1))
        else:
            z = x @ self.first.weights.T + self.first.intercepts
            e = np.exp(z - z.max(axis=1, keepdims=True))
            chance, names = e / e.sum(axis=1, keepdims=True), self.first.classes
        best = chance.argmax(axis=1)
        found, score = [UNKNOWN] * len(x), chance[np.arange(len(x)), best]
        for i, name in enumerate(names):
            rows = np.flatnonzero(best == i)
            members = self.families[name]
            votes, near = np.zeros((len(rows), len(members))), np.ones((len(rows), len(members)))
            for a, b in combinations(range(len(members)), 2):
                w, c = self.pairs[members[a], members[b]]
                for_b = 1 / (1 + np.exp(-2 * np.clip(x[rows] @ w + c, -30, 30)))
                votes[:, a] += for_b < 0.5
                votes[:, b] += for_b >= 0.5
                near[:, a] = np.minimum(near[:, a], 1 - for_b)
                near[:, b] = np.minimum(near[:, b], for_b)
            # As many votes: the one whose closest call was the clearest, then the first by name.
            pick = (votes + 0.5 * near).argmax(axis=1)
            score[rows] *= near[np.arange(len(rows)), pick]
            for row, p in zip(rows, pick):
                found[row] = members[p]
        return found, score


def held_out(key: str = "doc_id") -> Column:
    """A quarter of the rows, by id; false without an id."""
    return F.coalesce(F.crc32(F.col(key).cast("string").cast("binary")) % 4 == 2, F.lit(False))


def fit(docs: DataFrame, key: str = "doc_id", per_language: int = PER_LANGUAGE) -> Model:
    """Learn from labelled rows that are not held out."""
    rows = docs.select(
        docs[key].alias("key"), docs["lang"].alias("lang"), docs["text"].cast("string").alias("text")
    ).filter(F.col("lang").isNotNull() & F.col("key").isNotNull() & ~held_out("key"))
    sizes = {r["lang"]: r["n"] for r in rows.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).collect()}
    if not sizes:
        return Model()
    share = F.lit(0.0)
    for lang, n in sizes.items():
        share = F.when(F.col("lang") == lang, F.lit(min(1.0, per_language / n))).otherwise(share)
    place = F.pmod(F.xxhash64(F.lit("language"), F.col("key").cast("string")), F.lit(1 << 20)) / F.lit(1 << 20)
    taken = rows.filter(place < share).select("lang", "text")
    sample = map_batches(taken, _vectors, "lang string, vector array<float>")
    sample = write_stage(sample, "language-sample").select("lang", array_to_vector("vector").alias("features"))
    learned = sorted(r[0] for r in sample.select("lang").distinct().collect())
    model = Model()
    for lang in learned:
        model.families.setdefault(family_of(lang), []).append(lang)
    if not learned:
        return model
    names = sorted(model.families)
    if len(names) > 1:
        label = F.lit(0.0)
        for i, name in enumerate(names):
            label = F.when(F.col("lang").isin(model.families[name]), F.lit(float(i))).otherwise(label)
        fitted = LogisticRegression(
            family="multinomial", maxIter=20, regParam=1e-4, standardization=False
        ).fit(sample.select("features", label.alias("label")))
        model.first = Linear(names, fitted.coefficientMatrix.toArray(), fitted.interceptVector.toArray())
    for members in model.families.values():
        for a, b in combinations(members, 2):
            pair = sample.filter(F.col("lang").isin(a, b))
            machine = LinearSVC(maxIter=20, regParam=1e-4, standardization=False).fit(
                pair.select("features", (F.col("lang") == b).cast("double").alias("label"))
            )
            model.pairs[a, b] = (machine.coefficients.toArray(), float(machine.intercept))
    return model


def predict(docs: DataFrame, model: Model, key: str = "doc_id") -> DataFrame:
    """(key, lang_pred, score) of every whole text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches):
            texts = part.column(1).to_pylist()
            known = [i for i, t in enumerate(texts) if model.families and has_letter(t)]
            langs, scores = [UNKNOWN] * len(texts), np.zeros(len(texts))
            if known:
                found, score = model.predict(np.stack([vector(texts[i]) for i in known]))
                for i, lang, s in zip(known, found, score):
                    langs[i], scores[i] = lang, s
            yield pa.RecordBatch.from_arrays(
                [part.column(0), pa.array(langs, pa.string()), pa.array(np.clip(scores, 0.0, 1.0))],
                names=["key", "lang_pred", "score"],
            )

    kind = docs.schema[key].dataType.simpleString()
    rows = docs.select(docs[key].alias("key"), docs["text"].cast("string").alias("text"))
    return map_batches(rows, run, f"key {kind}, lang_pred string, score double").withColumnRenamed("key", key)


def recognised(docs: DataFrame, model: Model) -> DataFrame:
    """The rows of ``docs``, in all their columns, whose language is not ``und``."""
    at = docs.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches):
            texts = part.column(at).to_pylist()
            known = [i for i, t in enumerate(texts) if model.families and has_letter(t)]
            langs = model.predict(np.stack([vector(texts[i]) for i in known]))[0] if known else []
            kept = [i for i, lang in zip(known, langs) if lang != UNKNOWN]
            yield part.take(pa.array(kept, pa.int64()))

    return map_batches(docs, run, docs.schema)
