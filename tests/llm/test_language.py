import math
import zlib
from collections import Counter
from itertools import combinations

import numpy as np
from odd_tables import documents, no_documents, odd_documents, odd_rows

from tastemill.llm import language
from tastemill.sources.tables import read_table

FOLDER = "/root/testdata/sf0.01"


def test_held_out_accuracy(spark):
    docs = read_table(spark, FOLDER, "documents")
    model = language.fit(docs)
    assert model.families == {"germanic": ["de", "en"], "romance": ["es", "fr"]}
    known = {r.doc_id: r.lang for r in docs.select("doc_id", "lang").collect()}
    out = language.predict(docs, model).select("doc_id", "lang_pred", "score", language.held_out().alias("out")).collect()
    assert len(out) == len(known) and all(0 <= r.score <= 1 for r in out)
    assert all(r.out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in out)
    unseen = [r for r in out if r.out]
    assert sum(r.lang_pred == known[r.doc_id] for r in unseen) / len(unseen) > 0.98


def plain_vector(text):
    """Dictionary counts of hashed triples with whole numbers."""
    text, counts = f" {text.lower()} ", Counter()
    for x, y, z in zip(text, text[1:], text[2:]):
        h = (ord(x) * 0x9E3779B1 + ord(y) * 0x85EBCA77 + ord(z) * 0xC2B2AE3D) % 2**32
        counts[(h ^ (h >> 15)) * 0x27D4EB2F % 2**32 >> 20] += 1
    length = math.sqrt(sum(counts.values()))
    return {k: math.sqrt(n) / length for k, n in counts.items()}


def plain_prediction(model, text):
    """One text at a time: the likeliest family, then a vote of each pair of its languages."""
    if text is None or not any(ch.isalpha() for ch in text):
        return "und", 0.0
    x = plain_vector(text)
    z = [sum(w[k] * v for k, v in x.items()) + c for w, c in zip(model.first.weights, model.first.intercepts)]
    chance = [math.exp(v - max(z)) for v in z]
    best = z.index(max(z))
    members = model.families[model.first.classes[best]]
    votes, near = dict.fromkeys(members, 0), dict.fromkeys(members, 1.0)
    for (a, b), (w, c) in model.pairs.items():
        if a in votes and b in votes:
            for_b = 1 / (1 + math.exp(-2 * max(-30, min(30, sum(w[k] * v for k, v in x.items()) + c))))
            votes[b if for_b >= 0.5 else a] += 1
            near[a], near[b] = min(near[a], 1 - for_b), min(near[b], for_b)
    lang = max(members, key=lambda m: (votes[m], near[m]))
    return lang, chance[best] / sum(chance) * near[lang]


def test_every_prediction_equals_a_plain_one(spark):
    """Whole texts of the table, and a family of three in which languages get as many votes."""
    docs = read_table(spark, FOLDER, "documents")
    model = language.fit(docs)
    texts = {r.doc_id: r.text for r in docs.select("doc_id", "text").collect()}
    rng = np.random.default_rng(5)
    families = {"germanic": ["de", "en", "nl"], "only xx": ["xx"]}
    width = language.WIDTH
    three = language.Model(
        families,
        language.Linear(list(families), rng.normal(size=(2, width)), rng.normal(size=2) * 0.1),
        {pair: (rng.normal(size=width), 0.1) for pair in combinations(families["germanic"], 2)},
    )
    for known in (model, three):
        out = language.predict(docs, known).collect()
        assert len(out) == len(texts)
        for r in out:
            lang, score = plain_prediction(known, texts[r.doc_id])
            assert r.lang_pred == lang and abs(r.score - score) < 1e-4
    assert {r.lang_pred for r in out} == {"de", "en", "nl", "xx"}


def test_labels_of_held_out_rows_and_other_columns_have_no_effect(spark):
    docs = read_table(spark, FOLDER, "documents").limit(300)
    rows = [(r.doc_id, r.text, r.lang) for r in docs.collect()]
    changed = [(i, t, "xx" if zlib.crc32(str(i).encode()) % 4 == 2 else lang) for i, t, lang in rows]
    before, after = (language.fit(documents(spark, r)) for r in (rows, changed))
    assert before.families == after.families
    for a, b in zip(
        language.predict(documents(spark, rows), before).orderBy("doc_id").collect(),
        language.predict(documents(spark, changed), after).orderBy("doc_id").collect(),
    ):
        assert a.lang_pred == b.lang_pred and abs(a.score - b.score) < 1e-6


def test_odd_rows(spark):
    docs = odd_documents(spark)
    model = language.fit(docs)
    out = language.predict(docs, model).collect()
    assert len(out) == len(odd_rows())
    by_id = {r.doc_id: r for r in out}
    for i in (1, 2, 3, 10):
        assert by_id[i].lang_pred == "und" and by_id[i].score == 0
    assert by_id[7].lang_pred == "en"
    kept = language.recognised(docs, model)
    assert kept.columns == docs.columns
    assert kept.count() == len(out) - 4


def test_nothing_learned_one_language_and_empty_tables(spark):
    nothing = documents(spark, [(1, "some text", None), (None, "more", "en")])
    assert [r.lang_pred for r in language.predict(nothing, language.fit(nothing)).collect()] == ["und"] * 2
    assert language.recognised(nothing, language.fit(nothing)).count() == 0
    one = documents(spark, [(i, "only this", "tlh") for i in range(8)])
    out = language.predict(one, language.fit(one)).collect()
    assert {(r.lang_pred, r.score) for r in out} == {("tlh", 1.0)}
    empty = no_documents(spark)
    assert language.predict(empty, language.fit(empty)).count() == 0


def test_whole_long_texts_count():
    a, b = "abc " * 200_000, "xyz " * 200_000
    whole = language.vector(a + b)
    assert abs(float(whole @ language.vector(a)) - float(whole @ language.vector(b))) < 0.02
    parts = language.vector("q" * (language.CHUNK * 2 + 5))
    assert (parts > 0).sum() <= 3
