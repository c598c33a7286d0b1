import random
import re
import zlib
from collections import Counter

import numpy as np
from odd_tables import documents, no_documents, odd_documents, odd_rows, prose

from tastemill.llm import quality
from tastemill.sources.tables import read_table

FOLDER = "/root/testdata/sf0.1"
LABELS = "doc_id bigint, quality int, toxic int"


def plain(text):
    words = re.findall("[^\x20\x09-\x0d]+", text or "")
    windows = [tuple(words[i : i + 5]) for i in range(len(words) - 4)]
    times, inside = Counter(windows), set()
    for i, w in enumerate(windows):
        if times[w] > 1:
            inside.update(range(i, i + 5))
    lines = [x for x in (text or "").split("\n") if re.search("[^\x20\x09-\x0d]", x)]
    symbols = sum(c in "#*$%&|<>" for c in text or "")
    return [len(words), sum(map(len, words)), symbols, len(lines) - len(set(lines)), len(inside)]


def test_counts_equal_brute_force():
    rng = random.Random(2)
    for _ in range(1500):
        text = "".join(rng.choice(["a ", "b ", "c ", "\n", "#x ", "é\u0085 ", "<|>", "\t"]) for _ in range(rng.randint(0, 60)))
        assert quality.statistics(text)[0] == plain(text)
    for _, text, _ in odd_rows():
        assert quality.statistics(text or "")[0] == plain(text)


def test_trees_learn_and_stay_monotonic():
    rng = np.random.default_rng(1)
    x = rng.random((4000, 3))
    y = ((x[:, 0] < 0.6) & (x[:, 1] > 0.3) ^ (rng.random(4000) < 0.05)).astype(float)
    forest = quality.boost(x, y, decreasing=(0,))
    assert ((forest.chance(x) >= 0.5) == (y > 0.5)).mean() > 0.93
    grid = np.linspace(0, 1, 200)
    for rest in rng.random((50, 2)):
        line = np.column_stack([grid, np.tile(rest, (200, 1))])
        assert (np.diff(forest.margin(line)) <= 1e-12).all()
    by_hand = []
    for row in x[:50]:
        total = forest.start
        for node in forest.roots:
            while forest.feature[node] >= 0:
                node = forest.left[node] + int(row[forest.feature[node]] > forest.border[node])
            total += forest.value[node]
        by_hand.append(total)
    assert np.allclose(by_hand, forest.margin(x[:50]))


def test_held_out_accuracy(spark):
    docs, labels = read_table(spark, FOLDER, "documents"), read_table(spark, FOLDER, "labels")
    good = {r.doc_id: r.quality for r in labels.collect()}
    out = quality.judge(docs, labels).collect()
    assert len(out) == docs.count()
    unseen = [r for r in out if r.doc_id in good and zlib.crc32(str(r.doc_id).encode()) % 4 == 2]
    clean = [r for r in unseen if good[r.doc_id] and not r.base_failed]
    junk = [r for r in unseen if not good[r.doc_id]]
    assert sum(r.kept for r in clean) / len(clean) > 0.98
    assert sum(r.kept for r in junk) / len(junk) < 0.02


def test_odd_rows(spark):
    rows = odd_rows()
    labels = spark.createDataFrame([(None, 1, 0), (6, None, 0), (6, 1, 0), (6, 0, 0), (9, 0, 1), (11, 1, 0)], LABELS)
    out = quality.judge(odd_documents(spark), labels).collect()
    assert len(out) == len(rows)
    want = sorted(plain(t) for _, t, _ in rows)
    assert sorted([getattr(r, c) for c in quality.BASE] for r in out) == want
    for r in out:
        assert r.base_failed == (r.n_words < 10 or 100 * r.n_repeat_words > 20 * r.n_words)
        assert not (r.base_failed and r.kept)
    none = spark.createDataFrame([], LABELS)
    unlabelled = quality.judge(documents(spark, [(1, prose(12), None), (2, "x", None)]), none).collect()
    assert {r.doc_id: r.kept for r in unlabelled} == {1: True, 2: False}
    assert quality.judge(no_documents(spark), none).count() == 0
