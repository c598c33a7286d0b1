import random

import numpy as np
import pytest
import xxhash
from odd_tables import documents, no_documents, odd_documents, odd_rows, prose

from tastemill.llm import simhash


def plain_print(text):
    words = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    for blank in "\t\n\x0b\x0c\r":
        words = words.replace(blank, " ")
    words = [w for w in words.split(" ") if w]
    if not words:
        return 0
    size = min(3, len(words))
    h = [xxhash.xxh64_intdigest(" ".join(words[i : i + size]).encode(), 42) for i in range(len(words) - size + 1)]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def plain_components(prints, ids):
    label = list(range(len(prints)))
    f = np.array(prints, dtype=np.uint64)
    changed = True
    near = [np.flatnonzero(np.bitwise_count(f ^ x) <= 2) for x in f]
    while changed:
        changed = False
        for i, js in enumerate(near):
            low = min(label[j] for j in js)
            for j in js:
                if label[j] != low:
                    label[j], changed = low, True
    return [min((ids[j] for j in range(len(ids)) if label[j] == label[i] and ids[j] is not None), default=None) for i in range(len(ids))]


def test_fingerprints_equal_the_plain_ones():
    for _, text, _ in odd_rows():
        if text is None or len(text) < 10_000:
            assert simhash.fingerprint(text or "") == plain_print(text)
    for text in ("ÀB Àb c d", "One two", "É é e\u0085f g h i", "a a a a a a"):
        assert simhash.fingerprint(text) == plain_print(text)


def clustered(rng, centres, each, spread):
    out = set()
    for _ in range(centres):
        c = rng.getrandbits(64)
        for _ in range(each):
            x = c
            for _ in range(rng.randint(0, spread)):
                x ^= 1 << rng.randrange(64)
            out.add(x)
    return sorted(out)


def test_tree_search_finds_all_close_pairs():
    rng = random.Random(3)
    for centres, each, spread in ((1, 400, 4), (40, 12, 3), (300, 1, 0)):
        codes = np.array(clustered(rng, centres, each, spread), dtype=np.uint64)
        rank = codes.copy()
        for shift in (1, 2, 4, 8, 16, 32):
            rank ^= rank >> np.uint64(shift)
        group = (codes % np.uint64(3)).astype(np.int64)
        order = np.lexsort((rank, group))
        codes, group = codes[order], group[order]
        left, right = simhash.close_pairs(codes, group)
        found = set(zip(left.tolist(), right.tolist()))
        want = {
            (i, j)
            for i in range(len(codes))
            for j in range(i + 1, len(codes))
            if group[i] == group[j] and int(codes[i] ^ codes[j]).bit_count() <= 2
        }
        assert found == want


@pytest.mark.parametrize("node", [2048, 8])
def test_components_equal_brute_force_at_any_node_size(spark, node):
    rng = random.Random(5)
    prints = clustered(rng, 60, 25, 4) + [0, (1 << 64) - 1, 1, 3, 7, 15, 1 << 63]
    prints = sorted(set(prints))
    frame = spark.createDataFrame([(p - (1 << 64) if p >> 63 else p,) for p in prints], "fp bigint")
    roots = {r.node: r.root for r in simhash.components(simhash.links(frame, node)).collect()}
    signed = [p - (1 << 64) if p >> 63 else p for p in prints]
    order = sorted(range(len(prints)), key=signed.__getitem__)
    want = plain_components([prints[i] for i in order], [signed[i] for i in order])
    assert [roots.get(signed[i], signed[i]) for i in order] == want


def test_long_chains_end_in_one_component(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(200)], "a bigint, b bigint")
    found = {r.node: r.root for r in simhash.components(edges).collect()}
    assert found == {i: 0 for i in range(1, 201)}


def test_odd_rows(spark):
    rows = odd_rows() + [(20 + i, prose(200) + f" {i}", None) for i in range(6)]
    out = simhash.near_copies(documents(spark, rows, extra=True), ["doc_id"]).collect()
    prints = [simhash.fingerprint(t or "") for _, t, _ in rows]
    want = plain_components(prints, [r[0] for r in rows])
    assert sorted(map(repr, ((r.doc_id, r.component_id) for r in out))) == sorted(
        map(repr, zip([r[0] for r in rows], want))
    )
    assert simhash.near_copies(no_documents(spark), ["doc_id"]).count() == 0


def test_pipeline_form_keeps_one_row_of_each(spark):
    docs = odd_documents(spark)
    out = simhash.one_of_each(docs)
    prints = [simhash.fingerprint(t or "") for _, t, _ in odd_rows()]
    want = plain_components(prints, [r[0] for r in odd_rows()])
    assert out.columns == docs.columns
    assert sorted(r.doc_id for r in out.collect()) == sorted(set(want))
