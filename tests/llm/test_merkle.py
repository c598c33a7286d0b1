import hashlib
import zlib

import pytest
from odd_tables import DOCUMENTS, no_documents, odd_documents, prose
from pyspark.sql import functions as F

from tastemill.llm import merkle


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def leaf(row, text=None):
    fields = [row["doc_id"], row["source"], row["lang"], row["n_chars"], row["text"] if text is None else text]
    told = [None if x is None else str(x) for x in fields]
    return sha("".join("-" if x is None else f"{len(x.encode())}:{x}" for x in told))


def climb(nodes):
    """Root of a list of digests, and for each the siblings (before, after) up to it."""
    paths, at = [[] for _ in nodes], list(range(len(nodes)))
    while len(nodes) > 1:
        for i, path in enumerate(paths):
            start = at[i] // 16 * 16
            run = nodes[start : start + 16]
            path.append((run[: at[i] - start], run[at[i] - start + 1 :]))
            at[i] //= 16
        nodes = [sha("".join(nodes[i : i + 16])) for i in range(0, len(nodes), 16)]
    return (nodes or [None])[0], paths


def lower(text):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in text)


def plain(rows):
    """The contract's columns, from whole lists."""
    by_source = {}
    for r in rows:
        by_source.setdefault(r["source"], []).append(r)
    order = sorted(by_source, key=lambda s: (s is not None, (s or "").encode()))
    trees = {}
    for s, members in by_source.items():
        members.sort(key=lambda r: (r["doc_id"] is not None, r["doc_id"] or 0, leaf(r)))
        trees[s] = climb([leaf(r) for r in members])
    root, above = climb([trees[s][0] for s in order])
    out = []
    for s, up in zip(order, above):
        for r, path in zip(by_source[s], trees[s][1]):
            hit = r["doc_id"] is not None and zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0
            changed = r["text"] is not None and hit
            node = leaf(r, lower(r["text"])) if changed else leaf(r)
            proof = ""
            for before, after in path + up:
                proof += "".join(before + after)
                node = sha("".join(before) + node + "".join(after))
            out.append((r["doc_id"], leaf(r), trees[s][0], root, sha(proof), node, node == root))
    return out


NAMES = ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]


def check(frame, **how):
    rows = [r.asDict() for r in frame.select("doc_id", "text", "lang", "source", "n_chars").collect()]
    out = merkle.tampered(frame, **how)
    assert out.columns == NAMES
    found = sorted((tuple(r) for r in out.collect()), key=repr)
    assert found == sorted(plain(rows), key=repr)
    return found


def table(spark, sizes, text=lambda i: f"Text {i}"):
    rows = [(i * 7919 % 1_000_003, text(i), "en", s, i) for s, n in sizes.items() for i in range(n)]
    return spark.createDataFrame(rows, DOCUMENTS)


@pytest.mark.parametrize("sizes", [{"a": 1}, {"a": 16, None: 17}, {"b": 300, "B": 1, "é": 257, None: 4097, "": 5}])
def test_sizes_of_trees(spark, sizes):
    found = check(table(spark, sizes))
    assert {r[-1] for r in found} == {True, False} or len(found) < 20


def test_many_sources(spark):
    found = check(table(spark, {f"s{i}": 1 + i % 3 for i in range(300)}))
    assert len(found) == sum(1 + i % 3 for i in range(300))


def test_small_blocks_have_many_tiers(spark):
    check(table(spark, {"hot": 1100, "a": 18, "b": 1}), depth=1)


def test_odd_rows(spark):
    check(odd_documents(spark))
    assert merkle.tampered(no_documents(spark)).count() == 0
    assert merkle.Manifest(no_documents(spark)).root() is None


def test_unchanged_texts_verify(spark):
    rows = check(table(spark, {"a": 40}, lambda i: f"no capitals {i}"))
    assert all(r[-1] for r in rows)


def test_versions_share_all_but_the_copied_nodes(spark):
    """Version 0 with a version's own nodes laid over it is the tree of the changed table."""
    docs = table(spark, {"a": 700, "b": 20})
    hit = F.col("doc_id") % 97 == 0
    manifest = merkle.Manifest(docs, F.concat("text", F.lit("!")), hit)
    base = {(r.source, r.level, r.position): r.digest for r in manifest.nodes().collect()}
    own = {}
    for r in manifest.versions().collect():
        own.setdefault((r.source, r.version), {})[r.whole, r.level, r.position] = r.digest
    rows = [r.asDict() for r in docs.collect()]
    by_source = {s: sorted((r for r in rows if r["source"] == s), key=lambda r: r["doc_id"]) for s in "ab"}
    assert len(own) == sum(r["doc_id"] % 97 == 0 for r in rows)
    for (source, version), nodes in own.items():
        changed = [leaf(r) for r in by_source[source]]
        changed[version] = leaf(by_source[source][version], by_source[source][version]["text"] + "!")
        level, place = 0, version
        while len(changed) > 1:
            for i, digest in enumerate(changed):
                shared = base.get((source, level, i)) if level else None
                if i == place:
                    assert nodes[False, level, i] == digest
                elif level:
                    assert shared == digest
            changed = [sha("".join(changed[i : i + 16])) for i in range(0, len(changed), 16)]
            level, place = level + 1, place // 16
        assert nodes[False, level, 0] == nodes[True, 0, "ab".index(source)] == changed[0]
        other = climb([leaf(r) for r in by_source["ab"["ab".index(source) - 1]]])[0]
        subroots = [changed[0], other] if source == "a" else [other, changed[0]]
        assert nodes[True, 1, 0] == sha("".join(subroots))
        assert len(nodes) == level + 1 + 2


def test_equal_under_every_partitioning(spark):
    docs = table(spark, {"a": 100, "b": 7}, lambda i: prose(i % 9))
    one = sorted(map(tuple, merkle.tampered(docs.repartition(1)).collect()))
    assert one == sorted(map(tuple, merkle.tampered(docs.repartition(13)).collect()))
