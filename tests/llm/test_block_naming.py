import hashlib

from odd_tables import collected, documents, no_documents, odd_documents, odd_rows, prose
from pyspark.sql import functions as F

from tastemill.llm import block_naming


def plain(rows):
    """Groups by whole text; ties by the larger id."""
    groups = {}
    for i, text, _ in rows:
        groups.setdefault(text or "", []).append(i)
    return groups


def check(rows, found):
    groups = plain(rows)
    assert len(found) == len(rows)
    for text, ids in groups.items():
        digest = hashlib.sha256(text.encode()).hexdigest()
        same = [r for r in found if r.text_sha256 == digest]
        best = max((i for i in ids if i is not None), default=None)
        assert len(same) == len(ids)
        assert {r.keep_id for r in same} == {best} and {r.group_size for r in same} == {len(ids)}
        assert [r.doc_id for r in same if r.kept] == [best]


def test_odd_rows(spark):
    check(odd_rows(), block_naming.copies(odd_documents(spark)).collect())
    assert block_naming.copies(no_documents(spark)).count() == 0


def test_small_blocks_give_many_levels(spark):
    long = prose(300)
    texts = [long, long, long[:-1], long + "x", "y" + long, "", "ab", "ab", "abc", long[:64] * 3, long[:64] * 3]
    texts += [long[:n] for n in range(60, 70)] * 2
    rows = [(i, t, None) for i, t in enumerate(texts)]
    for block in (1, 7, 64):
        check(rows, block_naming.copies(documents(spark, rows), block=block).collect())


def test_colliding_hashes_do_not_join_texts(spark):
    texts = [prose(50, i % 9) + "é" * (i % 4) for i in range(60)] + ["a", "b", "c", "a"]
    docs = documents(spark, [(i, t, None) for i, t in enumerate(texts)])
    for hashed in (lambda c: F.lit(0).cast("bigint"), lambda c: F.pmod(F.xxhash64(c), F.lit(5))):
        out = block_naming.identities(docs, ["doc_id"], block=16, hashed=hashed).collect()
        groups = {}
        for r in out:
            groups.setdefault(r.identity, set()).add(texts[r.doc_id])
        assert len(out) == len(texts) and all(len(g) == 1 for g in groups.values())
        assert len(groups) == len(set(texts))


def test_names_do_not_depend_on_the_partitioning(spark):
    texts = [prose(300 + i % 7, i % 11) for i in range(30)] * 2 + ["short", "short", ""]
    docs = documents(spark, [(i, t, None) for i, t in enumerate(texts)])
    seen = []
    for parts in (1, 3, 11):
        named = block_naming.identities(docs.repartition(parts), ["doc_id"], block=32)
        found = {r.doc_id: r.identity for r in named.collect()}
        seen.append({i: name for i, name in found.items() if name >= 0})
    assert seen[0] == seen[1] == seen[2] and len(seen[0]) > 50


def test_one_group_with_a_third_of_all_rows(spark):
    rows = [(i, prose(900) if i % 3 == 0 else prose(20, i) + str(i), None) for i in range(900)]
    check(rows, block_naming.copies(documents(spark, rows)).collect())


def test_pipeline_form_keeps_columns_and_one_row(spark):
    docs = odd_documents(spark)
    out = block_naming.without_copies(docs)
    assert out.columns == docs.columns
    assert out.count() == len(plain(odd_rows()))
    assert collected(out, "doc_id").count((5,)) == 1


def test_no_python_in_the_plan(spark):
    plan = block_naming.copies(odd_documents(spark))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "CartesianProduct" not in plan
