"""The skew-safe helpers against brute force, with hot keys cut into several parts."""

import random
from itertools import combinations

import numpy as np
import pandas as pd
import pyarrow as pa
import pytest
from conftest import rows
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import Window
from pyspark.sql import functions as F

from tastemill.functions import bands, blocks
from tastemill.functions.blocks import block_top_k
from tastemill.functions.copies import hand_out, members_of
from tastemill.functions.exact import exact_sum, require, round6
from tastemill.functions.ordered import OrderedSplit
from tastemill.functions.pairs import directed_pairs, directed_stats, pair_stats, shared_pairs
from tastemill.functions import sparse
from tastemill.functions.sparse import near_vectors


def test_ordered_scans_equal_plain_windows(spark, many_parts):
    rng = random.Random(3)
    data = [("hot" if rng.random() < 0.7 else f"u{rng.randrange(40)}", i, rng.randrange(5)) for i in range(900)]
    df = spark.createDataFrame(data, "key string, id bigint, x bigint")
    scan = OrderedSplit(df, ["key"], ["id"])
    assert scan.df.filter("key = 'hot'").select("_part").distinct().count() > 3
    scan.row_number("n").running_sum(F.col("x"), "s").running_sum(F.col("x"), "before", inclusive=False)
    scan.key_total(F.col("x"), "total").lag(F.col("x"), "prev").lead(F.col("x"), "next")
    w = Window.partitionBy("key").orderBy("id")
    expected = df.select(
        "*",
        F.row_number().over(w).alias("n"),
        F.sum("x").over(w.rowsBetween(Window.unboundedPreceding, 0)).alias("s"),
        F.coalesce(F.sum("x").over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("before"),
        F.sum("x").over(Window.partitionBy("key")).alias("total"),
        F.lag("x").over(w).alias("prev"),
        F.lead("x").over(w).alias("next"),
    )
    got = {r["id"]: tuple(r[c] for c in expected.columns) for r in scan.result().collect()}
    assert got == {r["id"]: tuple(r) for r in expected.collect()}


def test_ordered_scan_without_keys(spark, many_parts):
    df = spark.range(500).select((F.col("id") * 7 % 500).alias("v"))
    scan = OrderedSplit(df, [], ["v"]).row_number("n").key_total(F.lit(1), "all").lag(F.col("v"), "p")
    for r in scan.result().collect():
        assert (r["n"], r["all"], r["p"]) == (r["v"] + 1, 500, r["v"] - 1 if r["v"] else None)


@settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(
    st.sets(st.tuples(st.integers(0, 4), st.integers(0, 14)), min_size=1, max_size=50),
    st.sampled_from([1, 2, 3, 100]),
)
def test_pairs_meet_once_whatever_the_cell(spark, owned, cell):
    df = spark.createDataFrame([(u, i, i * 10) for u, i in owned], "user bigint, item bigint, v bigint")
    got = rows(shared_pairs(df, "user", "item", ["v"], cell), "user", "a", "b", "v_a", "v_b")
    expected = []
    for user in {u for u, _ in owned}:
        items = sorted(i for u, i in owned if u == user)
        expected += [(user, a, b, a * 10, b * 10) for a, b in combinations(items, 2)]
    assert got == sorted(expected)


def test_pair_stats_of_nothing(spark):
    df = spark.createDataFrame([(1, 5), (2, 6)], "user bigint, item bigint")
    assert pair_stats(df, "user", "item", [F.count("*").alias("k")]).count() == 0


@settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(
    st.sets(st.tuples(st.integers(0, 4), st.integers(0, 14)), min_size=1, max_size=50),
    st.sampled_from([1, 2, 3, 100]),
)
def test_directed_pairs_meet_once_in_one_part(spark, owned, cell):
    df = spark.createDataFrame([(u, i, i * 10) for u, i in owned], "user bigint, item bigint, v bigint")
    pairs = directed_pairs(df, "user", "item", ["v"], cell)
    got = rows(pairs, "a", "b", "v_a", "v_b")
    expected = []
    for user in {u for u, _ in owned}:
        items = [i for u, i in owned if u == user]
        expected += [(a, b, a * 10, b * 10) for a in items for b in items if a != b]
    assert got == sorted(expected)
    assert len({r[:2] for r in rows(pairs, "a", "b", "part")}) == len(set(rows(pairs, "a", "b", "part")))


def test_directed_sums_need_no_further_shuffle(spark):
    df = spark.createDataFrame([(u, i, 1) for u in range(30) for i in range(9)], "user bigint, item bigint, n bigint")
    sums = directed_stats(df, "user", "item", [F.count("*").alias("k")], fixed=["n"], cell=4)
    assert {r["k"] for r in sums.collect()} == {30} and sums.count() == 72
    plan = sums._jdf.queryExecution().executedPlan().toString()
    spread = plan[: plan.index("Generate")]
    assert "HashAggregate" in spread and "Exchange" not in spread


def test_copies_share_the_list_of_their_representative(spark):
    rng = random.Random(5)
    values = {i: rng.choice([0, 0, 0, 1, 4, 9, 15]) for i in range(60)}
    df = spark.createDataFrame(list(values.items()), "id bigint, v bigint")
    members = members_of(df, "id", ["v"])
    reps = df.join(members.filter("id = rep").select("id"), "id")
    a, b = reps.toDF("a", "va"), reps.toDF("b", "vb")
    near = a.join(b, F.col("a") != F.col("b")).select(
        "a", "b", (1.0 / (1.0 + F.abs(F.col("va") - F.col("vb")))).alias("score")
    )
    got = rows(hand_out(near, members, 4, F.lit(1.0)), "id", "rank", "b")
    expected = []
    for i in values:
        others = sorted((-1 / (1 + abs(values[i] - values[j])), j) for j in values if j != i)
        expected += [(i, r + 1, j) for r, (_, j) in enumerate(others[:4])]
    assert got == sorted(expected)


@pytest.mark.parametrize("block", [4, 1000])
def test_block_products_equal_brute_force(spark, block):
    rng = np.random.default_rng(1)
    vectors = rng.normal(size=(40, 6))
    vectors[7] = vectors[3]
    df = spark.createDataFrame(
        [(i, v.tolist(), 0 if i < 30 else 1) for i, v in enumerate(vectors)],
        "id bigint, vec array<double>, cell int",
    )
    got = rows(block_top_k(df, df, 5, block, by="cell"), "id", "rank", "b")
    unit = vectors / np.linalg.norm(vectors, axis=1, keepdims=True)
    score = np.floor(unit @ unit.T * 1e6 + 0.5) / 1e6
    expected = []
    for i in range(40):
        same = [j for j in range(40) if j != i and (j < 30) == (i < 30)]
        best = sorted(same, key=lambda j: (-score[i, j], j))[:5]
        expected += [(i, r + 1, j) for r, j in enumerate(best)]
    assert got == sorted(expected)


@pytest.mark.parametrize("block", [4, 2048])
def test_left_out_pairs_are_masked_in_their_block(spark, block):
    """Users who have seen almost everything still get the right unseen items."""
    seen = [(0, i) for i in range(95)] + [(1, i) for i in range(0, 60, 2)] + [(2, 99), (2, 99), (3, 1000)]
    vectors = spark.createDataFrame([(i, [float(-i)]) for i in range(100)], "id bigint, vec array<double>")
    users = spark.createDataFrame([(i, [1.0]) for i in range(4)], "id bigint, vec array<double>")
    left_out = spark.createDataFrame(seen, "id bigint, b bigint")
    best = block_top_k(users, vectors, 3, block, cosine=False, skip_self=False, left_out=left_out)
    assert rows(best, "id", "rank", "b") == [
        (0, 1, 95), (0, 2, 96), (0, 3, 97), (1, 1, 1), (1, 2, 3), (1, 3, 5),
        (2, 1, 0), (2, 2, 1), (2, 3, 2), (3, 1, 0), (3, 2, 1), (3, 3, 2),
    ]


@pytest.mark.parametrize("block", [16, 2048])
def test_bands_leave_out_blocks_and_no_vector(spark, block):
    """Lengths that fall, ties, a zero query and vector, negative scores, users who have seen nearly all."""
    rng = np.random.default_rng(3)
    vectors = rng.normal(size=(300, 5)) * np.exp(-np.arange(300) / 60)[:, None]
    vectors[20:24], vectors[299] = vectors[10], 0.0
    people = rng.normal(size=(50, 5))
    people[7], people[8] = 0.0, -np.abs(people[8])
    schema = "id bigint, vec array<double>"
    v = spark.createDataFrame([(i, x.tolist()) for i, x in enumerate(vectors)], schema)
    q = spark.createDataFrame([(i, x.tolist()) for i, x in enumerate(people)], schema)
    seen = [(u, i) for u in range(50) for i in range(300) if (u * 7 + i) % 11 == 0] + [(3, i) for i in range(296)]
    left_out = spark.createDataFrame(seen, "id bigint, b bigint")
    for out in (None, left_out):
        expected = rows(block_top_k(q, v, 4, 64, cosine=False, skip_self=False, left_out=out))
        assert rows(bands.band_top_k(q, v, 4, block, out)) == expected
    held = bands.bands_of(v, block)
    assert np.all(np.diff(held.longest) <= 0) and held.blocks == -(-300 // block)
    if block == 16:
        near = bands.band_top_k(q, v, 4, block)
        seen_blocks = bands.visits(q, near, held, 4).agg(F.avg(F.col("last") + 1)).first()[0]
        assert seen_blocks < 0.4 * held.blocks
    assert bands.band_top_k(q, v.limit(0), 4, block).count() == 0 == bands.band_top_k(q.limit(0), v, 4, block).count()


def test_missing_columns_are_named(spark):
    with pytest.raises(ValueError, match="item"):
        require(spark.range(1), "item")


@pytest.mark.parametrize("ansi", ["true", "false"])
def test_exact_sums_do_not_clip(spark, ansi):
    spark.conf.set("spark.sql.ansi.enabled", ansi)
    try:
        for terms, scale in (
            ([1e10], 1e9),
            ([1e10, -1e10, 0.25], 1e9),
            ([1e14] * 40, 1e6),
            ([4e10] * 5, 1e9),
            ([9.3e9, 9.3e9, -0.5], 1e9),
            ([0.1] * 10 + [None], 1e9),
            ([-2.5, 1e13], 1e9),
        ):
            df = spark.createDataFrame([(t,) for t in terms], "x double").repartition(4)
            want = sum(np.floor(t * scale + 0.5) for t in terms if t is not None) / scale
            assert df.agg(exact_sum(F.col("x"), scale)).first()[0] == pytest.approx(want, rel=1e-15)
        empty = spark.createDataFrame([(None,)], "x double")
        assert empty.agg(exact_sum(F.col("x"))).first()[0] is None
        for bad in ([1e17], [float("inf")], [float("nan")], [1e15] * 4):
            df = spark.createDataFrame([(t,) for t in bad], "x double")
            with pytest.raises(Exception, match="range"):
                df.agg(exact_sum(F.col("x"))).collect()
        values = spark.createDataFrame([(1e13,), (-1e13,), (1.23456789,), (9.1e9,), (None,)], "x double")
        assert [r[0] for r in values.select(round6(F.col("x"))).collect()] == [1e13, -1e13, 1.234568, 9.1e9, None]
    finally:
        spark.conf.unset("spark.sql.ansi.enabled")


def test_exact_sum_does_not_depend_on_order(spark):
    rng = random.Random(8)
    data = [(i % 7, rng.uniform(-1e6, 1e6)) for i in range(4000)]
    results = set()
    for parts in (1, 3, 16):
        df = spark.createDataFrame(data, "g int, x double").repartition(parts)
        results.add(tuple(rows(df.groupBy("g").agg(exact_sum(F.col("x")).alias("s")))))
    assert len(results) == 1


def test_wide_blocks_are_searched_tile_by_tile():
    """Blocks of many tiles give the lists of one product: ties, copies, seen vectors, and queries without enough others."""
    rng = np.random.default_rng(11)
    vectors = np.round(rng.normal(size=(300, 4)), 1)
    vectors[50:90], vectors[200] = vectors[7], 0.0
    frame = pd.DataFrame({"b": np.arange(300), "b_vec": list(vectors)}).sample(frac=1, random_state=1)
    out = [np.arange(300) if q == 3 else np.arange(q % 7, 296, 2) if q % 5 == 0 else None for q in range(40)]
    asked = pd.DataFrame({"id": np.arange(40), "vec": list(vectors[:40]), "left_out": out})
    for cosine, scale in ((True, 1e6), (False, 1e12), (False, 1.0)):
        whole = blocks._best_of_block(9, cosine, True, scale, 512)(asked, frame)
        tiles = blocks._best_of_block(9, cosine, True, scale, 16)(asked, frame)
        order = ["id", "score", "b"]
        found = [x.sort_values(order, ascending=[True, False, True]).reset_index(drop=True) for x in (whole, tiles)]
        pd.testing.assert_frame_equal(*found)
        assert found[1].groupby("id").size().max() == 9 and 3 not in found[1]["id"].values


def test_vectors_travel_to_few_wide_blocks(spark):
    """At the least width a row of 100,000 would be copied to 49 blocks of the other side."""
    wide = spark.range(100000).select("id", F.array(F.lit(1.0)).alias("vec"))
    grid = blocks._grid(wide, wide, [], 2048, 8).first()
    assert (grid["_qs"], grid["_vs"]) == (4, 4)
    few = blocks._grid(wide, wide.limit(3000), [], 2048, 32).first()
    assert (few["_qs"], few["_vs"]) == (32, 1)


def test_a_block_of_sparse_vectors_is_packed_once_in_few_bytes(spark):
    """As arrays of numbers and doubles an entry has 16 bytes; weights and norms come out as they went in."""
    rng = np.random.default_rng(31)
    terms = [np.unique(np.minimum(rng.zipf(1.3, 200), 40000) - 5) for _ in range(3000)]
    weight = np.round(rng.uniform(0.1, 12, 40001) * 1e6) / 1e6
    us = [weight[t] for t in terms]
    norm = [float(np.sqrt((u * u).sum())) for u in us]
    kinds = [pa.int64(), pa.list_(pa.int64()), pa.list_(pa.float64()), pa.float64(), pa.int32()]
    columns = [pa.array(x, t) for x, t in zip((range(3000), terms, us, norm, [7] * 3000), kinds)]
    batch = pa.RecordBatch.from_arrays(columns, names=["id", "terms", "us", "norm", "part"])
    layout = [(2, True), (4, True)]
    (sent,) = sparse._packer(layout, -5, True)(iter([batch.slice(0, 1000), batch.slice(1000)]))
    part, *pack = (c[0].as_py() for c in sent.columns)
    entries = sum(map(len, terms))
    assert part == 7 and pack[2] == entries and len(pack[3]) < 3 * entries
    ids, sizes, term, u = sparse._opened(pack, layout, True)
    assert ids.tolist() == list(range(3000)) and (term == np.concatenate(terms) + 5).all()
    assert (u == np.concatenate([x / n for x, n in zip(us, norm)])).all() and sizes.tolist() == list(map(len, terms))
    rows_ = [(f"d{i}", [1, 2, 3 + i % 2], [1.0, 2.0, 2.0], 3.0) for i in range(4)]
    named = spark.createDataFrame(rows_, "id string, terms array<bigint>, us array<double>, norm double")
    met = near_vectors(named, 0.9, 3)
    assert rows(met) == [("d0", "d2", 1.0), ("d1", "d3", 1.0), ("d2", "d0", 1.0), ("d3", "d1", 1.0)]
    assert "CoGroups" not in met._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("bar", [0.3, 0.5, 0.8])
def test_sparse_vectors_meet_in_blocks_without_pair_rows(spark, bar):
    """Frequent and rare terms, copies, a vector without entries, and blocks, index and lists cut small."""
    rng = np.random.default_rng(13)
    near, data = {}, []
    for i in range(150):
        terms = np.unique(np.r_[rng.choice(400, 3), 400 + rng.choice(30, 6), 430 + rng.choice(4, 3)])
        base = data[i - 1][1:] if i % 3 == 1 else None
        if base is not None:
            terms = np.array(sorted(set(base[0][: rng.integers(4, 9)]) | set(terms[-2:].tolist())))
        u = rng.uniform(0.1, 2.0, len(terms)) * np.where(terms < 400, 3, 1)
        if base is not None and i % 4 == 1:
            terms, u = np.array(base[0]), np.array(base[1])
        u = u / np.sqrt((u * u).sum())
        data.append((i, terms.tolist(), u.tolist()))
    wide = np.zeros((150, 434))
    for i, terms, u in data:
        wide[i, terms] = u
    for i in range(150):
        score = np.floor(np.floor(wide * wide[i] * 1e9 + 0.5).sum(axis=1) / 1e9 * 1e6 + 0.5) / 1e6
        best = sorted((-score[j], j) for j in range(150) if j != i and score[j] >= bar)[:3]
        near.update({(i, j): -s for s, j in best})
    vectors = spark.createDataFrame([*data, (999, [], [])], "id bigint, terms array<bigint>, us array<double>").repartition(5)
    for sizes in ({}, {"least": 20, "step": 50}, {"entries": 300, "step": 7}):
        found = {(r["a"], r["b"]): r["score"] for r in near_vectors(vectors, bar, 3, **sizes).collect()}
        assert near.items() <= found.items() and all(s >= bar for s in found.values())
    assert len(near) > 30
