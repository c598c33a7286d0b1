"""Hand-made cases, properties and cross-checks of the batch operators."""

import math
import random
from collections import Counter
from datetime import datetime, timedelta

import numpy as np
import pandas as pd
import pyarrow as pa
import pytest
from conftest import rows
from pyspark.ml.evaluation import RankingEvaluator
from pyspark.ml.fpm import PrefixSpan
from pyspark.sql import functions as F

from tastemill.functions.pairs import mirrored, pair_stats
from tastemill.functions.top_pairs import top_pairs
from tastemill.functions import slope, top_pairs as packed_lists, votes
from tastemill.operators import baseline, content, factors, graph, metrics, patterns, ranking
from tastemill.operators import interactions as prep
from tastemill.operators import neighbours as nb
from tastemill.operators import postprocess as pp
from tastemill.plans import common
from tastemill.plans import content as registered
from tastemill.plans import evaluation
from tastemill.sources import tables

PREFS = "user bigint, item bigint, weight double"
START = datetime(2024, 1, 1)


def taste_groups(spark, seed=1):
    """Two groups of users and items; a user owns 8 of the 12 items of one group."""
    rng = random.Random(seed)
    data = []
    for user in range(40):
        group = user % 2
        for item in rng.sample(range(12), 8):
            data.append((user, item * 2 + group, 1.0 + rng.randrange(3)))
    return spark.createDataFrame(data, PREFS)


@pytest.fixture(scope="module")
def tastes(spark):
    return taste_groups(spark).cache()


def test_one_shared_item_has_no_pairs(spark):
    prefs = spark.createDataFrame([(1, 10, 1.0), (2, 10, 1.0)], PREFS)
    assert nb.item_cosine(prefs).count() == 0
    assert rows(nb.user_similarity(prefs, "cosine"), "a", "b", "score") == [(1, 2, 1.0)]


def test_empty_input(spark):
    empty = spark.createDataFrame([], PREFS)
    assert nb.neighbours(nb.item_cosine(empty), 3).count() == 0
    assert prep.k_core(empty.withColumn("last_ts", F.lit(None).cast("timestamp_ntz")), 2, 2).count() == 0


def test_tied_scores_rank_by_item(spark):
    recs = spark.createDataFrame([(1, i, 2.0) for i in (5, 3, 9)], "user bigint, item bigint, score double")
    assert rows(pp.top_n(recs, 2), "rank", "item") == [(1, 3), (2, 5)]


def test_item_cf_finds_the_planted_groups(tastes):
    recs = nb.item_cf(tastes, nb.neighbours(nb.item_cosine(tastes), 10), 4)
    got = recs.collect()
    assert got and all(r["user"] % 2 == r["item"] % 2 for r in got)
    assert recs.join(tastes, ["user", "item"]).count() == 0
    ranks = {}
    for r in got:
        ranks.setdefault(r["user"], []).append(r["rank"])
    assert all(sorted(v) == list(range(1, len(v) + 1)) for v in ranks.values())


@pytest.mark.parametrize("measure", [nb.item_cosine, nb.item_cosine_weighted, nb.item_jaccard])
def test_similarities_stay_in_range(tastes, measure):
    assert measure(tastes).filter("score < 0 or score > 1 or a >= b").count() == 0


def test_llr_of_independent_items_is_zero(spark):
    data = [(u, 1, 1.0) for u in (0, 1)] + [(u, 2, 1.0) for u in (0, 2)] + [(3, 3, 1.0)]
    found = nb.item_llr(spark.createDataFrame(data, PREFS)).filter("a = 1 and b = 2").first()
    assert found["score"] == 0.0


def test_k_core_is_stable(tastes):
    first = prep.k_core(tastes, 8, 13)
    assert rows(prep.k_core(first, 8, 13)) == rows(first)


def test_preferences_skip_null_weights(spark):
    data = [(1, 1, START, 2.0), (1, 1, START + timedelta(days=1), None)]
    acts = spark.createDataFrame(data, "user bigint, item bigint, ts timestamp_ntz, weight double")
    assert rows(prep.preferences(acts), "weight") == [(2.0,)]


def test_session_gap_of_exactly_the_limit_does_not_split(spark, many_parts):
    times = [0, 60, 121, 500]
    data = [(1, START + timedelta(seconds=t), i) for i, t in enumerate(times)]
    events = spark.createDataFrame(data, "user bigint, ts timestamp_ntz, event_id bigint")
    assert rows(prep.sessionise(events, 60), "event_id", "session") == [(0, 1), (1, 1), (2, 2), (3, 3)]


def test_giant_basket_keeps_all_items(spark):
    items = spark.range(1000).select(F.lit(1).cast("bigint").alias("basket"), F.col("id").alias("item"))
    parts = prep.baskets(items, chunk=300).orderBy("part").collect()
    assert [len(p["items"]) for p in parts] == [300, 300, 300, 100]
    assert [i for p in parts for i in p["items"]] == list(range(1000))


def test_negative_sample_goes_past_a_full_bucket(spark):
    items = spark.range(300).select(F.col("id").alias("item"))
    hot = [(1, i) for i in range(297)] + [(2, 5)]
    prefs = spark.createDataFrame(hot, "user bigint, item bigint")
    drawn = prep.negative_sample(prefs, items, 4, 1, bucket_items=30)
    assert {i for u, i in rows(drawn, "user", "item") if u == 1} == {297, 298, 299}
    assert [r for u, r in rows(drawn, "user", "rank") if u == 1] == [1, 2, 3]
    assert drawn.agg(F.max("round")).first()[0] <= 4  # 1, 2, 4 and the last 3 of 10 buckets
    assert drawn.filter("user = 2").count() == 4
    assert drawn.join(prefs, ["user", "item"]).count() == 0


def test_index_ids_follow_key_order(spark, many_parts):
    keys = spark.createDataFrame([(k,) for k in (10, 2, 33, 2, 7)], "k bigint")
    assert rows(prep.index_ids(keys, "k")) == [(2, 0), (7, 1), (10, 2), (33, 3)]


def test_recs_are_read_back(spark, tastes, tmp_path):
    recs = nb.item_cf(tastes, nb.neighbours(nb.item_cosine(tastes), 5), 3)
    tables.write_recs(recs, str(tmp_path / "recs"), 4)
    assert rows(tables.read_recs(spark, str(tmp_path / "recs"))) == rows(recs, "user", "item", "score", "rank")
    one = tables.read_recs(spark, str(tmp_path / "recs"), 2)
    assert 0 < one.count() < recs.count()
    tables.save_recs_table(recs, "recs_saved", 4)
    assert rows(spark.table("recs_saved"), "user", "item") == rows(recs, "user", "item")
    spark.sql("DROP TABLE recs_saved")


def test_minhash_pairs_are_exact_and_found(spark, tastes):
    exact = {(a, b): s for a, b, s in rows(nb.item_jaccard(tastes), "a", "b", "score")}
    near = nb.minhash_neighbours(tastes, 40, 0.3, 30).collect()
    for r in near:
        assert r["score"] == exact[min(r["id"], r["b"]), max(r["id"], r["b"])]
    wanted = {p for p, s in exact.items() if s >= 0.3}
    found = {(min(r["id"], r["b"]), max(r["id"], r["b"])) for r in near}
    assert found <= wanted and len(found) >= 0.8 * len(wanted)


def test_registered_minhash_finds_the_exact_lists(spark):
    folder = "/root/testdata/sf0.01"
    near = set(rows(registered.QUERIES["minhash_neighbours"](spark, folder), "id", "b"))
    wanted = nb.item_jaccard(common.prefs(spark, folder)).filter("score >= 0.04")
    exact = set(rows(nb.neighbours(wanted, 10), "a", "b"))
    assert len(near & exact) >= 0.9 * len(exact)


def _similar(owned, bar):
    sets = {}
    for user, item in owned:
        sets.setdefault(item, set()).add(user)
    out = {}
    for a in sets:
        for b in sets:
            score = len(sets[a] & sets[b]) / len(sets[a] | sets[b])
            if a != b and score >= bar:
                out.setdefault(a, []).append((-math.floor(score * 1e6 + 0.5) / 1e6, b))
    return sorted((a, b, -s) for a, found in out.items() for s, b in sorted(found)[:10])


@pytest.mark.parametrize("bar", [0.02, 0.15, 0.5, 0.9, 1.0])
def test_set_join_finds_every_pair_at_the_bar(spark, bar):
    rng = random.Random(7)
    owned = {(rng.randrange(12) if rng.random() < 0.6 else rng.randrange(90), i) for i in range(40) for _ in range(i % 25)}
    owned |= {(u, 100 + i) for u, j in list(owned) if 30 <= j for i in (j, j + 50) if rng.random() < 0.97}
    owned |= {(u, i) for u in range(200, 230) for i in (300, 301, 302)}
    prefs = spark.createDataFrame(sorted(owned), "user bigint, item bigint")
    for deep in (1, 2, 4):
        found = rows(nb.jaccard_join(prefs, bar, 10, deep), "id", "b", "score")
        assert found == _similar(owned, bar) and (bar > 0.5 or found)


def test_set_join_meets_far_fewer_pairs_than_share_a_user(spark):
    """Users with long histories are left out first: their pairs are most of the work."""
    prefs = common.prefs(spark, "/root/testdata/sf0.01").select("user", "item")
    sized = prefs.join(prefs.groupBy("item").agg(F.count("*").alias("n")), "item")

    def meetings(df):
        return df.groupBy("user").count().agg(F.sum(F.expr("count * (count - 1) / 2"))).first()[0]

    every = meetings(prefs)
    shares = [meetings(nb.rare_owners(sized, bar)) / every for bar in (0.04, 0.2, 0.5, 0.8)]
    assert shares == sorted(shares, reverse=True)
    assert shares[0] <= 1 and shares[2] < 0.4 and shares[3] < 0.15


def test_lists_of_hot_users_and_items_hold_no_pair_rows(spark):
    """Chunks, parts and folds as small as can be give the lists of the pair table."""
    rng = random.Random(11)
    owned = {(rng.randrange(30) if rng.random() < 0.5 else 1, rng.randrange(25) if rng.random() < 0.7 else -3) for _ in range(300)}
    prefs = spark.createDataFrame([(u, i, rng.randrange(1, 60) / 4) for u, i in sorted(owned)], "user bigint, item bigint, weight double")
    ratings = prefs.withColumnRenamed("weight", "rating")
    measures = [nb.cosine(prefs), nb.weighted_cosine(prefs), nb.conditional(prefs, 0.5), nb.pmi(prefs)]
    measures += [nb.pearson(ratings, 2), nb.adjusted_cosine(ratings), nb.iuf_cosine(prefs)]
    for m in measures:
        pairs = m.pairs()
        want = rows(pairs if m.directed else mirrored(pairs, both=["k", "score"]))
        totals = {} if m.totals is None else m.totals.first().asDict()
        for cell, entries in ((2048, 1 << 21), (4, 10)):
            found = top_pairs(
                m.rows, "user", "item", 1000, m.score, m.sums, m.values, m.fixed, m.shared, m.keep, m.directed, totals, cell, entries
            )
            assert rows(found.drop("rank")) == want
    # One row of lists for each row of the table, whatever the number of pairs.
    plan = nb.cosine(prefs).nearest(3)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("MapInArrow") >= 2 and "HashAggregate" not in plan[: plan.index("MapInArrow")]


def test_lists_for_one_task_go_as_one_compressed_row():
    rng = np.random.default_rng(13)
    groups = [rng.choice(1 << 20, 40, replace=False) for _ in range(2000)]
    sizes = rng.integers(20, 40, 1 << 20).astype(float)
    x = [[{"m": int(m), "_salts": 1, "f0": float(sizes[m])} for m in g] for g in groups]
    kind = pa.list_(pa.struct([("m", pa.int64()), ("_salts", pa.int32()), ("f0", pa.float64())]))
    batches = [pa.RecordBatch.from_arrays([pa.array(x[i : i + 500], kind)], names=["x"]) for i in range(0, 2000, 500)]
    layout = [(3, True), (1, True)]
    sent = list(packed_lists._sender(layout, 1, 0, 64, False)(iter(batches)))
    entries, lists = 2000 * 40 * 40, 2000 * 40
    assert sum(b.num_rows for b in sent) == 64
    assert sum(sum(b.column(1).to_pylist()) for b in sent) == lists
    assert sum(sum(b.column(2).to_pylist()) for b in sent) == entries
    # Entries as they are would be 12.8 MB, and 40 bytes more for each list.
    assert sum(sum(map(len, b.column(3).to_pylist())) for b in sent) < 0.85 * entries * 4


def test_lists_are_sorted_and_scored_a_block_at_a_time(monkeypatch):
    monkeypatch.setattr(packed_lists, "BLOCK", 512)
    rng = np.random.default_rng(17)
    groups = [rng.choice(50, 8, replace=False).tolist() for _ in range(60)]
    kind = pa.list_(pa.struct([("m", pa.int64()), ("_salts", pa.int32())]))
    x = pa.array([[{"m": m, "_salts": 1} for m in g] for g in groups], kind)
    sent = packed_lists._sender([(1, True)], 0, 0, 1, False)(iter([pa.RecordBatch.from_arrays([x], names=["x"])]))
    scored = []

    def score(v, m):
        scored.append(len(v["k"]))
        return v["k"] / 2

    meet = packed_lists._meeting([(1, True)], 0, 1, [], [], [], {}, score, None, False, {}, 100, 1 << 21, False)
    found = [tuple(r.values()) for batch in meet(sent) for r in batch.to_pylist()]
    want = {}
    for g in groups:
        want.update({(a, b): want.get((a, b), 0) + 1 for a in g for b in g if a != b})
    assert sorted(found) == sorted((a, b, k, k / 2) for (a, b), k in want.items())
    # A member's lists stay together: at most 30 of 8 entries here.
    assert sum(scored) == len(want) and len(scored) >= 4 and max(scored) <= 512 + 240


def test_diffusion_writes_its_preferences_once(spark, tastes, monkeypatch):
    written = []
    monkeypatch.setattr(graph, "write_stage", lambda df, label: written.append(label) or df)
    graph.mass_diffusion(tastes, 0.5, 3)
    assert written == ["prefs"]


def test_small_blocks_give_the_lists_of_the_pair_table(spark, monkeypatch):
    monkeypatch.setattr(packed_lists, "BLOCK", 16)
    rng = random.Random(18)
    owned = sorted({(rng.randrange(20), rng.randrange(25) if rng.random() < 0.7 else -3) for _ in range(200)})
    prefs = spark.createDataFrame([(u, i, rng.randrange(1, 60) / 4) for u, i in owned], "user bigint, item bigint, weight double")
    wanted = {(a, b) for a in range(-3, 25) for b in range(a + 1, 25) if rng.random() < 0.3}
    among = spark.createDataFrame([*wanted], "a bigint, b bigint")
    for m in (nb.llr(prefs), nb.weighted_cosine(prefs), nb.iuf_cosine(prefs)):
        pairs = m.pairs()
        assert rows(m.nearest(1000).drop("rank")) == rows(mirrored(pairs, both=["k", "score"]))
        assert rows(m.among(among)) == [r for r in rows(pairs) if r[:2] in wanted]


@pytest.mark.parametrize("name", ["novelty", "reciprocal_rank_fusion", "blend", "drop_seen", "fill_cold"])
def test_a_query_writes_its_folds_once(spark, monkeypatch, name):
    written = []
    monkeypatch.setattr(evaluation, "write_stage", lambda df, label: written.append(label) or df)
    evaluation.QUERIES[name](spark, "/root/testdata/sf0.001")
    assert written.count("folds") == 1


def test_pairs_once_each_have_no_pair_rows(spark):
    """All pairs a < b from half lists, whatever the chunks, parts and folds; nulls and repeated rows as in the join."""
    rng = random.Random(19)
    owned = [(rng.choice([None, 1, 1, 1, *range(30)]), rng.choice([None, -3, -3, *range(25)])) for _ in range(400)]
    ratings = spark.createDataFrame([(u, i, rng.choice([None, 1.0, 2.5, 4.0])) for u, i in owned], "user bigint, item bigint, rating double")
    pairs = pair_stats(ratings, "user", "item", [F.count(F.lit(1)).alias("k")])
    assert rows(nb.cooccur(ratings)) == rows(pairs)
    devs = nb.slope_one_deviations(ratings)
    by_name = nb.slope_one_deviations(ratings.withColumn("item", F.col("item").cast("string")))
    named = by_name.select(F.col("a").cast("bigint"), F.col("b").cast("bigint"), "k", "dev")
    turned = F.col("a") > F.col("b")
    low, high = F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")
    named = named.select(low, high, "k", F.when(turned, -F.col("dev")).otherwise(F.col("dev")).alias("dev"))
    close = {r[:2]: r[2:] for r in rows(named)}
    assert {r[:2] for r in map(tuple, devs.collect())} == set(close)
    for a, b, k, dev in devs.collect():
        assert k == close[a, b][0] and (dev is None) == (close[a, b][1] is None)
        assert dev is None or dev == pytest.approx(close[a, b][1], abs=2e-6)
    for cell, entries in ((4, 10), (4, 1 << 21), (2048, 10)):
        found = top_pairs(ratings, "user", "item", None, lambda v, m: v["k"], cell=cell, entries=entries, half=True)
        assert rows(found, "a", "b", "k") == rows(pairs)
    for made in (nb.cooccur(ratings), devs):
        plan = made._jdf.queryExecution().executedPlan().toString()
        assert plan.count("MapInArrow") >= 2 and "HashAggregate" not in plan[: plan.index("MapInArrow")]


def test_half_lists_send_half_the_entries():
    groups = [list(range(g, g + 20)) for g in range(30)]
    kind = pa.list_(pa.struct([("m", pa.int64()), ("_salts", pa.int32())]))
    x = pa.array([[{"m": m, "_salts": 1} for m in g] for g in groups], kind)
    batch = pa.RecordBatch.from_arrays([x], names=["x"])
    sent = [sum(sum(b.column(2).to_pylist()) for b in packed_lists._sender([(1, True)], 0, 0, 4, False, half)(iter([batch]))) for half in (False, True)]
    assert sent == [30 * 20 * 20, 30 * 20 * 19 // 2]


def test_wanted_pairs_come_from_half_lists(spark, tastes, monkeypatch):
    """The pairs inside lists (intra_list_diversity) need each pair once."""
    halves = []
    real = packed_lists._sender
    monkeypatch.setattr(packed_lists, "_sender", lambda *a, **how: halves.append(how.get("half")) or real(*a, **how))
    nb.item_cosine(tastes, among=spark.createDataFrame([(1, 2)], "a bigint, b bigint"))
    assert halves and all(halves)


def test_wanted_pairs_are_scored_without_the_others(spark):
    rng = random.Random(12)
    owned = {(rng.randrange(30), rng.randrange(25) if rng.random() < 0.7 else 3) for _ in range(300)}
    prefs = spark.createDataFrame(sorted(owned), "user bigint, item bigint")
    wanted = {(a, b) for a in range(27) for b in range(a + 1, 27) if rng.random() < 0.3}
    among = spark.createDataFrame([*wanted, *list(wanted)[:20]], "a bigint, b bigint")
    want = [r for r in rows(nb.item_cosine(prefs)) if r[:2] in wanted]
    sims = nb.item_cosine(prefs, among=among)
    assert want and rows(sims) == want
    m = nb.cosine(prefs)
    assert rows(top_pairs(m.rows, "user", "item", 0, m.score, fixed=m.fixed, cell=4, entries=10, among=among)) == want
    assert "_x" not in sims._jdf.queryExecution().executedPlan().toString()


def test_packed_votes_equal_a_plain_sum(spark):
    """Several batches of votes at a time, repeated rows, null users and weights; a row for a task, not for a vote."""
    rng = random.Random(21)
    prefs = [(rng.choice([None, *range(-2, 6)]), rng.choice([None, *range(-4, 30)]), rng.choice([None, 1.0, 2.5, -3.0])) for _ in range(300)]
    links = {(rng.randrange(-4, 30), rng.randrange(-40, 60)): rng.choice([0.25, 0.123457, -0.5]) for _ in range(250)}
    seen = {(u, i) for u, i, _ in prefs if u is not None and i is not None}
    totals = {}
    for u, i, w in prefs:
        for (a, b), sim in links.items():
            if a == i and (u, b) not in seen:
                total = totals.setdefault((u, b), [])
                if w is not None:
                    total.append(math.floor(w * sim * 1e6 + 0.5))
    scores = {p: math.floor(sum(t) / 1e6 * 1e6 + 0.5) / 1e6 if t else None for p, t in totals.items()}
    want = []
    for u in {u for u, _ in scores}:
        mine = sorted((-math.inf if s is None else s, -b) for (v, b), s in scores.items() if v == u)[::-1]
        want += [(u, -b, None if s == -math.inf else s, r) for r, (s, b) in enumerate(mine[:7], 1)]
    table = spark.createDataFrame(prefs, "user bigint, item bigint, weight double")
    near = spark.createDataFrame([(a, b, s) for (a, b), s in links.items()], "item bigint, b bigint, sim double")
    for at_a_time in (1 << 20, 40):
        found = votes.top_votes(table, near, 7, at_a_time)
        assert sorted(map(tuple, found.collect()), key=repr) == sorted(want, key=repr)
    sent = found._jdf.queryExecution().executedPlan().toString()
    assert "packed" in sent and "HashAggregate" not in sent[: sent.index("packed")]


def test_votes_of_nearest_users_equal_the_joins(spark):
    """Repeated rows, null users, items and weights, and users no one is near to; no rows for votes."""
    rng = random.Random(23)
    for weights in ([1.0, 7.0, 300.0], [None, 0.25, -2.5, 1e-7]):
        prefs = [(rng.choice([None, *range(-2, 25)]), rng.choice([None, *range(-9, 30)]), rng.choice(weights)) for _ in range(300)]
        prefs = spark.createDataFrame(prefs, "user bigint, item bigint, weight double")
        near = [(a, b, rng.choice([0.25, 0.123457, 0.5])) for a in range(-2, 20) for b in range(-2, 28) if a != b and rng.random() < 0.3]
        near = spark.createDataFrame(near, "a bigint, b bigint, score double")
        found = nb.user_cf(prefs, near, 6)
        wide = nb.user_cf(prefs.withColumn("user", F.col("user").cast("decimal(9,0)")), near, 6).withColumn("user", F.col("user").cast("bigint"))
        order = ["user", "rank", "item", "score"]
        assert sorted(map(str, found.select(order).collect())) == sorted(map(str, wide.select(order).collect()))
        assert found.filter("item IS NULL").count() > 0 and found.dtypes == wide.dtypes
        plan = found._jdf.queryExecution().executedPlan().toString()
        assert "packed" in plan and "HashAggregate" not in plan[: plan.index("packed")]


def test_set_join_keeps_candidates_only(spark):
    """Pairs under the bar are no rows: they are left out where the lists meet."""
    prefs = spark.createDataFrame([(u, i) for u in range(30) for i in range(u % 7 + 1)], "user bigint, item bigint")
    sized = prefs.join(prefs.groupBy("item").agg(F.count("*").alias("n")), "item")
    named = sized.withColumn("item", F.col("item").cast("string"))
    for bar in (0.1, 0.6):
        sets = nb.similar_sets(sized, bar)
        by_name = {frozenset((int(r["a"]), int(r["b"]))): r["k"] for r in nb.similar_sets(named, bar).collect()}
        assert {frozenset((r["a"], r["b"])): r["k"] for r in sets.collect()} == by_name
        assert all(r["n_a"] <= r["n_b"] for r in sets.collect())
    heads = nb.rare_owners(sized, 0.6)
    made = nb._candidates(heads, sized.groupBy("item").agg(F.max("n").alias("n")), 0.6, 2)
    plan = made._jdf.queryExecution().executedPlan().toString()
    assert plan.count("MapInArrow") >= 2 and "Generate" not in plan


def test_votes_are_added_up_where_the_user_is(spark):
    prefs = spark.createDataFrame([(1, 10, 2.0), (1, 11, 1.0), (2, 11, None), (None, 10, 3.0)], "user bigint, item bigint, weight double")
    near = spark.createDataFrame(
        [(10, 11, 0.5), (10, 12, 0.25), (11, 12, 0.5), (11, 13, 0.125)], "a bigint, b bigint, score double"
    )
    recs = nb.item_cf(prefs, near, 5)
    assert sorted(map(tuple, recs.collect()), key=repr) == sorted(
        [(1, 12, 1.0, 1), (1, 13, 0.125, 2), (2, 12, None, 1), (2, 13, None, 2), (None, 11, 1.5, 1), (None, 12, 0.75, 2)], key=repr
    )
    plan = recs._jdf.queryExecution().executedPlan().toString()
    assert "Generate" in plan and "Exchange" not in plan[: plan.index("Generate")]


def test_nearest_lists_equal_those_of_the_pair_table(spark, tastes):
    for measure in (nb.cosine, nb.weighted_cosine, nb.jaccard, nb.llr, nb.iuf_cosine):
        pairs = nb.neighbours(measure(tastes).pairs(), 3)
        assert rows(measure(tastes).nearest(3)) == rows(pairs)


def _endless_walk(owned, seed, damping):
    nodes = sorted({("u", u) for u, _ in owned} | {("i", i) for _, i in owned})
    at = {v: n for n, v in enumerate(nodes)}
    step = np.zeros((len(nodes), len(nodes)))
    for u, i in owned:
        step[at["i", i], at["u", u]] = step[at["u", u], at["i", i]] = 1
    degree = step.sum(axis=0)
    start = np.zeros(len(nodes))
    start[at["u", seed]] = 1 - damping
    score = np.linalg.solve(np.eye(len(nodes)) - damping * step / degree, start)
    return {v: (score[n], degree[n]) for v, n in at.items()}


@pytest.mark.parametrize("threshold", [1e-2, 1e-3, 1e-5])
def test_pushed_scores_lie_within_their_bound(spark, threshold):
    rng = random.Random(3)
    owned = sorted({(rng.randrange(40), rng.randrange(60) if rng.random() < 0.7 else 1) for _ in range(260)})
    prefs = spark.createDataFrame(owned, "user bigint, item bigint")
    seeds = spark.createDataFrame([(u,) for u in sorted({u for u, _ in owned})[:3]], "user bigint")
    found = graph.personal_rank_push(prefs, seeds, 0.8, threshold, 1000).collect()
    for seed in {r["user"] for r in found}:
        walk, mine = _endless_walk(owned, seed, 0.8), [r for r in found if r["user"] == seed]
        for r in mine:
            want, degree = walk["i", r["item"]]
            assert -1e-8 <= want - r["score"] <= min(threshold * degree, r["missing"]) + 1e-6
            assert (seed, r["item"]) not in owned
    if threshold == 1e-5:
        whole = graph.personal_rank_push(prefs, seeds, 0.8, threshold, 1000, keep=5).collect()
        assert whole and all(r["missing"] >= next(f["missing"] for f in found if f["user"] == r["user"]) for r in whole)
        for r in whole:
            assert -1e-8 <= _endless_walk(owned, r["user"], 0.8)["i", r["item"]][0] - r["score"] <= r["missing"] + 1e-6


def test_saved_lists_are_joined_where_they_lie(spark, tastes, tmp_path):
    recs = nb.cosine(tastes).nearest(5).select(F.col("a").alias("user"), F.col("b").alias("item"), "score", "rank")
    tables.save_recs_table(recs, "recs_in_buckets", 4, str(tmp_path / "lists"))
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        joined = tables.join_saved(spark.table("recs_in_buckets"), tastes.select("user", F.lit(1).alias("one")), 4)
        assert joined.count() == recs.join(tastes, "user").count()
        plan = joined._jdf.queryExecution().executedPlan().toString()
        assert plan.count("SortMergeJoin") == 1 and plan.split("Bucketed: true")[0].count("Exchange") <= 1
        assert plan.count("Exchange hashpartitioning(user") == 1
        assert rows(spark.table("recs_in_buckets")) == rows(recs)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
        spark.sql("DROP TABLE recs_in_buckets")


def test_slope_one_by_hand(spark):
    data = [(1, 1, 5.0), (1, 2, 3.0), (2, 1, 3.0), (2, 2, 4.0), (3, 2, 2.0)]
    ratings = spark.createDataFrame(data, "user bigint, item bigint, rating double")
    devs = nb.slope_one_deviations(ratings)
    assert rows(devs) == [(1, 2, 2, -0.5)]
    target = spark.createDataFrame([(3, 1)], "user bigint, item bigint")
    assert rows(nb.slope_one(ratings, target, devs)) == [(3, 1, 2.5)]


@pytest.mark.parametrize("whole", [True, False])
def test_slope_one_in_parts_equals_the_joins(spark, whole):
    """Hot users and items, targets that repeat, are rated or have no one in common, and steps cut small."""
    rng = random.Random(15)
    data = {}
    for _ in range(900):
        user = rng.choice([0, 0, *range(40)])
        item = rng.choice([3, 3, *range(60)]) * 1000
        data[user, item] = float(rng.randrange(1, 6)) if whole else rng.choice([None, rng.uniform(-3, 9)])
    data[77, 99000], data[78, -5 if not whole else 98000] = 2.0, 4.0
    ratings = spark.createDataFrame([(u, i, r) for (u, i), r in data.items()], "user bigint, item bigint, rating double")
    asked = [(rng.randrange(80), rng.randrange(62) * 1000) for _ in range(1500)] + [(500, 3000), (1, 7), (None, 3000), (1, None)]
    targets = spark.createDataFrame(asked, "user bigint, item bigint")
    pairs = nb.slope_one_deviations(ratings)
    expected = rows(nb.slope_one(ratings, targets.distinct(), pairs))
    top = rows(nb.slope_one_top(ratings, targets, pairs, 4), "user", "item", "score", "rank")
    assert len(expected) > 500 and len(top) > 100
    assert rows(nb.slope_one(ratings, targets, nb.deviations(ratings))) == expected
    assert rows(nb.slope_one_top(ratings, targets, nb.deviations(ratings), 4), "user", "item", "score", "rank") == top
    for parts, step in ((1, 1 << 20), (7, 40)):
        assert rows(slope.predictions(ratings, targets, parts=parts, step=step)) == expected
    no_pairs = nb.slope_one(ratings, targets, nb.deviations(ratings))._jdf.queryExecution().analyzed().toString()
    assert "dev#" not in no_pairs


def test_slope_one_deals_one_compressed_row_for_a_part(spark):
    """As records of their own the lists of a part would be four bytes an entry, and sorted on the way."""
    rng = np.random.default_rng(29)
    own = [[{"item": int(i), "rating": float(rng.integers(1, 6))} for i in rng.choice(1 << 16, 40, replace=False)] for _ in range(500)]
    asked = [rng.choice(1 << 16, 100).tolist() for _ in range(500)]
    kinds = [pa.int64(), pa.list_(pa.struct([("item", pa.int64()), ("rating", pa.float64())])), pa.list_(pa.int64())]
    batch = pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip((range(500), own, asked), kinds)], names=["user", "mine", "asked"])
    sent = list(slope._dealer([(3, True), (1, True)], 0, 5, True)(iter([batch])))
    assert sum(b.num_rows for b in sent) == 5
    entries = sum(sum(b.column(2).to_pylist()) for b in sent)
    assert entries == 5 * 500 * 40 and sum(sum(map(len, b.column(4).to_pylist())) for b in sent) < 3 * entries + 3 * 50000
    ratings = spark.createDataFrame([(1, 1, 2.0), (1, 2, 3.0), (2, 1, 4.0)], "user bigint, item bigint, rating double")
    lists = spark.createDataFrame([(2, [2, 2, 1, None, 9]), (None, [2]), (2, None)], "user bigint, items array<bigint>")
    plain = lists.select("user", F.explode("items").alias("item"))
    found = [nb.slope_one_top(ratings, x, nb.deviations(ratings), 3) for x in (lists, plain)]
    found.append(nb.slope_one_top(ratings, lists, nb.slope_one_deviations(ratings), 3))
    assert [rows(x, "user", "item", "score", "rank") for x in found] == [[(2, 2, 5.0, 1)]] * 3
    plan = found[0]._jdf.queryExecution().executedPlan().toString()
    assert "FlatMapGroupsInArrow" not in plan and plan.count("MapInArrow") >= 2


def steps(spark, sequences):
    data, event = [], 0
    for user, items in enumerate(sequences):
        for item in items:
            data.append((user, START + timedelta(minutes=event), event, item))
            event += 1
    return spark.createDataFrame(data, "user bigint, ts timestamp_ntz, event_id bigint, item bigint")


def test_prefix_span_equals_the_ml_one(spark, many_parts):
    rng = random.Random(2)
    sequences = [[rng.randrange(6) for _ in range(rng.randrange(3, 12))] for _ in range(30)]
    got = {tuple(r["pattern"]): r["freq"] for r in patterns.prefix_span(steps(spark, sequences), 0.2, 4).collect()}
    data = spark.createDataFrame([([[i] for i in s],) for s in sequences], "sequence array<array<bigint>>")
    ml = PrefixSpan(minSupport=0.2, maxPatternLength=4).findFrequentSequentialPatterns(data).collect()
    cut = patterns.prefix_span(steps(spark, sequences), 0.2, 4, cell=2)
    assert {tuple(r["pattern"]): r["freq"] for r in cut.collect()} == got
    expected = {
        tuple(x for part in r["sequence"] for x in part): r["freq"]
        for r in ml
        if all(len(part) == 1 for part in r["sequence"])
    }
    assert got == expected


def test_fp_growth_keeps_sets_at_exactly_the_bar(spark):
    data = [(b, i) for b in range(7) for i in (1, 2)] + [(b, 9) for b in range(25)]
    data += [(b, 100 + b) for b in range(70)]
    items = spark.createDataFrame(data, "basket bigint, item bigint")
    sets = {tuple(sorted(r["items"])): r["freq"] for r in patterns.fp_growth(items, 0.1, 0.1).freqItemsets.collect()}
    assert sets[(1, 2)] == 7 and sets[(9,)] == 25
    assert {(r["a"], r["b"]): r["k"] for r in patterns.frequent_pairs(items, 0.1).collect()} == {
        s: f for s, f in sets.items() if len(s) == 2
    }


def test_vertical_sets_equal_fp_growth_with_a_giant_basket(spark, many_parts):
    """Sets of up to five items, 300 baskets over several words, and one basket of every item."""
    held = [(n, i) for n in range(300) for i in range(12) if (n * (i + 3) + n // 7) % 5 < 2]
    giant = [(1000, i) for i in range(3000)]
    items = spark.createDataFrame(held + giant, "basket bigint, item bigint")
    tree = patterns.fp_growth(items, 0.08, 0.1).freqItemsets.collect()
    expected = {tuple(sorted(r["items"])): r["freq"] for r in tree}
    odd = items.union(spark.createDataFrame([(None, 1), (5, None), held[0]], items.schema)).withColumn("bits", F.lit(1))
    got = {tuple(r["items"]): r["freq"] for r in patterns.vertical_itemsets(odd, 0.08).collect()}
    assert got == expected and max(map(len, got)) >= 4
    small = {k: v for k, v in expected.items() if len(k) <= 2}
    assert {tuple(r["items"]): r["freq"] for r in patterns.vertical_itemsets(items, 0.08, 2).collect()} == small
    assert patterns.vertical_itemsets(items.limit(0), 0.08).count() == 0


def test_fp_growth_agrees_with_pairs(spark, tastes):
    items = tastes.select(F.col("user").alias("basket"), "item")
    sets = patterns.fp_growth(items, 0.2, 0.1).freqItemsets.collect()
    pairs = {tuple(sorted(r["items"])): r["freq"] for r in sets if len(r["items"]) == 2}
    assert pairs == {(a, b): k for a, b, k in rows(patterns.frequent_pairs(items, 0.2), "a", "b", "k")}


def test_rules_need_their_whole_antecedent(spark):
    items = spark.createDataFrame([(1, 1), (1, 2), (2, 1), (3, 1), (3, 2), (3, 9)], "basket bigint, item bigint")
    rules = spark.createDataFrame(
        [([1, 2], 9, 0.9), ([1], 7, 0.4), ([2], 7, 0.6)], "antecedent array<bigint>, consequent bigint, confidence double"
    )
    got = rows(patterns.apply_rules(items, rules, 5), "basket", "item", "score", "rank")
    assert got == [(1, 7, 0.6, 2), (1, 9, 0.9, 1), (2, 7, 0.4, 1), (3, 7, 0.6, 1)]


def test_similar_docs_equal_brute_force(spark):
    rng = random.Random(4)
    words = [f"w{i}" for i in range(30)]
    texts = [" ".join(rng.choices(words, weights=range(1, 31), k=rng.randrange(4, 14))) for _ in range(50)]
    texts += [texts[0]] * 12 + ["", "  "]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    terms = content.tfidf(docs)
    weights = {}
    for d, t, w in rows(terms, "doc_id", "term", "weight"):
        weights.setdefault(d, {})[t] = w
    norm = {d: math.sqrt(sum(w * w for w in v.values())) for d, v in weights.items()}
    expected = set()
    for d in weights:
        scored = []
        for e in weights:
            if e != d:
                dot = sum(w * weights[e].get(t, 0.0) for t, w in weights[d].items())
                score = math.floor(dot / norm[d] / norm[e] * 1e6 + 0.5) / 1e6
                if score >= 0.4:
                    scored.append((-score, e))
        expected |= {(d, e, r + 1) for r, (_, e) in enumerate(sorted(scored)[:5])}
    got = set(rows(content.similar_docs(terms, 5, 0.4), "id", "b", "rank"))
    assert got == expected and len(got) > 100


def test_als_learns_and_hides_seen_items(spark, tastes):
    ratings = tables.derived_ratings(tastes.withColumn("weight", F.col("weight") * 11))
    model = factors.als_explicit(ratings, 4, 0.05, 8, 1)
    learned = metrics.rmse_mae(factors.als_predictions(model, ratings)).first()["rmse"]
    plain = metrics.rmse_mae(baseline.bias_baseline(ratings, 5.0, 10.0)).first()["rmse"]
    assert learned < plain
    implicit = factors.als_implicit(tastes, 4, 0.05, 1.0, 8, 1)
    recs = factors.als_top_n(implicit, tastes.select("user").distinct(), tastes, 3)
    assert recs.count() == 120
    assert recs.join(tastes, ["user", "item"]).count() == 0
    same = recs.filter(F.col("user") % 2 == F.col("item") % 2).count()
    assert same >= 0.9 * recs.count()


def test_als_rejects_wide_keys(spark):
    wide = spark.createDataFrame([(2**40, 1, 3.0)], "user bigint, item bigint, rating double")
    with pytest.raises(ValueError, match="index_ids"):
        factors.als_explicit(wide, 2, 0.1, 1, 1)


def test_fold_in_solves_the_normal_equations(spark):
    rng = np.random.default_rng(7)
    v = rng.normal(size=(30, 3))
    items = spark.createDataFrame([(i, x.tolist()) for i, x in enumerate(v)], "id int, features array<double>")
    data = [(u, i, float(rng.integers(1, 6))) for u in range(5) for i in range(u, 30, u + 1)]
    ratings = spark.createDataFrame(data, "user bigint, item bigint, rating double")
    for r in factors.als_fold_in(items, ratings.repartition(7), 0.2, 3).collect():
        own = [(i, x) for u, i, x in data if u == r["user"]]
        m, y = v[[i for i, _ in own]], np.array([x for _, x in own])
        left = (m.T @ m + 0.2 * len(own) * np.eye(3)) @ np.array(r["features"]) - m.T @ y
        assert np.abs(left).max() < 1e-8


def test_vector_searches_agree_with_the_exact_one(spark):
    rng = np.random.default_rng(2)
    centre = rng.normal(size=(5, 8)) * 4
    v = centre[np.arange(200) % 5] + rng.normal(size=(200, 8))
    v /= np.linalg.norm(v, axis=1, keepdims=True)
    v[100:120] = v[0]
    df = spark.createDataFrame([(i, x.tolist()) for i, x in enumerate(v)], "id bigint, vec array<double>")
    exact = set(rows(factors.nearest_exact(df, df, 5), "id", "b"))
    clustered = set(rows(factors.nearest_in_cluster(df, factors.cluster_items(df, 5, 1), 5), "id", "b"))
    assert len(exact & clustered) >= 0.9 * len(exact)
    hashed = factors.nearest_lsh(df, 5, 1.0, 5, 0.8, 1)
    assert len(exact & set(rows(hashed, "id", "b"))) >= 0.6 * len(exact)
    assert hashed.filter("score < -0.8 or id = b").count() == 0


def test_cluster_search_finds_the_lists_with_and_without_clusters(spark):
    rng = np.random.default_rng(6)
    centre = rng.normal(size=(25, 16))
    for spread, few in ((0.1, True), (0.4, True), (30.0, False)):
        v = centre[np.arange(600) % 25] + spread * rng.normal(size=(600, 16))
        v /= np.linalg.norm(v, axis=1, keepdims=True)
        df = spark.createDataFrame([(i, x.tolist()) for i, x in enumerate(v)], "id bigint, vec array<double>")
        exact = set(rows(factors.nearest_exact(df, df, 10), "id", "b"))
        model = factors.cluster_items(df, factors.cluster_count(df), 5)
        found = factors.nearest_in_cluster(df, model, 10, 4, 64)
        assert len(exact & set(rows(found, "id", "b"))) >= 0.9 * len(exact)
        by_cell = "cell#" in found._jdf.queryExecution().analyzed().toString()
        assert by_cell or not few


def test_registered_cluster_search_finds_the_exact_lists(spark):
    folder = "/root/testdata/sf0.01"
    exact = set(rows(registered.QUERIES["nearest_exact"](spark, folder), "id", "b"))
    near = set(rows(registered.QUERIES["nearest_in_cluster"](spark, folder), "id", "b"))
    assert len(exact & near) >= 0.9 * len(exact)


def test_hashing_meets_few_pairs_and_finds_the_near_ones(spark):
    rng = np.random.default_rng(4)
    centre = rng.normal(size=(60, 64))
    v = centre[np.arange(600) % 60] + 0.15 * rng.normal(size=(600, 64))
    v /= np.linalg.norm(v, axis=1, keepdims=True)
    df = spark.createDataFrame([(i, x.tolist()) for i, x in enumerate(v)], "id bigint, vec array<double>")
    exact = set(rows(factors.nearest_exact(df, df, 5), "id", "b"))
    pairs = factors.lsh_candidates(df, 0.2, 8, 7, 5)
    assert pairs.count() < 0.1 * 600 * 599 / 2 and pairs.filter("a >= b").count() == 0
    found = set(rows(factors.nearest_lsh(df, 5, 0.2, 8, 1.3, 5, 7), "id", "b"))
    assert len(exact & found) >= 0.9 * len(exact)


def _frame(spark, v, first=0):
    return spark.createDataFrame([(first + i, list(map(float, x))) for i, x in enumerate(v)], "id bigint, vec array<double>")


@pytest.mark.parametrize("spread", [0.02, 0.5, 3.0])
def test_cells_give_the_exact_lists(spark, spread):
    rng = np.random.default_rng(8)
    centre = rng.normal(size=(12, 8))
    v = centre[np.arange(400) % 12] * rng.uniform(0.5, 2, (400, 1)) + spread * rng.normal(size=(400, 8))
    v[30:60] = v[30]  # copies
    v[100:103] = 0.0  # vectors without a direction
    df = _frame(spark, v)
    model = factors.cluster_items(df, 20, 5)
    assert rows(factors.nearest_in_cluster(df, model, 10, 1)) == rows(factors.nearest_exact(df, df, 10))


def test_few_sorted_cells_tell_what_a_query_sees_first():
    """The cells of the whole order, also with equal distances, overlapping cells and cells that hold next to nothing."""
    rng = np.random.default_rng(41)
    for radius, most in ((0.0, 4), (0.4, 3), (2.5, 2), (0.2, 1)):
        centres = factors._unit(pd.Series(list(rng.standard_normal((90, 4)).round(1))))
        size = rng.integers(1, most + 1, 90)
        cells = factors.Cells(np.arange(90, dtype=np.int32), centres, np.full(90, radius), size)
        x = factors._unit(pd.Series(list(rng.standard_normal((60, 4)))))
        for wanted, probes in ((11, 2), (40, 4), (5, 30), (500, 1)):
            seen, least = cells.seen(x, wanted, probes)
            order, count = cells.first(x, wanted, probes)
            for q in range(60):
                assert set(np.flatnonzero(seen[q])) == set(order[q, : count[q]].tolist())
            assert (least == np.maximum(factors._far(x, centres) - radius, 0.0)).all()


def test_als_has_more_blocks_for_more_ratings():
    assert [factors._als_blocks(n) for n in (0, 594_000, 10 << 22, 216_000_000)] == [10, 10, 10, 52]


def test_profiles_are_summed_where_the_rows_of_a_user_meet(spark):
    """Sums of a slice are over five times as long as what they are made of: they are not shuffled."""
    prefs = spark.createDataFrame([(1, 5, 2.0), (1, 6, 1.0)], PREFS)
    vectors = spark.createDataFrame([(5, [1.0, 0.0]), (6, [4.0, 3.0])], "id bigint, vec array<float>")
    found = content.user_profile(prefs, vectors, 2)
    assert rows(found) == [(1, [2.0, 1.0])]
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning(user" in plan and "hashpartitioning(user#0L, slice" not in plan
    assert all("slice" not in line for line in plan.splitlines() if "Exchange hashpartitioning" in line)


def test_cell_visits_come_in_small_batches_and_are_counted_without_rows():
    """Vectors without clusters visit all cells: their rows would be as many vectors in one batch."""
    rng = np.random.default_rng(12)
    centres = rng.normal(size=(50, 8))
    centres /= np.linalg.norm(centres, axis=1, keepdims=True)
    cells = factors.Cells(np.arange(50, dtype=np.int32), centres, np.full(50, 2.0), np.full(50, 9))
    batch = pd.DataFrame({"id": np.arange(3000), "vec": list(rng.normal(size=(3000, 8))), "bound": 0.0})
    made = list(factors._visit(cells, 5, 2, True, 100)(iter([batch])))
    assert max(map(len, made)) == 100
    counted = sum(x["met"].sum() for x in factors._count_visits(cells, 5, 2)(iter([batch])))
    assert counted == sum(map(len, made)) == 3000 * 48


def test_cells_rule_most_vectors_out_where_there_are_clusters(spark):
    rng = np.random.default_rng(9)
    centre = rng.normal(size=(40, 16))
    df = _frame(spark, centre[np.arange(2000) % 40] + 0.1 * rng.normal(size=(2000, 16)))
    homes, cells = factors.inverted_file(df, factors.cluster_items(df, 40, 5))
    size = dict(zip(cells.names.tolist(), cells.size.tolist()))
    seen = homes.select("id", "vec").mapInPandas(factors._visit(cells, 10, 1, False), "id bigint, vec array<double>, cell int")
    bound = factors.nearest_exact(df, df, 10).filter("rank = 10").select("id", F.col("score").alias("bound"))
    more = homes.select("id", "vec").join(bound, "id").mapInPandas(
        factors._visit(cells, 10, 1, True), "id bigint, vec array<double>, cell int"
    )
    touched = sum(size[r["cell"]] for r in seen.unionByName(more).collect())
    assert touched < 0.1 * 2000 * 2000


def test_registered_cells_prune(spark):
    vectors = registered._profile_vectors(spark, "/root/testdata/sf0.01")
    found = registered.QUERIES["nearest_parts_in_cells"](spark, "/root/testdata/sf0.01")
    assert found.count() == 10 * vectors.count()
    assert "cell#" in found._jdf.queryExecution().analyzed().toString()


def test_more_probes_are_taken_until_the_sample_is_found(spark):
    rng = np.random.default_rng(4)
    centre = rng.normal(size=(60, 64))
    v = centre[np.arange(600) % 60] + 0.25 * rng.normal(size=(600, 64))
    v /= np.linalg.norm(v, axis=1, keepdims=True)
    df = _frame(spark, v)
    exact = set(rows(factors.within(df, df, 5, 1.3), "id", "b"))
    plain = {p for a, b in rows(factors.lsh_candidates(df, 0.2, 4, 7, 5)) for p in ((a, b), (b, a))}
    assert len(exact & plain) < 0.9 * len(exact)
    tables, probes, recall, share = factors.lsh_plan(df, 5, 0.2, 4, 1.3, 5, 7)
    assert probes > 0 and recall >= 0.9 and share < 0.5
    found = set(rows(factors.nearest_lsh(df, 5, 0.2, 4, 1.3, 5, 7), "id", "b"))
    assert len(exact & found) >= 0.9 * len(exact)


def test_all_vectors_are_searched_where_hashing_does_not_pay(spark):
    rng = np.random.default_rng(5)
    df = _frame(spark, rng.normal(size=(200, 32)))
    assert factors.lsh_plan(df, 5, 0.3, 4, 100.0, 5, 6) is None
    found = rows(factors.nearest_lsh(df, 5, 0.3, 4, 100.0, 5, 6), "id", "b", "score")
    x = np.array([r["vec"] for r in sorted(df.collect())])
    far = np.linalg.norm(x[:, None] - x[None], axis=2) + np.diag([np.inf] * 200)
    want = [(i, int(b), round(-far[i, b], 6)) for i in range(200) for b in np.argsort(far[i])[:5]]
    assert [f[:2] for f in found] == sorted(w[:2] for w in want)


def uncut_contexts(sequences, window):
    """Every (centre, context) pair of whole histories, as counts of unordered item pairs."""
    count, weight = Counter(), Counter()
    for items in sequences:
        for at, item in enumerate(items):
            for far, other in enumerate(items[at + 1 : at + 1 + window], 1):
                if item is not None and other is not None:
                    pair = min(item, other), max(item, other)
                    count[pair] += 1
                    weight[pair] += window + 1 - far
    return sorted((a, b, k, weight[a, b]) for (a, b), k in count.items())


@pytest.mark.parametrize("chunk", [5, 7, 64])
def test_item_contexts_see_across_cells(spark, many_parts, chunk):
    rng = random.Random(chunk)
    sequences = [[rng.choice([*range(9), None]) for _ in range(rng.randrange(0, 90))] for _ in range(12)]
    got = factors.item_contexts(steps(spark, sequences), 5, chunk)
    assert rows(got, "a", "b", "k", "weight") == uncut_contexts(sequences, 5)


def test_item_contexts_of_a_long_history(spark, many_parts):
    rng = random.Random(4)
    sequences = [[rng.randrange(300) for _ in range(10_000)], [1, 2]]
    got = factors.item_contexts(steps(spark, sequences), 5)
    assert rows(got, "a", "b", "k", "weight") == uncut_contexts(sequences, 5)


def test_item_contexts_want_a_window_inside_a_cell(spark):
    with pytest.raises(ValueError):
        factors.item_contexts(steps(spark, [[1, 2]]), 6, 5)
    assert factors.item_contexts(steps(spark, [[]]), 2).count() == 0


def test_positive_pmi_by_hand(spark):
    contexts = spark.createDataFrame([(1, 2, 3, 3), (1, 1, 1, 1), (2, 3, 1, 1)], "a bigint, b bigint, k bigint, weight bigint")
    # Sums over contexts: 5 for item 1 (twice beside itself), 4 for item 2, 1 for item 3; 10 in all.
    want = {(1, 2): 3 * 10 / 20, (2, 1): 3 * 10 / 20, (2, 3): 10 / 4, (3, 2): 10 / 4, (1, 1): 2 * 10 / 25}
    got = {(a, b): score for a, b, score in rows(factors.positive_pmi(contexts), "a", "b", "score")}
    assert got == {p: round(math.log(r), 6) for p, r in want.items() if r > 1}
    shifted = factors.positive_pmi(contexts, 2.0)
    assert rows(shifted, "a", "b", "score") == [(2, 3, round(math.log(1.25), 6)), (3, 2, round(math.log(1.25), 6))]


def test_item2vec_tells_groups_apart(spark):
    rng = random.Random(7)
    sequences = [[rng.randrange(8) + 8 * (user % 3) for _ in range(40)] for user in range(60)]
    vectors = {r["id"]: np.array(r["vec"]) for r in factors.item2vec(steps(spark, sequences), 6, 3, 1).collect()}
    assert set(vectors) == set(range(24))
    unit = {i: v / np.linalg.norm(v) for i, v in vectors.items()}
    assert all(abs(unit[i] @ unit[i] - 1) < 1e-9 for i in unit)
    inside = [unit[i] @ unit[j] for i in unit for j in unit if i < j and i // 8 == j // 8]
    across = [unit[i] @ unit[j] for i in unit for j in unit if i < j and i // 8 != j // 8]
    assert min(inside) > max(across)


def test_item2vec_keeps_every_item(spark):
    got = {r["id"]: r["vec"] for r in factors.item2vec(steps(spark, [[1, 2, 3, 1, 2], [4, 5, 4], [6], [None]]), 3, 2, 1).collect()}
    assert set(got) == {1, 2, 3, 4, 5, 6} and all(len(v) == 3 for v in got.values())
    assert got[6] == [0.0, 0.0, 0.0] and any(got[1])
    alone = factors.item2vec(steps(spark, [[6], [7]]), 3, 2, 1).collect()
    assert sorted((r["id"], r["vec"]) for r in alone) == [(6, [0.0] * 3), (7, [0.0] * 3)]


def test_pagerank_keeps_its_mass(tastes):
    found = graph.pagerank_items(tastes, 0.85, 3)
    assert found.count() == 24 and found.filter("score <= 0").count() == 0


def test_personal_rank_stays_in_the_group(spark, tastes):
    seeds = spark.createDataFrame([(0,), (1,)], "user bigint")
    got = graph.personal_rank(tastes, seeds, 0.8, 4, 4).collect()
    assert len(got) == 8 and all(r["user"] % 2 == r["item"] % 2 for r in got)


def test_point_in_time_is_half_open(spark, many_parts):
    at = [0, 10, 10, 20, 30]
    events = spark.createDataFrame(
        [(1, START + timedelta(seconds=t), i) for i, t in enumerate(at)], "user bigint, ts timestamp_ntz, event_id bigint"
    )
    examples = events.select(F.col("event_id").alias("example_id"), "user", "ts")
    assert rows(ranking.point_in_time(examples, events, 10)) == [(0, 0), (1, 1), (2, 1), (3, 2), (4, 1)]


def test_hashed_features_and_models(spark):
    rng = random.Random(6)
    data = []
    for i in range(400):
        x, y = rng.random(), rng.random()
        data.append((i, x, y, rng.randrange(5), 1.0 if x + 0.3 * y > 0.7 else 0.0))
    examples = spark.createDataFrame(data, "example_id bigint, x double, y double, c bigint, label double")
    hashed = ranking.hash_features(examples, ["c"], [["c", "example_id"]], 64)
    assert all(1 <= r["features"].numNonzeros() <= 2 for r in hashed.collect())
    ready = ranking.assemble(examples, ["x", "y"]).cache()
    long = ranking.hashed_rows(examples, ["c"], [["c", "example_id"]], 64).collect()
    assert all(0 <= r["idx"] < 64 for r in long) and sum(r["value"] for r in long) == 2 * len(data)
    taught, unseen = ready.filter("example_id % 4 <> 0"), ready.filter("example_id % 4 = 0")
    fits = (ranking.logistic_ctr, lambda x: ranking.forest_ranker(x, 1), lambda x: ranking.boosted_ranker(x, 1))
    for fit in (*fits, lambda x: ranking.gbt_plus_lr(x, 1)):
        scored = ranking.scored(fit(taught), unseen)
        assert scored.filter("score < 0 or score > 1").count() == 0
        assert metrics.auc(scored).first()["auc"] > 0.9
    assert metrics.auc(ranking.scored(ranking.factorisation_machine(ready, 2, 1), ready)).first()["auc"] > 0.8


def test_auc_with_ties(spark, many_parts):
    data = [(1.0, 0.9), (0.0, 0.9), (1.0, 0.5), (0.0, 0.1)]
    got = metrics.auc(spark.createDataFrame(data, "label double, score double")).first()
    wins = sum(1.0 if p > n else 0.5 if p == n else 0.0 for lp, p in data if lp for ln, n in data if not ln)
    assert got["auc"] == wins / 4


def ranked_case(spark):
    recs = spark.createDataFrame([(1, 1, 1), (1, 2, 2), (1, 3, 3)], "user bigint, item bigint, rank int")
    truth = spark.createDataFrame([(1, 1), (1, 5)], "user bigint, item bigint")
    return recs, truth


def test_metrics_by_hand_and_by_the_ml_evaluator(spark):
    recs, truth = ranked_case(spark)
    pr = metrics.precision_recall_at(recs, truth, 2).first()
    got = {
        "precisionAtK": pr["precision"],
        "recallAtK": pr["recall"],
        "meanAveragePrecisionAtK": metrics.map_at(recs, truth, 2).first()["map"],
        "ndcgAtK": metrics.ndcg_at(recs, truth, 2).first()["ndcg"],
    }
    case = spark.createDataFrame([([1.0, 2.0, 3.0], [1.0, 5.0])], "prediction array<double>, label array<double>")
    for name, value in got.items():
        assert RankingEvaluator(metricName=name, k=2).evaluate(case) == pytest.approx(value, abs=1e-6)
    assert metrics.hit_rate_at(recs, truth, 2).first()["hit_rate"] == 1.0
    assert metrics.mrr(recs, truth).first()["mrr"] == 1.0


def test_gini_extremes(spark):
    items = spark.range(4).select(F.col("id").alias("item"))
    one = spark.createDataFrame([(0,)] * 5, "item bigint")
    assert metrics.gini(one, items).first()["gini"] == 0.75
    assert metrics.gini(items, items).first()["gini"] == 0.0


def test_fill_cold_by_brute_force(spark, many_parts):
    rng = random.Random(8)
    owned = [(0, i) for i in range(45)] + [(u, rng.randrange(50)) for u in range(1, 12) for _ in range(6)]
    owned = sorted(set(owned))
    ranks = spark.range(50).select(F.col("id").alias("item"), (F.col("id") + 1).alias("pop"))
    lists = {u: [i for i in rng.sample(range(50), 9) if (u, i) not in owned][: u % 4] for u in range(12)}
    recs = [(u, i, 1.0 / (r + 1), r + 1) for u, v in lists.items() for r, i in enumerate(v)]
    got = pp.fill_cold(
        spark.createDataFrame(recs, "user bigint, item bigint, score double, rank int"),
        ranks,
        spark.range(12).select(F.col("id").alias("user")),
        spark.createDataFrame(owned, "user bigint, item bigint"),
        5,
    )
    expected = []
    for u, v in lists.items():
        free = [i for i in range(50) if (u, i) not in owned and i not in v]
        expected += [(u, r + 1, i) for r, i in enumerate((v + free)[:5])]
    assert rows(got, "user", "rank", "item") == sorted(expected)


def test_mmr_prefers_variety(spark):
    recs = spark.createDataFrame([(1, 1, 1.0), (1, 2, 0.9), (1, 3, 0.5)], "user bigint, item bigint, score double")
    sims = spark.createDataFrame([(1, 2, 1.0), (2, 1, 1.0)], "a bigint, b bigint, score double")
    assert rows(pp.mmr(recs, sims, 0.5, 3), "rank", "item") == [(1, 1), (2, 3), (3, 2)]


def test_blend_and_fusion(spark):
    schema = "user bigint, item bigint, score double, rank int"
    x = spark.createDataFrame([(1, 1, 4.0, 1), (1, 2, 2.0, 2)], schema)
    y = spark.createDataFrame([(1, 2, 9.0, 1)], schema)
    assert rows(pp.blend([x, y], [0.4, 0.6], 5), "rank", "item", "score") == [(1, 2, 0.6), (2, 1, 0.4)]
    assert rows(pp.reciprocal_rank_fusion([x, y], 60, 5), "rank", "item") == [(1, 2), (2, 1)]


def test_attribute_similarity_of_identical_items(spark):
    data = [(i, "t1", "b1" if i < 5 else "b2") for i in range(8)] + [(9, "t2", "b1")]
    items = spark.createDataFrame(data, "item bigint, kind string, brand string")
    got = rows(content.attribute_similarity(items, {"brand": 0.7}, "kind", 3), "id", "rank", "b", "score")
    expected = []
    for i, kind, brand in data:
        others = sorted(
            (-(0.7 if b == brand else 0.0), j) for j, k, b in data if j != i and k == kind
        )
        expected += [(i, r + 1, j, -s) for r, (s, j) in enumerate(others[:3])]
    assert got == sorted(expected)


def test_diversity_counts_unknown_pairs_as_far(spark):
    recs = spark.createDataFrame([(1, i) for i in (1, 2, 3)], "user bigint, item bigint")
    sims = spark.createDataFrame([(1, 2, 0.6)], "a bigint, b bigint, score double")
    assert metrics.intra_list_diversity(recs, sims).first()["diversity"] == 0.8
