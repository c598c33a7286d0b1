"""Walks on the user-item graph."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tastemill.functions.exact import SCALE, exact_sum, require, round6
from tastemill.functions.ranked import top_per
from tastemill.operators.neighbours import Measure
from tastemill.session import write_stage


def _edges(prefs: DataFrame) -> DataFrame:
    """Written once: (user, item) with both degrees, read by every round."""
    require(prefs, "user", "item")
    pairs = prefs.select("user", "item")
    by_user = pairs.groupBy("user").agg(F.count(F.lit(1)).alias("n_u"))
    by_item = pairs.groupBy("item").agg(F.count(F.lit(1)).alias("n_i"))
    return write_stage(pairs.join(by_user, "user").join(by_item, "item"), "edges")


def pagerank_items(prefs: DataFrame, damping: float, iters: int) -> DataFrame:
    """Rank of the items after ``iters`` rounds on the undirected user-item graph.

    Ranks average 1 over all nodes (they are the usual ones times the node
    count), so they keep their digits on large graphs. A round is one join and
    one aggregate. ``iters`` is at least 1.
    """
    edges = _edges(prefs)
    # Items of a round need the users of the round before only, and these the items of the one before that:
    # a single chain of sides leads to the last round's items.
    sides = ["item" if (iters - step) % 2 == 0 else "user" for step in range(iters + 1)]
    ranks = edges.select(sides[0]).distinct().withColumn("rank", F.lit(1.0))
    for source, target in zip(sides, sides[1:]):
        flow = F.col("rank") / F.col("n_u" if source == "user" else "n_i")
        ranks = write_stage(
            edges.join(ranks, source)
            .groupBy(target)
            .agg(exact_sum(flow).alias("_in"))
            .select(target, round6((1.0 - damping) + damping * F.col("_in")).alias("rank")),
            "rank",
        )
    return ranks.select("item", F.col("rank").alias("score"))


def personal_rank(prefs: DataFrame, seeds: DataFrame, damping: float, iters: int, n: int) -> DataFrame:
    """Best n unseen items per seed user by a walk that restarts at the seed.

    The state is keyed by (seed, node) and never cut between rounds; ``iters`` is at least 1.
    """
    require(seeds, "user")
    edges = _edges(prefs)
    scale = 1e12
    start = seeds.select(F.col("user").alias("seed"), "user").distinct()
    start = write_stage(start.join(edges.select("user").distinct(), "user", "left_semi"), "seeds")
    # As in pagerank_items, only one side of each round leads to the result. With an even number of rounds
    # the chain begins after the first one, where the users hold what restarts at the seeds.
    users = start.withColumn("mass_u", F.lit(1.0 if iters % 2 else 1.0 - damping))
    for step in range(iters - 1 + iters % 2):
        if step % 2 == 0:
            items = write_stage(
                users.join(edges, "user")
                .groupBy("seed", "item")
                .agg((damping * exact_sum(F.col("mass_u") / F.col("n_u"), scale)).alias("mass_i")),
                "mass",
            )
        else:
            walked = (
                items.join(edges, "item")
                .groupBy("seed", "user")
                .agg((damping * exact_sum(F.col("mass_i") / F.col("n_i"), scale)).alias("mass_u"))
            )
            back = start.withColumn("mass_u", F.lit(1.0 - damping)).unionByName(walked)
            users = write_stage(
                back.groupBy("seed", "user").agg(exact_sum(F.col("mass_u"), scale).alias("mass_u")), "mass"
            )
    seen = edges.select(F.col("user").alias("seed"), "item")
    fresh = items.join(seen, ["seed", "item"], "left_anti").select(
        F.col("seed").alias("user"), "item", F.floor(F.col("mass_i") * 1e9 + 0.5).alias("score_e9")
    )
    return top_per(fresh, ["user"], [F.desc("score_e9"), F.asc("item")], n).select(
        "user", "item", (F.col("score_e9") / 1e9).alias("score"), "rank"
    )


def personal_rank_push(
    prefs: DataFrame, seeds: DataFrame, damping: float, threshold: float, n: int, keep: int | None = None
) -> DataFrame:
    """(user, item, score, rank, missing): best n unseen items per seed by pushing residuals, with an error bound.

    All mass begins as a residual at the seed. A node whose residual is over
    ``threshold`` times its degree keeps 1 - damping of it as its score and pushes
    the rest to its neighbours; it ends when no residual is over that. Scores
    are those of the endless walk, less at most ``threshold`` times the degree
    of the node. A seed's nodes with a score have at most 1 / (threshold (1 -
    damping)) neighbours together, whatever the size of the graph, and so has
    its state. ``missing`` is the mass no node has got: no score can be further
    off. With ``keep`` only the largest ``keep`` residuals of a seed stay in each
    round (the survey's form); what is dropped shows in ``missing``.
    """
    require(seeds, "user")
    edges = _edges(prefs)
    by_user = edges.select(F.lit(False).alias("is_item"), F.col("user").alias("node"), "n_u", "item", "n_i").toDF(
        "is_item", "node", "_own", "_to", "_to_degree"
    )
    by_item = edges.select(F.lit(True).alias("is_item"), F.col("item").alias("node"), "n_i", "user", "n_u").toDF(
        "is_item", "node", "_own", "_to", "_to_degree"
    )
    links = write_stage(by_user.unionByName(by_item), "links")
    known = edges.select("user", F.col("n_u").alias("degree")).distinct()
    zero = F.lit(0.0)
    state = write_stage(
        seeds.select("user").distinct().join(known, "user").select(
            F.col("user").alias("seed"), F.lit(False).alias("is_item"), F.col("user").alias("node"), "degree",
            F.lit(1.0).alias("residual"), zero.alias("score"),
        ),
        "pushed",
    )
    active = F.col("residual") > F.lit(threshold) * F.col("degree")
    while not state.filter(active).isEmpty():
        sent = (
            state.filter(active)
            .join(links, ["is_item", "node"])
            .groupBy("seed", (~F.col("is_item")).alias("is_item"), F.col("_to").alias("node"), F.col("_to_degree").alias("degree"))
            .agg(exact_sum(F.lit(damping) * F.col("residual") / F.col("degree"), 1e12).alias("flow"))
        )
        held = state.select(
            "seed", "is_item", "node", "degree",
            F.when(active, zero).otherwise(F.col("residual")).alias("left"),
            (F.col("score") + F.when(active, F.lit(1.0 - damping) * F.col("residual")).otherwise(zero)).alias("score"),
        )
        joined = held.join(sent, ["seed", "is_item", "node", "degree"], "full")
        after = joined.select(
            "seed", "is_item", "node", "degree",
            (F.coalesce("left", zero) + F.coalesce("flow", zero)).alias("residual"), F.coalesce("score", zero).alias("score"),
        )
        if keep is not None:
            place = F.row_number().over(
                Window.partitionBy("seed").orderBy(F.desc("residual"), "is_item", "node")
            )
            after = after.withColumn("_place", place).withColumn(
                "residual", F.when(F.col("_place") <= keep, F.col("residual")).otherwise(zero)
            ).filter((F.col("residual") > 0) | (F.col("score") > 0)).drop("_place")
        state = write_stage(after, "pushed")
    given = state.groupBy("seed").agg(round6(1.0 - exact_sum(F.col("score"), 1e12)).alias("missing"))
    seen = edges.select(F.col("user").alias("seed"), F.col("item").alias("node"))
    scored = (
        state.filter(F.col("is_item") & (F.col("score") > 0))
        .join(seen, ["seed", "node"], "left_anti")
        .select(F.col("seed").alias("user"), F.col("node").alias("item"), (F.floor(F.col("score") * 1e9 + 0.5) / 1e9).alias("score"))
    )
    best = top_per(scored, ["user"], [F.desc("score"), F.asc("item")], n)
    return best.join(given.withColumnRenamed("seed", "user"), "user").select("user", "item", "score", "rank", "missing")


def mass_diffusion(prefs: DataFrame, blend: float, k: int) -> DataFrame:
    """Item-to-item resource flow a -> b: blend 1 spreads mass, 0 spreads heat; best k per a.

    The flow is sum over shared users of 1 / n_user, over n_b^(1-blend) n_a^blend.
    """
    require(prefs, "user", "item")
    # Read for the rows and for the degrees of both sides.
    pairs = write_stage(prefs.select("user", "item"), "prefs")
    share = pairs.groupBy("user").agg((1.0 / F.count(F.lit(1))).alias("r"))
    sizes = pairs.groupBy("item").agg(F.count(F.lit(1)).alias("n"))

    def score(v, m):
        base = m.power(v["n_b"] * m.number(1), m.number(1.0 - blend)) * m.power(v["n_a"] * m.number(1), m.number(blend))
        return v["flow"] / base

    flows = Measure(
        pairs.join(sizes, "item").join(share, "user"),
        score,
        {"flow": (lambda v: v["r"], SCALE)},
        fixed=("n",),
        shared=("r",),
        directed=True,
    )
    return flows.nearest(k).drop("k")
