"""Merging, filtering and re-ranking of candidate lists."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tastemill.functions.exact import exact_sum, require, round6
from tastemill.functions.ordered import OrderedSplit
from tastemill.functions.ranked import top_per
from tastemill.session import write_stage


def drop_seen(recs: DataFrame, prefs: DataFrame) -> DataFrame:
    return recs.join(prefs.select("user", "item"), ["user", "item"], "left_anti")


def top_n(recs: DataFrame, n: int) -> DataFrame:
    """Best n per user by score, ties by item."""
    require(recs, "user", "item", "score")
    return top_per(recs, ["user"], [F.desc("score"), F.asc("item")], n)


def blend(sources: Sequence[DataFrame], weights: Sequence[float], n: int) -> DataFrame:
    """Weighted sum of the lists after min-max scaling per user and source.

    Per-user ranges are partial aggregates, not windows over a whole list.
    """
    if len(sources) != len(weights):
        raise ValueError("one weight per source")
    scaled = None
    for recs, weight in zip(sources, weights):
        recs = write_stage(recs.select("user", "item", "score"), "source")
        span = recs.groupBy("user").agg(F.min("score").alias("_lo"), F.max("score").alias("_hi"))
        width = F.col("_hi") - F.col("_lo")
        unit = F.when(width > 0, (F.col("score") - F.col("_lo")) / width).otherwise(F.lit(1.0))
        part = recs.join(span, "user").select("user", "item", (unit * weight).alias("_s"))
        scaled = part if scaled is None else scaled.unionByName(part)
    total = scaled.groupBy("user", "item").agg(round6(exact_sum(F.col("_s"))).alias("score"))
    return top_n(total, n)


def reciprocal_rank_fusion(sources: Sequence[DataFrame], k0: int, n: int) -> DataFrame:
    """Sum over lists of 1 / (k0 + rank)."""
    merged = None
    for recs in sources:
        part = recs.select("user", "item", (1.0 / (F.col("rank") + k0)).alias("_s"))
        merged = part if merged is None else merged.unionByName(part)
    total = merged.groupBy("user", "item").agg(round6(exact_sum(F.col("_s"))).alias("score"))
    return top_n(total, n)


def cap_per_group(recs: DataFrame, items: DataFrame, attribute: str, m: int, n: int) -> DataFrame:
    """At most m items of one attribute value in each user's list of n.

    Items without a row in ``items``, or with a null there, are one value of their own.
    """
    known = recs.select("user", "item", "score").join(items.select("item", attribute), "item", "left")
    best = top_per(known, ["user", attribute], [F.desc("score"), F.asc("item")], m)
    return top_n(best.select("user", "item", "score"), n)


def mmr(recs: DataFrame, sims: DataFrame, trade: float, n: int) -> DataFrame:
    """Greedy list: trade * score - (1 - trade) * largest similarity to the picks so far.

    ``sims`` holds directed (a, b, score); a missing pair counts as 0. It is
    read once, for the pairs inside a list (a list of m candidates has at most
    m (m - 1)). Each pick is a written table, with the running largest
    similarity on each remaining candidate, so round r looks at the last pick only.
    """
    require(recs, "user", "item", "score")
    left = write_stage(recs.select("user", "item", "score", F.lit(0.0).alias("_near")), "mmr")
    lists = left.select("user", F.col("item").alias("_pick"))
    known = sims.select(
        F.col("a").alias("_pick"), F.col("b").alias("item"), F.col("score").alias("_sim")
    )
    links = write_stage(
        lists.join(left.select("user", "item"), "user")
        .filter(F.col("_pick") != F.col("item"))
        .join(known, ["_pick", "item"]),
        "links",
    )
    value = round6(trade * F.col("score") - (1.0 - trade) * F.col("_near"))
    chosen = None
    for step in range(1, n + 1):
        best = top_per(left.withColumn("_value", value), ["user"], [F.desc("_value"), F.asc("item")], 1)
        pick = write_stage(
            best.select("user", "item", F.col("_value").alias("score"), F.lit(step).alias("rank")), "pick"
        )
        chosen = pick if chosen is None else chosen.unionByName(pick)
        if step == n:
            break
        last = pick.select("user", F.col("item").alias("_pick"))
        left = write_stage(
            left.join(last, "user")
            .filter(F.col("item") != F.col("_pick"))
            .join(links, ["user", "_pick", "item"], "left")
            .withColumn("_near", F.greatest("_near", F.coalesce("_sim", F.lit(0.0))))
            .select("user", "item", "score", "_near"),
            "mmr",
        )
    return chosen


def fill_cold(recs: DataFrame, ranks: DataFrame, users: DataFrame, seen: DataFrame, n: int) -> DataFrame:
    """Lists shorter than n topped up with the most popular items not owned or listed.

    ``ranks`` numbers all items by popularity from 1 (item, pop). A user's
    missing ranks are the gaps between the ranks already taken, so the first
    ones needed are read off the user's own rows: no user meets the whole item
    table, however many popular items the user owns.
    """
    require(recs, "user", "item", "score", "rank")
    recs = write_stage(recs.select("user", "item", "score", "rank"), "lists")
    have = recs.groupBy("user").agg(F.count(F.lit(1)).alias("_have"))
    short = (
        users.select("user")
        .join(have, "user", "left")
        .withColumn("_have", F.coalesce("_have", F.lit(0)))
        .filter(F.col("_have") < n)
    )
    used = seen.select("user", "item").unionByName(recs.select("user", "item")).distinct()
    taken = (
        used.join(short.select("user"), "user", "left_semi").join(ranks, "item").select("user", "pop")
    )
    start = short.select("user", F.lit(0).cast("bigint").alias("pop"))
    scan = OrderedSplit(taken.unionByName(start), ["user"], ["pop"])
    scan.row_number("_j").lead(F.col("pop"), "_next")
    items = ranks.agg(F.max("pop").alias("last")).scalar()
    gaps = scan.result().withColumn("_last", items).join(short, "user")
    before = F.col("pop") - (F.col("_j") - 1)
    free = F.coalesce(F.col("_next") - 1, F.col("_last")) - F.col("pop")
    size = F.least(free, n - F.col("_have") - before)
    fill = (
        gaps.withColumn("_before", before)
        .withColumn("_size", size)
        .filter(F.col("_size") > 0)
        .select(
            "user",
            (F.col("_have") + F.col("_before")).alias("_done"),
            F.posexplode(F.sequence(F.col("pop") + 1, F.col("pop") + F.col("_size"))).alias("_o", "pop"),
        )
        .join(ranks, "pop")
        .select(
            "user",
            "item",
            F.lit(0.0).alias("score"),
            (F.col("_done") + F.col("_o") + 1).cast("int").alias("rank"),
        )
    )
    own = recs.filter(F.col("rank") <= n).select("user", "item", "score", F.col("rank").cast("int"))
    return own.unionByName(fill)


def eligible(
    recs: DataFrame, items: DataFrame, allowed: Column, blocked: DataFrame | None = None
) -> DataFrame:
    """Keep items that satisfy a predicate over the item table and are not blocked."""
    kept = recs.join(items.filter(allowed).select("item"), "item", "left_semi")
    if blocked is not None:
        kept = kept.join(blocked.select("item"), "item", "left_anti")
    return kept
