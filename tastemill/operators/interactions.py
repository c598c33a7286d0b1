"""From raw actions to preferences, sessions, sequences and splits."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tastemill.functions.exact import exact_sum, hash_int, require, round6
from tastemill.functions.ordered import OrderedSplit
from tastemill.functions.ranked import top_per
from tastemill.session import write_stage


def preferences(interactions: DataFrame, how: str = "sum", ties: Sequence[str] = ()) -> DataFrame:
    """One row per (user, item): sum, count, max or last weight, and the last time."""
    require(interactions, "user", "item", "ts", "weight")
    if how == "sum":
        weight = exact_sum(F.col("weight"))
    elif how == "count":
        weight = F.count("weight").cast("double")
    elif how == "max":
        weight = F.max("weight")
    elif how == "last":
        weight = F.max_by("weight", F.struct("ts", *ties, "weight"))
    else:
        raise ValueError(f"unknown how: {how}")
    return interactions.groupBy("user", "item").agg(
        weight.alias("weight"), F.max("ts").alias("last_ts")
    )


def decay(interactions: DataFrame, as_of: str, rate: float) -> DataFrame:
    """Weight times exp(-rate * days before ``as_of``)."""
    days = F.datediff(F.lit(as_of).cast("date"), F.col("ts"))
    return interactions.withColumn("weight", round6(F.col("weight") * F.exp(-rate * days)))


def binarise(prefs: DataFrame, threshold: float) -> DataFrame:
    """Implicit 1 where the weight reaches the threshold; other pairs are not preferences."""
    return prefs.filter(F.col("weight") >= threshold).withColumn("weight", F.lit(1.0))


def k_core(prefs: DataFrame, k_user: int, k_item: int) -> DataFrame:
    """Drop thin users, then thin items, until nothing changes.

    Counts are partial aggregates joined back, so no task holds a whole user.
    Each round is a written table: the plan stays one round deep.
    """
    current = write_stage(prefs, "kcore")
    size = current.count()
    while True:
        for key, least in (("user", k_user), ("item", k_item)):
            thick = current.groupBy(key).agg(F.count(F.lit(1)).alias("_n"))
            current = current.join(thick.filter(F.col("_n") >= least), key, "left_semi")
        current = write_stage(current, "kcore")
        left = current.count()
        if left == size:
            return current
        size = left


def index_ids(df: DataFrame, column: str) -> DataFrame:
    """Map table (column, idx): dense ids from 0 in key order, numbered in parallel."""
    keys = df.select(column).where(F.col(column).isNotNull()).distinct()
    numbered = OrderedSplit(keys, [], [column]).row_number("_n").result()
    return numbered.select(column, (F.col("_n") - 1).cast("bigint").alias("idx"))


def apply_index(df: DataFrame, ids: DataFrame, column: str) -> DataFrame:
    """Swap a key for its dense id."""
    return df.join(ids, column).drop(column).withColumnRenamed("idx", column)


def dedupe_latest(
    interactions: DataFrame, keys: Sequence[str], ties: Sequence[str] = ()
) -> DataFrame:
    """Newest row per key; equal times go to the larger tie columns."""
    order = [F.col(c).desc_nulls_last() for c in ("ts", *ties)]
    return top_per(interactions, keys, order, 1).drop("rank")


def sessionise(events: DataFrame, gap_seconds: int) -> DataFrame:
    """Number sessions per user from 1; a pause longer than the gap starts a new one."""
    require(events, "user", "ts", "event_id")
    micros = F.unix_micros(F.col("ts").cast("timestamp"))
    scan = OrderedSplit(events.withColumn("_us", micros), ["user"], ["_us", "event_id"])
    scan.lag(F.col("_us"), "_prev")
    opens = F.col("_prev").isNull() | (F.col("_us") - F.col("_prev") > gap_seconds * 1_000_000)
    scan.running_sum(F.when(opens, 1).otherwise(0).cast("bigint"), "session")
    return scan.result().drop("_us", "_prev")


def basket_items(interactions: DataFrame) -> DataFrame:
    """Distinct (basket, item): the long form every pair job works on."""
    require(interactions, "basket", "item")
    return interactions.select("basket", "item").distinct()


def baskets(items: DataFrame, chunk: int = 4096) -> DataFrame:
    """Sorted item arrays per basket, in parts of at most ``chunk`` items.

    All ordinary baskets have the one part 0; a giant basket keeps all its
    items as several rows instead of one unbounded array.
    """
    scan = OrderedSplit(items, ["basket"], ["item"]).row_number("_n")
    part = F.floor((F.col("_n") - 1) / chunk).cast("int")
    return (
        scan.result()
        .groupBy("basket", part.alias("part"))
        .agg(F.array_sort(F.collect_list("item")).alias("items"))
    )


def sequences(events: DataFrame, chunk: int = 4096) -> DataFrame:
    """Time-ordered items per user, in consecutive parts of at most ``chunk`` steps."""
    require(events, "user", "ts", "event_id", "item")
    scan = OrderedSplit(
        events.select("user", "ts", "event_id", "item"), ["user"], ["ts", "event_id"]
    ).row_number("_n")
    part = F.floor((F.col("_n") - 1) / chunk).cast("int")
    step = F.struct("ts", "event_id", "item")
    return (
        scan.result()
        .groupBy("user", part.alias("part"))
        .agg(F.array_sort(F.collect_list(step)).alias("seq"))
    )


def negative_sample(
    prefs: DataFrame, items: DataFrame, n: int, seed: int, bucket_items: int = 64
) -> DataFrame:
    """``n`` unseen items per user with one ``rank``, smallest hash first, from the user's buckets of items.

    Items are hashed into buckets of about ``bucket_items``; a user meets its
    home bucket first, so the join grows with users x bucket and never with
    users x items. A user who has seen too much of it goes on to the next 2, 4,
    8... buckets, until n are found or all buckets are met: the rounds grow with
    the logarithm of the catalogue. Within a round the smallest hashes win.
    """
    require(prefs, "user", "item")
    catalogue = items.select("item").distinct()
    buckets = max(1, catalogue.count() // bucket_items)
    salt = F.lit(seed)
    bucket = F.pmod(hash_int(salt, F.col("item")), F.lit(buckets))
    catalogue = write_stage(catalogue.withColumn("_bucket", bucket), "catalogue")
    users = prefs.select("user").distinct()
    home = F.pmod(hash_int(F.col("user"), salt), F.lit(buckets))
    pending = users.select("user", home.alias("_home"), F.lit(0).cast("int").alias("_have"))
    seen = prefs.select("user", "item")
    found, first, step = None, 0, 0
    while first < buckets:
        last = min(2 * first, buckets - 1)
        next_ones = F.explode(F.sequence(F.lit(first), F.lit(last)))
        draws = (
            pending.withColumn("_next", next_ones)
            .withColumn("_bucket", F.pmod(F.col("_home") + F.col("_next"), F.lit(buckets)))
            .join(catalogue, "_bucket")
            .join(seen, ["user", "item"], "left_anti")
            .withColumn("_hash", hash_int(F.col("user"), F.col("item"), salt))
        )
        place = (F.col("_have") + F.col("rank")).cast("int")
        picked = (
            top_per(draws, ["user"], [F.col("_hash"), F.col("item")], n)
            .filter(place <= n)
            .select("user", "item", F.lit(step).alias("round"), place.alias("rank"))
        )
        picked = write_stage(picked, "negatives")
        found = picked if found is None else found.unionByName(picked)
        got = picked.groupBy("user").agg(F.count(F.lit(1)).alias("_got"))
        have = (F.col("_have") + F.coalesce(F.col("_got"), F.lit(0))).cast("int")
        pending = write_stage(
            pending.join(got, "user", "left").select("user", "_home", have.alias("_have")).filter(F.col("_have") < n),
            "pending",
        )
        if pending.isEmpty():
            break
        first, step = last + 1, step + 1
    return found


def split_last_one(interactions: DataFrame, ties: Sequence[str] = ("item",)) -> DataFrame:
    """Fold ``test`` for each user's last row, ``train`` for the rest."""
    position = F.struct("ts", *ties)
    last = interactions.groupBy("user").agg(F.max(position).alias("_last"))
    fold = F.when(position == F.col("_last"), "test").otherwise("train")
    return interactions.join(last, "user").withColumn("fold", fold).drop("_last")


def split_by_date(interactions: DataFrame, cut: str) -> DataFrame:
    fold = F.when(F.col("ts") >= F.lit(cut).cast("timestamp_ntz"), "test").otherwise("train")
    return interactions.withColumn("fold", fold)


def split_last_fraction(
    interactions: DataFrame, fraction: float, ties: Sequence[str] = ("item",)
) -> DataFrame:
    """Fold ``test`` for rows whose percent rank in the user's history is in the last fraction."""
    scan = OrderedSplit(interactions, ["user"], ["ts", *ties])
    scan.row_number("_n").key_total(F.lit(1).cast("bigint"), "_of")
    share = F.when(F.col("_of") > 1, (F.col("_n") - 1) / (F.col("_of") - 1)).otherwise(F.lit(0.0))
    fold = F.when(share >= 1.0 - fraction, "test").otherwise("train")
    return scan.result().withColumn("fold", fold).drop("_n", "_of")


def split_by_hash(interactions: DataFrame, percent: int, salt: str) -> DataFrame:
    """Fold by a hash of (user, item): stable under repartitioning and reruns."""
    bucket = F.pmod(hash_int(F.lit(salt), F.col("user"), F.col("item")), F.lit(100))
    return interactions.withColumn("fold", F.when(bucket < percent, "test").otherwise("train"))
