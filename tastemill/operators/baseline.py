"""Popularity rankings and baseline predictors."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tastemill.functions.exact import exact_sum, require, round6
from tastemill.functions.ordered import OrderedSplit
from tastemill.functions.ranked import top_per


def _item_totals(prefs: DataFrame) -> DataFrame:
    # (user, item) is unique in preferences, so a plain count is the distinct user count.
    return prefs.groupBy("item").agg(
        F.count(F.lit(1)).alias("users"), exact_sum(F.col("weight"), 1e6).alias("weight")
    )


_BY_POPULARITY = (F.desc, "users"), (F.desc, "weight"), (F.asc, "item")


def popular(prefs: DataFrame, n: int) -> DataFrame:
    """Top items by distinct users, then weight, then key."""
    require(prefs, "user", "item", "weight")
    order = [way(c) for way, c in _BY_POPULARITY]
    return _item_totals(prefs).orderBy(*order).limit(n)


def popularity_ranks(prefs: DataFrame) -> DataFrame:
    """Every item with its place ``pop`` in the order of ``popular``, numbered in parallel."""
    totals = _item_totals(prefs).select(
        "item", (-F.col("users")).alias("_u"), (-F.col("weight")).alias("_w")
    )
    return OrderedSplit(totals, [], ["_u", "_w", "item"]).row_number("pop").result().select("item", "pop")


def popular_by(prefs: DataFrame, users: DataFrame, segment: str, n: int) -> DataFrame:
    """``popular`` inside each segment of the users table (user, segment)."""
    totals = (
        prefs.join(users.select("user", segment), "user")
        .groupBy(segment, "item")
        .agg(F.count(F.lit(1)).alias("users"), exact_sum(F.col("weight"), 1e6).alias("weight"))
    )
    return top_per(totals, [segment], [way(c) for way, c in _BY_POPULARITY], n)


def trending(interactions: DataFrame, now: str, recent_days: int, base_days: int, n: int) -> DataFrame:
    """Smoothed rate of the last days over the rate of the days before, best n."""
    age = F.datediff(F.lit(now).cast("date"), F.col("ts"))
    start = F.date_sub(F.lit(now).cast("date"), recent_days + base_days - 1)
    counts = (
        interactions.filter((F.col("ts") >= start.cast("timestamp_ntz")) & (age >= 0))
        .groupBy("item")
        .agg(
            F.count_if(age < recent_days).alias("recent"),
            F.count_if(age >= recent_days).alias("base"),
        )
    )
    ratio = (F.col("recent") + 1) * float(base_days) / ((F.col("base") + 1) * float(recent_days))
    return (
        counts.withColumn("score", round6(ratio)).orderBy(F.desc("score"), F.asc("item")).limit(n)
    )


def centre(ratings: DataFrame, by: str, method: str = "mean") -> DataFrame:
    """Rating minus the mean of its user or item, or its z-score there."""
    require(ratings, "user", "item", "rating")
    stats = ratings.groupBy(by).agg(
        F.count(F.lit(1)).alias("_n"),
        exact_sum(F.col("rating"), 1e6).alias("_s"),
        exact_sum(F.col("rating") * F.col("rating"), 1e6).alias("_q"),
    )
    mean = F.col("_s") / F.col("_n")
    gap = F.col("rating") - mean
    if method == "z":
        spread = F.sqrt(F.greatest(F.lit(0.0), F.col("_q") / F.col("_n") - mean * mean))
        gap = F.when(spread > 1e-9, gap / spread).otherwise(F.lit(0.0))
    elif method != "mean":
        raise ValueError(f"unknown method: {method}")
    return ratings.join(stats, by).select("user", "item", round6(gap).alias("rating"))


def bias_baseline(ratings: DataFrame, l_item: float, l_user: float) -> DataFrame:
    """Predicted rating mu + b_item + b_user from damped one-pass means."""
    require(ratings, "user", "item", "rating")
    mu = ratings.agg((exact_sum(F.col("rating"), 1e6) / F.count(F.lit(1))).alias("mu")).scalar()
    rated = ratings.withColumn("mu", mu)
    item_bias = rated.groupBy("item").agg(
        (exact_sum(F.col("rating") - F.col("mu")) / (F.count(F.lit(1)) + l_item)).alias("b_item")
    )
    with_item = rated.join(item_bias, "item")
    left = F.col("rating") - F.col("mu") - F.col("b_item")
    user_bias = with_item.groupBy("user").agg(
        (exact_sum(left) / (F.count(F.lit(1)) + l_user)).alias("b_user")
    )
    return with_item.join(user_bias, "user").select(
        "user",
        "item",
        "rating",
        round6(F.col("mu") + F.col("b_item") + F.col("b_user")).alias("predicted"),
    )


def shrunk_mean(prefs: DataFrame, m: float) -> DataFrame:
    """Bayesian item mean (sum + m * mu) / (n + m)."""
    mu = prefs.agg((exact_sum(F.col("weight"), 1e6) / F.count(F.lit(1))).alias("mu")).scalar()
    return (
        prefs.groupBy("item")
        .agg(F.count(F.lit(1)).alias("n"), exact_sum(F.col("weight"), 1e6).alias("s"))
        .withColumn("mu", mu)
        .select(
            "item", "n", round6((F.col("s") + m * F.col("mu")) / (F.col("n") + m)).alias("score")
        )
    )


def wilson_lower(prefs: DataFrame, liked_from: float, z: float = 1.96) -> DataFrame:
    """Wilson lower bound of the share of weights at or above ``liked_from``."""
    counts = prefs.groupBy("item").agg(
        F.count(F.lit(1)).alias("n"), F.count_if(F.col("weight") >= liked_from).alias("liked")
    )
    p, n = F.col("liked") / F.col("n"), F.col("n")
    spread = z * F.sqrt((p * (1.0 - p) + z * z / (4.0 * n)) / n)
    low = (p + z * z / (2.0 * n) - spread) / (1.0 + z * z / n)
    return counts.select("item", "n", "liked", round6(low).alias("score"))
