"""Offline evaluation of lists, predictions and experiments.

Lists are (user, item, rank); truth is (user, item) without repeats. Users
without truth are left out, users with truth but no list count as 0.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tastemill.functions.exact import exact_sum, hash_int, require, round6
from tastemill.functions.ordered import OrderedSplit
from tastemill.session import write_stage


def _hits(recs: DataFrame, truth: DataFrame, k: int | None) -> DataFrame:
    lists = recs.select("user", "item", "rank")
    if k is not None:
        lists = lists.filter(F.col("rank") <= k)
    return lists.join(truth.select("user", "item"), ["user", "item"])


def _per_user(hit_values: DataFrame, truth: DataFrame) -> DataFrame:
    sizes = truth.groupBy("user").agg(F.count(F.lit(1)).alias("relevant"))
    return sizes.join(hit_values, "user", "left")


def _mean(value: Column) -> Column:
    return round6(exact_sum(F.coalesce(value, F.lit(0.0))) / F.count(F.lit(1)))


def precision_recall_at(recs: DataFrame, truth: DataFrame, k: int) -> DataFrame:
    hits = _hits(recs, truth, k).groupBy("user").agg(F.count(F.lit(1)).alias("hits"))
    return _per_user(hits, truth).agg(
        F.count(F.lit(1)).alias("users"),
        _mean(F.col("hits") / F.lit(float(k))).alias("precision"),
        _mean(F.col("hits") / F.col("relevant")).alias("recall"),
    )


def hit_rate_at(recs: DataFrame, truth: DataFrame, k: int) -> DataFrame:
    hits = _hits(recs, truth, k).groupBy("user").agg(F.lit(1.0).alias("hit"))
    return _per_user(hits, truth).agg(
        F.count(F.lit(1)).alias("users"), _mean(F.col("hit")).alias("hit_rate")
    )


def map_at(recs: DataFrame, truth: DataFrame, k: int) -> DataFrame:
    """Mean average precision; the ideal is the smaller of k and the relevant count."""
    so_far = F.count(F.lit(1)).over(Window.partitionBy("user").orderBy("rank"))
    gains = (
        _hits(recs, truth, k)
        .withColumn("_p", so_far / F.col("rank"))
        .groupBy("user")
        .agg(exact_sum(F.col("_p")).alias("gain"))
    )
    ideal = F.least(F.col("relevant"), F.lit(k))
    return _per_user(gains, truth).agg(
        F.count(F.lit(1)).alias("users"), _mean(F.col("gain") / ideal).alias("map")
    )


def ndcg_at(recs: DataFrame, truth: DataFrame, k: int) -> DataFrame:
    """Binary gain 1 / log2(rank + 1) over that of the ideal list."""
    gains = (
        _hits(recs, truth, k)
        .groupBy("user")
        .agg(exact_sum(1.0 / F.log2(F.col("rank") + 1.0)).alias("gain"))
    )
    ideal = F.aggregate(
        F.sequence(F.lit(1), F.least(F.col("relevant"), F.lit(k)).cast("int")),
        F.lit(0.0),
        lambda s, r: s + 1.0 / F.log2(r + 1.0),
    )
    return _per_user(gains, truth).agg(
        F.count(F.lit(1)).alias("users"), _mean(F.col("gain") / ideal).alias("ndcg")
    )


def mrr(recs: DataFrame, truth: DataFrame) -> DataFrame:
    first = _hits(recs, truth, None).groupBy("user").agg((1.0 / F.min("rank")).alias("first"))
    return _per_user(first, truth).agg(
        F.count(F.lit(1)).alias("users"), _mean(F.col("first")).alias("mrr")
    )


def coverage(recs: DataFrame, items: DataFrame, users: DataFrame) -> DataFrame:
    """Share of the catalogue that is recommended and of the users who are reached."""
    catalogue = items.agg(F.count(F.lit(1)).alias("n")).scalar()
    people = users.agg(F.count(F.lit(1)).alias("n")).scalar()
    return recs.agg(
        F.countDistinct("item").alias("items"), F.countDistinct("user").alias("users")
    ).select(
        "items",
        "users",
        round6(F.col("items") / catalogue).alias("item_coverage"),
        round6(F.col("users") / people).alias("user_coverage"),
    )


def gini(recs: DataFrame, items: DataFrame) -> DataFrame:
    """Concentration of exposure over the whole catalogue, unseen items counting 0.

    Items are folded to a histogram first. T exposures have at most
    sqrt(2 T) + 1 different counts, so the one unpartitioned window stays small.
    """
    shown = recs.groupBy("item").agg(F.count(F.lit(1)).alias("x"))
    histogram = (
        items.select("item")
        .join(shown, "item", "left")
        .groupBy(F.coalesce("x", F.lit(0)).alias("x"))
        .agg(F.count(F.lit(1)).alias("m"))
    )
    before = F.coalesce(
        F.sum("m").over(Window.orderBy("x").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)
    )
    wide = "decimal(19,0)"
    ranks = F.col("m") * F.col("_s") + F.floor(F.col("m") * (F.col("m") + 1) / 2)
    sums = (
        histogram.withColumn("_s", before)
        .agg(
            F.sum(F.col("x").cast(wide) * ranks.cast(wide)).cast("double").alias("rx"),
            F.sum(F.col("x") * F.col("m")).alias("t"),
            F.sum("m").alias("n"),
        )
    )
    value = 2.0 * F.col("rx") / (F.col("n") * F.col("t")) - (F.col("n") + 1.0) / F.col("n")
    return sums.select(F.col("n").alias("items"), F.col("t").alias("exposures"), round6(value).alias("gini"))


def novelty(recs: DataFrame, prefs: DataFrame) -> DataFrame:
    """Mean -log2 of the share of users who own the recommended item.

    An item that no one owns counts as owned by one user, the rarest there can be.
    """
    owners = prefs.groupBy("item").agg(F.count(F.lit(1)).alias("n"))
    people = prefs.agg(F.countDistinct("user").alias("n")).scalar()
    info = -F.log2(F.col("n") / F.col("_people"))
    return (
        recs.select("item")
        .join(owners, "item", "left")
        .withColumn("n", F.coalesce("n", F.lit(1)))
        .withColumn("_people", people)
        .agg(F.count(F.lit(1)).alias("recs"), _mean(info).alias("novelty"))
    )


def intra_list_diversity(recs: DataFrame, sims: DataFrame) -> DataFrame:
    """1 - mean similarity of the pairs of a list; pairs not in (a, b, score) count 0.

    A list holds n items at most, so it has n (n - 1) / 2 pairs. Every list of
    two or more items weighs the same.
    """
    recs = write_stage(recs.select("user", "item"), "lists")
    left = recs.select("user", F.col("item").alias("a"))
    right = recs.select("user", F.col("item").alias("b"))
    pairs = left.join(right, "user").filter(F.col("a") < F.col("b"))
    known = sims.select("a", "b", "score").filter(F.col("a") < F.col("b"))
    lists = (
        pairs.join(known, ["a", "b"], "left")
        .groupBy("user")
        .agg((exact_sum(F.coalesce("score", F.lit(0.0))) / F.count(F.lit(1))).alias("_near"))
    )
    return lists.agg(
        F.count(F.lit(1)).alias("users"), round6(1.0 - exact_sum(F.col("_near")) / F.count(F.lit(1))).alias("diversity")
    )


def rmse_mae(predictions: DataFrame) -> DataFrame:
    require(predictions, "rating", "predicted")
    gap = F.col("rating") - F.col("predicted")
    return predictions.agg(
        F.count(F.lit(1)).alias("n"),
        round6(F.sqrt(exact_sum(gap * gap) / F.count(F.lit(1)))).alias("rmse"),
        round6(exact_sum(F.abs(gap)) / F.count(F.lit(1))).alias("mae"),
    )


def auc(scores: DataFrame) -> DataFrame:
    """Area under the ROC curve, tied scores sharing their rank.

    Rows are folded per score, then scanned in score order in parallel.
    """
    require(scores, "label", "score")
    folded = scores.groupBy("score").agg(
        F.count_if(F.col("label") == 1).alias("pos"), F.count_if(F.col("label") != 1).alias("neg")
    )
    scan = OrderedSplit(folded, [], ["score"]).running_sum(F.col("neg"), "_below", inclusive=False)
    wide = "decimal(19,0)"
    wins = F.col("pos").cast(wide) * (2 * F.col("_below") + F.col("neg")).cast(wide)
    sums = scan.result().agg(
        F.sum(wins).cast("double").alias("w"), F.sum("pos").alias("pos"), F.sum("neg").alias("neg")
    )
    area = F.col("w") / 2.0 / (F.col("pos").cast("double") * F.col("neg"))
    return sums.select("pos", "neg", round6(area).alias("auc"))


def log_loss(scores: DataFrame, clip: float = 1e-6) -> DataFrame:
    p = F.greatest(F.lit(clip), F.least(F.lit(1.0 - clip), F.col("score")))
    loss = -(F.col("label") * F.ln(p) + (1.0 - F.col("label")) * F.ln(1.0 - p))
    return scores.agg(F.count(F.lit(1)).alias("n"), _mean(loss).alias("log_loss"))


def ab_summary(events: DataFrame, salt: str, arms: int) -> DataFrame:
    """Purchase rate per arm with standard error and z against arm 0; users are hashed to arms."""
    require(events, "user", "success")
    arm = F.pmod(hash_int(F.lit(salt), F.col("user")), F.lit(arms))
    totals = events.groupBy(arm.cast("int").alias("arm")).agg(
        F.count(F.lit(1)).alias("n"), F.count_if("success").alias("hits")
    )
    # One row per arm from here on.
    over = Window.partitionBy()
    n0 = F.max(F.when(F.col("arm") == 0, F.col("n"))).over(over)
    x0 = F.max(F.when(F.col("arm") == 0, F.col("hits"))).over(over)
    rated = totals.withColumn("_n0", n0).withColumn("_x0", x0)
    p = F.col("hits") / F.col("n")
    pool = (F.col("hits") + F.col("_x0")) / (F.col("n") + F.col("_n0"))
    spread = F.sqrt(pool * (1.0 - pool) * (1.0 / F.col("n") + 1.0 / F.col("_n0")))
    z = F.when((F.col("arm") == 0) | (spread == 0), F.lit(0.0)).otherwise(
        (p - F.col("_x0") / F.col("_n0")) / spread
    )
    return rated.select(
        "arm",
        "n",
        "hits",
        round6(p).alias("rate"),
        round6(F.sqrt(p * (1.0 - p) / F.col("n"))).alias("std_error"),
        round6(z).alias("z"),
    )
