"""Association rules, ordered patterns and next-item statistics."""

from __future__ import annotations

from pyspark.ml.fpm import FPGrowth, FPGrowthModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tastemill.functions.exact import exact_sum, require, round6
from tastemill.functions.ordered import OrderedSplit
from tastemill.functions.pairs import CELL, mirrored, pair_stats, shared_pairs
from tastemill.functions.ranked import top_per
from tastemill.session import write_stage


def _frequent_items(items: DataFrame, min_support: float) -> DataFrame:
    """Basket rows of the items that can be in a frequent set, with count ``n`` and all baskets ``total``."""
    require(items, "basket", "item")
    items = write_stage(items.select("basket", "item"), "baskets")
    baskets = items.agg(F.countDistinct("basket").alias("total")).scalar()
    counts = (
        items.groupBy("item")
        .agg(F.count(F.lit(1)).alias("n"))
        .withColumn("total", baskets)
        .filter(F.col("n") / F.col("total") >= min_support)
    )
    return items.join(counts, "item")


def frequent_pairs(items: DataFrame, min_support: float) -> DataFrame:
    """Item pairs with support, both confidences and lift, from distinct (basket, item)."""
    rows = _frequent_items(items, min_support)
    pairs = pair_stats(
        rows,
        "basket",
        "item",
        [
            F.count(F.lit(1)).alias("k"),
            F.max("n_a").alias("n_a"),
            F.max("n_b").alias("n_b"),
            F.max("total_a").alias("total"),
        ],
        ["n", "total"],
    )
    k, n_a, n_b, all_ = (F.col(c).cast("double") for c in ("k", "n_a", "n_b", "total"))
    return pairs.filter(F.col("k") / F.col("total") >= min_support).select(
        "a",
        "b",
        "k",
        round6(k / all_).alias("support"),
        round6(k / n_a).alias("confidence_ab"),
        round6(k / n_b).alias("confidence_ba"),
        round6(k * all_ / (n_a * n_b)).alias("lift"),
    )


def pair_rules(pairs: DataFrame, min_confidence: float) -> DataFrame:
    """Frequent pairs as rules (antecedent array, consequent, confidence)."""
    rule = F.array(
        F.struct(F.array("a").alias("antecedent"), F.col("b").alias("consequent"), F.col("confidence_ab").alias("confidence")),
        F.struct(F.array("b").alias("antecedent"), F.col("a").alias("consequent"), F.col("confidence_ba").alias("confidence")),
    )
    return pairs.select(F.inline(rule)).filter(F.col("confidence") >= min_confidence)


def fp_growth(items: DataFrame, min_support: float, min_confidence: float) -> FPGrowthModel:
    """Frequent sets of any size and their rules.

    Only items frequent on their own reach the basket arrays. There are at most
    (mean basket size / min_support) of these, which bounds every array.
    """
    rows = _frequent_items(items, min_support)
    baskets = rows.groupBy("basket").agg(F.collect_list("item").alias("items"))
    # Support is a share of all baskets, including those left without a frequent item.
    every = items.select("basket").distinct().count()
    kept = max(1, baskets.count())
    # Half a basket under the smallest count that passes, so that no rounding moves the bar.
    share = (_smallest_count(min_support, every) - 0.5) / kept
    return FPGrowth(
        itemsCol="items", minSupport=min(1.0, max(0.0, share)), minConfidence=min_confidence
    ).fit(baskets)


#: Baskets a word of a bitmap stands for.
_WORD = 64


def _bitmaps(rows: DataFrame, *keys: str) -> DataFrame:
    """(keys, word, bits): the numbered baskets (tid) of each key, as words that are not zero."""
    bit = F.expr(f"shiftleft(1L, CAST(tid % {_WORD} AS INT))")
    return rows.groupBy(*keys, F.floor(F.col("tid") / _WORD).alias("word")).agg(F.bit_or(bit).alias("bits"))


def vertical_itemsets(items: DataFrame, min_support: float, max_size: int | None = None) -> DataFrame:
    """Frequent sets (items sorted array, freq), level by level, from bitmaps of the baskets that hold a set.

    Baskets are numbered densely, and a set is the words of 64 baskets in which
    its bits are not all zero. Two sets of one prefix class (all items but the
    last are the same) meet word by word, and what both have is the set that has
    both last items; its count is the number of bits. No basket is gathered in a
    row. Single items and pairs are counted on the rows, since words of single
    items share baskets far less often than they meet.

    A giant basket is cut into join cells like any large group. Rows without
    basket or item, and repeats of a row, do not count. A table without baskets
    has no sets.
    """
    require(items, "basket", "item")
    rows = _frequent_items(items.select("basket", "item").dropna().distinct(), min_support)
    rows = write_stage(rows.select("basket", "item", "n", "total"), "frequent")
    single = rows.groupBy(F.array("item").alias("items")).agg(F.max("n").alias("freq"))
    found = single
    if max_size == 1 or rows.isEmpty():
        return found
    need = _smallest_count(min_support, rows.first()["total"])
    numbers = OrderedSplit(rows.select("basket").distinct(), [], ["basket"]).row_number("tid").result()
    pairs = shared_pairs(rows.join(numbers, "basket").select("tid", "item"), "tid", "item")
    counts = pairs.groupBy("a", "b").agg(F.count(F.lit(1)).alias("freq")).filter(F.col("freq") >= need)
    counts = write_stage(counts, "frequent-pairs")
    level = counts.select(F.array("a", "b").alias("items"), "freq")
    held = _bitmaps(pairs.join(counts.select("a", "b"), ["a", "b"], "left_semi"), "a", "b")
    state = held.select(F.struct(F.array("a").alias("prefix"), "word").alias("class"), F.col("b").alias("item"), "bits")
    size = 2
    while not level.isEmpty():
        found = found.unionByName(level)
        if size == max_size:
            break
        size += 1
        both = F.col("bits_a").bitwiseAND(F.col("bits_b"))
        met = shared_pairs(state, "class", "item", ["bits"]).withColumn("bits", both).filter("bits <> 0")
        # Written once: the counts and the next level both read it.
        grown = write_stage(
            met.select(
                F.concat("class.prefix", F.array("a")).alias("prefix"),
                F.col("b").alias("item"),
                F.col("class.word").alias("word"),
                "bits",
            ),
            "grown",
        )
        freq = F.sum(F.bit_count("bits")).alias("freq")
        counts = write_stage(grown.groupBy("prefix", "item").agg(freq).filter(F.col("freq") >= need), "frequent-sets")
        level = counts.select(F.concat("prefix", F.array("item")).alias("items"), "freq")
        state = grown.join(counts, ["prefix", "item"], "left_semi").select(
            F.struct("prefix", "word").alias("class"), "item", "bits"
        )
    return found


def _smallest_count(min_support: float, total: int) -> int:
    """Smallest count whose share of ``total`` reaches the bar, by the comparison frequent items use."""
    count = max(1, int(min_support * total) - 1)
    while total and count / total < min_support:
        count += 1
    return count


def apply_rules(items: DataFrame, rules: DataFrame, n: int) -> DataFrame:
    """Best n consequents per basket whose whole antecedent lies in it, not already there.

    A rule fires when as many of its items match as it has, counted by a join
    on single items: no basket is ever gathered into one array.
    """
    require(items, "basket", "item")
    ruled = rules.select("antecedent", "consequent", "confidence").withColumn(
        "item", F.explode("antecedent")
    )
    fired = (
        items.join(ruled, "item")
        .groupBy("basket", "antecedent", "consequent", "confidence")
        .agg(F.count(F.lit(1)).alias("_hits"))
        .filter(F.col("_hits") == F.size("antecedent"))
        .groupBy("basket", F.col("consequent").alias("item"))
        .agg(F.max("confidence").alias("score"))
    )
    fresh = fired.join(items.select("basket", "item"), ["basket", "item"], "left_anti")
    return top_per(fresh, ["basket"], [F.desc("score"), F.asc("item")], n)


def prefix_span(steps: DataFrame, min_support: float, max_len: int, cell: int = CELL) -> DataFrame:
    """Frequent ordered patterns (pattern array, freq) of up to ``max_len`` items.

    Grown one item at a time. For each user and frequent pattern only the
    leftmost place where the pattern ends is kept; an item extends it when its
    last place in the user's history lies further right. Histories are never
    gathered into arrays, and repeats of an item collapse to two positions. A user
    with over ``cell`` frequent items is cut by a hash of the item, so that the
    user's patterns meet them in several tasks; the cut travels with the patterns.
    """
    require(steps, "user", "ts", "event_id", "item")
    placed = OrderedSplit(steps.select("user", "ts", "event_id", "item"), ["user"], ["ts", "event_id"])
    rows = placed.row_number("pos").result().select("user", "item", "pos")
    total = steps.select("user").distinct().count()

    def frequent(grown: DataFrame) -> DataFrame:
        support = grown.groupBy("pattern").agg(F.count(F.lit(1)).alias("freq"))
        return write_stage(support.filter(F.col("freq") / total >= min_support), "patterns")

    ends = rows.groupBy("user", "item").agg(F.min("pos").alias("end"), F.max("pos").alias("last"))
    single = ends.withColumn("pattern", F.array("item"))
    result = level = frequent(single)
    keep = level.select(F.col("pattern")[0].alias("item"))
    rows = rows.join(keep, "item", "left_semi")
    ends = write_stage(ends.join(keep, "item", "left_semi"), "ends")
    several = (
        ends.groupBy("user")
        .agg(F.ceil(F.count(F.lit(1)) / F.lit(cell)).cast("int").alias("salts"))
        .filter(F.col("salts") > 1)
    )
    ends = ends.join(several, "user", "left").withColumn("salts", F.coalesce("salts", F.lit(1)))
    salt = F.pmod(F.xxhash64("item"), F.col("salts")).cast("int")
    lasts = write_stage(ends.select("user", F.col("item").alias("next"), "last", salt.alias("salt")), "lasts")
    state = ends.select("user", F.array("item").alias("pattern"), "end", "salts")
    for length in range(2, max_len + 1):
        # Written once: the supports and the next state both read it.
        grown = write_stage(
            state.withColumn("salt", F.explode(F.sequence(F.lit(0), F.col("salts") - 1)))
            .join(lasts, ["user", "salt"])
            .filter(F.col("last") > F.col("end"))
            .select(
                "user",
                "end",
                "next",
                "salts",
                F.concat("pattern", F.array("next")).alias("pattern"),
            ),
            "grown",
        )
        level = frequent(grown)
        if level.isEmpty():
            break
        result = result.unionByName(level)
        if length < max_len:
            later = rows.select("user", F.col("item").alias("next"), "pos")
            kept = grown.join(level.select("pattern"), "pattern", "left_semi")
            state = write_stage(
                kept.join(later, ["user", "next"])
                .filter(F.col("pos") > F.col("end"))
                .groupBy("user", "pattern")
                .agg(F.min("pos").alias("end"), F.max("salts").alias("salts")),
                "state",
            )
    return result


def markov_next(steps: DataFrame, n: int, alpha: float) -> DataFrame:
    """Smoothed P(next item | item), best n per item."""
    require(steps, "user", "ts", "event_id", "item")
    scan = OrderedSplit(steps.select("user", "ts", "event_id", "item"), ["user"], ["ts", "event_id"])
    moves = scan.lead(F.col("item"), "next").result().filter(F.col("next").isNotNull())
    counts = moves.groupBy("item", "next").agg(F.count(F.lit(1)).alias("k"))
    totals = counts.groupBy("item").agg(F.sum("k").alias("of"))
    kinds = steps.agg(F.countDistinct("item").alias("v")).scalar()
    p = (F.col("k") + alpha) / (F.col("of") + alpha * F.col("_v"))
    scored = counts.join(totals, "item").withColumn("_v", kinds).select(
        "item", "next", "k", round6(p).alias("score")
    )
    return top_per(scored, ["item"], [F.desc("score"), F.asc("next")], n)


def session_cf(steps: DataFrame, n: int) -> DataFrame:
    """Items near each other in a session, each meeting worth 1 / (1 + distance), best n.

    Rows carry user, session, ts, event_id and item.
    """
    require(steps, "user", "session", "ts", "event_id", "item")
    scan = OrderedSplit(
        steps.select("user", "session", "ts", "event_id", "item"), ["user", "session"], ["ts", "event_id"]
    ).row_number("pos")
    rows = scan.result().select(F.struct("user", "session").alias("sid"), "pos", "item")
    met = shared_pairs(rows, "sid", "pos", ["item"]).filter(F.col("item_a") != F.col("item_b"))
    near = 1.0 / (1.0 + (F.col("b") - F.col("a")))
    pairs = met.groupBy(
        F.least("item_a", "item_b").alias("a"), F.greatest("item_a", "item_b").alias("b")
    ).agg(F.count(F.lit(1)).alias("k"), round6(exact_sum(near)).alias("score"))
    return top_per(mirrored(pairs, both=["k", "score"]), ["a"], [F.desc("score"), F.asc("b")], n)
