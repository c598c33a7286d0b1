"""Item and user neighbourhoods from shared users or shared items."""

from __future__ import annotations

import sys
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field

import numpy as np
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import IntegralType

from tastemill.functions.copies import hand_out, members_of
from tastemill.functions.exact import SCALE, exact_sum, require, round6
from tastemill.functions.ordered import OrderedSplit
from tastemill.functions.pairs import directed_pairs, directed_stats, mirrored, pair_stats, shared_pairs
from tastemill.functions.ranked import top_per
from tastemill.functions.slope import predictions
from tastemill.functions.top_pairs import SqlMaths, top_pairs
from tastemill.functions.votes import top_votes
from tastemill.operators.postprocess import drop_seen, top_n
from tastemill.session import write_stage

#: Votes that a task adds up, on average.
_VOTES = 1 << 20
#: The least chance with which min-hashes must meet a pair at the bar.
_MET = 0.9



@dataclass(frozen=True)
class Measure:
    """How alike two items are by the users they share.

    ``rows`` are (user, item) with ``values`` of the row itself, ``fixed`` ones
    of the item and ``shared`` ones of the user; all travel with the rows, which
    are few, so that the pairs need no join. ``sums`` are exact sums (term,
    scale) over shared users (``k`` counts them), and ``score`` is made of them,
    of the fixed values of ``a`` and ``b`` and of ``totals``, a table of one row.
    Terms and scores are written once, for columns and for arrays.
    """

    rows: DataFrame
    score: Callable
    sums: Mapping[str, tuple[Callable, float]] = field(default_factory=dict)
    values: tuple[str, ...] = ()
    fixed: tuple[str, ...] = ()
    shared: tuple[str, ...] = ()
    keep: Callable | None = None
    #: The score of (a, b) is another one than that of (b, a).
    directed: bool = False
    totals: DataFrame | None = None

    def _scored(self, pairs: DataFrame) -> DataFrame:
        known = {c: F.col(c) for c in pairs.columns}
        if self.totals is not None:
            known.update({c: self.totals.select(c).scalar() for c in self.totals.columns})
        kept = pairs if self.keep is None else pairs.filter(self.keep(known))
        return kept.select("a", "b", "k", round6(self.score(known, SqlMaths)).alias("score"))

    def _sums(self, carried: Sequence[str]) -> list[Column]:
        known = {f"{v}_{s}": F.col(f"{v}_{s}") for v in carried for s in "ab"}
        known.update({v: F.col(f"{v}_a") for v in self.shared})
        return [_shared(), *[exact_sum(term(known), scale).alias(n) for n, (term, scale) in self.sums.items()]]

    def pairs(self) -> DataFrame:
        """(a, b, k, score) of all pairs a < b that share a user; both directions of a directed measure."""
        carried = [*self.values, *self.fixed, *self.shared]
        sides = [F.max(f"{v}_{s}").alias(f"{v}_{s}") for v in self.fixed for s in "ab"]
        found = pair_stats(self.rows, "user", "item", [*self._sums(carried), *sides], carried)
        if self.directed:
            found = mirrored(found, both=["k"], sided=list(self.fixed))
        return self._scored(found)

    def among(self, wanted: DataFrame) -> DataFrame:
        """(a, b, k, score) of those of the pairs ``wanted`` (a < b) that share a user, without rows for the others."""
        if isinstance(self.rows.schema["item"].dataType, IntegralType):
            return self._met(0, wanted)
        return self.pairs().join(wanted.select("a", "b").distinct(), ["a", "b"], "left_semi")

    def _met(self, k: int, among: DataFrame | None = None) -> DataFrame:
        totals = {} if self.totals is None else {c: float(x) for c, x in self.totals.first().asDict().items()}
        return top_pairs(
            self.rows,
            "user",
            "item",
            k,
            self.score,
            self.sums,
            self.values,
            self.fixed,
            self.shared,
            self.keep,
            self.directed,
            totals,
            among=among,
            half=among is not None and not self.directed,
        )

    def nearest(self, k: int) -> DataFrame:
        """(a, b, k, score, rank): the best k neighbours of every item.

        Lists are made where the pairs of an item meet, in arrays, so there are
        no rows of pairs (see ``functions.top_pairs``). Items that are no whole
        numbers have their pairs in rows (see ``functions.pairs.directed_pairs``).
        """
        if isinstance(self.rows.schema["item"].dataType, IntegralType):
            return self._met(k)
        carried = [*self.values, *self.shared]
        found = directed_stats(self.rows, "user", "item", self._sums(carried), carried, self.fixed)
        if not self.directed:
            # In one order for both directions, so that both round alike.
            in_order = F.col("a") < F.col("b")
            found = found.withColumns(
                {
                    f"{v}_{s}": F.when(in_order, F.col(f"{v}_{s}")).otherwise(F.col(f"{v}_{o}"))
                    for v in self.fixed
                    for s, o in ("ab", "ba")
                }
            )
        return top_per(self._scored(found), ["a"], [F.desc("score"), F.asc("b")], k)


def _shared() -> Column:
    return F.count(F.lit(1)).alias("k")


def _sized(prefs: DataFrame, key: str = "item") -> DataFrame:
    """Preferences with ``n``, the owners of the item, carried on each row."""
    sizes = prefs.groupBy(key).agg(F.count(F.lit(1)).alias("n"))
    return prefs.select("user", "item").join(sizes, key)


def _binary(prefs: DataFrame, score: Callable, **how) -> Measure:
    """A measure of k, n_a and n_b."""
    require(prefs, "user", "item")
    return Measure(_sized(prefs), score, fixed=("n",), **how)


def cooccur(prefs: DataFrame) -> DataFrame:
    """Users who share items a < b, counted where the lists of ``a`` meet; items that are no whole numbers have rows."""
    require(prefs, "user", "item")
    rows = prefs.select("user", "item")
    if isinstance(rows.schema["item"].dataType, IntegralType):
        return top_pairs(rows, "user", "item", None, lambda v, m: v["k"], half=True).select("a", "b", "k")
    return pair_stats(rows, "user", "item", [_shared()])


def neighbours(similar: DataFrame, k: int) -> DataFrame:
    """Best k directed neighbours per ``a`` of an undirected similarity table."""
    directed = mirrored(similar, both=["k", "score"])
    return top_per(directed, ["a"], [F.desc("score"), F.asc("b")], k)


def cosine(prefs: DataFrame) -> Measure:
    """k / sqrt(n_a n_b) over binary ownership."""
    return _binary(prefs, lambda v, m: v["k"] / m.sqrt(v["n_a"] * m.number(1) * v["n_b"]))


def item_cosine(prefs: DataFrame, among: DataFrame | None = None) -> DataFrame:
    """All pairs a < b that share a user, or those ``among`` the given ones."""
    return cosine(prefs).pairs() if among is None else cosine(prefs).among(among)


def weighted_cosine(prefs: DataFrame) -> Measure:
    """Dot product of weight columns over their norms."""
    require(prefs, "user", "item", "weight")
    w = F.col("weight")
    # Sums of squares are often whole numbers, which travel in fewer bytes than their roots.
    norms = prefs.groupBy("item").agg(exact_sum(w * w, 1e6).alias("squares"))

    def both(v, m):
        return m.sqrt(v["squares_a"]) * m.sqrt(v["squares_b"])

    return Measure(
        prefs.select("user", "item", "weight").join(norms, "item"),
        lambda v, m: v["dot"] / both(v, m),
        {"dot": (lambda v: v["weight_a"] * v["weight_b"], 1e6)},
        ("weight",),
        ("squares",),
        keep=lambda v: (v["squares_a"] > 0) & (v["squares_b"] > 0),
    )


def item_cosine_weighted(prefs: DataFrame) -> DataFrame:
    return weighted_cosine(prefs).pairs()


def jaccard(prefs: DataFrame) -> Measure:
    """Shared users over all users of either."""
    return _binary(prefs, lambda v, m: v["k"] / (v["n_a"] + v["n_b"] - v["k"]))


def item_jaccard(prefs: DataFrame) -> DataFrame:
    return jaccard(prefs).pairs()


def _user_count(prefs: DataFrame) -> DataFrame:
    return prefs.agg(F.countDistinct("user").alias("users"))


def _lift(v, m):
    return v["k"] * m.number(1) * v["users"] / (v["n_a"] * m.number(1) * v["n_b"])


def lift(prefs: DataFrame) -> Measure:
    """k N / (n_a n_b)."""
    return _binary(prefs, _lift, totals=_user_count(prefs))


def item_lift(prefs: DataFrame) -> DataFrame:
    return lift(prefs).pairs()


def pmi(prefs: DataFrame) -> Measure:
    """Natural log of the lift."""
    return _binary(prefs, lambda v, m: m.ln(_lift(v, m)), totals=_user_count(prefs))


def item_pmi(prefs: DataFrame) -> DataFrame:
    return pmi(prefs).pairs()


def _xlogx(x, m):
    return m.where(x > 0, x * m.ln(x), m.number(0))


def _llr(v, m):
    total, both = v["users"] * m.number(1), v["k"] * m.number(1)
    n_a, n_b = v["n_a"] * m.number(1), v["n_b"] * m.number(1)
    neither = total - n_a - n_b + both
    cells = _xlogx(both, m) + _xlogx(n_a - both, m) + _xlogx(n_b - both, m) + _xlogx(neither, m)
    rows = _xlogx(n_a, m) + _xlogx(total - n_a, m)
    columns = _xlogx(n_b, m) + _xlogx(total - n_b, m)
    return m.positive(2.0 * (cells - rows - columns + _xlogx(total, m)))


def llr(prefs: DataFrame) -> Measure:
    """Log-likelihood ratio of the 2x2 table of owners of a and of b."""
    return _binary(prefs, _llr, totals=_user_count(prefs))


def item_llr(prefs: DataFrame) -> DataFrame:
    return llr(prefs).pairs()


def iuf_cosine(prefs: DataFrame) -> Measure:
    """Cosine in which a shared user of n_u items counts 1 / ln(1 + n_u)."""
    require(prefs, "user", "item")
    breadth = prefs.groupBy("user").agg(
        (1.0 / F.ln(1.0 + F.count(F.lit(1)))).alias("iuf")
    )
    return Measure(
        _sized(prefs).join(breadth, "user"),
        lambda v, m: v["s"] / m.sqrt(v["n_a"] * m.number(1) * v["n_b"]),
        {"s": (lambda v: v["iuf"], SCALE)},
        fixed=("n",),
        shared=("iuf",),
    )


def item_iuf_cosine(prefs: DataFrame) -> DataFrame:
    return iuf_cosine(prefs).pairs()


def conditional(prefs: DataFrame, alpha: float) -> Measure:
    """Directed k / (n_a n_b ** alpha)."""

    def score(v, m):
        return v["k"] / (v["n_a"] * m.power(v["n_b"] * m.number(1), m.number(alpha)))

    return _binary(prefs, score, directed=True)


def item_conditional(prefs: DataFrame, alpha: float) -> DataFrame:
    """Both directions are returned."""
    return conditional(prefs, alpha).pairs()


def adjusted_cosine(ratings: DataFrame) -> Measure:
    """Cosine of ratings centred by the user's mean, over shared users."""
    require(ratings, "user", "item", "rating")
    means = ratings.groupBy("user").agg(
        (exact_sum(F.col("rating"), 1e6) / F.count(F.lit(1))).alias("mean")
    )

    def score(v, m):
        base = m.sqrt(v["aa"] * v["bb"])
        return m.where(base > 0, v["ab"] / base, m.number(0))

    return Measure(
        ratings.select("user", "item", "rating").join(means, "user"),
        score,
        {
            "ab": (lambda v: (v["rating_a"] - v["mean"]) * (v["rating_b"] - v["mean"]), SCALE),
            "aa": (lambda v: (v["rating_a"] - v["mean"]) * (v["rating_a"] - v["mean"]), SCALE),
            "bb": (lambda v: (v["rating_b"] - v["mean"]) * (v["rating_b"] - v["mean"]), SCALE),
        },
        ("rating",),
        shared=("mean",),
    )


def item_adjusted_cosine(ratings: DataFrame) -> DataFrame:
    return adjusted_cosine(ratings).pairs()


def pearson(ratings: DataFrame, min_overlap: int) -> Measure:
    """Pearson correlation over the users two items share."""
    require(ratings, "user", "item", "rating")

    def score(v, m):
        k = v["k"]
        cov = k * v["sab"] - v["sa"] * v["sb"]
        va = k * v["saa"] - v["sa"] * v["sa"]
        vb = k * v["sbb"] - v["sb"] * v["sb"]
        return m.where((va > 0) & (vb > 0), cov / m.sqrt(va * vb), m.number(0))

    return Measure(
        ratings.select("user", "item", "rating"),
        score,
        {
            "sa": (lambda v: v["rating_a"], 1e6),
            "sb": (lambda v: v["rating_b"], 1e6),
            "saa": (lambda v: v["rating_a"] * v["rating_a"], 1e6),
            "sbb": (lambda v: v["rating_b"] * v["rating_b"], 1e6),
            "sab": (lambda v: v["rating_a"] * v["rating_b"], 1e6),
        },
        ("rating",),
        keep=lambda v: v["k"] >= min_overlap,
    )


def item_pearson(ratings: DataFrame, min_overlap: int) -> DataFrame:
    return pearson(ratings, min_overlap).pairs()


def _swap(table: DataFrame) -> DataFrame:
    value = "weight" if "weight" in table.columns else "rating"
    return table.select(F.col("item").alias("user"), F.col("user").alias("item"), value)


def user_measure(table: DataFrame, method: str, min_overlap: int = 1) -> Measure:
    """The item measures with the roles swapped; popular items are split, not dropped."""
    swapped = _swap(table)
    if method == "cosine":
        return cosine(swapped)
    if method == "weighted":
        return weighted_cosine(swapped)
    if method == "jaccard":
        return jaccard(swapped)
    if method == "adjusted":
        return adjusted_cosine(swapped)
    if method == "pearson":
        return pearson(swapped, min_overlap)
    raise ValueError(f"unknown method: {method}")


def user_similarity(table: DataFrame, method: str, min_overlap: int = 1) -> DataFrame:
    return user_measure(table, method, min_overlap).pairs()


def item_cf(prefs: DataFrame, near: DataFrame, n: int) -> DataFrame:
    """Unseen items by the weighted similarity to what a user owns, best n."""
    require(near, "a", "b", "score")
    prefs = prefs.select("user", "item", "weight")
    near = near.select(F.col("a").alias("item"), "b", F.col("score").alias("sim"))
    kinds = [prefs.schema["item"].dataType, near.schema["b"].dataType]
    if isinstance(prefs.schema["user"].dataType, IntegralType) and isinstance(kinds[0], IntegralType) and kinds[0] == kinds[1]:
        return top_votes(prefs, near, n)
    near = write_stage(near, "near")
    lists = near.groupBy("item").agg(F.collect_list(F.struct("b", "sim")).alias("links"))
    longest = lists.agg(F.max(F.size("links"))).first()[0] or 0
    parts = int(prefs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    parts = max(parts, -(-prefs.count() * longest // _VOTES))
    # A user's lists travel whole and are voted out where the user is, beside what the user has.
    seen = prefs.filter(F.col("user").isNotNull() & F.col("item").isNotNull())
    own = F.array(F.struct(F.col("item").alias("b"), F.lit(None).cast("double").alias("sim")))
    sent = (
        prefs.join(lists, "item")
        .select("user", "weight", "links", F.lit(False).alias("seen"))
        .unionByName(seen.select("user", "weight", own.alias("links"), F.lit(True).alias("seen")))
        .repartition(parts, "user")
    )
    votes = (
        sent.select("user", "weight", "seen", F.inline("links").alias("item", "sim"))
        .groupBy("user", "item")
        .agg(round6(exact_sum(F.col("weight") * F.col("sim"), 1e6)).alias("score"), F.max("seen").alias("seen"))
    )
    return top_n(votes.filter("not seen").drop("seen"), n)


def user_cf(prefs: DataFrame, near: DataFrame, n: int) -> DataFrame:
    """Unseen items by the weighted vote of each user's nearest users, best n.

    With whole numbers as ids the packed histories of the nearest users go beside
    the user, and there are no rows for votes (see ``functions.votes``).
    """
    require(near, "a", "b", "score")
    kinds = [t.dataType for t in (prefs.schema["user"], prefs.schema["item"], near.schema["a"], near.schema["b"])]
    if all(isinstance(t, IntegralType) for t in kinds) and kinds[0] == kinds[2] == kinds[3]:
        owned = prefs.filter(F.col("user").isNotNull())
        histories = owned.select(F.col("user").alias("item"), F.col("item").alias("b"), F.col("weight").alias("sim"))
        asked = near.select(F.col("a").alias("user"), F.col("b").alias("item"), F.col("score").alias("weight"))
        return top_votes(write_stage(asked, "near"), histories, n, seen=owned.select("user", "item"))
    links = near.select(F.col("a"), F.col("b").alias("user"), F.col("score").alias("_sim"))
    votes = (
        prefs.select("user", "item", "weight")
        .join(links, "user")
        .groupBy(F.col("a").alias("user"), "item")
        .agg(round6(exact_sum(F.col("weight") * F.col("_sim"), 1e6)).alias("score"))
    )
    return top_n(drop_seen(votes, prefs), n)


def slope_one_deviations(ratings: DataFrame) -> DataFrame:
    """Mean rating difference b - a over shared users, for a < b, made where the lists of ``a`` meet as in ``cooccur``."""
    require(ratings, "user", "item", "rating")
    rows = ratings.select("user", "item", "rating")
    if isinstance(rows.schema["item"].dataType, IntegralType):
        value = F.col("rating").cast("double")
        wrong = F.raise_error(F.lit("a rating is not a number")).cast("double")
        met = top_pairs(
            rows.withColumn("rating", F.when(F.isnan(value), wrong).otherwise(value)),
            "user",
            "item",
            None,
            lambda v, m: v["d"] / v["k"],
            {"d": (lambda v: v["rating_b"] - v["rating_a"], 1e6)},
            ("rating",),
            half=True,
        )
        return met.select("a", "b", "k", F.col("score").alias("dev"))
    return pair_stats(
        rows,
        "user",
        "item",
        [_shared(), exact_sum(F.col("rating_b") - F.col("rating_a"), 1e6).alias("d")],
        ["rating"],
    ).select("a", "b", "k", round6(F.col("d") / F.col("k")).alias("dev"))


@dataclass(frozen=True)
class Deviations:
    """Mean rating differences that are counted where predictions need them (see ``functions.slope``)."""

    ratings: DataFrame

    def pairs(self) -> DataFrame:
        return slope_one_deviations(self.ratings)


def deviations(ratings: DataFrame) -> Deviations:
    """The deviations of ``slope_one_deviations``, which ``slope_one`` then needs no table of."""
    require(ratings, "user", "item", "rating")
    return Deviations(ratings)


def _in_parts(ratings: DataFrame, deviations: DataFrame | Deviations) -> bool:
    return (
        isinstance(deviations, Deviations)
        and deviations.ratings is ratings
        and isinstance(ratings.schema["item"].dataType, IntegralType)
    )


def slope_one(ratings: DataFrame, targets: DataFrame, deviations: DataFrame | Deviations) -> DataFrame:
    """Weighted slope-one prediction for the (user, item) targets.

    With ``deviations(ratings)`` there are no rows for pairs of items or for the
    terms of a prediction.
    """
    if _in_parts(ratings, deviations):
        return predictions(ratings, targets)
    if isinstance(deviations, Deviations):
        deviations = deviations.pairs()
    pair = F.array(
        F.struct(F.col("a").alias("owned"), F.col("b").alias("item"), F.col("dev").alias("dev"), "k"),
        F.struct(F.col("b").alias("owned"), F.col("a").alias("item"), (-F.col("dev")).alias("dev"), "k"),
    )
    directed = deviations.select(F.inline(pair))
    owned = ratings.select("user", F.col("item").alias("owned"), "rating")
    known = targets.select("user", "item").join(owned, "user")
    terms = known.join(directed, ["owned", "item"])
    top = exact_sum(F.col("k") * (F.col("rating") + F.col("dev")), 1e6)
    return terms.groupBy("user", "item").agg(round6(top / F.sum("k")).alias("predicted"))


def slope_one_top(ratings: DataFrame, candidates: DataFrame, deviations: DataFrame | Deviations, n: int) -> DataFrame:
    """The n candidates a user has not rated with the best slope-one prediction; candidates are (user, item) or (user, items)."""
    if _in_parts(ratings, deviations):
        return top_n(predictions(ratings, candidates, fresh=True).withColumnRenamed("predicted", "score"), n)
    if "item" not in candidates.columns:
        candidates = candidates.select("user", F.explode("items").alias("item"))
    fresh = drop_seen(candidates.select("user", "item").distinct(), ratings)
    predicted = slope_one(ratings, fresh, deviations).withColumnRenamed("predicted", "score")
    return top_n(predicted, n)


#: How many rare users two items must share before they are compared.
_DEEP = 2


def _classes(owned: DataFrame, *more: Column) -> tuple[DataFrame, DataFrame]:
    """(item, n, ...) of one item per set of owners, and (id, rep) of all items.

    Items with the same owners are one class (see ``functions.copies``); two
    sums of hashes and the size stand for the set.
    """
    sketches = owned.groupBy("item").agg(
        F.count(F.lit(1)).alias("n"),
        F.sum(F.xxhash64("user").cast("decimal(20,0)")).alias("_sig"),
        F.sum(F.xxhash64(F.lit(-1), "user").cast("decimal(20,0)")).alias("_sig2"),
        *more,
    )
    sketches = write_stage(sketches, "sketches")
    members = write_stage(members_of(sketches, "item", ["n", "_sig", "_sig2"]), "classes")
    first = members.filter(F.col("id") == F.col("rep")).select(F.col("id").alias("item"))
    return sketches.join(first, "item", "left_semi").drop("_sig", "_sig2"), members


def _least_shared(bar: float, size: Column, other: Column | None = None) -> Column:
    """Users two sets of these sizes must share to reach the bar; with one size, that set and any other."""
    # Scores are rounded, so the bar is taken a little lower.
    low = max(bar - 1e-6, 0.0)
    part = low * size if other is None else low / (1 + low) * (size + other)
    return F.greatest(F.ceil(part - F.lit(1e-9)), F.lit(1)).cast("bigint")


def rare_owners(sized: DataFrame, bar: float, deep: int = _DEEP) -> DataFrame:
    """(user, item, n, whole): of every item the owners by which it can be found.

    ``sized`` is (user, item, n). Owners are ordered by how few items they have.
    Two sets that reach the bar share at least ``least`` users; leaving all but
    ``deep`` of these out at the frequent end of both, ``deep`` shared users are
    left. Users with the longest histories, whose pairs are most, thus drop out.
    ``whole`` marks items of which no owner is left out.
    """
    least = _least_shared(bar, F.col("n"))
    kept = F.col("n") - least + F.least(F.lit(deep), least)
    sized = sized.withColumn("_kept", kept)
    whole = sized.filter(F.col("_kept") >= F.col("n")).select("user", "item", "n", F.lit(True).alias("whole"))
    breadth = sized.groupBy("user").agg(F.count(F.lit(1)).alias("_breadth"))
    cut = sized.filter(F.col("_kept") < F.col("n")).join(breadth, "user")
    ranked = OrderedSplit(cut, ["item"], ["_breadth", "user"]).row_number("_at").result()
    heads = ranked.filter(F.col("_at") <= F.col("_kept")).select("user", "item", "n", F.lit(False).alias("whole"))
    return whole.unionByName(heads)


def similar_sets(sized: DataFrame, bar: float, deep: int = _DEEP) -> DataFrame:
    """(a, b, k, n_a, n_b): all pairs of items whose Jaccard reaches the bar, each once, exactly.

    A join of an inverted index in packed lists: items meet in the owners ``rare_owners`` leaves,
    if their sizes allow the bar. Pairs of whole items are then counted; of the
    others those with ``deep`` shared rare owners are candidates, and only for
    these all owners of the smaller item are looked up in the other.
    """
    heads = rare_owners(sized, bar, deep)
    low = max(bar - 1e-6, 0.0)
    if isinstance(sized.schema["item"].dataType, IntegralType):
        sizes = sized.groupBy("item").agg(F.max("n").alias("n"))
        return _checked(_candidates(heads, sizes, low, deep), sized, bar)
    smaller = (F.col("n_a") < F.col("n_b")) | ((F.col("n_a") == F.col("n_b")) & (F.col("a") < F.col("b")))
    met = directed_pairs(heads, "user", "item", ["n", "whole"]).filter(
        smaller & (F.col("n_a") >= F.lit(low) * F.col("n_b"))
    )
    counted = met.groupBy("a", "part", "b", "n_a", "n_b", "whole_a", "whole_b").agg(_shared())
    need = _least_shared(bar, F.col("n_a"), F.col("n_b"))
    known = F.col("whole_a") & F.col("whole_b")
    # Items that are no whole numbers have their pairs in rows.
    enough = F.when(known, need).otherwise(F.least(F.lit(deep), need))
    return _checked(counted.filter(F.col("k") >= enough).select("a", "b", "k", "n_a", "n_b", known.alias("known")), sized, bar)


def _candidates(heads: DataFrame, sizes: DataFrame, low: float, deep: int) -> DataFrame:
    """The candidates (a, b, k, n_a, n_b, known) of ``similar_sets`` with a the smaller one, made where half lists meet, without rows for the other pairs."""

    def enough(v):
        need = np.maximum(np.ceil(low / (1 + low) * (v["n_a"] + v["n_b"]) - 1e-9), 1)
        known = (v["whole_a"] > 0) & (v["whole_b"] > 0)
        sized_alike = np.minimum(v["n_a"], v["n_b"]) >= low * np.maximum(v["n_a"], v["n_b"])
        return sized_alike & (v["k"] >= np.where(known, need, np.minimum(deep, need)))

    def known(v, m):
        return v["whole_a"] * v["whole_b"]

    rows = heads.select("user", "item", "n", F.col("whole").cast("int").alias("whole"))
    met = top_pairs(rows, "user", "item", None, known, fixed=("n", "whole"), keep=enough, half=True)
    met = met.join(sizes.toDF("a", "_n"), "a").join(sizes.toDF("b", "_m"), "b")
    turned = F.col("_n") > F.col("_m")
    sides = [F.when(turned, F.col(y)).otherwise(F.col(x)) for x, y in (("a", "b"), ("b", "a"), ("_n", "_m"), ("_m", "_n"))]
    a, b, n_a, n_b = (c.alias(n) for c, n in zip(sides, ("a", "b", "n_a", "n_b")))
    return met.select(a, b, "k", n_a, n_b, (F.col("score") > 0).alias("known"))


def _checked(found: DataFrame, sized: DataFrame, bar: float) -> DataFrame:
    """Of the candidates those that reach the bar; where owners were left out, all are counted."""
    found = write_stage(found, "candidates")
    need = _least_shared(bar, F.col("n_a"), F.col("n_b"))
    of_a = sized.select(F.col("item").alias("a"), "user")
    of_b = sized.select(F.col("item").alias("b"), "user")
    checked = (
        found.filter("not known")
        .drop("k")
        .join(of_a, "a")
        .join(of_b, ["b", "user"])
        .groupBy("a", "b", "n_a", "n_b")
        .agg(_shared())
    )
    return (
        found.filter("known")
        .select("a", "b", "k", "n_a", "n_b")
        .unionByName(checked.select("a", "b", "k", "n_a", "n_b"))
        .filter(F.col("k") >= need)
    )


def _listed(shared: DataFrame, members: DataFrame, threshold: float, k: int) -> DataFrame:
    """The k best of each item from (a, b, k, n_a, n_b) between representatives."""
    score = round6(F.col("k") / (F.col("n_a") + F.col("n_b") - F.col("k")))
    scored = shared.select("a", "b", score.alias("score")).filter(F.col("score") >= threshold)
    near = top_per(mirrored(scored, both=["score"]), ["a"], [F.desc("score"), F.asc("b")], k)
    return hand_out(near, members, k, F.lit(1.0))


def jaccard_join(prefs: DataFrame, bar: float, k: int, deep: int = _DEEP) -> DataFrame:
    """(id, b, score, rank): the k nearest items with Jaccard at least ``bar``, exactly (see ``similar_sets``)."""
    require(prefs, "user", "item")
    owned = write_stage(prefs.select("user", "item"), "owned")
    reps, members = _classes(owned)
    sized = write_stage(owned.join(reps, "item"), "sized")
    return _listed(similar_sets(sized, bar, deep), members, bar, k)


def minhash_neighbours(prefs: DataFrame, tables: int, threshold: float, k: int) -> DataFrame:
    """The k nearest items found by min-hashing, with Jaccard at least ``threshold``.

    Two items are candidates when one of ``tables`` min-hashes of their owners
    agrees; every candidate's Jaccard is then counted exactly. Signatures are
    plain ``min`` aggregates, so no owner list is gathered, and items with the
    same owners are one class.

    A pair at the bar is met with chance 1 - (1 - threshold)^tables. Where that
    is under 0.9, hashing would lose too many pairs, so the pairs come from the
    exact join ``similar_sets`` instead.
    """
    require(prefs, "user", "item")
    if 1 - (1 - threshold) ** tables < _MET:
        return jaccard_join(prefs, threshold, k)
    owned = write_stage(prefs.select("user", "item"), "owned")
    mins = [F.min(F.xxhash64(F.lit(t), "user")) for t in range(tables)]
    reps, members = _classes(owned, F.array(*mins).alias("sketch"))
    spots = reps.select("item", F.posexplode("sketch").alias("t", "h")).select(
        F.xxhash64("t", "h").alias("bucket"), "item"
    )
    candidates = shared_pairs(spots.distinct(), "bucket", "item").select("a", "b").distinct()
    of_a = owned.select(F.col("item").alias("a"), "user")
    of_b = owned.select(F.col("item").alias("b"), "user")
    shared = candidates.join(of_a, "a").join(of_b, ["b", "user"]).groupBy("a", "b").agg(_shared())
    sizes = reps.select("item", "n")
    sized = shared.join(sizes.toDF("a", "n_a"), "a").join(sizes.toDF("b", "n_b"), "b")
    return _listed(sized, members, threshold, k)


# Tasks get the scores by value, so workers need not have the package installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
