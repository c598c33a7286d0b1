"""Features for ranking and the ranking models."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import (
    FMClassifier,
    GBTClassificationModel,
    GBTClassifier,
    LogisticRegression,
    RandomForestClassificationModel,
    RandomForestClassifier,
)
from pyspark.ml.feature import FeatureHasher, MinMaxScaler, OneHotEncoder, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import FMRegressor
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tastemill.functions.exact import exact_sum, hash_int, require, round6
from tastemill.functions.ordered import OrderedSplit
from tastemill.sources.tables import EVENT_WEIGHTS


def _activity(lines: DataFrame, key: str, other: str, as_of: str) -> DataFrame:
    spend = F.col("price") * (1.0 - F.col("discount"))
    return (
        lines.groupBy(key)
        .agg(
            F.datediff(F.lit(as_of).cast("date"), F.max("ts")).cast("bigint").alias("recency"),
            F.countDistinct("basket").alias("frequency"),
            exact_sum(spend, 1e4).alias("spend"),
            F.countDistinct(other).alias("breadth"),
            round6(F.count_if(F.col("flag") == "R") / F.count(F.lit(1))).alias("return_rate"),
        )
    )


def purchase_lines(lineitem: DataFrame, orders: DataFrame) -> DataFrame:
    """Purchase rows with price, discount and return flag."""
    lines = lineitem.select(
        F.col("l_orderkey").alias("basket"),
        F.col("l_partkey").alias("item"),
        F.col("l_extendedprice").alias("price"),
        F.col("l_discount").alias("discount"),
        F.col("l_returnflag").alias("flag"),
    )
    heads = orders.select(
        F.col("o_orderkey").alias("basket"), F.col("o_custkey").alias("user"), F.col("o_orderdate").alias("ts")
    )
    return lines.join(heads, "basket")


def user_features(lines: DataFrame, as_of: str) -> DataFrame:
    """Recency, frequency, spend, breadth and return rate per user."""
    return _activity(lines, "user", "item", as_of)


def item_features(lines: DataFrame, as_of: str) -> DataFrame:
    """The same per item; breadth is the number of users."""
    return _activity(lines, "item", "user", as_of)


def point_in_time(examples: DataFrame, events: DataFrame, horizon_seconds: int) -> DataFrame:
    """(example_id, seen): the user's events in [t - horizon, t), nothing at or after t.

    Events and two markers per example (its start and its end) go through one
    running count per user, split over tasks. The count at the end marker minus
    the one at the start marker is the answer, so no range frame has to hold a
    hot user's rows in memory.
    """
    require(examples, "example_id", "user", "ts")
    require(events, "user", "ts", "event_id")
    micros = F.unix_micros(F.col("ts").cast("timestamp"))
    # At equal times a marker sorts before the events, which makes both ends exact.
    marks = examples.select(
        "user",
        F.inline(
            F.array(
                F.struct(micros.alias("us"), F.lit(0).alias("kind"), F.lit(1).alias("sign")),
                F.struct(
                    (micros - horizon_seconds * 1_000_000).alias("us"),
                    F.lit(1).alias("kind"),
                    F.lit(-1).alias("sign"),
                ),
            )
        ),
        F.col("example_id").alias("id"),
    )
    rows = events.select(
        "user",
        micros.alias("us"),
        F.lit(2).alias("kind"),
        F.lit(0).alias("sign"),
        F.col("event_id").alias("id"),
    )
    scan = OrderedSplit(marks.select(*rows.columns).unionByName(rows), ["user"], ["us", "kind", "id"])
    scan.running_sum(F.when(F.col("kind") == 2, 1).otherwise(0).cast("bigint"), "_count")
    return (
        scan.result()
        .filter(F.col("kind") < 2)
        .groupBy(F.col("id").alias("example_id"))
        .agg(F.sum(F.col("sign") * F.col("_count")).alias("seen"))
    )


def target_encode(examples: DataFrame, column: str, m: float, folds: int) -> DataFrame:
    """Smoothed mean label of the category, from the other folds only."""
    require(examples, "example_id", column, "label")
    rows = examples.withColumn("_fold", F.pmod(hash_int(F.col("example_id")), F.lit(folds)))
    per_fold = rows.groupBy(column, "_fold").agg(
        F.count(F.lit(1)).alias("_n"), exact_sum(F.col("label"), 1e6).alias("_s")
    )
    totals = per_fold.groupBy(column).agg(
        F.sum("_n").alias("_tn"), exact_sum(F.col("_s"), 1e6).alias("_ts")
    )
    prior = examples.agg((exact_sum(F.col("label"), 1e6) / F.count(F.lit(1))).alias("p")).scalar()
    rest_n = F.col("_tn") - F.col("_n")
    rest_s = F.col("_ts") - F.col("_s")
    encoded = (
        per_fold.join(totals, column)
        .withColumn("_p", prior)
        .select(
            column, "_fold", round6((rest_s + m * F.col("_p")) / (rest_n + m)).alias("encoded")
        )
    )
    return rows.join(encoded, [column, "_fold"]).drop("_fold")


def examples_from_events(events: DataFrame) -> DataFrame:
    """Listed events as examples: label 1 for a purchase, with item, hour and value."""
    return events.filter(F.col("event_type").isin(list(EVENT_WEIGHTS))).select(
        F.col("event_id").alias("example_id"),
        F.col("user_id").alias("user"),
        "ts",
        F.get_json_object("props", "$.k").cast("bigint").alias("item"),
        F.hour("ts").alias("hour"),
        "value",
        F.when(F.col("event_type") == "purchase", 1.0).otherwise(0.0).alias("label"),
    )


def hash_features(
    examples: DataFrame, columns: Sequence[str], crosses: Sequence[Sequence[str]], dim: int
) -> DataFrame:
    """Columns and their crosses hashed into one sparse vector ``features``."""
    rows, names = examples, []
    for c in columns:
        rows = rows.withColumn(f"_h_{c}", F.col(c).cast("string"))
        names.append(f"_h_{c}")
    for cross in crosses:
        name = "_x_" + "_".join(cross)
        rows = rows.withColumn(name, F.concat_ws("|", *[F.col(c).cast("string") for c in cross]))
        names.append(name)
    hasher = FeatureHasher(inputCols=names, outputCol="features", numFeatures=dim)
    return hasher.transform(rows).drop(*names)


def hashed_rows(
    examples: DataFrame, columns: Sequence[str], crosses: Sequence[Sequence[str]], dim: int
) -> DataFrame:
    """The same idea as long rows (example_id, idx, value), with a hash any engine can repeat.

    A value above 1 shows features of one example that fell into the same place. Nulls are left out.
    """
    require(examples, "example_id")
    places = []
    for names in [[c] for c in columns] + [list(x) for x in crosses]:
        present = F.lit(True)
        for c in names:
            present = present & F.col(c).isNotNull()
        place = F.pmod(hash_int(F.lit("_".join(names)), *[F.col(c) for c in names]), F.lit(dim))
        places.append(F.when(present, place))
    rows = examples.select("example_id", F.explode(F.array_compact(F.array(*places))).alias("idx"))
    return rows.groupBy("example_id", "idx").agg(F.count(F.lit(1)).cast("double").alias("value"))


def assemble(examples: DataFrame, columns: Sequence[str]) -> DataFrame:
    return VectorAssembler(inputCols=list(columns), outputCol="features").transform(examples)


def logistic_ctr(examples: DataFrame, reg: float = 0.01) -> LogisticRegression:
    return LogisticRegression(regParam=reg, maxIter=30).fit(examples)


def factorisation_machine(examples: DataFrame, rank: int, seed: int, regress: bool = False):
    """Classifier on 0/1 labels, or regressor on any label; dense inputs are scaled to [0, 1]."""
    kind = FMRegressor if regress else FMClassifier
    scale = MinMaxScaler(inputCol="features", outputCol="scaled")
    machine = kind(featuresCol="scaled", factorSize=rank, seed=seed, maxIter=30, stepSize=0.05)
    return Pipeline(stages=[scale, machine]).fit(examples)


def forest_ranker(examples: DataFrame, seed: int) -> RandomForestClassificationModel:
    return RandomForestClassifier(numTrees=10, maxDepth=5, seed=seed).fit(examples)


def boosted_ranker(examples: DataFrame, seed: int) -> GBTClassificationModel:
    return GBTClassifier(maxIter=5, maxDepth=3, seed=seed).fit(examples)


class GbtLr:
    """Boosted trees whose leaves are the inputs of a logistic regression."""

    def __init__(self, trees, encoder: PipelineModel):
        self.trees = trees
        self.encoder = encoder

    @staticmethod
    def leaves(trees, examples: DataFrame) -> DataFrame:
        found = trees.setLeafCol("leaf").transform(examples)
        found = found.drop("rawPrediction", "probability", "prediction")
        cells = vector_to_array("leaf")
        names = [f"leaf_{i}" for i in range(trees.getNumTrees)]
        return found.select("*", *[cells[i].alias(name) for i, name in enumerate(names)]).drop("leaf")

    def transform(self, examples: DataFrame) -> DataFrame:
        return self.encoder.transform(self.leaves(self.trees, examples))


def gbt_plus_lr(examples: DataFrame, seed: int) -> GbtLr:
    trees = GBTClassifier(maxIter=5, maxDepth=3, seed=seed).fit(examples)
    names = [f"leaf_{i}" for i in range(trees.getNumTrees)]
    hot = [f"hot_{i}" for i in range(trees.getNumTrees)]
    stages = [
        OneHotEncoder(inputCols=names, outputCols=hot, handleInvalid="keep"),
        VectorAssembler(inputCols=hot, outputCol="leaf_features"),
        LogisticRegression(featuresCol="leaf_features", regParam=0.01, maxIter=30),
    ]
    return GbtLr(trees, Pipeline(stages=stages).fit(GbtLr.leaves(trees, examples)))


def scored(model, examples: DataFrame) -> DataFrame:
    """(example_id, label, score) with the probability of label 1."""
    return model.transform(examples).select(
        "example_id", "label", vector_to_array("probability")[1].alias("score")
    )


def calibration(scores: DataFrame, bins: int, equal_size: bool = False) -> DataFrame:
    """Mean score against mean label per bin of equal width or equal size."""
    require(scores, "example_id", "label", "score")
    if equal_size:
        scan = OrderedSplit(scores, [], ["score", "example_id"]).row_number("_n")
        scan.key_total(F.lit(1).cast("bigint"), "_of")
        spot, size = F.col("_n") - 1, F.floor(F.col("_of") / bins)
        extra = F.col("_of") % bins
        edge = extra * (size + 1)
        late = extra + F.floor((spot - edge) / F.greatest(size, F.lit(1)))
        bin_no = F.when(spot < edge, F.floor(spot / (size + 1))).otherwise(late)
        rows = scan.result()
    else:
        bin_no = F.least(F.floor(F.col("score") * bins), F.lit(bins - 1))
        rows = scores
    return rows.groupBy(bin_no.cast("bigint").alias("bin")).agg(
        F.count(F.lit(1)).alias("n"),
        round6(exact_sum(F.col("score")) / F.count(F.lit(1))).alias("mean_score"),
        round6(exact_sum(F.col("label"), 1e6) / F.count(F.lit(1))).alias("mean_label"),
    )
