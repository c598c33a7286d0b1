"""Input tables, the model tables derived from them, and output tables."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tastemill.functions.exact import require

# Weight of each listed event type.
EVENT_WEIGHTS = {"view": 1.0, "click": 2.0, "purchase": 5.0}


def read_table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder.rstrip('/')}/{name}.parquet")


def purchases(lineitem: DataFrame, orders: DataFrame) -> DataFrame:
    """Interactions (user, item, ts, weight) plus the order key as ``basket``."""
    require(lineitem, "l_orderkey", "l_partkey", "l_quantity")
    require(orders, "o_orderkey", "o_custkey", "o_orderdate")
    lines = lineitem.select(
        F.col("l_orderkey").alias("basket"),
        F.col("l_partkey").alias("item"),
        F.col("l_quantity").alias("weight"),
    )
    heads = orders.select(
        F.col("o_orderkey").alias("basket"),
        F.col("o_custkey").alias("user"),
        F.col("o_orderdate").alias("ts"),
    )
    return lines.join(heads, "basket").select("user", "item", "ts", "weight", "basket")


def event_interactions(events: DataFrame, weights: Mapping[str, float] = EVENT_WEIGHTS) -> DataFrame:
    """Listed event types as interactions; the item is ``props.k``."""
    require(events, "event_id", "user_id", "event_type", "ts", "props")
    weight = F.lit(None).cast("double")
    for kind, value in weights.items():
        weight = F.when(F.col("event_type") == kind, F.lit(float(value))).otherwise(weight)
    return events.filter(F.col("event_type").isin(list(weights))).select(
        F.col("user_id").alias("user"),
        F.get_json_object("props", "$.k").cast("bigint").alias("item"),
        "ts",
        weight.alias("weight"),
        "event_id",
    )


def derived_ratings(prefs: DataFrame) -> DataFrame:
    """Synthetic 1-5 ratings from summed weight, since no table carries real ones."""
    require(prefs, "user", "item", "weight")
    rating = F.least(F.lit(5.0), 1.0 + F.floor(F.col("weight") / 11.0))
    return prefs.select("user", "item", rating.cast("double").alias("rating"))


def item_attributes(part: DataFrame) -> DataFrame:
    return part.select(
        F.col("p_partkey").alias("item"),
        "p_brand",
        "p_type",
        F.floor(F.col("p_size") / 10).cast("int").alias("size_band"),
        "p_retailprice",
    )


def item_vectors(embeddings: DataFrame) -> DataFrame:
    return embeddings.select(F.col("vec_id").alias("id"), F.col("embedding").alias("vec"))


def write_recs(recs: DataFrame, path: str, buckets: int) -> None:
    """Recommendation lists as parquet, one folder per user bucket.

    All rows of a user land in one folder. A folder is written by a few tasks:
    the shuffle partitions are shared out over the buckets, by a second hash of
    the user, so more users mean neither longer tasks nor a file from every task.
    """
    require(recs, "user", "item", "score", "rank")
    bucket = F.pmod(F.xxhash64("user"), F.lit(buckets)).cast("int")
    parts = max(buckets, int(recs.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    share = F.pmod(F.xxhash64(F.lit("share"), "user"), F.lit(-(-parts // buckets)))
    (
        recs.withColumn("bucket", bucket)
        .repartition(parts, "bucket", share)
        .sortWithinPartitions("bucket", "user", "rank")
        .write.mode("overwrite")
        .partitionBy("bucket")
        .parquet(path)
    )


def save_recs_table(recs: DataFrame, table: str, buckets: int, path: str | None = None) -> None:
    """The same lists as a bucketed table, so joins on ``user`` need no shuffle.

    With ``path`` the files lie there and the table is only their entry in the catalogue.
    """
    require(recs, "user", "item", "score", "rank")
    writer = (
        recs.repartition(buckets, "user")
        .write.mode("overwrite")
        .bucketBy(buckets, "user")
        .sortBy("user", "rank")
    )
    if path is not None:
        writer = writer.option("path", path)
    writer.saveAsTable(table)


def join_saved(saved: DataFrame, other: DataFrame, buckets: int) -> DataFrame:
    """``saved``, a table of ``save_recs_table``, with the rows of ``other`` of the same user.

    The other side is brought into the buckets of the table, whose rows stay where they are.
    """
    return saved.join(other.repartition(buckets, "user"), "user")


def read_recs(spark: SparkSession, path: str, user_bucket: int | None = None) -> DataFrame:
    """Read lists back; a bucket filter prunes the other folders."""
    recs = spark.read.parquet(path)
    if user_bucket is not None:
        recs = recs.filter(F.col("bucket") == user_bucket)
    return recs.select("user", "item", "score", "rank")
