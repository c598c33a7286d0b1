"""Pairs of members that share a group, counted without one task owning a group."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tastemill.session import write_stage

CELL = 2048


def _cells(rows: DataFrame, group: str, member: str, cell: int) -> DataFrame:
    """Tag each row with its chunk of the group; only groups above ``cell`` rows have several."""
    large = (
        rows.groupBy(group)
        .agg(F.count(F.lit(1)).alias("_size"))
        .filter(F.col("_size") > cell)
        .select(group, F.ceil(F.col("_size") / F.lit(cell)).cast("int").alias("_chunks"))
    )
    chunks = F.coalesce(F.col("_chunks"), F.lit(1))
    return (
        rows.join(large, group, "left")
        .withColumn("_chunks", chunks)
        .withColumn("_chunk", F.pmod(F.xxhash64(member), F.col("_chunks")).cast("int"))
    )


def shared_pairs(
    rows: DataFrame, group: str, member: str, values: Sequence[str] = (), cell: int = CELL
) -> DataFrame:
    """One row per unordered pair ``a < b`` and shared group, with ``<v>_a`` / ``<v>_b`` values.

    ``rows`` must be unique in (group, member). A group larger than ``cell`` is
    cut into chunks by a hash of the member, and chunk i meets chunk j in the
    join cell (i, j). A group holding a third of all rows is then spread over
    many equally small cells; every pair still meets in exactly one of them.

    The rows are read three times (sizes, left, right), so they are written
    once first: next to the pairs they are few, and their own scans, joins and
    aggregates are not repeated.
    """
    rows = write_stage(rows.select(group, member, *values), "members")
    tagged = _cells(rows, group, member, cell)
    left = tagged.select(
        F.col(group),
        F.col("_chunk").alias("_i"),
        F.explode(F.sequence("_chunk", F.col("_chunks") - 1)).alias("_j"),
        F.col(member).alias("_x"),
        *[F.col(v).alias(f"_x_{v}") for v in values],
    )
    right = tagged.select(
        F.col(group),
        F.explode(F.sequence(F.lit(0), F.col("_chunk"))).alias("_i"),
        F.col("_chunk").alias("_j"),
        F.col(member).alias("_y"),
        *[F.col(v).alias(f"_y_{v}") for v in values],
    )
    # The output is far larger than the input, so the input keeps its full partition
    # count here: left to itself, Spark would merge these small partitions into a few.
    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    cell_key = [group, "_i", "_j"]
    joined = (
        left.repartition(parts, *cell_key)
        .join(right.repartition(parts, *cell_key), cell_key)
        .filter((F.col("_i") < F.col("_j")) | (F.col("_x") < F.col("_y")))
    )
    in_order = F.col("_x") < F.col("_y")
    picked: list[Column] = [
        F.col(group),
        F.least("_x", "_y").alias("a"),
        F.greatest("_x", "_y").alias("b"),
    ]
    for v in values:
        first, second = F.col(f"_x_{v}"), F.col(f"_y_{v}")
        picked.append(F.when(in_order, first).otherwise(second).alias(f"{v}_a"))
        picked.append(F.when(in_order, second).otherwise(first).alias(f"{v}_b"))
    return joined.select(*picked)


def pairs_between(left: DataFrame, right: DataFrame, group: str, member: str, cell: int = CELL) -> DataFrame:
    """One row (group, a, b) for each member ``a`` of ``left`` and ``b`` of ``right`` that share a group.

    Both must be unique in (group, member). As in ``shared_pairs`` either side
    of a group above ``cell`` rows is cut into chunks, and each chunk of the one
    meets each chunk of the other in a join cell of its own.
    """
    x, y = _cells(left.select(group, member), group, member, cell), _cells(right.select(group, member), group, member, cell)

    def facing(rows: DataFrame, others: DataFrame, own: str, other: str, name: str) -> DataFrame:
        many = others.filter(F.col("_chunks") > 1).select(group, F.col("_chunks").alias("_facing")).distinct()
        last = F.coalesce(F.col("_facing"), F.lit(1)) - 1
        return rows.join(many, group, "left").select(
            group,
            F.col("_chunk").alias(own),
            F.explode(F.sequence(F.lit(0), last)).alias(other),
            F.col(member).alias(name),
        )

    return facing(x, y, "_i", "_j", "a").join(facing(y, x, "_j", "_i", "b"), [group, "_i", "_j"]).select(group, "a", "b")


def _halves(rows: DataFrame, group: str, member: str, values: Sequence[str], cell: int) -> DataFrame:
    """(list_x, list_y): for each join cell of a group the members of its two chunks, at most ``cell`` a list or so."""
    tagged = _cells(rows, group, member, cell)
    one = F.struct(F.col(member).alias("m"), F.col("_salts"), *[F.col(v).alias(f"v_{v}") for v in values])
    lists = tagged.groupBy(group, "_chunk", "_chunks").agg(F.collect_list(one).alias("list"))
    others = F.sequence(F.lit(0), F.col("_chunks") - 1)
    left = lists.select(group, F.col("_chunk").alias("_i"), F.explode(others).alias("_j"), F.col("list").alias("list_x"))
    right = lists.select(group, F.explode(others).alias("_i"), F.col("_chunk").alias("_j"), F.col("list").alias("list_y"))
    return left.join(right, [group, "_i", "_j"]).select("list_x", "list_y")


def directed_pairs(
    rows: DataFrame, group: str, member: str, values: Sequence[str] = (), cell: int = CELL
) -> DataFrame:
    """One row per ordered pair ``a <> b`` and shared group, all rows of (a, part, b) in one task.

    ``rows`` must be unique in (group, member). What is shuffled are lists of
    members, one for each member and chunk of a group it is in; pairs are made
    after that, so whatever is added up by (a, part, b) needs no further shuffle.
    Groups are cut as in ``shared_pairs``. A member of more than ``cell`` groups
    has several parts, by a hash of the other member, so it is no task's alone.
    """
    rows = write_stage(rows.select(group, member, *values), "members")
    heavy = (
        rows.groupBy(member)
        .agg(F.count(F.lit(1)).alias("_in"))
        .filter(F.col("_in") > cell)
        .select(member, F.ceil(F.col("_in") / F.lit(cell)).cast("int").alias("_salts"))
    )
    rows = rows.join(heavy, member, "left").withColumn("_salts", F.coalesce("_salts", F.lit(1)))
    halves = _halves(rows, group, member, values, cell)
    firsts = halves.select(F.inline("list_x").alias("a", "_salts", *[f"{v}_a" for v in values]), "list_y")
    parted = firsts.withColumn("part", F.explode(F.sequence(F.lit(0), F.col("_salts") - 1)))
    own = F.filter("list_y", lambda y: F.pmod(F.xxhash64(y["m"]), F.col("_salts")) == F.col("part"))
    mine = F.when(F.col("_salts") == 1, F.col("list_y")).otherwise(own)
    # Fields travel as arrays of their own, which are half as long as an array of structs.
    columns = [mine["m"].alias("b"), *[mine[f"v_{v}"].alias(f"{v}_b") for v in values]]
    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    kept = ["a", "part", *[f"{v}_a" for v in values]]
    sent = parted.select(*kept, *columns).repartition(parts, "a", "part")
    zipped = F.arrays_zip("b", *[f"{v}_b" for v in values])
    return sent.select(*kept, F.inline(zipped)).filter("a <> b")


def directed_stats(
    rows: DataFrame,
    group: str,
    member: str,
    aggregates: Sequence[Column],
    values: Sequence[str] = (),
    fixed: Sequence[str] = (),
    cell: int = CELL,
) -> DataFrame:
    """``directed_pairs`` folded to one row per ordered pair; ``fixed`` values belong to the member alone."""
    pairs = directed_pairs(rows, group, member, [*values, *fixed], cell)
    own = [f"{v}_{side}" for side in "ab" for v in fixed]
    return pairs.groupBy("a", "part", "b", *own).agg(*aggregates).drop("part")


def pair_stats(
    rows: DataFrame,
    group: str,
    member: str,
    aggregates: Sequence[Column],
    values: Sequence[str] = (),
    cell: int = CELL,
) -> DataFrame:
    """``shared_pairs`` folded to one row per pair; partial sums are made before the shuffle."""
    return shared_pairs(rows, group, member, values, cell).groupBy("a", "b").agg(*aggregates)


def mirrored(pairs: DataFrame, both: Sequence[str] = (), sided: Sequence[str] = ()) -> DataFrame:
    """Each unordered pair as two directed rows, in one pass over the pairs.

    ``both`` columns are copied; ``sided`` names v stand for ``v_a``/``v_b``, which are swapped.
    """

    def side(a: str, b: str) -> Column:
        fields = [F.col(a).alias("a"), F.col(b).alias("b")]
        fields += [F.col(c).alias(c) for c in both]
        for v in sided:
            fields += [F.col(f"{v}_{a}").alias(f"{v}_a"), F.col(f"{v}_{b}").alias(f"{v}_b")]
        return F.struct(*fields)

    return pairs.select(F.inline(F.array(side("a", "b"), side("b", "a"))))
