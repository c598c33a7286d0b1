"""Exact copies by deterministic block naming, in DataFrame operations only.

Each text is cut into blocks of a fixed number of bytes. Equal blocks get one
integer name; then adjacent names are paired and the pairs are named, level by
level, until every document has one name. Two texts have the same name if and
only if they are identical: a name is the rank of a block among all different
blocks, sorted by hash and then bytes, or of a pair among all different pairs, so
different blocks cannot share one, and names are the same however the table is
partitioned.

- A block that occurs once needs no name of its own: its document is unlike all
  others, gets a negative name from its row number and leaves the naming.
- Blocks are shuffled once, merged before they leave a task, so a block that a
  third of all rows hold is one row per task. Rows look their names up by a
  64-bit hash of the block, which is first checked to tell all blocks of the
  corpus apart; blocks whose hashes collide are looked up by their bytes.
- Hot names in the lookups are plain equi-joins of written tables, which
  adaptive execution splits.

Defined results: null text is the empty text (equal to it); repeated rows and
equal doc_ids give one kept row, the one with the largest doc_id, then the
later row; a null doc_id is smaller than any other; empty tables give empty
results.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tastemill.functions.ordered import OrderedSplit
from tastemill.llm.common import identified, text_or_empty, unused
from tastemill.session import write_stage

#: Bytes in a block.
BLOCK = 4096
#: A name is a rank times LEVELS plus the level it was given at, so names of two levels differ.
LEVELS = 64
_EXACT = LEVELS - 1


def _ranked(rows: DataFrame, order: list[str], level: int, name: str = "name") -> DataFrame:
    """``rows``, which differ in ``order``, named by their rank in it.

    The sort is spread over range parts; a rank is counted from the parts before.
    """
    ranked = OrderedSplit(rows, [], order).row_number("_rank").result()
    return ranked.withColumn(name, F.col("_rank") * LEVELS + level).drop("_rank")


def _blocks(docs: DataFrame, carry: list[str], text: str, block: int) -> DataFrame:
    """(row, carry, n, sha, index, bytes): one row per block; the digest rides on the first."""
    named = docs.select(
        F.monotonically_increasing_id().alias("row"),
        *[docs[c].alias(f"c_{i}") for i, c in enumerate(carry)],
        text_or_empty(docs, text).alias("whole"),
    )
    raw = F.col("whole").cast("binary")
    count = F.greatest(F.ceil(F.octet_length("whole") / F.lit(block)), F.lit(1)).cast("int")
    cut = named.select(
        "row",
        *[f"c_{i}" for i in range(len(carry))],
        count.alias("n"),
        F.sha2("whole", 256).alias("sha"),
        F.posexplode(
            F.transform(
                F.sequence(F.lit(0), count - 1), lambda i: F.substring(raw, i * block + 1, F.lit(block))
            )
        ).alias("index", "bytes"),
    )
    return cut.withColumn("sha", F.when(F.col("index") == 0, F.col("sha")))


def _name_blocks(blocks: DataFrame, hashed: Callable[[Column], Column]) -> tuple[DataFrame, DataFrame | None]:
    """Names of the blocks that occur twice or more, by hash, and by bytes where hashes collide."""
    distinct = blocks.groupBy("bytes").agg(F.count(F.lit(1)).alias("times"))
    by_hash = distinct.groupBy(hashed(F.col("bytes")).alias("h")).agg(
        F.count(F.lit(1)).alias("blocks"), F.max("times").alias("times")
    )
    repeated = by_hash.filter((F.col("times") > 1) | (F.col("blocks") > 1))
    named = write_stage(_ranked(repeated, ["h"], 0), "block-names")
    clashing = named.filter(F.col("blocks") > 1).select("h")
    exact = None
    if not clashing.isEmpty():
        clashes = (
            distinct.filter(F.col("times") > 1)
            .withColumn("h", hashed(F.col("bytes")))
            .join(clashing, "h", "left_semi")
            .select("h", "bytes")
        )
        exact = write_stage(_ranked(clashes, ["h", "bytes"], _EXACT, "exact_name").drop("h"), "block-clashes")
    return named.filter(F.col("blocks") == 1).select("h", "name"), exact


def identities(
    docs: DataFrame,
    carry: list[str],
    text: str = "text",
    block: int = BLOCK,
    hashed: Callable[[Column], Column] = F.xxhash64,
) -> DataFrame:
    """(row, carry, sha, identity): one row per document.

    Texts are identical exactly where identities are equal; a negative identity
    belongs to one document alone. ``hashed`` is only ever a lookup key.
    """
    blocks = _blocks(docs, carry, text, block)
    by_hash, exact = _name_blocks(blocks, hashed)
    rows = blocks.withColumn("h", hashed(F.col("bytes")))
    if exact is None:
        rows = rows.drop("bytes").join(by_hash, "h", "left")
    else:
        rows = rows.join(by_hash, "h", "left").join(exact, "bytes", "left").withColumn(
            "name", F.coalesce("exact_name", "name")
        )
    own = -F.col("row") - 1  # the document is then unlike all others
    columns = [f"c_{i}" for i in range(len(carry))]
    level = write_stage(
        rows.select("row", *columns, "n", "sha", "index", F.coalesce("name", own).alias("name")),
        "named-blocks",
    )

    documents = level.filter("index = 0").select("row", *columns, "n", "sha", "name")
    single = documents.filter("n = 1").select("row", *columns, "sha", F.col("name").alias("identity"))
    long = documents.filter("n > 1").drop("name")
    settled = level.filter("n > 1").groupBy("row").agg(F.min("name").alias("lowest"))
    lone = settled.filter("lowest < 0").select("row", F.col("lowest").alias("identity"))
    open_rows = settled.filter("lowest >= 0").select("row")
    pending = write_stage(
        level.filter("n > 1").select("row", "n", "index", "name").join(open_rows, "row", "left_semi"),
        "open-blocks",
    )
    done = [lone]
    height = 0
    while not pending.isEmpty():
        height += 1
        pending = write_stage(_pair_up(pending, height), "named-pairs")
        done.append(pending.filter("n = 1").select("row", F.col("name").alias("identity")))
        pending = pending.filter("n > 1")
    ended = done[0]
    for one in done[1:]:
        ended = ended.unionByName(one)
    named = single.unionByName(long.drop("n").join(ended, "row"))
    return named.withColumnsRenamed({f"c_{i}": c for i, c in enumerate(carry)}).select(
        "row", *carry, "sha", "identity"
    )


def _pair_up(level: DataFrame, height: int) -> DataFrame:
    """One level: names of adjacent pairs; a name left over at an odd end is paired with nothing."""
    left = F.max(F.when(F.col("index") % 2 == 0, F.col("name"))).alias("l")
    right = F.max(F.when(F.col("index") % 2 == 1, F.col("name"))).alias("r")
    pairs = (
        level.groupBy("row", "n", F.floor(F.col("index") / 2).cast("int").alias("half"))
        .agg(left, right)
        .select(
            "row",
            F.ceil(F.col("n") / 2).cast("int").alias("n"),
            F.col("half").alias("index"),
            "l",
            F.coalesce("r", F.lit(-1)).alias("r"),
        )
    )
    pairs = write_stage(pairs, "pairs")
    names = _ranked(pairs.select("l", "r").distinct(), ["l", "r"], height)
    return pairs.join(write_stage(names, "pair-names"), ["l", "r"]).select("row", "n", "index", "name")


def copies(docs: DataFrame, text: str = "text", key: str = "doc_id", block: int = BLOCK) -> DataFrame:
    """(doc_id, keep_id, group_size, kept, text_sha256): one row per document."""
    return decisions(docs, [key], text, key, block).select(
        F.col(key), "keep_id", "group_size", "kept", F.col("sha").alias("text_sha256")
    )


def decisions(docs: DataFrame, carry: list[str], text: str, key: str, block: int = BLOCK) -> DataFrame:
    """(carry, sha, keep_id, group_size, kept), with ``carry`` holding ``key``."""
    named = write_stage(identities(docs, carry, text, block), "identities")
    groups = (
        named.filter("identity >= 0")
        .groupBy("identity")
        .agg(
            F.count(F.lit(1)).alias("group_size"),
            F.max(F.struct(F.col(key).alias("id"), "row")).alias("best"),
        )
        .filter("group_size > 1")
        .select("identity", "group_size", F.col("best.id").alias("keep_id"), F.col("best.row").alias("keep_row"))
    )
    repeated = write_stage(groups, "copy-groups")
    joined = named.join(repeated, "identity", "left")
    alone = F.col("group_size").isNull()
    return joined.select(
        *carry,
        "sha",
        F.when(alone, F.col(key)).otherwise(F.col("keep_id")).alias("keep_id"),
        F.coalesce("group_size", F.lit(1)).cast("bigint").alias("group_size"),
        (alone | (F.col("row") == F.col("keep_row"))).alias("kept"),
    )


def without_copies(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` without the rows whose text a kept row has; all columns stay."""
    row = unused(docs, "row_of")
    rows = identified(docs, row, "documents")
    dropped = decisions(rows, [key, row], text, key).filter("not kept").select(row)
    return rows.join(write_stage(dropped, "dropped"), row, "left_anti").drop(row)
