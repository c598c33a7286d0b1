"""Merkle dataset manifest: a persistent tree of digests whose versions share nodes.

Every row is a leaf. The leaves of a source, by doc_id, are hashed in runs of 16
up to one digest, the source's subroot; the subroots are hashed in the same way
up to the root. Version 0 is the table as it is. A changed row makes a version
of its own by path copying: only the ancestors of its leaf are made anew, every
other node is the one of version 0.

Nodes are handled in aligned blocks of 16^3 leaves, so a task holds one block at
a time, however many rows a source has. The roots of the blocks are the leaves
of the next tier, which is cut into blocks again; tiers shrink 4,096 times, so
even 10^14 rows have four. Going down again, every block gets the path above it
(one small row), on which the versions made in the block continue up to the
root. Texts are read once and never shuffled; digests are.

Defined results: a null field is hashed as ``-``; a null doc_id comes first, is
no version and is otherwise a row like others; rows with equal doc_ids are
ordered by their digest, so equal rows can stand for each other; null sources
are one source; an empty table has no rows and no root; other columns are not
read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import groupby

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from tastemill.functions.ordered import OrderedSplit
from tastemill.llm.common import map_batches
from tastemill.session import write_stage

#: Nodes in a run, and levels in an aligned block.
FAN, DEPTH = 16, 3
#: The fields of a leaf, in the order in which they are hashed.
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
#: Rows handed to Spark at a time.
_SLICE = 512

_PATH = "array<struct<before: string, after: string>>"
_PATH_TYPE = pa.list_(pa.struct([("before", pa.string()), ("after", pa.string())]))
_KEY = ("known", "source")


def node_digest(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def leaf_digest(fields: list[Column]) -> Column:
    """SHA-256 of the fields, each with its length in bytes before it, or ``-`` where it is null."""
    parts = []
    for field in fields:
        text = field.cast("string")
        parts.append(F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-")))
    return F.sha2(F.concat(*parts), 256)


def leaves(docs: DataFrame, text: Column | None = None, changed: Column | None = None) -> DataFrame:
    """(known, source, doc_id, leaf, changed) of every row, written once.

    ``changed`` is the digest of the leaf with ``text`` in place of the text,
    null in rows where the condition ``changed`` does not hold.
    """
    own = [docs[c] for c in FIELDS]
    other = F.lit(None).cast("string")
    if text is not None:
        other = F.when(changed, leaf_digest([*own[:-1], text]))
    rows = docs.select(
        docs["source"].isNotNull().alias("known"),
        F.coalesce(docs["source"].cast("string"), F.lit("")).alias("source"),
        docs["doc_id"].alias("doc_id"),
        leaf_digest(own).alias("leaf"),
        other.alias("changed"),
    )
    return write_stage(rows, "leaves")


def height(n: int) -> int:
    """Levels above ``n`` leaves."""
    levels = 0
    while n > 1:
        n, levels = -(-n // FAN), levels + 1
    return levels


def grow(digests: list[str], levels: int) -> list[list[str]]:
    """The nodes over some leaves, level by level from the leaves up."""
    tree = [digests]
    for _ in range(levels):
        below = tree[-1]
        tree.append([node_digest("".join(below[i : i + FAN])) for i in range(0, len(below), FAN)])
    return tree


def siblings(tree: list[list[str]], at: int) -> list[dict]:
    """For each level under the top the others of the run, before and after the ancestor of leaf ``at``."""
    path = []
    for nodes in tree[:-1]:
        start = at // FAN * FAN
        path.append({"before": "".join(nodes[start:at]), "after": "".join(nodes[at + 1 : start + FAN])})
        at //= FAN
    return path


def copied(leaf: str, path: list[dict]) -> list[str]:
    """The nodes of a version from its leaf to the root: copies of the ancestors over shared siblings."""
    nodes = [leaf]
    for step in path:
        nodes.append(node_digest(step["before"] + nodes[-1] + step["after"]))
    return nodes


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    for batch in batches:
        yield from zip(*(c.to_pylist() for c in batch.columns))


def _sent(rows: Iterator[tuple], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    held: list[tuple] = []
    for row in rows:
        held.append(row)
        if len(held) == _SLICE:
            yield pa.RecordBatch.from_pylist([dict(zip(schema.names, r)) for r in held], schema=schema)
            held = []
    if held:
        yield pa.RecordBatch.from_pylist([dict(zip(schema.names, r)) for r in held], schema=schema)


_NODE = "known boolean, source string, n bigint, level int, position bigint, digest string"
_NODE_TYPE = pa.schema(
    [
        ("known", pa.bool_()),
        ("source", pa.string()),
        ("n", pa.int64()),
        ("level", pa.int32()),
        ("position", pa.int64()),
        ("digest", pa.string()),
    ]
)


def _grow_blocks(depth: int):
    """All nodes over the leaves of each block; rows come sorted, one block after the other."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def nodes() -> Iterator[tuple]:
            for (known, source, block), group in groupby(_rows(batches), key=lambda r: r[:3]):
                rows = list(group)
                n = rows[0][3]
                tree = grow([r[5] for r in rows], min(depth, height(n)))
                for level, made in enumerate(tree[1:], 1):
                    for i, digest in enumerate(made, block * FAN ** (depth - level)):
                        yield known, source, n, level, i, digest

        return _sent(nodes(), _NODE_TYPE)

    return run


def _by_block(rows: DataFrame, *order: str) -> DataFrame:
    """Each block in one task, in order. A block has at most 16^depth leaves, whatever the source has."""
    return rows.repartition(*_KEY, "block").sortWithinPartitions(*_KEY, "block", *order)


class Tier:
    """Digests in a row per tree, (known, source, position, n, digest, ...), and the nodes over them."""

    def __init__(self, rows: DataFrame, depth: int):
        self.depth = depth
        block = F.floor(F.col("position") / F.lit(FAN**depth))
        self.rows = write_stage(rows.withColumn("block", block), "tier")
        leaf_rows = self.rows.select(*_KEY, "block", "n", "position", "digest")
        many = _by_block(leaf_rows.filter("n > 1"), "position")
        self.nodes = write_stage(map_batches(many, _grow_blocks(depth), _NODE), "nodes")

    def tops(self) -> DataFrame:
        """(known, source, position, n, digest): the highest node of each block, or a lone leaf."""
        blocks = F.ceil(F.col("n") / F.lit(FAN**self.depth)).cast("bigint")
        levels = F.lit(self.depth)
        for depth in range(self.depth - 1, 0, -1):
            levels = F.when(F.col("n") <= FAN**depth, depth).otherwise(levels)
        high = self.nodes.filter(F.col("level") == levels)
        alone = self.rows.filter("n = 1").select(*_KEY, "position", "n", "digest")
        return high.select(*_KEY, "position", blocks.alias("n"), "digest").unionByName(alone)


def _climb(rows: DataFrame, depth: int) -> tuple[list[Tier], DataFrame]:
    """Tiers from the leaves up, and the last digest of every tree."""
    tiers = [Tier(rows, depth)]
    while True:
        tops = write_stage(tiers[-1].tops(), "tops")
        if tops.filter("n > 1").isEmpty():
            return tiers, tops.select(*_KEY, "digest")
        tiers.append(Tier(tops, depth))


_WALKED = f"known boolean, source string, position bigint, carried {{}}, path {_PATH}, nodes array<string>, subroot string, root string"


def _walk_blocks(carried: pa.DataType, depth: int):
    """For every leaf of a block the path to the root and the nodes of its version.

    The first row of a block is its head: the path above the block and the roots.
    """
    schema = pa.schema(
        [
            ("known", pa.bool_()),
            ("source", pa.string()),
            ("position", pa.int64()),
            ("carried", carried),
            ("path", _PATH_TYPE),
            ("nodes", pa.list_(pa.string())),
            ("subroot", pa.string()),
            ("root", pa.string()),
        ]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def walked() -> Iterator[tuple]:
            for (known, source, _), group in groupby(_rows(batches), key=lambda r: r[:3]):
                head, *rows = group
                above, subroot, root = head[7:]
                tree = grow([r[5] for r in rows], min(depth, height(rows[0][3])))
                for at, row in enumerate(rows):
                    path = siblings(tree, at) + above
                    changed = row[6].get("changed")
                    yield known, source, row[4], row[6], path, copied(changed or row[5], path), subroot, root

        return _sent(walked(), schema)

    return run


def _descend(tier: Tier, heads: DataFrame, carry: list[str]) -> DataFrame:
    """(known, source, position, carried, path, nodes, subroot, root) of the tier's digests.

    ``heads`` is (known, source, block, path, subroot, root), one row per block.
    Heads and leaves travel together, so no join is needed.
    """
    picked = tier.rows.select(
        *_KEY,
        "block",
        "n",
        "position",
        "digest",
        F.struct(*[F.col(c) for c in carry], F.col("digest").alias("_digest")).alias("carried"),
        F.lit(None).cast(_PATH).alias("path"),
        F.lit(None).cast("string").alias("subroot"),
        F.lit(None).cast("string").alias("root"),
    )
    first = heads.select(
        *_KEY,
        "block",
        F.lit(0).cast("bigint").alias("n"),
        F.lit(-1).cast("bigint").alias("position"),
        F.lit("").alias("digest"),
        F.lit(None).cast(picked.schema["carried"].dataType).alias("carried"),
        "path",
        "subroot",
        "root",
    )
    rows = _by_block(picked.unionByName(first), "position")
    carried = picked.schema["carried"].dataType
    return map_batches(rows, _walk_blocks(to_arrow_type(carried), tier.depth), _WALKED.format(carried.simpleString()))


def _walk_down(tiers: list[Tier], heads: DataFrame, carry: list[str]) -> DataFrame:
    """Paths of the lowest tier. ``heads`` has one row per tree: (known, source, path, subroot, root)."""
    heads = heads.withColumn("block", F.lit(0).cast("bigint"))
    for tier in reversed(tiers[1:]):
        walked = _descend(tier, heads, [])
        heads = write_stage(
            walked.select(*_KEY, F.col("position").alias("block"), "path", "subroot", "root"), "paths"
        )
    return _descend(tiers[0], heads, carry)


def _above(place: str) -> Column:
    """The position of the ancestor ``_at`` levels over a leaf."""
    return F.expr(f"shiftright({place}, 4 * _at)").alias("position")


class Manifest:
    """The tree over ``docs`` and the versions that a change of single rows makes.

    ``text`` is the changed text, in rows where the condition ``changed`` holds.
    """

    def __init__(
        self, docs: DataFrame, text: Column | None = None, changed: Column | None = None, depth: int = DEPTH
    ):
        rows = leaves(docs, text, changed).withColumn("row", F.monotonically_increasing_id())
        one = F.lit(1).cast("bigint")
        placed = (
            OrderedSplit(rows, list(_KEY), ["doc_id", "leaf", "row"])
            .running_sum(one, "position", inclusive=False)
            .key_total(one, "n")
            .result()
        )
        self.tiers, subroots = _climb(placed.drop("row").withColumnRenamed("leaf", "digest"), depth)
        ranked = OrderedSplit(subroots, [], list(_KEY)).running_sum(one, "position", inclusive=False).result()
        self.subroots = write_stage(ranked, "subroots")
        # The subroots are the leaves of one more tree, whose key is the same in all rows.
        total = self.subroots.count()
        self.upper, tops = _climb(
            self.subroots.select(
                F.lit(True).alias("known"),
                F.lit("").alias("source"),
                "position",
                F.lit(total).cast("bigint").alias("n"),
                "digest",
                F.struct(*_KEY).alias("tree"),
            ),
            depth,
        )
        self.top = tops

    def root(self) -> str | None:
        """The digest of the whole table."""
        row = self.top.first()
        return row["digest"] if row else None

    def nodes(self) -> DataFrame:
        """(known, source, level, position, digest): all nodes of version 0 over the leaves of each source."""
        found = None
        for tier, part in enumerate(self.tiers):
            moved = part.nodes.withColumn("level", F.col("level") + tier * part.depth).drop("n")
            found = moved if found is None else found.unionByName(moved)
        return found

    def proofs(self) -> DataFrame:
        """One row per document, with its path to the root and the nodes of its version.

        (source, doc_id, position, leaf, changed, leaves, path, nodes, subroot, root): ``path``
        has the siblings on each level, from the leaves up, joined before and after
        the ancestor; ``nodes`` the digests from the leaf (the changed one, if it is
        changed) to the root of the version. All but these few nodes are shared.
        ``leaves`` counts those of the source.
        """
        head = F.lit(None).cast("string")
        root = F.lit(self.root()).cast("string")
        above = self.top.select(
            *_KEY, F.array().cast(_PATH).alias("path"), head.alias("subroot"), root.alias("root")
        )
        trees = write_stage(_walk_down(self.upper, above, ["tree"]), "tree-paths").select(
            F.col("carried.tree.known").alias("known"),
            F.col("carried.tree.source").alias("source"),
            "path",
            F.col("carried._digest").alias("subroot"),
            "root",
        )
        walked = _walk_down(self.tiers, trees, ["doc_id", "changed", "n"])
        return walked.select(
            F.when(F.col("known"), F.col("source")).alias("source"),
            F.col("carried.doc_id").alias("doc_id"),
            "position",
            F.col("carried._digest").alias("leaf"),
            F.col("carried.changed").alias("changed"),
            F.col("carried.n").alias("leaves"),
            "path",
            "nodes",
            "subroot",
            "root",
        )

    def versions(self) -> DataFrame:
        """(source, version, whole, level, position, digest): the nodes that versions add to the shared ones.

        A version is named by its source and the position of its changed leaf.
        ``whole`` tells the nodes over the sources, where a subroot has level 0.
        """
        levels = sum((F.col("leaves") > FAN**k).cast("int") for k in range(15))
        made = self.proofs().filter(F.col("changed").isNotNull())
        nodes = made.select(
            "source",
            F.coalesce("source", F.lit("")).alias("_source"),
            F.col("source").isNotNull().alias("_known"),
            F.col("position").alias("version"),
            levels.alias("_levels"),
            F.posexplode("nodes").alias("_at", "digest"),
        )
        inside = nodes.filter(F.col("_at") <= F.col("_levels")).select(
            "source", "version", F.lit(False).alias("whole"), F.col("_at").alias("level"), _above("version"), "digest"
        )
        places = self.subroots.select(
            F.col("known").alias("_known"), F.col("source").alias("_source"), F.col("position").alias("_place")
        )
        over = (
            nodes.filter(F.col("_at") >= F.col("_levels"))
            .join(places, ["_known", "_source"])
            .withColumn("_at", F.col("_at") - F.col("_levels"))
            .select("source", "version", F.lit(True).alias("whole"), F.col("_at").alias("level"), _above("_place"), "digest")
        )
        return inside.unionByName(over)


def proof_digest(path: Column) -> Column:
    """SHA-256 of all siblings on a path, from the leaves up and from left to right."""
    parts = F.flatten(F.transform(path, lambda s: F.array(s["before"], s["after"])))
    return F.sha2(F.array_join(parts, ""), 256)


def lowered(text: Column) -> Column:
    """``text`` with A-Z in lower case and all else as it is."""
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def tampered(docs: DataFrame, depth: int = DEPTH) -> DataFrame:
    """Digest columns of every row's proof, where a fifth of the rows has a tampered text."""
    hit = F.crc32(docs["doc_id"].cast("string").cast("binary")) % 5 == 0
    proofs = Manifest(docs, lowered(docs["text"]), hit, depth).proofs()
    folded = F.element_at("nodes", -1)
    return proofs.select(
        "doc_id",
        "leaf",
        "subroot",
        "root",
        proof_digest(F.col("path")).alias("proof_sha256"),
        folded.alias("folded_root"),
        (folded == F.col("root")).alias("verified"),
    )
