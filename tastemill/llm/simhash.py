"""Near copies by SimHash and a Gray-order hierarchical index.

Fingerprints are compared as distinct values, so a thousand copies of a text
are one entry. Upper nodes of the index are shared masked bit patterns: of 64
bits cut in three segments, two fingerprints that differ in at most two bits
agree in one segment, so every fingerprint is entered below three patterns and
each link is below one of them. A node with too many entries factors a segment
of its remaining bits again, in the same way, until it is small; only crowded
nodes are entered anew, and no node ever has to be split over tasks.

Inside a node the entries are sorted by Gray rank, which brings codes that
differ in few bits together. Runs of eight become leaves, eight leaves a
branch, and so on; each keeps the bits all its entries share. A search walks
down from the node, adds up differences in the bits each level fixes anew, and
drops whole branches once more than two bits differ.

Each node hands on a spanning forest of its links, not all pairs. Components
are found by star contraction on written edge tables.

Defined results: a null or wordless text has fingerprint zero and is linked like
any other; repeated rows fall into one component; a null doc_id takes part and
is never the smallest id unless a component has no other; an empty table gives
an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tastemill.llm.common import identified, per_text, slices, unused
from tastemill.session import write_stage

RADIUS = 2
SHINGLE = 3
SEED = 42
#: Entries a node may have before a further segment is factored out of it.
NODE = 2048
#: A node with no more free bits than this holds at most 2^FREE entries and is never factored again.
FREE = 12
FAN_OUT = 8
#: Shingles hashed at a time, so that a very long text needs no large arrays.
CHUNK = 1 << 16


def fingerprint(text: str) -> int:
    """64-bit SimHash: a bit is 1 if it is set in more than half of the shingle hashes."""
    words = text.encode().lower().split()  # bytes: only A-Z change, and only ASCII white space splits
    if not words:
        return 0
    size = min(SHINGLE, len(words))
    shingles = map(b" ".join, zip(*(words[i:] for i in range(size))))
    count, ones = len(words) - size + 1, np.zeros(64, dtype=np.int64)
    hashes = map(xxhash.xxh64_intdigest, shingles, repeat(SEED))
    for start in range(0, count, CHUNK):
        h = np.fromiter(hashes, np.uint64, min(CHUNK, count - start))
        bits = np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones += bits.sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > count, bitorder="little").view(np.uint64)[0])


def _fingerprints(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for part in slices(batches):
        prints = np.array([fingerprint(t) for t in part.column(1).to_pylist()], dtype=np.uint64)
        yield pa.RecordBatch.from_arrays(
            [part.column(0), pa.array(prints.view(np.int64))], names=["key", "fp"]
        )


def fingerprints(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, fp): the fingerprint as a signed BIGINT of the same bits."""
    return per_text(docs, key, _fingerprints, "fp bigint", text)


def _signed(mask: int) -> int:
    return mask - (1 << 64) if mask >> 63 else mask


def _segments(mask: int) -> list[int]:
    """The bits that ``mask`` leaves free, cut into RADIUS + 1 runs, each added to ``mask``."""
    free = [b for b in range(63, -1, -1) if not mask >> b & 1]
    cuts = np.array_split(np.array(free), RADIUS + 1)
    return [mask | sum(1 << int(b) for b in run) for run in cuts]


def gray_rank(fp: Column) -> Column:
    """Place of a code in Gray order: each bit is the parity of the bits from the top down to it."""
    for shift in (1, 2, 4, 8, 16, 32):
        fp = fp.bitwiseXOR(F.shiftrightunsigned(fp, shift))
    return fp


def _entries(prints: DataFrame, masks: dict[int, list[int]] | None) -> DataFrame:
    """Rows (mask, pattern, fp) below the given masks; ``masks`` maps a node's mask to its children's."""
    if masks is None:
        below = F.array(*[F.lit(_signed(m)) for m in _segments(0)])
    else:
        below = F.lit(None).cast("array<bigint>")
        for mask, children in masks.items():
            child = F.array(*[F.lit(_signed(m)) for m in children])
            below = F.when(F.col("mask") == _signed(mask), child).otherwise(below)
    return prints.select("fp", F.explode(below).alias("mask")).withColumn(
        "pattern", F.col("fp").bitwiseAND(F.col("mask"))
    )


def index_nodes(prints: DataFrame, node: int = NODE) -> DataFrame:
    """(mask, pattern, fp) of every index node with two entries or more and at most ``node`` of them.

    A round for each depth of the index. One is enough unless fingerprints crowd
    together; a crowded node is only ever counted, never gathered.
    """
    done, masks = [], None
    while True:
        entries = write_stage(_entries(prints, masks), "index-entries")
        sizes = (
            entries.groupBy("mask", "pattern").agg(F.count(F.lit(1)).alias("size")).filter("size > 1")
        )
        sizes = write_stage(sizes, "index-sizes")
        level = [m[0] % (1 << 64) for m in sizes.select("mask").distinct().collect()]  # 3^depth at most
        full = [m for m in level if 64 - m.bit_count() <= FREE]
        small = (F.col("size") <= node) | F.col("mask").isin([_signed(m) for m in full])
        done.append(entries.join(sizes.filter(small).drop("size"), ["mask", "pattern"], "left_semi"))
        crowded = sizes.filter(~small).drop("size")
        masks = {m[0] % (1 << 64): _segments(m[0] % (1 << 64)) for m in crowded.select("mask").distinct().collect()}
        if not masks:
            break
        prints = entries.join(crowded, ["mask", "pattern"], "left_semi").select("mask", "fp").distinct()
    out = done[0]
    for more in done[1:]:
        out = out.unionByName(more)
    return out


class _Level:
    """Nodes of one level: the bits all entries share, their values, and the child range."""

    def __init__(self, mask: np.ndarray, value: np.ndarray, first: np.ndarray, end: np.ndarray):
        self.mask, self.value, self.first, self.end = mask, value, first, end


def _raise(below: _Level, group: np.ndarray) -> tuple[_Level, np.ndarray]:
    """The level above: runs of FAN_OUT neighbours of a group, with the bits they share."""
    n = len(group)
    new = np.ones(n, dtype=bool)
    new[1:] = group[1:] != group[:-1]
    start_of = np.maximum.accumulate(np.where(new, np.arange(n), 0))
    cut = np.flatnonzero((np.arange(n) - start_of) % FAN_OUT == 0)
    ends = np.append(cut[1:], n)
    all_one = np.bitwise_and.reduceat(below.value | ~below.mask, cut)
    any_one = np.bitwise_or.reduceat(below.value & below.mask, cut)
    shared = np.bitwise_and.reduceat(below.mask, cut) & ~(all_one ^ any_one)
    return _Level(shared, any_one & shared, cut, ends), group[cut]


def close_pairs(codes: np.ndarray, group: np.ndarray, radius: int = RADIUS) -> tuple[np.ndarray, np.ndarray]:
    """Index pairs i < j within a group whose codes differ in ``radius`` bits at most.

    ``codes`` is sorted by group and Gray rank. All searches walk down together:
    the frontier holds (code, node, differences so far).
    """
    full = np.uint64(0xFFFFFFFFFFFFFFFF)
    n = len(codes)
    levels = [_Level(np.full(n, full), codes, np.arange(n), np.arange(n) + 1)]
    groups = group
    while len(groups) > 1 and (groups[1:] == groups[:-1]).any():
        level, groups = _raise(levels[-1], groups)
        levels.append(level)
    root_of = np.searchsorted(groups, group)
    left, right = [], []
    for start in range(0, n, 1 << 14):
        query = np.arange(start, min(n, start + (1 << 14)))
        node = root_of[query]
        gap = np.bitwise_count((codes[query] ^ levels[-1].value[node]) & levels[-1].mask[node]).astype(np.int64)
        for upper, lower in zip(levels[:0:-1], levels[-2::-1]):
            size = upper.end[node] - upper.first[node]
            parent = np.repeat(node, size)
            child = np.arange(int(size.sum())) + np.repeat(upper.first[node] - (np.cumsum(size) - size), size)
            query, gap = np.repeat(query, size), np.repeat(gap, size)
            fresh = lower.mask[child] & ~upper.mask[parent]
            gap = gap + np.bitwise_count((codes[query] ^ lower.value[child]) & fresh)
            near = gap <= radius
            query, node, gap = query[near], child[near], gap[near]
        later = query < node
        left.append(query[later])
        right.append(node[later])
    return np.concatenate(left), np.concatenate(right)


def _forest(n: int, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Each linked index with the smallest one reachable from it: a star for each component."""
    label = np.arange(n)
    while True:
        low = np.minimum(label[left], label[right])
        new = label.copy()
        np.minimum.at(new, left, low)
        np.minimum.at(new, right, low)
        np.minimum.at(new, label[left], low)
        np.minimum.at(new, label[right], low)
        new = new[new]
        if (new == label).all():
            break
        label = new
    linked = np.flatnonzero(label != np.arange(n))
    return linked, label[linked]


def _links(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Search the nodes of a partition sorted by node and Gray rank; a node cut by a batch is carried on."""
    rest: list[np.ndarray] = [np.empty(0, np.int64)] * 3

    def search(columns: list[np.ndarray]) -> pa.RecordBatch:
        mask, pattern, fp = columns
        new = np.ones(len(fp), dtype=bool)
        new[1:] = (mask[1:] != mask[:-1]) | (pattern[1:] != pattern[:-1])
        left, right = close_pairs(fp.view(np.uint64), np.cumsum(new))
        a, b = _forest(len(fp), left, right)
        return pa.RecordBatch.from_arrays([pa.array(fp[a]), pa.array(fp[b])], names=["a", "b"])

    for batch in batches:
        part = [np.concatenate([r, c.to_numpy(zero_copy_only=False)]) for r, c in zip(rest, batch.columns)]
        if not len(part[0]):
            continue
        last = (part[0] == part[0][-1]) & (part[1] == part[1][-1])
        cut = len(last) - int(last.sum())
        if cut:
            yield search([c[:cut] for c in part])
        rest = [c[cut:] for c in part]
    if len(rest[0]):
        yield search(rest)


def links(prints: DataFrame, node: int = NODE) -> DataFrame:
    """(a, b): links between distinct fingerprints that hold their components together."""
    entries = index_nodes(prints, node)
    return (
        entries.repartition("mask", "pattern")
        .withColumn("rank", gray_rank(F.col("fp")))
        .sortWithinPartitions("mask", "pattern", "rank")
        .select("mask", "pattern", "fp")
        .mapInArrow(_links, "a bigint, b bigint")
    )


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every linked node: the smallest node of its component.

    Alternating star contraction (large-star, small-star): the number of rounds
    grows with the logarithm of the component size. Every round is a written
    table of at most as many edges; joins on a hub are plain equi-joins.
    """
    ordered = F.least("a", "b"), F.greatest("a", "b")
    edges = write_stage(
        edges.filter("a <> b").select(ordered[1].alias("a"), ordered[0].alias("b")).distinct(), "edges"
    )
    state = None
    while True:
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("low"))
        large = write_stage(
            both.filter("b > a").join(low, "a").select(F.col("b").alias("a"), F.col("low").alias("b")).distinct(),
            "large-star",
        )
        low = large.groupBy("a").agg(F.min("b").alias("low"))
        moved = large.join(low, "a").select(F.col("b").alias("a"), F.col("low").alias("b")).filter("a <> b")
        edges = write_stage(moved.unionByName(low.select("a", F.col("low").alias("b"))).distinct(), "small-star")
        now = edges.agg(
            F.count(F.lit(1)).alias("n"),
            F.bit_xor(F.xxhash64("a", "b")).alias("x"),
            F.sum(F.xxhash64("a", "b").cast("decimal(20,0)")).alias("s"),
        ).first()
        if now == state:
            break
        state = now
    return edges.select(F.col("a").alias("node"), F.col("b").alias("root"))


def near_copies(docs: DataFrame, carry: list[str], text: str = "text", key: str = "doc_id", node: int = NODE) -> DataFrame:
    """(carry, fp, component_id): every row with the smallest ``key`` reachable from it."""
    rows = docs.select(*[docs[c] for c in carry], F.struct(*[docs[c] for c in carry]).alias("_all"), docs[text])
    prints = write_stage(
        fingerprints(rows.select("_all", text), "_all", text).select("_all.*", "fp"), "fingerprints"
    )
    distinct = write_stage(
        prints.groupBy("fp").agg(F.min(key).alias("lowest"), F.count(F.lit(1)).alias("rows")), "distinct-prints"
    )
    roots = components(links(distinct.select("fp"), node))
    placed = distinct.join(roots.withColumnRenamed("node", "fp"), "fp", "left").withColumn(
        "root", F.coalesce("root", "fp")
    )
    lowest = placed.groupBy("root").agg(F.min("lowest").alias("component_id"), F.sum("rows").alias("members"))
    of_print = write_stage(
        placed.select("fp", "root").join(lowest, "root").select("fp", "component_id", "root", "members"), "components"
    )
    return prints.join(of_print, "fp").select(*carry, "fp", "component_id", "root", "members")


def hex64(fp: Column) -> Column:
    return F.lower(F.lpad(F.hex(fp), 16, "0"))


def one_of_each(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` with one row of every component, the one with the smallest ``key``; all columns stay."""
    row = unused(docs, "row_of")
    rows = identified(docs, row, "documents")
    near = near_copies(rows, [key, row], text, key).filter("members > 1")
    near = write_stage(near.select(row, key, "root"), "near-copies")
    first = F.min(F.struct(F.col(key).isNull(), F.col(key), F.col(row).alias("row"))).getField("row")
    kept = near.groupBy("root").agg(first.alias(row)).select(row)
    dropped = write_stage(near.select(row).join(kept, row, "left_anti"), "dropped")
    return rows.join(dropped, row, "left_anti").drop(row)
