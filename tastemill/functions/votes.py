"""Best n items of every user by the votes of the items the user has, without rows for votes.

The links of an item travel beside the user's row, packed for the task where the
user is. There the votes are added up, what the user has is left out, and the
best n are kept. Tasks add up a fixed number of votes at a time, whatever the
input and however many rows a user has.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tastemill.functions import top_pairs as tp
from tastemill.session import write_stage

#: Votes that a task adds up on average, and twice that at a time.
VOTES = 1 << 20
#: Links that are sent in one batch.
LOT = 1 << 22

#: User, whether it is known (1) and has the item (2), item, weight, links.
_ROW = [(8, True), (1, True), (8, True), (8, False), (4, True)]
_SENT = "pid int, sent bigint, links bigint, packed binary"
_BEST = "user bigint, best array<struct<item: bigint, score: double, rank: int>>"


def _packer(layout: list[tuple[int, bool]], low: int, scale: float):
    """(item, links) -> (item, packed links), which are sorted and in steps; a null b is ``low``."""
    width = sum(w for w, _ in layout)

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            links = batch.column(1)
            offsets, links = links.offsets.to_numpy().astype(np.int64), links.flatten()
            offsets -= offsets[0]
            sim = links.field(1)
            if pc.any(pc.is_nan(sim)).as_py():
                raise ValueError("a term is out of the range of an exact sum")
            sim = sim.to_numpy(zero_copy_only=False)
            b = pc.fill_null(links.field(0), low).to_numpy()
            order = np.lexsort((b, np.repeat(np.arange(batch.num_rows), np.diff(offsets))))
            b, sim = tp._steps(b[order] - low, offsets[:-1][np.diff(offsets) > 0]), sim[order]
            records = tp._pack([b, np.floor(sim * scale + 0.5) if scale else sim], layout)
            at = pa.py_buffer((offsets * width).astype(np.int32))
            packed = pa.Array.from_buffers(pa.binary(), batch.num_rows, [None, at, pa.py_buffer(records)])
            yield pa.RecordBatch.from_arrays([batch.column(0), packed], names=["item", "links"])

    return pack


def _sender(layout: list[tuple[int, bool]], parts: int):
    """(user, item, weight, packed links, has) -> the rows for one task as one row, byte plane by byte plane, compressed."""
    width = sum(w for w, _ in layout)

    def lots(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for batch in batches:
            held.append(batch)
            size += batch.num_rows + batch.column(3).nbytes // width
            if size >= LOT:
                yield from pa.Table.from_batches(held).combine_chunks().to_batches()
                held, size = [], 0
        if held:
            yield from pa.Table.from_batches(held).combine_chunks().to_batches()

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = pa.Codec("zstd", compression_level=1)
        for batch in lots(batches):
            if not batch.num_rows:
                continue
            user, item, weight, links, has = batch.columns
            links = pc.fill_null(links, b"")
            offsets = np.frombuffer(links.buffers()[1], np.int32)[links.offset : links.offset + len(links) + 1]
            length = np.diff(offsets.astype(np.int64)) // width
            data = memoryview(links.buffers()[2] or b"")[offsets[0] : offsets[-1]]
            planes = np.ascontiguousarray(np.frombuffer(data, np.uint8).reshape(-1, width).T)
            if pc.any(pc.is_nan(weight.filter(pa.array(length > 0)))).as_py():
                raise ValueError("a term is out of the range of an exact sum")
            known = pc.is_valid(user).to_numpy(zero_copy_only=False).astype(np.int64)
            user = pc.fill_null(user, 0).to_numpy()
            pid = (tp._place(user, known) % np.uint64(parts)).astype(np.int32)
            known += 2 * has.to_numpy(zero_copy_only=False).astype(np.int64)
            order = np.argsort(pid, kind="stable")
            start = (np.cumsum(length) - length)[order]
            rows = [user, known, pc.fill_null(item, 0).to_numpy(), weight.to_numpy(zero_copy_only=False), length]
            heads = tp._planes([c[order] for c in rows], _ROW)
            at = tp._ranges(start, length[order])
            body = np.empty((width, len(at)), np.uint8)
            for i in range(width):
                np.take(planes[i], at, out=body[i])
            pid, ends = pid[order], np.r_[0, np.cumsum(length[order])]
            first, last = tp._runs(pid)
            packed = [
                codec.compress(heads[:, f:t].tobytes() + body[:, ends[f] : ends[t]].tobytes(), asbytes=True)
                for f, t in zip(first.tolist(), last.tolist())
            ]
            columns = [pa.array(pid[first]), pa.array(last - first), pa.array(ends[last] - ends[first]), pa.array(packed, pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, names=["pid", "sent", "links", "packed"])

    return send


def _voter(layout: list[tuple[int, bool]], low: int, scale: float, n: int, at_a_time: int):
    """Packed rows -> (user, the best n (item, score, rank) in a list)."""
    head, width = sum(w for w, _ in _ROW), sum(w for w, _ in layout)

    def opened(row, share, shares):
        """Votes and seen items of one share of the items."""
        sent, links, packed = row
        raw = np.frombuffer(pa.Codec("zstd").decompress(packed, sent * head + links * width, asbytes=True), np.uint8)
        user, known, item, weight, length = tp._columns(raw[: sent * head].reshape(head, sent), _ROW)
        b, sim = tp._columns(raw[sent * head :].reshape(width, links), layout)
        b, sim = (tp._added_up(b, length) if links else b) + low, sim / scale if scale else sim
        of = np.repeat(np.arange(sent), length)
        seen = np.flatnonzero(known == 3)
        known = known & 1
        if shares > 1:
            mine = np.flatnonzero(tp._mixed(b) % np.uint64(shares) == share)
            of, b, sim = of[mine], b[mine], sim[mine]
            seen = seen[tp._mixed(item[seen]) % np.uint64(shares) == share]
        term = weight[of] * sim
        if np.isnan(term[~(np.isnan(weight[of]) | np.isnan(sim))]).any():
            raise ValueError("a term is out of the range of an exact sum")
        return (user[of], known[of], b, term), (user[seen], known[seen], item[seen])

    def added_up(rows, share, shares):
        """(user, known, item, score): the best n of each user among the items of the share."""
        parts = [opened(row, share, shares) for row in rows]
        user, known, item, term = (np.concatenate(c) for c in zip(*[votes for votes, _ in parts]))
        if not len(user):
            return None
        seen = [np.concatenate(c) for c in zip(*[s for _, s in parts])]
        code = tp._codes(np.r_[user, seen[0]], np.r_[known, seen[1]])
        code, seen_code = code[: len(user)], code[len(user) :]
        order = np.lexsort((item, code))
        code, item, term = code[order], item[order], term[order]
        starts = np.flatnonzero(np.r_[True, (item[1:] != item[:-1]) | (code[1:] != code[:-1])])
        score = tp._rounded(tp._exact_sums(term, 1e6, starts))
        code, item, at = code[starts], item[starts], order[starts]
        # A run of equal (user, item) that begins with a seen one has more than itself.
        both = np.lexsort((np.r_[np.zeros(len(seen_code), np.int8), np.ones(len(code), np.int8)], np.r_[seen[2], item], np.r_[seen_code, code]))
        c, i = np.r_[seen_code, code][both], np.r_[seen[2], item][both]
        run = np.cumsum(np.r_[True, (c[1:] != c[:-1]) | (i[1:] != i[:-1])]) - 1
        has = np.zeros(run[-1] + 1, bool)
        has[run[both < len(seen_code)]] = True
        free = np.ones(len(code), bool)
        vote = both >= len(seen_code)
        free[both[vote] - len(seen_code)] = ~has[run[vote]]
        kept = np.flatnonzero(free)
        code, item, at, score = code[kept], item[kept], at[kept], score[kept]
        if not len(code):
            return None
        best = tp._best(np.where(np.isnan(score), -np.inf, score), code, n)
        return user[at[best]], known[at[best]], item[best], score[best]

    def vote(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = []
        for batch in batches:
            rows += zip(*[batch.column(i).to_pylist() for i in (1, 2, 3)])
        if not rows:
            return
        shares = max(1, -(-sum(sent + links for sent, links, _ in rows) // (2 * at_a_time)))
        with np.errstate(all="ignore"):
            found = [x for x in (added_up(rows, share, shares) for share in range(shares)) if x is not None]
            if not found:
                return
            user, known, item, score = (np.concatenate(c) for c in zip(*found))
            code = tp._codes(user, known)
            order = np.lexsort((item, code))
            user, known, item, score, code = (c[order] for c in (user, known, item, score, code))
            best = tp._best(np.where(np.isnan(score), -np.inf, score), code, n)
        first, last = tp._runs(code[best])
        rank = np.arange(len(best)) - np.repeat(first, last - first) + 1
        score = pa.array(score[best], mask=np.isnan(score[best]))
        entries = pa.StructArray.from_arrays([pa.array(item[best]), score, pa.array(rank.astype(np.int32))], ["item", "score", "rank"])
        who = best[first]
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(user[who], mask=known[who] == 0),
                pa.ListArray.from_arrays(pa.array(np.r_[first, len(best)].astype(np.int32)), entries),
            ],
            names=["user", "best"],
        )

    return vote


def top_votes(prefs: DataFrame, links: DataFrame, n: int, at_a_time: int = VOTES, seen: DataFrame | None = None) -> DataFrame:
    """(user, item, score, rank): the best n items that a user does not have, by added-up weight x sim.

    ``prefs`` are (user, item, weight), ``links`` (item, b, sim) with whole
    numbers as ids; ``prefs`` is read twice. Rows of a null user are one user who
    has nothing. Ties go to the smaller item.

    With ``seen`` (user, item) this is what users have, and the items of
    ``prefs`` only name lists of links; then b may be null, which no one has.
    """
    one = F.struct(F.col("b").cast("bigint").alias("b"), F.col("sim").cast("double").alias("sim"))
    lists = write_stage(links.groupBy("item").agg(F.collect_list(one).alias("links")), "links")

    def short(x):
        return x.isNotNull() & (x >= 0) & (x < 1e9) & (F.floor(x * 1e6 + 0.5) / 1e6 == x)

    bounds = lists.agg(
        F.min(F.array_min("links.b")).alias("low"),
        F.max(F.array_max("links.b")).alias("high"),
        F.bool_and(F.coalesce(F.forall("links.sim", short), F.lit(False))).alias("micro"),
        F.bool_and(F.coalesce(F.forall("links.sim", lambda x: short(x) & (x == F.floor(x))), F.lit(False))).alias("whole"),
        F.bool_or(F.exists("links.b", lambda x: x.isNull())).alias("nulls"),
        F.max(F.array_max("links.sim")).alias("most"),
        F.max(F.size("links")).alias("longest"),
    ).first()
    low, scale = int(bounds["low"] or 0), 1.0 if bounds["whole"] else 1e6 if bounds["micro"] else 0.0
    high = int(bounds["high"] or 0)
    if bounds["nulls"]:
        # One less than any other, as nulls come first.
        low -= 1
    layout = [(tp._bytes_for(0, high - low), True)]
    layout.append((tp._bytes_for(0, int(bounds["most"] * scale) + 1), True) if scale else (8, False))
    parts = int(prefs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    if seen is None:
        votes = prefs.count() * ((bounds["longest"] or 0) + 1)
    else:
        met = prefs.join(lists.select("item", F.size("links").cast("bigint").alias("size")), "item")
        votes = met.agg(F.sum("size")).first()[0] or 0
    parts = max(parts, -(-votes // at_a_time))
    packed = f"item {lists.schema['item'].dataType.simpleString()}, links binary"
    packed = lists.mapInArrow(_packer(layout, low, scale), packed)
    rows = prefs.filter(F.col("item").isNotNull()).join(packed, "item", "left")
    rows = rows.select(F.col("user").cast("bigint"), F.col("item").cast("bigint"), F.col("weight").cast("double"), "links", F.lit(seen is None).alias("has"))
    if seen is not None:
        has = seen.filter(F.col("user").isNotNull() & F.col("item").isNotNull())
        has = has.select(F.col("user").cast("bigint"), F.col("item").cast("bigint"))
        nothing = [F.lit(None).cast(t).alias(c) for c, t in (("weight", "double"), ("links", "binary"))]
        rows = rows.unionByName(has.select("*", *nothing, F.lit(True).alias("has")))
    user, item = prefs.schema["user"].dataType, links.schema["b"].dataType
    found = F.when(F.col("item") != low, F.col("item")) if bounds["nulls"] else F.col("item")
    return (
        rows.mapInArrow(_sender(layout, parts), _SENT)
        .repartitionById(parts, F.col("pid"))
        .mapInArrow(_voter(layout, low, scale, n, at_a_time), _BEST)
        .select("user", F.inline("best"))
        .select(F.col("user").cast(user).alias("user"), found.cast(item).alias("item"), "score", "rank")
    )


# Tasks get this module's functions by value, so workers need not have the package installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
