"""Best partners of every member by what its pairs share, without rows for the pairs.

A group's members travel as packed lists, one for each member and group (or
chunk of one); the lists for one task go as one compressed row. Where the lists
of a member meet they are sorted, added up, scored and cut to the best k in
arrays, so neither a shuffle nor an aggregate ever holds a pair. Tasks open a
fixed number of entries at a time, whatever the input.
"""

from __future__ import annotations

import sys
from collections.abc import Callable, Iterator, Mapping, Sequence

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tastemill.functions.exact import LIMB
from tastemill.functions.pairs import CELL
from tastemill.functions.ranked import top_per
from tastemill.session import write_stage

#: Entries of lists that a task takes in at a time, and has in all on average.
ENTRIES = 1 << 21
#: Bytes of lists that are sent in one batch.
SENT = 1 << 25
#: Entries of lists that are sent in one batch, a list at least.
LOT = 1 << 23
#: Entries that are sorted and scored at a time, a member's part at least: few enough to stay in a core's cache.
BLOCK = 1 << 16


class SqlMaths:
    """What scores and terms are made of, on columns."""

    sqrt, ln, power = staticmethod(F.sqrt), staticmethod(F.ln), staticmethod(F.pow)

    @staticmethod
    def where(condition, yes, no):
        return F.when(condition, yes).otherwise(no)

    @staticmethod
    def positive(x):
        return F.greatest(F.lit(0.0), x)

    @staticmethod
    def number(x):
        return F.lit(float(x))


class ArrayMaths:
    """The same on arrays; a null is a NaN."""

    sqrt, ln, power, where = staticmethod(np.sqrt), staticmethod(np.log), staticmethod(np.power), staticmethod(np.where)

    @staticmethod
    def positive(x):
        return np.fmax(0.0, x)

    @staticmethod
    def number(x):
        return float(x)


def _exact_sums(term: np.ndarray, scale: float, starts: np.ndarray) -> np.ndarray:
    """``exact.exact_sum`` of the runs that begin at ``starts``."""
    scaled = term * scale + 0.5
    null = np.isnan(scaled)
    some_null = bool(null.any())
    if some_null:
        scaled = np.where(null, 0.5, scaled)
    largest = float(np.abs(scaled).max())
    if largest >= float(1 << 80):
        raise ValueError("a term is out of the range of an exact sum")
    if largest * len(scaled) < float(1 << 62):
        total = np.add.reduceat(np.floor(scaled).astype(np.int64), starts).astype(np.float64)
    else:
        whole = np.array([int(np.floor(x)) for x in scaled], dtype=object)
        sums = np.add.reduceat(whole, starts)
        if any(abs(t) >= LIMB << 63 for t in sums):
            raise ValueError("an exact sum is out of range")
        total = np.array([float(t) for t in sums])
    if some_null:
        total[np.add.reduceat((~null).astype(np.int64), starts) == 0] = np.nan
    return total / scale


def _rounded(value: np.ndarray) -> np.ndarray:
    """``exact.round6``."""
    return np.where(np.abs(value) < 9e9, np.floor(value * 1e6 + 0.5) / 1e6, value)


def _pack(columns: list[np.ndarray], layout: list[tuple[int, bool]]) -> np.ndarray:
    """One record of bytes for each entry: whole numbers in the bytes they need, others as doubles."""
    out = np.empty((len(columns[0]), sum(w for w, _ in layout)), np.uint8)
    at = 0
    for column, (width, whole) in zip(columns, layout):
        flat = np.ascontiguousarray(column.astype("<i8" if whole else "<f8"))
        out[:, at : at + width] = flat.view(np.uint8).reshape(-1, 8)[:, :width]
        at += width
    return out


def _unpack(records: np.ndarray, at: int, width: int, whole: bool) -> np.ndarray:
    wide = np.zeros((len(records), 8), np.uint8)
    wide[:, :width] = records[:, at : at + width]
    return wide.reshape(-1).view("<i8" if whole else "<f8")


def _planes(columns: list[np.ndarray], layout: list[tuple[int, bool]]) -> np.ndarray:
    """One row for each byte of an entry: whole numbers in the bytes they need, others as doubles."""
    out = np.empty((sum(w for w, _ in layout), len(columns[0])), np.uint8)
    at = 0
    for column, (width, whole) in zip(columns, layout):
        flat = np.ascontiguousarray(column.astype("<i8" if whole else "<f8"))
        out[at : at + width] = flat.view(np.uint8).reshape(-1, 8)[:, :width].T
        at += width
    return out


def _column(planes: np.ndarray, width: int, whole: bool) -> np.ndarray:
    wide = np.zeros((planes.shape[1], 8), np.uint8)
    for i in range(width):
        wide[:, i] = planes[i]
    return wide.reshape(-1).view("<i8" if whole else "<f8")


def _columns(planes: np.ndarray, layout: list[tuple[int, bool]]) -> list[np.ndarray]:
    ends = np.cumsum([w for w, _ in layout]).tolist()
    return [_column(planes[end - w : end], w, whole) for end, (w, whole) in zip(ends, layout)]


def _ranges(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The places of runs, one run after the other."""
    return np.repeat(starts - np.cumsum(lengths) + lengths, lengths) + np.arange(lengths.sum())


def _steps(values: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Each value less the one before it in its run; the first ones stay."""
    steps = values.copy()
    steps[1:] -= values[:-1]
    steps[starts] = values[starts]
    return steps


def _added_up(steps: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The values of ``_steps``; numbers wrap around there and back."""
    total = np.cumsum(steps)
    full = lengths[lengths > 0]
    first = np.cumsum(full) - full
    return total - np.repeat(total[first] - steps[first], full)


def _mixed(x: np.ndarray) -> np.ndarray:
    x = x.astype(np.uint64)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _part(members: np.ndarray, salts) -> np.ndarray:
    mixed = (members.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(33)
    return (mixed % np.asarray(salts).astype(np.uint64)).astype(np.int32)


def _place(a: np.ndarray, part: np.ndarray) -> np.ndarray:
    """Where the lists of (a, part) meet: this modulo the tasks."""
    return _mixed(_mixed(a) + part.astype(np.uint64)) >> np.uint64(1)


#: (tasks' number, lists, entries, the packed lists; pairs that are asked for)
_SENT = "pid int, lists bigint, entries bigint, packed binary, a array<bigint>, part array<int>, b array<bigint>"
_SENT_NAMES = ["pid", "lists", "entries", "packed", "a", "part", "b"]


def _picked(planes: np.ndarray, at: np.ndarray) -> np.ndarray:
    """``planes[:, at]``, row by row."""
    out = np.empty((len(planes), len(at)), np.uint8)
    for i, plane in enumerate(planes):
        np.take(plane, at, out=out[i])
    return out


def _runs(sorted_: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    first = np.flatnonzero(np.r_[True, sorted_[1:] != sorted_[:-1]])
    return first, np.r_[first[1:], len(sorted_)]


def _blocks(code: np.ndarray, lengths: np.ndarray) -> tuple[list[int], list[int]]:
    """Runs of lists (sorted by code) of about ``BLOCK`` entries; those of a code stay together."""
    begins = np.cumsum(lengths) - lengths
    first, _ = _runs(code)
    kept = np.flatnonzero(np.r_[True, np.diff(begins[first] // BLOCK) > 0])
    first = first[kept]
    return first.tolist(), [*first[1:].tolist(), len(code)]


def _asker(parts: int):
    """(a, b, salts) -> the pairs, to where the part of ``a`` that meets ``b`` is."""

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            a, b, salts = (c.to_numpy() for c in batch.columns)
            part = _part(b, salts)
            pid = (_place(a, part) % np.uint64(parts)).astype(np.int32)
            order = np.argsort(pid, kind="stable")
            first, _ = _runs(pid[order])
            offsets = pa.array(np.r_[first, len(order)].astype(np.int32))
            none = np.zeros(len(first), np.int64)
            columns = [pa.array(pid[order[first]]), pa.array(none), pa.array(none), pa.nulls(len(first), pa.binary())]
            columns += [pa.ListArray.from_arrays(offsets, pa.array(c[order])) for c in (a, part, b)]
            yield pa.RecordBatch.from_arrays(columns, names=_SENT_NAMES)

    return ask


def _headers(layout: list[tuple[int, bool]], n_shared: int) -> list[tuple[int, bool]]:
    """What comes before the entries of a list: its member with its values, part, length and the group's values."""
    return [(8, True), *layout[1:], (4, True), (4, True), *[(8, False)] * n_shared]


def _sender(layout: list[tuple[int, bool]], n_fields: int, low: int, parts: int, twice: bool, half: bool = False):
    """(x, [y,] shared...) -> the list ``y`` (``x`` if not given) for every member of ``x``.

    Lists for one task go together, member by member in steps, byte plane by byte plane, compressed.
    A list is as steps from ``low``; with ``half`` it holds larger members only, as steps from its own.
    """
    width = sum(w for w, _ in layout)

    def lists(column):
        offsets = column.offsets.to_numpy().astype(np.int64)
        return offsets - offsets[0], column.flatten()

    def entries(theirs, fields, starts, base=low):
        return _planes([_steps(theirs - base, starts), *fields], layout)

    def lots(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Small batches together, so that a task's lists compress well."""
        held, size = [], 0
        for batch in batches:
            x_at, y_at = lists(batch.column(0))[0], lists(batch.column(1 if twice else 0))[0]
            held.append(batch)
            size += int((np.diff(x_at) * np.diff(y_at)).sum())
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
            x_at, x = lists(batch.column(0))
            y_at, y = lists(batch.column(1)) if twice else (x_at, x)
            members, salts = x.field(0).to_numpy(), x.field(1).to_numpy()
            own = [x.field(2 + i).to_numpy(zero_copy_only=False) for i in range(n_fields)]
            of = 2 if twice else 1
            shared = [batch.column(i).to_numpy(zero_copy_only=False) for i in range(of, batch.num_columns)]
            header = _headers(layout, len(shared))
            theirs = y.field(0).to_numpy()
            order = np.lexsort((theirs, np.repeat(np.arange(len(y_at) - 1), np.diff(y_at))))
            theirs = theirs[order]
            fields = [y.field(2 + i).to_numpy(zero_copy_only=False)[order] for i in range(n_fields)]
            pool = entries(theirs, fields, y_at[:-1][np.diff(y_at) > 0])
            if half and not twice:
                # Where a member stands in the sorted pool; what follows there is its list.
                stands = np.empty(len(order), np.int64)
                stands[order] = np.arange(len(order))
            sent = np.cumsum(np.diff(x_at) * np.diff(y_at))
            begin = 0
            while begin < batch.num_rows:
                before = sent[begin - 1] if begin else 0
                end = max(begin + 1, int(np.searchsorted(sent, before + LOT, "right")))
                group = np.repeat(np.arange(begin, end), np.diff(x_at[begin : end + 1]))
                place = np.arange(x_at[begin], x_at[end])
                light = np.zeros(len(place), bool) if half and twice else salts[place] == 1
                pools, at = [pool[:, y_at[begin] : y_at[end]]], y_at[end] - y_at[begin]
                g, p = [group[light]], [place[light]]
                from_ = stands[p[0]] + 1 if half and not twice else y_at[g[0]]
                part, start, length = [np.zeros(len(g[0]), np.int32)], [from_ - y_at[begin]], [y_at[g[0] + 1] - from_]
                for gi, pi in zip(group[~light].tolist(), place[~light].tolist()):
                    # A member of very many groups is shared out by a hash of the other member.
                    mine = slice(y_at[gi], y_at[gi + 1])
                    if half:
                        mine = slice(mine.start + int(np.searchsorted(theirs[mine], members[pi], "right")), mine.stop)
                        if mine.start == mine.stop:
                            continue
                    parted = _part(theirs[mine], salts[pi])
                    by = np.argsort(parted, kind="stable")
                    first, last = _runs(parted[by])
                    base = members[pi] if half else low
                    pools.append(entries(theirs[mine][by], [f[mine][by] for f in fields], first, base))
                    g.append(np.full(len(first), gi))
                    p.append(np.full(len(first), pi))
                    part.append(parted[by][first])
                    start.append(at + first)
                    length.append(last - first)
                    at += len(by)
                g, p, part, start, length = (np.concatenate(c) for c in (g, p, part, start, length))
                used = np.concatenate(pools, axis=1) if len(pools) > 1 else pools[0]
                begin = end
                if half:
                    some = length > 0
                    g, p, part, start, length = (c[some] for c in (g, p, part, start, length))
                if not len(g):
                    continue
                pid = (_place(members[p], part) % np.uint64(parts)).astype(np.int32)
                order = np.argsort(pid, kind="stable")
                pid, g, p, part, start, length = (c[order] for c in (pid, g, p, part, start, length))
                heads = _planes([members[p], *[c[p] for c in own], part, length, *[c[g] for c in shared]], header)
                body = _picked(used, _ranges(start, length))
                first, last = _runs(pid)
                ends = np.r_[0, np.cumsum(length)]
                packed = [
                    codec.compress(np.r_[heads[:, f:t].ravel(), body[:, ends[f] : ends[t]].ravel()], asbytes=True)
                    for f, t in zip(first.tolist(), last.tolist())
                ]
                columns = [pa.array(pid[first]), pa.array(last - first), pa.array(ends[last] - ends[first]), pa.array(packed, pa.binary())]
                columns += [pa.nulls(len(first), pa.list_(t)) for t in (pa.int64(), pa.int32(), pa.int64())]
                yield pa.RecordBatch.from_arrays(columns, names=_SENT_NAMES)

    return send


def _best(score: np.ndarray, code: np.ndarray, k: int) -> np.ndarray:
    """Places of the k best scores of each code, best first; codes are sorted, ties go to the earlier place."""
    first = np.flatnonzero(np.r_[True, code[1:] != code[:-1]])
    last = np.r_[first[1:], len(code)]
    kept = np.ones(len(code), bool)
    for lo, hi in zip(first.tolist(), last.tolist()):
        if hi - lo > k:
            part = score[lo:hi]
            kept[lo:hi] = part >= np.partition(part, hi - lo - k)[hi - lo - k]
    at = np.flatnonzero(kept)
    at = at[np.lexsort((-score[at], code[at]))]
    run = np.flatnonzero(np.r_[True, code[at[1:]] != code[at[:-1]]])
    rank = np.arange(len(at)) - np.repeat(run, np.diff(np.r_[run, len(at)]))
    return at[rank < k]


def _codes(a: np.ndarray, part: np.ndarray) -> np.ndarray:
    """The same number for equal (a, part) only."""
    order = np.lexsort((part, a))
    a, part = a[order], part[order]
    code = np.empty(len(order), np.int64)
    code[order] = np.cumsum(np.r_[0, (a[1:] != a[:-1]) | (part[1:] != part[:-1])])
    return code


def _meeting(layout, low, parts, values, fixed, shared, sums, score, keep, directed, totals, k, entries, among_, half=False):
    """Packed lists -> the k best (a, b, k, score) of each (a, part), or all without ``k``."""
    fields = [*values, *fixed]
    width = sum(w for w, _ in layout)
    ats = np.cumsum([0, *[w for w, _ in layout]])
    header = _headers(layout, len(shared))
    head = sum(w for w, _ in header)
    maths = ArrayMaths

    def among(key, b, codes, wanted):
        """Which of the pairs (key, b) are wanted; both sorted alike."""
        low, span = int(b.min()), int(b.max() - b.min()).bit_length()
        inside = (wanted >= low) & (wanted <= int(b.max()))
        codes, wanted = codes[inside], wanted[inside]
        if span + int(key[-1]).bit_length() <= 62:
            return np.isin((key << span) | (b - low), (codes << span) | (wanted - low))
        both = set(zip(codes.tolist(), wanted.tolist()))
        return np.array([x in both for x in zip(key.tolist(), b.tolist())], bool)

    def fold(a, code, lengths, other, body, own, common, asked):
        row = np.repeat(np.arange(len(a)), lengths)
        apart = np.flatnonzero(other != np.repeat(a, lengths))
        if not len(apart):
            return None
        row, b = row[apart], other[apart]
        key, least = code[row], int(b.min())
        place, span = len(apart).bit_length(), (int(b.max()) - least).bit_length()
        if place + span + int(code.max()).bit_length() <= 62:
            # Code, member and place in one number: it is sorted, not its places.
            packed = (((key << span) | (b - least)) << place) | np.arange(len(apart))
            packed.sort()
            order = packed & ((1 << place) - 1)
            packed >>= place
            starts = np.flatnonzero(np.r_[True, packed[1:] != packed[:-1]])
        else:
            order = np.lexsort((b, key))
            key_, b_ = key[order], b[order]
            starts = np.flatnonzero(np.r_[True, (b_[1:] != b_[:-1]) | (key_[1:] != key_[:-1])])
        at, row = apart[order], row[order]
        first = order[starts]
        key, b = key[first], b[first]
        known = {"k": np.diff(np.r_[starts, len(at)])}
        each = {}
        if sums:
            for i, v in enumerate(values):
                theirs = _column(body[ats[1 + i] :], *layout[1 + i])[at]
                each[f"{v}_a"], each[f"{v}_b"] = own[i][row], theirs.astype(np.float64)
            each.update({v: common[i][row] for i, v in enumerate(shared)})
            for name, (term, scale) in sums.items():
                known[name] = _exact_sums(term(each), scale, starts)
        if asked is not None:
            # Only these pairs are scored.
            hit = np.flatnonzero(among(key, b, *asked))
            if not len(hit):
                return None
            known = {name: x[hit] for name, x in known.items()}
            starts, key, b = starts[hit], key[hit], b[hit]
        row, at = row[starts], at[starts]
        a_, b_ = a[row], b
        for i, v in enumerate(fields):
            if v in fixed:
                mine = own[i][row]
                theirs = _column(_picked(body[ats[1 + i] : ats[2 + i]], at), *layout[1 + i]).astype(np.float64)
                if not directed:
                    # In one order for both directions, so that both round alike.
                    mine, theirs = np.where(a_ < b_, mine, theirs), np.where(a_ < b_, theirs, mine)
                known[f"{v}_a"], known[f"{v}_b"] = mine, theirs
        known.update(totals)
        number = _rounded(score(known, maths))
        if keep is not None:
            kept = np.flatnonzero(keep(known))
            if not len(kept):
                return None
            a_, b_, key, number, known["k"] = a_[kept], b_[kept], key[kept], number[kept], known["k"][kept]
        null = np.isnan(number)
        every = asked is not None or k is None
        best = np.arange(len(number)) if every else _best(np.where(null, -np.inf, number), key, k)
        return pa.RecordBatch.from_arrays(
            [
                pa.array(a_[best]),
                pa.array(b_[best]),
                pa.array(known["k"][best].astype(np.int64)),
                pa.array(number[best], mask=null[best]),
            ],
            names=["a", "b", "k", "score"],
        )

    def folded(rows, wanted, share, shares):
        """The lists of one share of the members, by a hash; packed lists are opened again for each share."""
        codec = pa.Codec("zstd")
        heads, bodies = [], []
        for n, m, packed in rows:
            raw = np.frombuffer(codec.decompress(packed, n * head + m * width, asbytes=True), np.uint8)
            opened, body = raw[: n * head].reshape(head, n), raw[n * head :].reshape(width, m)
            if shares > 1:
                columns = _columns(opened, header)
                mine = np.flatnonzero(_place(columns[0], columns[len(layout)]) // np.uint64(parts) % np.uint64(shares) == share)
                length = columns[len(layout) + 1]
                body = _picked(body, _ranges((np.cumsum(length) - length)[mine], length[mine]))
                opened = opened[:, mine]
            heads.append(opened)
            bodies.append(body)
        columns = _columns(np.concatenate(heads, axis=1), header)
        body = np.concatenate(bodies, axis=1)
        a, part, lengths = columns[0], columns[len(layout)], columns[len(layout) + 1]
        if not len(a):
            return
        own = [c.astype(np.float64) for c in columns[1 : len(layout)]]
        common = columns[len(layout) + 2 :]
        if wanted is None:
            code = _codes(a, part)
        else:
            code = _codes(np.r_[a, wanted[0]], np.r_[part, wanted[1]])
            code, asked = code[: len(a)], code[len(a) :]
            by = np.argsort(asked, kind="stable")
            asked, wanted_b = asked[by], wanted[2][by]
        # Whole (a, part), a block at a time.
        order = np.argsort(code, kind="stable")
        at = (np.cumsum(lengths) - lengths)[order]
        a, code, lengths, own, common = a[order], code[order], lengths[order], [c[order] for c in own], [c[order] for c in common]
        for first, last in zip(*_blocks(code, lengths)):
            now = slice(first, last)
            mine = _picked(body, _ranges(at[now], lengths[now]))
            other = _added_up(_column(mine, *layout[0]), lengths[now]) + (np.repeat(a[now], lengths[now]) if half else low)
            here = None
            if wanted is not None:
                from_, to = np.searchsorted(asked, code[first]), np.searchsorted(asked, code[last - 1], "right")
                if from_ == to:
                    continue
                here = asked[from_:to], wanted_b[from_:to]
            with np.errstate(all="ignore"):
                out = fold(a[now], code[now], lengths[now], other, mine, [c[now] for c in own], [c[now] for c in common], here)
            if out is not None:
                yield out

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows, asked = [], []
        for batch in batches:
            lists, counts, packed = (batch.column(i) for i in (1, 2, 3))
            rows += [x for x in zip(lists.to_pylist(), counts.to_pylist(), packed.to_pylist()) if x[0]]
            asked.append([batch.column(i).flatten().to_numpy() for i in (4, 5, 6)])
        wanted = [np.concatenate(c) for c in zip(*asked)] if among_ and asked else None
        shares = max(1, -(-sum(m for _, m, _ in rows) // (2 * entries)))
        for share in range(shares if rows else 0):
            yield from folded(rows, wanted, share, shares)

    return meet


def _bytes_for(low, high) -> int:
    """Bytes for whole numbers from low to high."""
    return 8 if low < 0 else max(1, (int(high).bit_length() + 7) // 8)


def top_pairs(
    rows: DataFrame,
    group: str,
    member: str,
    k: int | None,
    score: Callable,
    sums: Mapping[str, tuple[Callable, float]] | None = None,
    values: Sequence[str] = (),
    fixed: Sequence[str] = (),
    shared: Sequence[str] = (),
    keep: Callable | None = None,
    directed: bool = False,
    totals: Mapping[str, float] | None = None,
    cell: int = CELL,
    entries: int = ENTRIES,
    among: DataFrame | None = None,
    half: bool = False,
) -> DataFrame:
    """(a, b, k, score, rank): for every member the best k others it shares a group with.

    ``rows`` must be unique in (group, member); members are whole numbers. Of a
    row come ``values``, of its member ``fixed``, of its group ``shared`` values.
    ``sums`` are exact sums over the shared groups of term(v), where v holds
    ``<value>_a``, ``<value>_b`` and the shared values; ``score(v, maths)`` and
    ``keep(v)`` see these sums, ``k`` (the shared groups), ``<fixed>_a``,
    ``<fixed>_b`` and ``totals``. Unless ``directed``, a and b stand in one order
    for both directions of a pair. Rows of a null group or member have no pairs.

    A group above ``cell`` rows is cut as in ``pairs.shared_pairs``, a member of
    more than ``cell`` groups has several parts as in ``pairs.directed_pairs``.

    With ``among`` the result is (a, b, k, score) of its pairs (a, b) that share
    a group, all of them: they are sent to where the lists of ``a`` meet.

    With ``half`` only pairs a < b are made, and lists hold only larger members
    than their own, so about half as much is sent. Then ``k`` may be None: the
    result is (a, b, k, score) of all pairs.
    """
    if k is None and not half:
        raise ValueError("all pairs are made once each: they need ``half``")
    spark, kind = rows.sparkSession, rows.schema[member].dataType
    fields = [*values, *fixed]
    doubles = [F.col(c).cast("double").alias(c) for c in (*fields, *shared)]
    base = write_stage(
        rows.filter(F.col(group).isNotNull() & F.col(member).isNotNull()).select(
            group, F.col(member).cast("bigint").alias(member), *doubles
        ),
        "members",
    )
    sizes = write_stage(base.groupBy(group).agg(F.count(F.lit(1)).alias("_size")), "sizes")
    chunks = F.ceil(F.col("_size") / F.lit(cell)).cast("int")
    large = sizes.filter(F.col("_size") > cell).select(group, chunks.alias("_chunks"))
    heavy = write_stage(
        base.groupBy(member)
        .agg(F.count(F.lit(1)).alias("_in"))
        .filter(F.col("_in") > cell)
        .select(member, F.ceil(F.col("_in") / F.lit(cell)).cast("int").alias("_salts")),
        "heavy",
    )
    met = sizes.agg(
        F.sum(F.col("_size").cast("double") * F.col("_size")).alias("met"), F.max("_size").alias("most")
    ).first()
    whole = [
        F.bool_and(F.col(f).isNotNull() & (F.col(f) >= 0) & (F.col(f) < 2.0**53) & (F.col(f) == F.floor(f))).alias(f"w{i}")
        for i, f in enumerate(fields)
    ]
    range_ = base.agg(
        F.coalesce(F.min(member), F.lit(0)).alias("low"),
        F.coalesce(F.max(member), F.lit(0)).alias("high"),
        *whole,
        *[F.max(f).alias(f"h{i}") for i, f in enumerate(fields)],
    ).first()
    layout = [(_bytes_for(0, range_["high"] - range_["low"]), True)]
    layout += [
        (_bytes_for(0, int(range_[f"h{i}"])), True) if range_[f"w{i}"] else (8, False) for i in range(len(fields))
    ]
    sent_in_all = int(met["met"] or 0) // (2 if half else 1)
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-sent_in_all // entries))
    salted = base.join(heavy, member, "left").withColumn("_salts", F.coalesce("_salts", F.lit(1)))
    one = F.struct(F.col(member).alias("m"), F.col("_salts"), *[F.col(f).alias(f"f{i}") for i, f in enumerate(fields)])
    of_group = [F.max(c).alias(c) for c in shared]
    lists = F.collect_list(one)
    if (met["most"] or 0) <= cell:
        whole_groups = salted.groupBy(group).agg(lists.alias("x"), *of_group)
    else:
        whole_groups = salted.join(large, group, "left_anti").groupBy(group).agg(lists.alias("x"), *of_group)
    sender = dict(layout=layout, n_fields=len(fields), low=range_["low"], parts=parts, half=half)
    sent = whole_groups.filter(F.size("x") > 1).select("x", *shared).mapInArrow(_sender(**sender, twice=False), _SENT)
    if (met["most"] or 0) > cell:
        # Chunks of the large groups, each met with each.
        chunked = write_stage(
            salted.join(large, group)
            .groupBy(group, F.pmod(F.xxhash64(member), F.col("_chunks")).cast("int").alias("_chunk"), "_chunks")
            .agg(lists.alias("list"), *of_group),
            "chunks",
        )
        others = F.explode(F.sequence(F.lit(0), F.col("_chunks") - 1))
        left = chunked.select(group, F.col("_chunk").alias("_i"), others.alias("_j"), F.col("list").alias("x"), *shared)
        right = chunked.select(group, others.alias("_i"), F.col("_chunk").alias("_j"), F.col("list").alias("y"))
        cells = left.join(right, [group, "_i", "_j"]).select("x", "y", *shared)
        sent = sent.unionByName(cells.mapInArrow(_sender(**sender, twice=True), _SENT))
    if among is not None:
        asked = among.filter("a < b" if half else "a <> b").select(F.col("a").cast("bigint").alias("a"), F.col("b").cast("bigint").alias("b"))
        salts = F.coalesce("_salts", F.lit(1))
        asked = asked.distinct().join(heavy.withColumnRenamed(member, "a"), "a", "left").select("a", "b", salts)
        sent = sent.unionByName(asked.mapInArrow(_asker(parts), _SENT))
    meet = _meeting(
        layout,
        range_["low"],
        parts,
        list(values),
        list(fixed),
        list(shared),
        dict(sums or {}),
        score,
        keep,
        directed,
        dict(totals or {}),
        k,
        entries,
        among is not None,
        half,
    )
    best = (
        sent.repartitionById(parts, F.col("pid"))
        .mapInArrow(meet, "a bigint, b bigint, k bigint, score double")
        .select(F.col("a").cast(kind).alias("a"), F.col("b").cast(kind).alias("b"), "k", "score")
    )
    if among is not None or k is None:
        return best
    return top_per(best, ["a"], [F.desc("score"), F.asc("b")], k)


# Tasks get this module's functions by value, so workers need not have the package installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
