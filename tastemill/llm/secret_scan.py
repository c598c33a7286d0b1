"""Secret scans: multipart credential linking.

Three patterns report on their own (assignments, access ids, long hex runs).
Weaker parts (a user name, a random-looking string, an address) mean nothing
alone. They are joined, as intervals within a reach of each other in one
document, and reported only where complementary parts meet: a name or an
address beside a secret, a random string beside a name or an address.

Defined results: a null text counts as empty; an empty table gives an empty
result; repeated rows are scanned one by one; other columns are not read.
"""

from __future__ import annotations

import math
import re
from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator
from itertools import accumulate

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tastemill.llm.common import identified, numbered, per_text, slices, unused
from tastemill.session import write_stage

#: Spans are told apart by kind, in this order.
KINDS = ("assign", "access", "hex", "identity", "random", "endpoint")
#: Largest gap, in code points, between two parts of one credential.
REACH = 200
#: Intervals meet in cells of this many code points.
CELL = 256

_ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
    re.IGNORECASE | re.ASCII,
)
_ACCESS = re.compile(r"AKIA[A-Z0-9]{12,}")
_HEX = re.compile(r"[0-9a-f]{32,}")
_IDENTITY = re.compile(
    r"""(?<![A-Za-z0-9])(?:user(?:_?name)?|login|account|client_?id|key_?id)["']?\x20*[:=]\x20*["']?"""
    r"""([A-Za-z0-9._@+-]{3,})""",
    re.IGNORECASE | re.ASCII,
)
_RANDOM = re.compile(r"(?<![A-Za-z0-9+/_-])[A-Za-z0-9+/_-]{20,}={0,2}")
_ENDPOINT = re.compile(
    r"""(?<![A-Za-z0-9])(?:[a-z][a-z0-9+.-]{1,15}://[^\s"'<>]+"""
    r"""|(?:host(?:_?name)?|server|endpoint)["']?\x20*[:=]\x20*["']?[A-Za-z0-9._:-]{4,})""",
    re.IGNORECASE | re.ASCII,
)


def strong_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind number, end) of the patterns that report on their own.

    Assignments are scanned leftmost first without overlap, and only then those
    with a short value are dropped; a shorter pattern would find others.
    """
    found = [(m.start(), 0, m.end()) for m in _ASSIGN.finditer(text) if m.end(2) - m.start(2) >= 8]
    if "AKIA" in text:
        found += [(m.start(), 1, m.end()) for m in _ACCESS.finditer(text)]
    found += [(m.start(), 2, m.end()) for m in _HEX.finditer(text)]
    return sorted(found)


def _looks_random(value: str) -> bool:
    """Mixed case with digits and at least 3.5 bits a character."""
    if not (re.search("[a-z]", value) and re.search("[A-Z]", value) and re.search("[0-9]", value)):
        return False
    n = len(value)
    return -sum(c / n * math.log2(c / n) for c in Counter(value).values()) >= 3.5


def weak_spans(text: str, strong: list[tuple[int, int, int]]) -> list[tuple[int, int, int]]:
    """(start, kind number, end) of parts that count only beside their complement."""
    weak = [(m.start(), 3, m.end()) for m in _IDENTITY.finditer(text)]
    weak += [(m.start(), 5, m.end()) for m in _ENDPOINT.finditer(text)]
    taken = sorted((a, b) for a, _, b in strong + weak)
    starts = [a for a, _ in taken]
    reach = list(accumulate((b for _, b in taken), max))  # furthest end of the spans up to each
    for m in _RANDOM.finditer(text):
        before = bisect_left(starts, m.end()) - 1
        free = before < 0 or reach[before] <= m.start()
        if free and _looks_random(m.group()):
            weak.append((m.start(), 4, m.end()))
    return sorted(weak)


_SPAN = pa.struct([("start", pa.int32()), ("kind", pa.int32()), ("stop", pa.int32())])


def _spans(rows: list[list[tuple[int, int, int]]]) -> pa.Array:
    return pa.array(
        [[{"start": a, "kind": k, "stop": b} for a, k, b in row] for row in rows],
        pa.list_(_SPAN),
    )


def _scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for part in slices(batches):
        strong, weak = [], []
        for text in part.column(1).to_pylist():
            strong.append(strong_spans(text))
            weak.append(weak_spans(text, strong[-1]))
        yield pa.RecordBatch.from_arrays(
            [part.column(0), _spans(strong), _spans(weak)], names=["key", "strong", "weak"]
        )


def scan(docs: DataFrame, key: str, text: str = "text") -> DataFrame:
    """(key, strong, weak): the spans of each row, with weak candidates not yet judged."""
    spans = "array<struct<start int, kind int, stop int>>"
    rows = docs.select(docs[key].alias("key"), docs[text].alias("text"))
    return per_text(rows, "key", _scan, f"strong {spans}, weak {spans}")


def _cells(first: Column, last: Column) -> Column:
    at = [F.floor(F.greatest(x, F.lit(0)) / F.lit(CELL)).cast("int") for x in (first, last)]
    return F.explode(F.sequence(*at))


def linked(scanned: DataFrame, reach: int = REACH) -> DataFrame:
    """(key, start, kind, stop, partner_start, partner_kind): weak parts with their nearest complement.

    An interval join: each part is put into the cells it covers, each weak part
    looks into the cells within its reach. A cell holds few parts, since parts
    are several characters long, so a document full of parts spreads over many
    cells and no cell is large.
    """
    every = scanned.filter(F.size("weak") > 0)
    parts = every.select("key", F.inline(F.concat("strong", "weak")))
    secret, name = F.col("kind").isin(0, 2, 4), F.col("kind").isin(1, 3)
    parts = parts.withColumn("role", F.when(secret, 1).when(name, 2).otherwise(4))
    looking = parts.filter(F.col("kind") >= 3).select(
        "key",
        "start",
        "kind",
        "stop",
        F.when(F.col("role") == 1, 6).otherwise(1).alias("wanted"),
        _cells(F.col("start") - F.lit(reach), F.col("stop") + F.lit(reach)).alias("cell"),
    )
    there = parts.select(
        "key",
        F.col("start").alias("p_start"),
        F.col("kind").alias("p_kind"),
        F.col("stop").alias("p_stop"),
        F.col("role").alias("p_role"),
        _cells(F.col("start"), F.col("stop") - 1).alias("cell"),
    )
    gap = F.greatest(F.col("p_start") - F.col("stop"), F.col("start") - F.col("p_stop"), F.lit(0))
    return (
        looking.join(there, ["key", "cell"])
        .filter((F.col("wanted").bitwiseAND(F.col("p_role")) > 0) & (gap <= reach))
        .groupBy("key", "start", "kind", "stop")
        .agg(F.min(F.struct(gap.alias("gap"), "p_start", "p_kind")).alias("near"))
        .select(
            "key",
            "start",
            "kind",
            "stop",
            F.col("near.p_start").alias("partner_start"),
            F.col("near.p_kind").alias("partner_kind"),
        )
    )


def find_secrets(docs: DataFrame, carry: str, text: str = "text", reach: int = REACH) -> DataFrame:
    """(``carry``, strong, spans) for every row: spans are the strong ones and the linked weak ones.

    The scan is written once; only small span rows are joined after that, and
    rows without a weak candidate (nearly all) take no part in the linking.
    """
    scanned = numbered(scan(docs, carry, text), "row", "scanned")
    weak = (
        linked(scanned.select(F.col("row").alias("key"), "strong", "weak"), reach)
        .groupBy("key")
        .agg(F.collect_list(F.struct("start", "kind", "stop")).alias("more"))
    )
    spans = F.array_sort(F.when(F.col("more").isNull(), F.col("strong")).otherwise(F.concat("strong", "more")))
    return scanned.join(weak.withColumnRenamed("key", "row"), "row", "left").select(
        F.col("key").alias(carry), "strong", spans.alias("spans")
    )


def span_text(spans: Column) -> Column:
    """``kind:start:end`` of each span, comma-joined."""
    kinds = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(
        F.transform(
            spans,
            lambda s: F.concat_ws(
                ":", F.element_at(kinds, s["kind"] + 1), s["start"].cast("string"), s["stop"].cast("string")
            ),
        ),
        ",",
    )


def mask_text(text: str, starts: list[int], stops: list[int], mask: str) -> str:
    """``text`` with one ``mask`` for each stretch that spans, sorted by start, cover."""
    out, at = [], 0
    for start, stop in zip(starts, stops):
        if start > at or not out:
            out.append(text[at:start])
        at = max(at, stop)
    return mask.join([*out, text[at:]])


def masked(text: Column, spans: Column, mask: str = "[REDACTED]") -> Column:
    """``text`` with the characters of all spans replaced by one ``mask`` per covered stretch.

    Spans may overlap and must be sorted by start. Texts without spans (null or
    none) stay in the JVM; the others are cut in one pass each, however many
    spans they have.
    """

    def cut(texts: pd.Series, starts: pd.Series, stops: pd.Series) -> pd.Series:
        return pd.Series(
            [None if t is None else mask_text(t, a, b, mask) for t, a, b in zip(texts, starts, stops)], dtype=object
        )

    some = F.size(spans) > 0
    made = F.pandas_udf(cut, "string")(F.when(some, text), spans["start"], spans["stop"])
    return F.when(some, made).otherwise(text)


def redact(docs: DataFrame, row: str) -> DataFrame:
    """``docs`` with every found span masked in ``text`` and ``n_chars`` counted anew where it changed.

    ``row`` is a column that numbers the rows. Other columns stay as they are.
    """
    name = unused(docs, "secret_spans")
    found = (
        find_secrets(docs, row).filter(F.size("spans") > 0).select(F.col(row), F.col("spans").alias(name))
    )
    found = write_stage(found, "secret-spans")
    fresh = unused(docs, "masked_text")
    out = docs.join(found, row, "left").withColumn(fresh, masked(F.col("text"), F.col(name)))
    text = F.col(fresh)
    changed = F.col(name).isNotNull()
    picked = []
    for c in docs.columns:
        if c == "text":
            picked.append(F.when(changed, text).otherwise(F.col("text")).alias("text"))
        elif c == "n_chars":
            counted = F.when(changed, F.char_length(text)).otherwise(F.col("n_chars"))
            picked.append(counted.cast(docs.schema[c].dataType).alias(c))
        else:
            picked.append(F.col(f"`{c}`"))
    return out.select(*picked)


def without_secrets(docs: DataFrame) -> DataFrame:
    """``docs`` with its secrets masked; all rows and columns stay."""
    row = unused(docs, "row_of")
    return redact(identified(docs, row, "documents"), row).drop(row)
