"""WARC derivatives: linked metadata and plain-text conversion records from responses.

Every response gives two records. The metadata record holds the source's
headers and digests as fields, the conversion record the page's plain text.
Both refer to the response by its record id, and the metadata names the
conversion. Ids are made from the source's id, so a second run gives the same.

Writing and reading use Spark's text source with the record separator of the
format, so that files land where the cluster's file system is.

``derivatives_of`` takes response records, such as ``read_warc`` reads; for tables
of pages without any, ``responses`` makes them up first.

Defined results: records that are no responses have none; null html or url counts as empty; pages that are equal in all
columns give equal records; an empty table gives no records.
"""

from __future__ import annotations

import base64
import hashlib
import html as entities
import re
import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tastemill.llm.common import map_batches, slices

VERSION = "WARC/1.1"
#: Date of records whose source has none.
NO_DATE = "1970-01-01T00:00:00Z"
_SPACE = uuid.UUID("6ba7b811-9dad-11d1-80b4-00c04fd430c8")  # fixed value: the URL name space of RFC 4122

_SILENT = re.compile(r"<!--|<(script|style|template|noscript)\b[^>]*>", re.I)
_CLOSERS = {n: re.compile(rf"</{n}\s*>", re.I) for n in ("script", "style", "template", "noscript")}
_BREAK = re.compile(
    r"</?(?:p|div|br|li|ul|ol|h[1-6]|tr|table|article|section|nav|header|footer|main|aside|title|head|body|html)"
    r"\b[^>]*>|<!doctype[^>]*>",
    re.I,
)
_TAG = re.compile(r"</?[a-z][^>]*>", re.I)
_TITLE = re.compile(r"<title\b[^>]*>", re.I)
_TITLE_END = re.compile(r"</title", re.I)
_HTML = re.compile(r"<html\b([^>]*)>", re.I)
_LANG = re.compile(r"""\blang\s*=\s*["']?([A-Za-z-]+)""", re.I)


def _told(page: str, last: int) -> str:
    """``page`` up to its last ``>``, with a space for each comment, script, style, template and noscript.

    One walk; an end that is not found is not searched for again.
    """
    out, at = [], 0
    closers, comments = dict(_CLOSERS), True
    for found in iter(lambda: _SILENT.search(page, at, last), None):
        name = (found.group(1) or "").lower()
        if name:
            end = closers[name].search(page, found.end()) if name in closers else None
            stop = end.end() if end else found.end()
            if not end:
                closers.pop(name, None)
        else:
            close = page.find("-->", found.end()) if comments else -1
            comments = close >= 0
            stop = close + 3 if comments else found.end()
        silent = bool(end) if name else comments
        out.append(page[at : found.start()] + " " if silent else page[at:stop])
        at = stop
    return "".join(out) + page[at:last]


def plain_text(page: str) -> str:
    """Text of the whole page, one line a block, without markup, scripts and styles."""
    last = page.rfind(">") + 1  # no tag ends after this
    text = _TAG.sub("", _BREAK.sub("\n", _told(page, last))) + page[last:]
    text = entities.unescape(text)
    return "\n".join(line for line in (" ".join(x.split()) for x in text.split("\n")) if line)


def title_and_language(page: str) -> tuple[str, str]:
    last = page.rfind(">") + 1
    start, html = _TITLE.search(page, 0, last), _HTML.search(page, 0, last)
    end = _TITLE_END.search(page, start.end()) if start else None
    lang = _LANG.search(html.group(1)) if html else None
    return entities.unescape(page[start.end() : end.start()]) if end else "", lang.group(1) if lang else ""


def digest(data: bytes) -> str:
    return "sha1:" + base64.b32encode(hashlib.sha1(data).digest()).decode()


def _one_line(value: str) -> str:
    return " ".join(value.split())


def record_id(*parts: str) -> str:
    return f"<urn:uuid:{uuid.uuid5(_SPACE, chr(0).join(parts))}>"


def _headers(pairs: list[tuple[str, str]]) -> str:
    return "\r\n".join([VERSION, *(f"{k}: {_one_line(v)}" for k, v in pairs)]) + "\r\n"


def response(key: str, url: str, page: str, date: str = NO_DATE) -> dict:
    """The response record of a page: its headers, the server's headers and the payload's digests."""
    payload = page.encode()
    http = (
        "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
        f"Content-Length: {len(payload)}\r\n\r\n"
    )
    block = http.encode() + payload
    head = [
        ("WARC-Type", "response"),
        ("WARC-Record-ID", record_id("response", key, url, digest(payload))),
        ("WARC-Target-URI", url),
        ("WARC-Date", date),
        ("WARC-Payload-Digest", digest(payload)),
        ("WARC-Block-Digest", digest(block)),
        ("Content-Type", "application/http;msgtype=response"),
        ("Content-Length", str(len(block))),
    ]
    return {"head": head, "http": http, "payload": page}


def derive(source: dict) -> list[dict]:
    """The metadata and the conversion record of a response."""
    head, page = dict(source["head"]), source["payload"]
    origin, text = head["WARC-Record-ID"], plain_text(page)
    content = text.encode()
    shared = [
        ("WARC-Refers-To", origin),
        ("WARC-Refers-To-Target-URI", head["WARC-Target-URI"]),
        ("WARC-Refers-To-Date", head["WARC-Date"]),
        ("WARC-Target-URI", head["WARC-Target-URI"]),
        ("WARC-Date", head["WARC-Date"]),
    ]
    conversion = record_id("conversion", origin)
    title, lang = title_and_language(page)
    fields = [
        ("via-conversion", conversion),
        ("title", title),
        ("language", lang),
        ("text-characters", str(len(text))),
    ]
    fields += [(f"source-{k.lower()}", v) for k, v in source["head"]]
    for line in source["http"].split("\r\n"):
        name, colon, value = line.partition(": ")
        if colon:
            fields.append((f"source-http-{name.lower()}", value))
    told = "".join(f"{k}: {_one_line(v)}\r\n" for k, v in fields)
    made = []
    for kind, own, media, block in (
        ("metadata", record_id("metadata", origin), "application/warc-fields", told.encode()),
        ("conversion", conversion, "text/plain; charset=utf-8", content),
    ):
        pairs = [("WARC-Type", kind), ("WARC-Record-ID", own), *shared]
        pairs += [
            ("WARC-Block-Digest", digest(block)),
            ("Content-Type", media),
            ("Content-Length", str(len(block))),
        ]
        made.append(
            {
                "warc_type": kind,
                "record_id": own,
                "refers_to": origin,
                "target_uri": head["WARC-Target-URI"],
                "source_digest": head["WARC-Payload-Digest"],
                "block_digest": digest(block),
                "content_length": len(block),
                "headers": _headers(pairs),
                "block": block.decode(),
            }
        )
    return made


_FIELDS = (
    "warc_type string, record_id string, refers_to string, target_uri string, source_digest string, "
    "block_digest string, content_length bigint, headers string, block string"
)
_NAMES = [f.split()[0] for f in _FIELDS.split(", ")]


def source_of(headers: str, block: str) -> dict | None:
    """The response that a record holds, None for records of other types.

    Headers keep their order and their repeats; folded lines are joined. What the
    record does not say is filled in: a digest of the payload, an id made from
    it, and ``NO_DATE``.
    """
    head: list[tuple[str, str]] = []
    for line in headers.split("\r\n")[1:]:
        name, colon, value = line.partition(":")
        if line[:1] in (" ", "\t") and head:
            head[-1] = (head[-1][0], f"{head[-1][1]} {line.strip()}")
        elif colon:
            head.append((name.strip(), value.strip()))
    # The names that records are linked by, however the source writes them.
    known = {n.lower(): n for n in ("WARC-Type", "WARC-Record-ID", "WARC-Target-URI", "WARC-Date", "WARC-Payload-Digest")}
    head = [(known.get(name.lower(), name), value) for name, value in head]
    said = dict(head)
    if said.get("WARC-Type", "").lower() != "response":
        return None
    http, gap, payload = block.partition("\r\n\r\n") if block.startswith("HTTP/") else ("", "", block)
    said.setdefault("WARC-Payload-Digest", digest(payload.encode()))
    said.setdefault("WARC-Target-URI", "")
    said.setdefault("WARC-Date", NO_DATE)
    said.setdefault("WARC-Record-ID", record_id("response", said["WARC-Target-URI"], said["WARC-Payload-Digest"]))
    head += [(name, value) for name, value in said.items() if name not in dict(head)]
    return {"head": head, "http": http + gap, "payload": payload}


def responses(pages: DataFrame, key: str = "page_id", date: str = NO_DATE) -> DataFrame:
    """(key, headers, block): a response record made up for each page of a table that has no records.

    The status, the two server headers and the date are not the page's own.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches):
            keys, names, urls, htmls = part.column(0), *(c.to_pylist() for c in part.columns[1:])
            made = [response(n or "", u or "", h or "", date) for n, u, h in zip(names, urls, htmls)]
            heads = pa.array([_headers(m["head"]) for m in made], pa.string())
            blocks = pa.array([m["http"] + m["payload"] for m in made], pa.string())
            yield pa.RecordBatch.from_arrays([keys, heads, blocks], names=["key", "headers", "block"])

    kind = pages.schema[key].dataType.simpleString()
    rows = pages.select(
        pages[key].alias("key"),
        pages[key].cast("string").alias("name"),
        pages["url"].cast("string").alias("url"),
        pages["html"].cast("string").alias("html"),
    )
    return map_batches(rows, run, f"key {kind}, headers string, block string").withColumnRenamed("key", key)


def derivatives_of(records: DataFrame, key: str | None = None) -> DataFrame:
    """Two records of every response in (headers, block), as ``read_warc`` gives them, with ``key`` if there is one.

    Records of other types have no derivatives.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches):
            keys, heads, blocks = (c.to_pylist() for c in part.columns)
            sources = [source_of(h or "", b or "") for h, b in zip(heads, blocks)]
            rows = [{"key": k, **record} for k, s in zip(keys, sources) if s for record in derive(s)]
            schema = pa.schema(
                [("key", part.schema.field(0).type)]
                + [(n, pa.int64() if n == "content_length" else pa.string()) for n in _NAMES]
            )
            yield pa.RecordBatch.from_pylist(rows, schema=schema)

    own = records[key] if key else F.lit(None).cast("bigint")
    rows = records.select(own.alias("key"), records["headers"].alias("headers"), records["block"].alias("block"))
    kind = rows.schema["key"].dataType.simpleString()
    made = map_batches(rows, run, f"key {kind}, {_FIELDS}")
    return made.withColumnRenamed("key", key) if key else made.drop("key")


def derivatives(pages: DataFrame, key: str = "page_id", date: str = NO_DATE) -> DataFrame:
    """Two records of every page of a table that has no records, with the page's key (see ``responses``)."""
    return derivatives_of(responses(pages, key, date), key)


def write_warc(records: DataFrame, path: str, compression: str = "none") -> None:
    """One WARC file for each partition: headers, an empty line, the block, two line ends."""
    records.select(F.concat("headers", F.lit("\r\n"), "block").alias("value")).write.option(
        "lineSep", "\r\n\r\n"
    ).option("compression", compression).text(path)


def read_warc(spark: SparkSession, path: str) -> DataFrame:
    """(headers, block, whole) of the records of files made by ``write_warc``.

    Files are split at the start of a record; ``whole`` tells whether the block has the length its header names.
    """
    start = VERSION + "\r\n"
    rows = spark.read.option("lineSep", "\r\n\r\n" + start).text(path)
    text = F.regexp_replace("value", f"^{re.escape(start)}|\r\n\r\n$", "")
    cut = F.instr(text, "\r\n\r\n")
    record = rows.select(text.alias("value"), cut.alias("cut"))
    block = F.expr("substring(value, cut + 4)")
    length = F.regexp_extract("headers", r"(?i)Content-Length: (\d+)", 1).cast("bigint")
    return record.select(F.concat(F.lit(start), F.expr("substring(value, 1, cut + 1)")).alias("headers"), block.alias("block")).withColumn(
        "whole", F.octet_length("block") == length
    )
