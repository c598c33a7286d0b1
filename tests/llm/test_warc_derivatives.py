import base64
import hashlib
import time
from html.parser import HTMLParser

import pytest
from odd_tables import PAGES

from tastemill.llm import warc_derivatives as warc
from tastemill.sources.tables import read_table


def fields(headers):
    lines = headers.split("\r\n")
    return lines[0], dict(x.split(": ", 1) for x in lines[1:] if x)


def check(rows, found):
    by_page = {}
    for r in found:
        by_page.setdefault(r.page_id, []).append(r)
    for page_id, url, html in rows:
        payload = (html or "").encode()
        http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n"
        sha1 = lambda b: "sha1:" + base64.b32encode(hashlib.sha1(b).digest()).decode()
        records = {r.warc_type: r for r in by_page[page_id]}
        assert set(records) == {"metadata", "conversion"}
        told = dict(x.split(": ", 1) for x in records["metadata"].block.split("\r\n") if ": " in x)
        for r in records.values():
            version, head = fields(r.headers)
            assert version == warc.VERSION and head["WARC-Type"] == r.warc_type
            assert head["WARC-Record-ID"] == r.record_id != r.refers_to == head["WARC-Refers-To"]
            assert r.refers_to == told["source-warc-record-id"]
            assert head["Content-Length"] == str(len(r.block.encode())) == str(r.content_length)
            assert head["WARC-Block-Digest"] == r.block_digest == sha1(r.block.encode())
            assert r.source_digest == sha1(payload) == told["source-warc-payload-digest"]
        assert told["source-warc-block-digest"] == sha1(http.encode() + payload)
        assert told["via-conversion"] == records["conversion"].record_id
        assert told["source-http-content-type"] == "text/html; charset=utf-8"
        assert records["conversion"].block == warc.plain_text(html or "")


def test_records_of_the_table(spark):
    pages = read_table(spark, "/root/testdata/sf0.001", "pages")
    found = warc.derivatives(pages).collect()
    check([tuple(r) for r in pages.collect()], found)
    assert len({r.record_id for r in found}) == len(found) == 2 * pages.count()


def test_plain_text():
    page = "<title>a &amp; b</title><script>x<p></script><!-- <p>no --><p>one <b>two</b><br>three<style>p{}</style></p>4 < 5"
    assert warc.plain_text(page) == "a & b\none two\nthree\n4 < 5"
    assert warc.plain_text("") == ""


def test_files_read_back(spark, tmp_path):
    rows = [(i, f"http://x/{i}", f"<p>text {i}\r\n\r\n<p>more é") for i in range(50)]
    made = warc.derivatives(spark.createDataFrame(rows, PAGES))
    for compression in ("none", "gzip"):
        path = str(tmp_path / compression)
        warc.write_warc(made, path, compression)
        back = warc.read_warc(spark, path).collect()
        assert all(r.whole for r in back)
        assert sorted((r.headers, r.block) for r in back) == sorted((r.headers, r.block) for r in made.collect())


def test_odd_rows(spark):
    rows = [(1, None, None), (None, "u", ""), (3, "v\r\nX: y", "<p>a" + " b" * 100_000)]
    frame = spark.createDataFrame([(*r, "x") for r in rows + rows[:1]], PAGES + ", record_id string")
    found = warc.derivatives(frame).collect()
    assert len(found) == 8
    ids = [r.record_id for r in found]
    assert len(set(ids)) == 6  # the repeated row gives the same records
    assert all("\r\n\r\n" not in r.headers for r in found)
    assert warc.derivatives(spark.createDataFrame([], PAGES)).count() == 0


class _Text(HTMLParser):
    """Another way to the plain text, for pages without broken markup."""

    silent = ("script", "style", "template", "noscript")
    blocks = ("p div br li ul ol h1 h2 h3 h4 h5 h6 tr table article section nav header footer main aside title head "
              "body html").split()  # fmt: skip

    def __init__(self):
        super().__init__()
        self.parts, self.deep = [], 0

    def handle_starttag(self, tag, attrs):
        self.deep += tag in self.silent
        self.parts.append("\n" if tag in self.blocks else "")

    def handle_endtag(self, tag):
        self.deep -= tag in self.silent
        self.parts.append(" " if tag in self.silent else "\n" if tag in self.blocks else "")

    def handle_decl(self, decl):
        self.parts.append("\n")

    def handle_comment(self, data):
        self.parts.append(" ")

    def handle_data(self, data):
        if not self.deep:
            self.parts.append(data)


def other_text(page):
    parser = _Text()
    parser.feed(page)
    parser.close()
    lines = (" ".join(x.split()) for x in "".join(parser.parts).split("\n"))
    return "\n".join(x for x in lines if x)


def test_conversion_text_of_the_table(spark):
    pages = read_table(spark, "/root/testdata/sf0.01", "pages")
    html = {r.page_id: r.html for r in pages.collect()}
    found = warc.derivatives(pages).filter("warc_type = 'conversion'").collect()
    assert len(found) == len(html)
    for r in found:
        assert r.block == other_text(html[r.page_id])


@pytest.mark.parametrize("bit", ["<script>", "<!--", "<p ", "<title>", "<html ", "<style>a</style ", "<noscript><!-- "])
def test_broken_markup_takes_time_in_proportion(bit):
    start = time.time()
    for end in ("", ">", "x<p>y"):
        page = bit * (1_000_000 // len(bit)) + end
        warc.plain_text(page)
        warc.title_and_language(page)
    assert time.time() - start < 10


def test_records_from_a_file_keep_their_source(spark, tmp_path):
    rows = []
    for i in range(40):
        payload = f"<html lang=fr><title>T{i}</title><p>un\r\n\r\ndeux {i}"
        block = f"HTTP/1.1 404 Not Found\r\nServer: mill\r\nX-Twice: a\r\nX-Twice: b\r\n\r\n{payload}"
        kind = "request" if i % 4 == 3 else "response"
        headers = (
            f"WARC/1.1\r\nwarc-type: {kind}\r\nWARC-Record-ID: <urn:uuid:{i}>\r\nWARC-Target-URI: http://x/{i}\r\n"
            f"WARC-Date: 2024-05-0{i % 9 + 1}T00:00:00Z\r\nWARC-IP-Address: 192.0.2.{i}\r\n"
            f"WARC-Payload-Digest: sha1:GIVEN{i}\r\nContent-Length: {len(block.encode())}\r\n"
        )
        rows.append((headers, block))
    path = str(tmp_path / "source")
    warc.write_warc(spark.createDataFrame(rows, "headers string, block string").repartition(3), path)
    found = warc.derivatives_of(warc.read_warc(spark, path)).collect()
    assert len(found) == 2 * 30
    by_source = {}
    for r in found:
        by_source.setdefault(r.refers_to, {})[r.warc_type] = r
    for i in [i for i in range(40) if i % 4 != 3]:
        records = by_source[f"<urn:uuid:{i}>"]
        told = records["metadata"].block.split("\r\n")
        for line in (
            f"source-warc-ip-address: 192.0.2.{i}", f"source-warc-payload-digest: sha1:GIVEN{i}", "source-http-server: mill",
            "source-http-x-twice: a", "source-http-x-twice: b", f"title: T{i}", "language: fr",
            f"source-warc-date: 2024-05-0{i % 9 + 1}T00:00:00Z",
        ):
            assert line in told
        assert records["conversion"].block == f"T{i}\nun\ndeux {i}"
        for r in records.values():
            assert r.target_uri == f"http://x/{i}" and r.source_digest == f"sha1:GIVEN{i}"
            assert f"WARC-Refers-To-Date: 2024-05-0{i % 9 + 1}T00:00:00Z" in r.headers


def test_records_that_say_little(spark):
    rows = [("WARC/1.1\r\nWARC-Type: response\r\n", "plain body"), ("WARC/1.1\r\n", "x"), (None, None), ("", "")]
    found = warc.derivatives_of(spark.createDataFrame(rows, "headers string, block string")).collect()
    assert {r.warc_type: r.refers_to for r in found}.keys() == {"metadata", "conversion"}
    assert all(r.source_digest == warc.digest(b"plain body") for r in found)
