import hashlib
import time
import random
import re

from odd_tables import documents, no_documents, odd_documents, odd_rows

from tastemill.llm import queries, secret_scan

PLAIN = {
    "assign": r"""(?ai)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
    "access": r"AKIA[A-Z0-9]+",
    "hex": r"[0-9a-f]+",
}


def plain(text):
    found = []
    for order, (kind, pattern) in enumerate(PLAIN.items()):
        for m in re.finditer(pattern, text or ""):
            long = {"assign": lambda: len(m[2]) >= 8, "access": lambda: len(m[0]) >= 16, "hex": lambda: len(m[0]) >= 32}
            if long[kind]():
                found.append((m.start(), order, m.end()))
    return sorted(found)


def test_strong_spans_equal_the_plain_patterns():
    rng = random.Random(4)
    bits = ["password", "Token", "api_key", "APIKEY", "secret", ":", "=", " ", "  ", '"', "'", "AKIA", "AKIAAKIA"]
    bits += ["ABCD1234", "0123456789abcdef", "deadbeef", "x", "é", "ſecret=abcdefghi", "==", "token:token=", "\n", "-"]
    for _ in range(5000):
        text = "".join(rng.choice(bits) for _ in range(rng.randint(0, 14)))
        assert secret_scan.strong_spans(text) == plain(text)


def spans_of(spark, *texts):
    docs = documents(spark, [(i, t, None) for i, t in enumerate(texts)])
    out = secret_scan.find_secrets(docs, "doc_id").select("doc_id", secret_scan.span_text("spans").alias("s"))
    return [r.s for r in out.orderBy("doc_id").collect()]


def test_weak_parts_count_only_beside_their_complement(spark):
    user, rand = "user=annabel", "Zk3bQ9xT7mLw2VrP8sYd"
    assert spans_of(spark, user, rand, "https://example.com/a", f"{user} at https://example.com") == [""] * 4
    pair, far, with_host, strong = spans_of(
        spark, f"{user} {rand}", user + " " * 300 + rand, f"{rand} https://h.example", f"{user} password=abcdefgh9"
    )
    assert pair == "identity:0:12,random:13:33"
    assert far == ""
    assert with_host == "random:0:20,endpoint:21:38"
    assert strong == "identity:0:12,assign:13:31"


def test_a_text_full_of_parts_is_linked_in_cells(spark):
    line = "user=annabel Zk3bQ9xT7mLw2VrP8sYd\n"
    (spans,) = spans_of(spark, line * 3000)
    assert spans.count("identity") == spans.count("random") == 3000


def test_long_parts_reach_as_intervals(spark):
    (spans,) = spans_of(spark, "user=annabel https://h.example/" + "z" * 2000 + " password=abcdefgh9")
    assert spans.startswith("endpoint:13:") and "identity" not in spans


def test_odd_rows_and_redaction(spark):
    docs = odd_documents(spark)
    found = secret_scan.find_secrets(docs, "doc_id").collect()
    assert len(found) == len(odd_rows())
    out = secret_scan.without_secrets(docs)
    assert out.columns == docs.columns and out.count() == docs.count()
    by_id = {r.doc_id: r for r in out.collect()}
    assert by_id[11].text.endswith(" [REDACTED]") and by_id[11].n_chars == len(by_id[11].text)
    assert by_id[1].text is None and by_id[6].text == odd_rows()[6][1]
    assert secret_scan.find_secrets(no_documents(spark), "doc_id").count() == 0
    assert secret_scan.without_secrets(no_documents(spark)).count() == 0


def test_overlapping_spans_are_masked_once(spark):
    hexes = hashlib.md5(b"x").hexdigest()
    docs = documents(spark, [(1, f"é token = \"{hexes}\" z {hexes}", None)])
    assert secret_scan.without_secrets(docs).first().text == 'é [REDACTED]" z [REDACTED]'


def test_masking_many_spans_takes_one_pass():
    spans = [(i * 10 + i % 7, i * 10 + i % 7 + i % 13) for i in range(200_000)]
    text = "abcdefghij" * 200_000
    covered = bytearray(len(text) + 20)
    for a, b in spans:
        covered[a:b] = b"x" * (b - a)
    start = time.time()
    found = secret_scan.mask_text(text, [a for a, _ in spans], [b for _, b in spans], "#")
    assert time.time() - start < 5
    # A span of no width between two letters is masked too, so the plain loop marks places, not only letters.
    plain, at = [], 0
    for a, b in spans:
        if a > at or not plain:
            plain.append(text[at:a])
        at = max(at, b)
    assert found == "#".join(plain) + "#" + text[at:]
    kept = "".join(c for c, x in zip(text, covered) if not x)
    assert found.replace("#", "") == kept


def test_a_text_with_many_spans_is_masked_in_a_job(spark):
    line = "token=abcdefgh9\n"
    docs = documents(spark, [(1, line * 20_000, None), (2, "none", None), (3, None, None)])
    by_id = {r.doc_id: r for r in secret_scan.without_secrets(docs).collect()}
    assert by_id[1].text == "[REDACTED]\n" * 20_000 and by_id[1].n_chars == len(by_id[1].text)
    assert by_id[2].text == "none" and by_id[3].text is None


def test_the_query_counts_spans_by_kind(spark, tmp_path):
    hexes, key = "0123456789abcdef" * 2, "AKIA" + "Z9" * 6
    texts = ["password=abcdefgh9", key, hexes, f"{key} {hexes} {hexes} token={hexes}", "none", None]
    documents(spark, [(i, t, None) for i, t in enumerate(texts)]).write.parquet(f"{tmp_path}/documents.parquet")
    found = queries.op1_secret_scan(spark, str(tmp_path)).orderBy("doc_id").collect()
    spans = [plain(t) for t in texts]
    assert [(r.n_assign, r.n_access, r.n_hex) for r in found] == [
        tuple(sum(kind == i for _, kind, _ in s) for i in range(3)) for s in spans
    ]
    told = [",".join(f"{secret_scan.KINDS[k]}:{a}:{b}" for a, k, b in s) for s in spans]
    assert [r.base_sha256 for r in found] == [hashlib.sha256(t.encode()).hexdigest() for t in told]
