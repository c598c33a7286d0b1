import zlib

import numpy as np
from odd_tables import documents, no_documents, odd_documents, prose
from pyspark.sql import functions as F
from test_simhash import plain_components
from tokenizers import Tokenizer

import corpus_pipeline
from tastemill.llm import language, secret_scan, simhash
from tastemill.llm.common import default_vocabulary
from tastemill.session import write_stage
from tastemill.sources.tables import read_table


def by_hand(rows, known):
    """The first three stages over (doc_id, text) rows, in plain Python."""
    rows = [(i, t) for i, t in rows if i in known]
    last = {}
    for i, t in sorted(rows):
        last[t] = i
    rows = sorted((i, t) for t, i in last.items())
    near = plain_components([simhash.fingerprint(t) for _, t in rows], [i for i, _ in rows])
    return [r for r, first in zip(rows, near) if r[0] == first]


def test_pipeline_equals_the_stages_by_hand(spark):
    docs = read_table(spark, "/root/testdata/sf0.001", "documents")
    pieces = corpus_pipeline.run(spark, "/root/testdata/sf0.001").collect()
    model = language.fit(docs)
    known = {r.doc_id for r in language.predict(docs, model).filter("lang_pred <> 'und'").collect()}
    kept = by_hand([(r.doc_id, r.text) for r in docs.collect()], known)
    tokenizer = Tokenizer.from_file(default_vocabulary("word_bpe_49k.json"))
    found = {}
    for r in sorted(pieces, key=lambda r: (r.doc_id, r.start)):
        found.setdefault(r.doc_id, []).append(r)
    assert set(found) == {i for i, _ in kept}
    spans = {
        r.doc_id: r.spans for r in secret_scan.find_secrets(docs, "doc_id").filter("size(spans) > 0").collect()
    }
    for i, text in kept:
        for s in reversed(spans.get(i, [])):
            text = text[: s.start] + "[REDACTED]" + text[s.stop :] if not inside(s, spans[i]) else text
        ids = np.array([*tokenizer.encode(text, add_special_tokens=False).ids, 1], dtype="<u4")
        at = 0
        for r in found[i]:
            assert r.start == at and r.doc_tokens == len(ids)
            assert r.ids_crc32 == zlib.crc32(ids[at : at + r.length].tobytes())
            at += r.length
        assert at == len(ids)


def inside(span, spans):
    """Is a span within one that starts before it?"""
    return any(o.start < span.start < o.stop for o in spans)


def test_stages_get_through_odd_and_empty_tables(spark):
    for docs in (odd_documents(spark), no_documents(spark)):
        columns = docs.columns
        for name, stage in corpus_pipeline.STAGES[:-1]:
            docs = write_stage(stage(spark, docs, ""), name)
            assert docs.columns == columns
        corpus_pipeline.STAGES[-1][1](spark, docs, "").count()


def test_stages_on_files_and_on_other_tables_agree(spark, tmp_path):
    docs = odd_documents(spark).withColumn("_metadata", F.lit("x"))
    docs.repartition(3).write.parquet(str(tmp_path / "docs"))
    files = spark.read.parquet(str(tmp_path / "docs"))
    other = files.unionByName(files.limit(0))
    for _, stage in corpus_pipeline.STAGES[1:4]:
        first, second = (stage(spark, t, "") for t in (files, other))
        assert first.columns == files.columns
        assert sorted(map(repr, first.collect())) == sorted(map(repr, second.collect()))


def test_clean_documents_stay(spark):
    rows = [(i, prose(80, i) + f" number {i} of a kind {i * i}", "en") for i in range(40)]
    docs = documents(spark, rows)
    prints = [simhash.fingerprint(t) for _, t, _ in rows]
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, "")
    assert {r.doc_id for r in docs.collect()} == set(plain_components(prints, list(range(40))))
