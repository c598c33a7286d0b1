"""Awkward small tables that every operator must get through, and plain helpers."""

from pyspark.sql import types as T

DOCUMENTS = "doc_id bigint, text string, lang string, source string, n_chars bigint"
PAGES = "page_id bigint, url string, html string"
# Columns an input may have beside its own; they clash with names the operators use inside.
EXTRA = [
    "row", "key", "name", "h", "index", "bytes", "n", "sha", "identity", "fp", "root", "members", "spans",
    "strong", "weak", "ids", "curve", "begin", "features", "label", "chance", "row_number", "_spans", "_all",
]

WORDS = "the old river runs past a quiet mill where seven grey herons wait for small fish every dawn".split()


def prose(n, shift=0):
    return " ".join(WORDS[(i * 7 + i * i * 3 + shift) % len(WORDS)] for i in range(n))


def documents(spark, rows, extra=False):
    full = [(i, text, lang, "s", None if text is None else len(text)) for i, text, lang in rows]
    schema = T._parse_datatype_string(DOCUMENTS)
    if extra:
        for name in EXTRA:
            schema = schema.add(name, T.StringType())
        full = [(*r, *["x"] * len(EXTRA)) for r in full]
    return spark.createDataFrame(full, schema)


def odd_rows():
    """Nulls in every column, empty, blank, very long, repeated and tied rows."""
    long = prose(30_000)
    return [
        (1, None, None),
        (2, "", "en"),
        (3, " \t\n", "en"),
        (None, prose(40), "en"),
        (5, prose(40), None),
        (5, prose(40), None),
        (6, long, "en"),
        (7, long, "en"),
        (8, long + " end", "en"),
        (9, "x" * 50_000, "de"),
        (10, "\U0001f642 12345 -- !!", "de"),
        (11, prose(60, 1) + " password=abcdefgh12345", "fr"),
        (12, "a", "fr"),
    ]


def odd_documents(spark):
    return documents(spark, odd_rows(), extra=True)


def no_documents(spark):
    return documents(spark, [])


def collected(df, *columns):
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=repr)
