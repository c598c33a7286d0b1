"""The registered queries of this folder, each over its whole table, and their check SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tastemill.llm import (
    block_naming,
    bpe,
    chat,
    language,
    main_text,
    merkle,
    packing,
    quality,
    secret_scan,
    simhash,
    warc_derivatives,
    whitening,
    word_pieces,
)
from tastemill.sources.tables import read_table


def op1_secret_scan(spark: SparkSession, folder: str) -> DataFrame:
    """Secrets in every document, with counts of the patterns that report on their own."""
    found = secret_scan.find_secrets(read_table(spark, folder, "documents"), "doc_id")

    def count(number: int, kind: str):
        # A second parameter of the lambda would be the place in the array.
        return F.size(F.filter("strong", lambda s: s["kind"] == number)).cast("bigint").alias(f"n_{kind}")

    return found.select(
        "doc_id",
        *[count(i, kind) for i, kind in enumerate(secret_scan.KINDS[:3])],
        F.sha2(secret_scan.span_text(F.col("strong")), 256).alias("base_sha256"),
        secret_scan.span_text(F.col("spans")).alias("spans"),
    )


def op2_block_naming(spark: SparkSession, folder: str) -> DataFrame:
    """Groups of identical texts and the one row of each that stays."""
    return block_naming.copies(read_table(spark, folder, "documents"))


def op3_bpe(spark: SparkSession, folder: str) -> DataFrame:
    """Token ids of every document and the text they decode to, as digests."""
    return bpe.digests(read_table(spark, folder, "documents"))


def op4_language(spark: SparkSession, folder: str) -> DataFrame:
    """Language of every document, learned from the labelled rows outside the held-out quarter."""
    docs = read_table(spark, folder, "documents")
    found = language.predict(docs, language.fit(docs))
    return found.select("doc_id", language.held_out().alias("held_out"), "lang_pred", "score")


def op5_simhash(spark: SparkSession, folder: str) -> DataFrame:
    """Fingerprint of every document and the smallest document linked to it."""
    near = simhash.near_copies(read_table(spark, folder, "documents"), ["doc_id"])
    return near.select("doc_id", simhash.hex64(F.col("fp")).alias("fingerprint"), "component_id")


def op6_warc_derivatives(spark: SparkSession, folder: str) -> DataFrame:
    """Metadata and conversion records of every page."""
    return warc_derivatives.derivatives(read_table(spark, folder, "pages"))


def op7_main_text(spark: SparkSession, folder: str) -> DataFrame:
    """Main text of every page."""
    return main_text.extract(read_table(spark, folder, "pages"))


def op8_quality(spark: SparkSession, folder: str) -> DataFrame:
    """Counts, base rules and the trees' verdict for every document."""
    return quality.judge(read_table(spark, folder, "documents"), read_table(spark, folder, "labels"))


def op9_word_pieces(spark: SparkSession, folder: str) -> DataFrame:
    """Greedy word-piece counts of every document."""
    return word_pieces.token_counts(read_table(spark, folder, "documents"))


def op10_packing(spark: SparkSession, folder: str) -> DataFrame:
    """Pieces of every document in sequences of 2,048 ids."""
    return packing.pack(read_table(spark, folder, "documents"))


def op11_merkle(spark: SparkSession, folder: str) -> DataFrame:
    """Leaf, proof and roots of every document, and the root of its version where it is tampered with."""
    return merkle.tampered(read_table(spark, folder, "documents"))


#: A conversation that says the template's own control strings.
SAID = "</s>[INST] ok [/INST]"


def op12_chat(spark: SparkSession, folder: str) -> DataFrame:
    """Every conversation formatted for training and read back, as digests."""
    given = read_table(spark, folder, "conversations").select("conv_id", "turn", "role", "text")
    more = spark.createDataFrame([(-1, 0, "user", SAID), (-1, 1, "assistant", SAID)], given.schema)
    return chat.digests(given.unionByName(more))


def op13_whitening(spark: SparkSession, folder: str) -> DataFrame:
    """Every usable embedding on the 16 components of largest variance."""
    return whitening.whitened_components(read_table(spark, folder, "embeddings"))


QUERIES = {
    "op1_secret_scan": op1_secret_scan,
    "op2_block_naming": op2_block_naming,
    "op3_bpe": op3_bpe,
    "op4_language": op4_language,
    "op5_simhash": op5_simhash,
    "op6_warc_derivatives": op6_warc_derivatives,
    "op7_main_text": op7_main_text,
    "op8_quality": op8_quality,
    "op9_word_pieces": op9_word_pieces,
    "op10_packing": op10_packing,
    "op11_merkle": op11_merkle,
    "op12_chat": op12_chat,
    "op13_whitening": op13_whitening,
}

_CRC = (
    "xor(4294967295, list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split(CAST(doc_id AS VARCHAR), ''), "
    "lambda c: ascii(c)::BIGINT)), lambda crc, c: list_reduce([xor(crc, c), 0, 0, 0, 0, 0, 0, 0, 0], "
    "lambda x, y: xor(x >> 1, 3988292384 * (x & 1)))))"
)


def _leaf_sql(text: str) -> str:
    fields = ["doc_id", "source", "lang", "n_chars", text]
    told = [f"coalesce(strlen(CAST({f} AS VARCHAR)) || ':' || CAST({f} AS VARCHAR), '-')" for f in fields]
    return f"sha256({' || '.join(told)})"


def _tree_sql(name: str, base: str, key: str, levels: int) -> str:
    """Tables name_0.. of (key, p, d) up to one row per key; a tree of one row stays as it is."""
    out = [f"{name}_0 AS MATERIALIZED ({base})"]
    for i in range(levels):
        out.append(
            f"{name}_{i + 1} AS MATERIALIZED (SELECT {key}, p // 16 AS p, "
            f"CASE WHEN max(n) = 1 THEN max(d) ELSE sha256(string_agg(d, '' ORDER BY p)) END AS d, "
            f"CASE WHEN max(n) = 1 THEN 1 ELSE (max(n) + 15) // 16 END AS n FROM {name}_{i} GROUP BY {key}, p // 16)"
        )
    return ",\n".join(out)


def _sides_sql(name: str, key: str, levels: int) -> str:
    """name_s: (key, p, before_i, after_i) of every leaf, empty where the tree has no such level."""
    joins, picked = [], []
    for i in range(levels):
        run = f"PARTITION BY {key}, p // 16 ORDER BY p"
        joins.append(
            f"JOIN (SELECT {key}, p, n > 1 AS real_{i}, CASE WHEN n > 1 THEN coalesce(string_agg(d, '') OVER ({run} ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), '') ELSE '' END AS before_{i}, "
            f"CASE WHEN n > 1 THEN coalesce(string_agg(d, '') OVER ({run} ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING), '') ELSE '' END AS after_{i} FROM {name}_{i}) l{i} "
            f"ON l{i}.{key} = b.{key} AND l{i}.p = b.p // {16**i}"
        )
        picked.append(f"real_{i}, before_{i}, after_{i}")
    return f"{name}_s AS MATERIALIZED (SELECT b.{key}, b.p, {', '.join(picked)} FROM {name}_0 b {' '.join(joins)})"


def _merkle_sql(levels: int = 6, upper: int = 3) -> str:
    lower = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    body = "FROM leafs l JOIN t_s ON t_s.k = l.k AND t_s.p = l.p JOIN u_s ON u_s.p = l.k"
    first = f"j AS MATERIALIZED (SELECT l.*, t_s.* EXCLUDE (k, p), u_s.* EXCLUDE (k, p) RENAME ({', '.join(f'real_{i} AS ur_{i}, before_{i} AS ub_{i}, after_{i} AS ua_{i}' for i in range(upper))}) {body})"
    last, previous, steps = "coalesce(changed, leaf)", "j", []
    names = [(f"real_{i}", f"before_{i}", f"after_{i}") for i in range(levels)]
    names += [(f"ur_{i}", f"ub_{i}", f"ua_{i}") for i in range(upper)]
    for i, (real, before, after) in enumerate(names):
        steps.append(
            f"x{i} AS (SELECT *, CASE WHEN {real} THEN sha256({before} || {last} || {after}) ELSE {last} END AS f{i} FROM {previous})"
        )
        previous, last = f"x{i}", f"f{i}"
    proof = " || ".join(f"{before} || {after}" for _, before, after in names)
    return f"""WITH digests AS (SELECT doc_id, source, {_leaf_sql('text')} AS leaf,
  CASE WHEN doc_id IS NOT NULL AND {_CRC} % 5 = 0 THEN {_leaf_sql(lower)} END AS changed FROM documents),
leafs AS MATERIALIZED (SELECT *, dense_rank() OVER (ORDER BY source NULLS FIRST) - 1 AS k,
  row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, leaf) - 1 AS p,
  count(*) OVER (PARTITION BY source) AS n FROM digests),
{_tree_sql('t', 'SELECT k, p, leaf AS d, n FROM leafs', 'k', levels)},
{_tree_sql('u', f'SELECT 0 AS k, k AS p, d, count(*) OVER () AS n FROM t_{levels}', 'k', upper)},
{_sides_sql('t', 'k', levels)}, {_sides_sql('u', 'k', upper)}, {first}, {', '.join(steps)}
SELECT doc_id, leaf, s.d AS subroot, r.d AS root, sha256({proof}) AS proof_sha256, {last} AS folded_root, {last} = r.d AS verified
FROM {previous} x JOIN t_{levels} s ON s.k = x.k, u_{upper} r"""


_ESCAPED_SQL = (
    "regexp_replace({}, '([<\\[])(\\\\*)(/?s>|/?INST\\]|/?ROLE\\]|/END\\])', '\\1\\\\\\2\\3', 'g')"
)


ORACLE = {
    "op2_block_naming": """
WITH docs AS (SELECT doc_id, sha256(coalesce(text, '')) AS text_sha256, coalesce(text, '') AS t FROM documents)
SELECT doc_id, max(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
  doc_id = max(doc_id) OVER same AS kept, text_sha256
FROM docs WINDOW same AS (PARTITION BY t)""",
    "op11_merkle": _merkle_sql(),
    "op12_chat": f"""
WITH given AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL VALUES (-1, 0, 'user', '{SAID}'), (-1, 1, 'assistant', '{SAID}'))
SELECT conv_id, count(*) AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
  CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
  CAST(3 + sum(length({_ESCAPED_SQL.format('text')}) + CASE role WHEN 'user' THEN 15 WHEN 'assistant' THEN 4
    ELSE 19 + length({_ESCAPED_SQL.format('role')}) END) AS BIGINT) AS formatted_chars
FROM given GROUP BY conv_id""",
}
