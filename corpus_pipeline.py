"""The cleaning pipeline over ``documents``: language, copies, near copies, secrets, packing.

Each stage works on all rows the stage before it kept and hands on the columns
of ``documents``; the last one returns the pieces of the packed sequences.
Null texts have no language and go at the first stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tastemill.llm import block_naming, language, packing, secret_scan, simhash
from tastemill.session import write_stage
from tastemill.sources.tables import read_table


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in which a language is recognised."""
    return language.recognised(docs, language.fit(docs))


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of identical texts, the row with the largest doc_id."""
    return block_naming.without_copies(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each component of near copies, the row with the smallest doc_id."""
    return simhash.one_of_each(docs)


def mask_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document, with the found secrets masked in its text."""
    return secret_scan.without_secrets(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents in sequences of ids."""
    return packing.pack(docs)


STAGES = [
    ("language_id", identify_language),
    ("exact_dedup", drop_copies),
    ("simhash_near_dedup", drop_near_copies),
    ("secret_scan", mask_secrets),
    ("packing", pack),
]

#: The language stage is a fitted model, which SQL cannot express; tests compare with a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the whole table; every stage but the last is written before the next begins."""
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = write_stage(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
