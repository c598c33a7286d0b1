"""Small helpers shared by the operators of this folder."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tastemill.session import write_stage

#: Texts turned into Python objects at a time, so that a batch of long ones is not held twice.
SLICE = 256
#: Rows in an Arrow batch of texts.
BATCH = 1024
_RECORDS = "spark.sql.execution.arrow.maxRecordsPerBatch"


def text_or_empty(df: DataFrame, column: str = "text") -> Column:
    return F.coalesce(df[column].cast("string"), F.lit(""))


def unused(df: DataFrame, name: str) -> str:
    """``name``, with underscores in front until no column of ``df`` is called so."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name


def numbered(df: DataFrame, row: str, label: str) -> DataFrame:
    """``df`` written once with a row number in column ``row``.

    Row numbers of Spark depend on how a scan was cut, which may change after
    an executor is lost; written down, they stay what they are.
    """
    return write_stage(df.withColumn(row, F.monotonically_increasing_id()), label)


def identified(df: DataFrame, row: str, label: str) -> DataFrame:
    """``df`` with a column ``row`` that names each row and stays the same in every scan.

    For a table read from files it is the file and the place in it, at no cost.
    Any other table is written once with row numbers.
    """
    try:
        hidden = df.metadataColumn("_metadata")
        place = F.struct(hidden["file_path"].alias("file"), hidden["row_index"].alias("at"))
        return df.select("*", place.alias(row))
    except AnalysisException:
        return numbered(df, row, label)


def map_batches(
    df: DataFrame, function: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], schema: str | StructType
) -> DataFrame:
    """``mapInArrow`` with batches of at most ``BATCH`` rows.

    Spark's default of 10,000 rows is made for numbers; that many texts fill the
    memory beside the heap. A smaller setting of the session is left alone.
    """
    conf = df.sparkSession.conf
    if int(conf.get(_RECORDS)) > BATCH:
        conf.set(_RECORDS, str(BATCH))
    return df.mapInArrow(function, schema)


def per_text(
    docs: DataFrame,
    key: str,
    function: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]],
    fields: str,
    text: str = "text",
) -> DataFrame:
    """(``key``, ``fields``): what ``function`` makes of batches (key, text); a null text is empty."""
    kind = docs.schema[key].dataType.simpleString()
    rows = docs.select(docs[key].alias("key"), text_or_empty(docs, text).alias("text"))
    return map_batches(rows, function, f"key {kind}, {fields}").withColumnRenamed("key", key)


def slices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for start in range(0, batch.num_rows, SLICE):
            yield batch.slice(start, SLICE)


def default_vocabulary(name: str) -> str:
    """Place of a public tokenizer file; it must be readable on every executor."""
    import public_tokenizers

    return public_tokenizers.path(name)
