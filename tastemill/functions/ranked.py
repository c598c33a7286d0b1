"""Top-n per key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window


def top_per(df: DataFrame, keys: Sequence[str], order: Sequence[Column], n: int) -> DataFrame:
    """Best ``n`` rows per key with a 1-based ``rank``.

    The ``rank <= n`` filter lets Spark cut each map partition to n rows per
    key before the shuffle, so a hot key moves at most n rows per map task.
    """
    window = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("rank", F.row_number().over(window)).filter(F.col("rank") <= n)
