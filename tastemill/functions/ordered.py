"""Ordered scans (lag, running sum, row number) that do not put one key in one task."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tastemill.session import write_stage


class OrderedSplit:
    """Rows range-partitioned by (keys, order), with scans stitched across the parts.

    A plain ``Window.partitionBy(user)`` sorts a whole user in one task. Here a
    hot key spans many range parts; each part is scanned on its own, and what a
    part needs from its neighbours (a total, a first or last value) travels in a
    carry table. Only keys cut by a part boundary are in that table, so it has
    at most two rows per part and is safe to broadcast. With no keys the scan
    runs over the whole table.

    ``order`` must end in a unique column, and keys must not be null.
    """

    def __init__(self, df: DataFrame, keys: Sequence[str], order: Sequence[str]):
        self.keys = list(keys)
        self.order = list(order)
        tagged = df.repartitionByRange(*self.keys, *self.order).withColumn(
            "_part", F.spark_partition_id()
        )
        # Range bounds are sampled, so the tags are written once and never recomputed.
        self.df = write_stage(tagged, "ordered")
        self._segment = Window.partitionBy("_part", *self.keys)
        self._scan = self._segment.orderBy(*self.order)

    def _carry(self, summary: DataFrame, carried: Column, name: str) -> DataFrame:
        """Join one carried value per (key, part) for keys that cross a part boundary."""
        key_window = Window.partitionBy(*self.keys)
        table = (
            summary.withColumn("_spread", F.count(F.lit(1)).over(key_window))
            .filter(F.col("_spread") > 1)
            .withColumn(name, carried)
            .select(*self.keys, "_part", name)
        )
        return self.df.join(F.broadcast(table), [*self.keys, "_part"], "left")

    def _parts_of_key(self) -> Window:
        return Window.partitionBy(*self.keys).orderBy("_part")

    def running_sum(self, term: Column, name: str, inclusive: bool = True) -> "OrderedSplit":
        """Sum of an integer ``term`` over the rows up to this one."""
        summary = self.df.groupBy(*self.keys, "_part").agg(F.sum(term).alias("_total"))
        before = F.sum("_total").over(
            self._parts_of_key().rowsBetween(Window.unboundedPreceding, -1)
        )
        end = Window.currentRow if inclusive else -1
        inside = F.sum(term).over(self._scan.rowsBetween(Window.unboundedPreceding, end))
        zero = F.lit(0)
        self.df = (
            self._carry(summary, before, "_before")
            .withColumn(name, F.coalesce(inside, zero) + F.coalesce(F.col("_before"), zero))
            .drop("_before")
        )
        return self

    def row_number(self, name: str) -> "OrderedSplit":
        return self.running_sum(F.lit(1).cast("bigint"), name)

    def key_total(self, term: Column, name: str) -> "OrderedSplit":
        """Sum of ``term`` over all rows of the key, on every row."""
        summary = self.df.groupBy(*self.keys, "_part").agg(F.sum(term).alias("_total"))
        others = F.sum("_total").over(Window.partitionBy(*self.keys)) - F.col("_total")
        self.df = (
            self._carry(summary, others, "_others")
            .withColumn(
                name, F.sum(term).over(self._segment) + F.coalesce(F.col("_others"), F.lit(0))
            )
            .drop("_others")
        )
        return self

    def lag(self, value: Column, name: str) -> "OrderedSplit":
        return self._neighbour(value, name, back=True)

    def lead(self, value: Column, name: str) -> "OrderedSplit":
        return self._neighbour(value, name, back=False)

    def _neighbour(self, value: Column, name: str, back: bool) -> "OrderedSplit":
        position = F.struct(*[F.col(c) for c in self.order])
        edge = F.max_by(value, position) if back else F.min_by(value, position)
        summary = self.df.groupBy(*self.keys, "_part").agg(edge.alias("_edge"))
        step = F.lag if back else F.lead
        carried = step("_edge").over(self._parts_of_key())
        probe = step(F.lit(1)).over(self._scan)
        self.df = (
            self._carry(summary, carried, "_outside")
            .withColumn(
                name,
                F.when(probe.isNull(), F.col("_outside")).otherwise(step(value).over(self._scan)),
            )
            .drop("_outside")
        )
        return self

    def result(self) -> DataFrame:
        return self.df.drop("_part")
