"""Consecutive numbers over sorted rows, without sending a group to one task."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from logwarden.session import durable


def number_within(df: DataFrame, group: str, order: list[str], name: str = "number") -> DataFrame:
    """Add 1, 2, 3 … within each ``group``, in ``order``, which has to be unique.

    ``row_number`` over a window would sort a whole group in one task. Instead the rows are
    sorted by range partitions; a row's number is its place in its partition plus the
    group's rows in earlier partitions. The sorted rows are stored first, because range
    borders come from sampling and may differ between two runs of the same plan.
    """
    row_bits = 33  # monotonically_increasing_id: partition number above, row number below
    ordered = df.orderBy(group, *order).withColumn("_row", F.monotonically_increasing_id())
    stored = durable(ordered).withColumn("_part", F.shiftrightunsigned("_row", row_bits))

    runs = stored.groupBy(group, "_part").agg(F.min("_row").alias("_first"), F.count("*").alias("_n"))
    earlier = Window.partitionBy(group).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    shift = F.coalesce(F.sum("_n").over(earlier), F.lit(0)) - F.col("_first") + 1
    # one row per partition and group: groups lie behind each other, so at most
    # (number of partitions + number of groups) rows; stored, so that later passes over the
    # numbered rows do not count them again
    offsets = durable(runs.select(group, "_part", shift.alias("_shift")))
    numbered = stored.join(F.broadcast(offsets), [group, "_part"])
    return numbered.withColumn(name, F.col("_row") + F.col("_shift")).drop("_row", "_part", "_shift")
