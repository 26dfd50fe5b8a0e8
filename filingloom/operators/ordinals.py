"""Ordinals within groups of any size, and calendars made of them.

Rows are dealt out by ranges of group and order, so a large group lies in several partitions, in order. A partition's row
numbers run on, so a row's place in its part of the group is its number less the first one; to that comes the number of the
group's rows in the partitions before, from a table with a row for each part of a group. No window holds a group.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..sources.stage import saved


def ordinals(df: DataFrame, keys: list[str], order: list[str], name: str = "place", parts: int | None = None) -> DataFrame:
    """df with each row's place in its group, from 0. order: columns that tell the rows of a group apart; of rows that
    they don't, the order is any. A null key is a group of its own; nulls come first."""
    columns = df.columns
    dealt = df.repartitionByRange(*([parts] if parts else []), *keys, *order).sortWithinPartitions(*keys, *order)
    numbered = saved(dealt.withColumns({"__part": F.spark_partition_id(), "__k": F.monotonically_increasing_id()}))
    pieces = numbered.groupBy("__part", *keys).agg(F.min("__k").alias("__first"), F.count("*").alias("__n"))
    past = Window.partitionBy(*keys).orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)  # a row for each part of the group
    before = pieces.withColumn("__before", F.coalesce(F.sum("__n").over(past), F.lit(0))).withColumnsRenamed({k: f"__of_{k}" for k in keys})
    same = F.col("__part") == F.col("__at")
    for k in keys:
        same &= F.col(k).eqNullSafe(F.col(f"__of_{k}"))
    whole = numbered.join(before.withColumnRenamed("__part", "__at"), same)
    return whole.select(*columns, (F.col("__k") - F.col("__first") + F.col("__before")).alias(name))


def calendar(requests: DataFrame, host: str, order: list[str], delay: float, start: float = 0.0, name: str = "slot") -> DataFrame:
    """requests with the second at which each may be sent: those of a host `delay` apart, in order, whatever task sends them."""
    placed = ordinals(requests, [host], order, "__place")
    return placed.withColumn(name, F.lit(start) + F.col("__place") * F.lit(delay)).drop("__place")
