"""Positions in a global order, without a task that sees all rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..sources.shared import saved

#: Row numbers of one partition stand in the low bits of monotonically_increasing_id.
_ROW_BITS = (1 << 33) - 1


def numbered(rows: DataFrame, order: Sequence[str | Column], name: str = "position") -> DataFrame:
    """``rows`` with their place, from 1, in the order given (every column ascending, nulls first).

    Two passes: rows are written as sorted range partitions with their place inside the partition;
    a place in the whole is that plus the number of rows in the partitions before. The driver sees
    a number per partition. Rows that are equal in all of ``order`` get neighbouring places in any
    order, so name enough columns.
    """
    keys = [F.col(c) if isinstance(c, str) else c for c in order]
    ranged = rows.repartitionByRange(*keys).sortWithinPartitions(*keys)
    placed = ranged.select("*", F.spark_partition_id().alias("__part"), F.monotonically_increasing_id().bitwiseAND(F.lit(_ROW_BITS)).alias("__row"))
    table = saved(placed, "ordered")
    sizes = dict(table.groupBy("__part").count().collect())  # a row per partition
    before, starts = 0, []
    for part in sorted(sizes):
        starts.append((part, before))
        before += sizes[part]
    offsets = rows.sparkSession.createDataFrame(starts, "__part int, __before long")
    return table.join(F.broadcast(offsets), "__part").withColumn(name, F.col("__before") + F.col("__row") + 1).drop("__part", "__row", "__before")


def numbered_in_groups(rows: DataFrame, groups: Sequence[str], order: Sequence[str], name: str, size: str | None = None) -> DataFrame:
    """``rows`` with their place in their group, and the group's ``size``; a group may be larger than any task.

    All rows are numbered by (groups, order); a group begins at its least number.
    """
    placed = numbered(rows, [*groups, *order], "__at")
    first = placed.groupBy(*[F.col(g).alias(f"__{g}") for g in groups]).agg(F.min("__at").alias("__first"), F.count("*").alias("__size"))
    same = F.lit(True)
    for g in groups:
        same = same & F.col(g).eqNullSafe(F.col(f"__{g}"))
    made = placed.join(first, same).withColumn(name, F.col("__at") - F.col("__first") + 1)
    if size:
        made = made.withColumn(size, F.col("__size"))
    return made.drop("__at", "__first", "__size", *[f"__{g}" for g in groups])
