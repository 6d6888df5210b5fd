"""Positions of rows in a global or grouped order, without a task that sees a whole group.

Rows are dealt by range on (group, order), numbered inside their partition and
written; the counts by (partition, group) then give each partition's offset.
A group that holds most rows is spread over many partitions like any other.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from scrutin.llm.common import shuffle_partitions, stored

_IN_PART = (1 << 33) - 1


def dealt_by_range(df: DataFrame, order: list[str | Column], name: str, partitions: int | None = None) -> DataFrame:
    """The rows written in global order, with ``part`` (the partition, ascending) and
    ``at`` (the place in it, from 0).  Nulls come first."""
    n = partitions or shuffle_partitions(df.sparkSession)
    sorted_ = df.repartitionByRange(n, *order).sortWithinPartitions(*order)
    written = stored(sorted_.withColumn("at", F.monotonically_increasing_id()), name)
    return written.withColumns({"part": F.shiftright("at", 33), "at": F.col("at").bitwiseAND(_IN_PART)})


def positions(df: DataFrame, group: list[str], order: list[str | Column], name: str) -> DataFrame:
    """``df`` with ``pos`` (place in its group's order, from 0) and ``n`` (the group's rows).

    Group columns hold no nulls.  Without groups the whole table is one.  The
    offsets are a table of one row for each partition and group in it.  Rows
    that are equal in all of this are told apart by their place in the written
    input, so that many equal rows are spread too.
    """
    told = stored(df.withColumn("tie", F.monotonically_increasing_id()), f"{name}-input")
    rows = dealt_by_range(told, [*group, *order, "tie"], name)
    runs = rows.groupBy("part", *group).agg(F.min("at").alias("first"), F.count("*").alias("run"))
    w = Window.partitionBy(*group) if group else Window.partitionBy()
    runs = runs.select(
        "part", *group, "first",
        F.coalesce(F.sum("run").over(w.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("before"),
        F.sum("run").over(w).alias("n"))
    return (rows.join(runs, ["part", *group])
            .withColumn("pos", F.col("at") - F.col("first") + F.col("before"))
            .drop("part", "at", "tie", "first", "before"))
