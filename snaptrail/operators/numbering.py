"""Consecutive numbers over a whole table in a given order, without one task that sees all rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from snaptrail.operators.lookup import cut_lineage

# monotonically_increasing_id holds the partition above these bits and the row in it below.
_ROW_BITS = 33


def numbered(rows: DataFrame, *order: str | Column, column: str = "number") -> DataFrame:
    """Adds ``column``, 1 to the number of rows in ``order``, nulls first.

    Rows are sorted in range partitions, which are written, and counted there. What stands before a
    partition is a running sum over one row per partition, the only thing that is brought together.
    Rows that tie in ``order`` get different numbers, in an order that holds for this result only.
    """
    ordered = rows.repartitionByRange(*order).sortWithinPartitions(*order)
    placed = cut_lineage(ordered.withColumn("_at", F.monotonically_increasing_id()))
    part = F.shiftright("_at", _ROW_BITS)
    counts = placed.groupBy(part.alias("_part")).agg(F.count("*").alias("_rows"))
    earlier = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    before = counts.select("_part", F.coalesce(F.sum("_rows").over(earlier), F.lit(0)).alias("_before"))
    in_part = F.col("_at").bitwiseAND((1 << _ROW_BITS) - 1)
    joined = placed.join(F.broadcast(before), part == F.col("_part"))
    return joined.withColumn(column, F.col("_before") + in_part + 1).select(*rows.columns, column)
