"""Places of rows in an order over the whole cluster, without a window over it.

Rows are dealt by ranges of the order and sorted in their tasks; a row's place is its place in its range and the
sizes of the ranges before it. Only these sizes, a row a task, are summed up as a whole.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..stages import materialise

#: ``monotonically_increasing_id`` has the task's number above these bits and the row's below.
_BITS = 33


def placed(table: DataFrame, order: list[Column], name: str) -> DataFrame:
    """``table`` with __at, the place from 0. It must be a written table: the place in its files is the last key of the order, so that
    a range may begin among rows equal in all others, and a task that runs again deals its rows as before."""
    rows = table.withColumn("__tie", F.monotonically_increasing_id())
    order = [*order, F.col("__tie").asc()]
    ranges = rows.repartitionByRange(*order).sortWithinPartitions(*order).drop("__tie").withColumn("__id", F.monotonically_increasing_id())
    ranges = materialise(ranges, name)
    part = F.shiftright("__id", _BITS)
    sizes = ranges.groupBy(part.alias("__part")).agg(F.count("*").alias("__n"))
    before = F.coalesce(F.sum("__n").over(W.orderBy("__part").rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    starts = sizes.select("__part", before.alias("__before"))  # a row a task of the sort
    at = F.col("__before") + F.col("__id").bitwiseAND(F.lit((1 << _BITS) - 1))
    return ranges.withColumn("__part", part).join(F.broadcast(starts), "__part").withColumn("__at", at).drop("__part", "__before", "__id")
