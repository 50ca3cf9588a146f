"""Dense numbering of rows in a global order, without one task holding them all."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ticketmart.config import shared_folder


def number_in_order(rows: DataFrame, order: Sequence[str], weight: str | None = None) -> DataFrame:
    """Adds `start`: how many rows, or how much weight, come before in the order.

    The rows must be distinct in the order columns. They are range-partitioned
    and checkpointed, so that both the sizes of the ranges and the rows come from
    the same division, also if executors are lost in between. The sizes are one
    row per range, no more than there are shuffle partitions; their running sum
    is broadcast.
    """
    shared_folder(rows.sparkSession)
    ordered = rows.repartitionByRange(*order).withColumn("_range", F.spark_partition_id())
    if weight:
        inside = (
            Window.partitionBy("_range").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
        )
        place = F.coalesce(F.sum(weight).over(inside), F.lit(0))
        size = F.max(F.col("_place") + F.col(weight))
    else:  # Spark numbers the rows of a task from the task's number, shifted by 33 bits
        ordered = ordered.sortWithinPartitions(*order)
        place = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))
        size = F.max(F.col("_place") + 1)
    held = ordered.withColumn("_place", place).checkpoint()
    sizes = held.groupBy("_range").agg(size.alias("_size"))
    before = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select(
        "_range", F.coalesce(F.sum("_size").over(before), F.lit(0)).alias("_offset")
    )
    return (
        held.join(F.broadcast(offsets), "_range")
        .withColumn("start", F.col("_offset") + F.col("_place"))
        .drop("_range", "_offset", "_place")
    )
