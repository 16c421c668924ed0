"""Dense global row numbers without a single-partition window."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerlane.sources.publish import store

_ROW_BITS = 33  # monotonically_increasing_id keeps the row number of a partition in its lower 33 bits


def number_rows(df: DataFrame, order: Sequence[Column], name: str = "idx") -> DataFrame:
    """``df`` with 1-based consecutive numbers in ``order``.

    Rows are range-partitioned and sorted, each partition numbers its own rows, and the counts of the earlier
    partitions are added. The sorted rows are stored once, because range boundaries are sampled and a second
    computation could draw others. The offsets have one row per partition, which bounds both their window and the
    broadcast.
    """
    placed = (
        df.repartitionByRange(*order)
        .sortWithinPartitions(*order)
        .withColumns({"_slot": F.spark_partition_id(), "_row": F.monotonically_increasing_id()})
    )
    placed = store(placed, "numbered")
    earlier = Window.orderBy("_slot").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        placed.groupBy("_slot")
        .count()
        .select("_slot", F.coalesce(F.sum("count").over(earlier), F.lit(0)).alias("_before"))
    )
    local = F.col("_row").bitwiseAND(F.lit((1 << _ROW_BITS) - 1))
    return (
        placed.join(F.broadcast(offsets), "_slot")
        .withColumn(name, F.col("_before") + local + 1)
        .drop("_slot", "_row", "_before")
    )
