"""Consecutive row numbers over a whole table without sorting it in one task."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from txlake.plans.session import shared_folder


def number_rows(df: DataFrame, order: list[str], name: str = "row_number") -> DataFrame:
    """1, 2, 3, ... in the order of `order`, which should be unique.

    The rows are range-partitioned and sorted within partitions. The result is written once with a
    checkpoint, so that counting and numbering see the same partitions; the position inside a partition
    comes from the row's id there, and the partition's offset from one count per partition.
    """
    shared_folder(df.sparkSession)
    ordered = df.repartitionByRange(*order).sortWithinPartitions(*order).checkpoint()
    placed = ordered.withColumn("__id", F.monotonically_increasing_id()).withColumns({
        "__part": F.shiftright("__id", 33),
        "__pos": F.col("__id").bitwiseAND(F.lit((1 << 33) - 1)),
    })
    # One row per partition: a single task sums a list as long as the number of partitions.
    counts = placed.groupBy("__part").agg(F.count("*").alias("n"))
    before = Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("__part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("__offset"))
    return placed.join(F.broadcast(offsets), "__part").select(
        *df.columns, (F.col("__offset") + F.col("__pos") + 1).cast("bigint").alias(name)
    )
