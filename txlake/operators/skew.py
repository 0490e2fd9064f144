"""Joins that survive a key with a large share of all rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

MARK = "__dealt_by"


def spread_join(rows: DataFrame, side: DataFrame, keys: str | list[str], how: str = "left") -> DataFrame:
    """Join rows with a side of few rows per key, in a plan whose hot partitions the adaptive execution can split.

    It only splits a join both sides of which are shuffled for that join. A side that was aggregated by the key is dealt by it already and
    would be joined as it lies, which takes the possibility away. So the join names a hash of the keys as one more key: Spark wants
    both sides dealt by all keys of a join, and shuffles the side, which has one row per key, once more. A split
    reads the side's partition again in every part. Sides under the broadcast threshold are broadcast as ever.
    """
    keys = [keys] if isinstance(keys, str) else keys
    dealt = F.xxhash64(*keys)
    return rows.withColumn(MARK, dealt).join(side.withColumn(MARK, dealt), [*keys, MARK], how).drop(MARK)
