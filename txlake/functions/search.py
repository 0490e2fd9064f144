"""Binary search in sorted arrays."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F


def leading(array: Column, holds: Callable[[Column], Column]) -> Column:
    """How many elements at the head of an array hold; from the first that does not, none may. 0 for a null array."""
    steps = F.sequence(F.lit(1), F.ceil(F.log2(F.size(array) + 1)).cast("int"))

    def halve(bounds: Column, _: Column) -> Column:
        middle = F.floor((bounds["low"] + bounds["high"]) / 2).cast("int")
        test, open_ = holds(F.get(array, middle)), bounds["low"] < bounds["high"]
        return F.struct(
            F.when(open_ & test, middle + 1).otherwise(bounds["low"]).alias("low"),
            F.when(open_ & ~test, middle).otherwise(bounds["high"]).alias("high"),
        )

    whole = F.struct(F.lit(0).alias("low"), F.size(array).alias("high"))
    found = F.aggregate(steps, whole, halve, lambda bounds: bounds["low"])
    # Most arrays hold one element; testing it stays within generated code.
    return F.when(F.size(array) > 1, found).when(holds(F.get(array, F.lit(0))), 1).otherwise(0)
