"""Tolerant conversion of a column to a registry type: what cannot be read becomes null.

The rules are SQL texts, so that a wide projection costs one call per column on the driver.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from txlake.registry import BOOL, DOUBLE, LONG, NULL_WORDS, STRING, TIME

_TOKENS = ", ".join(f"'{t}'" for t in NULL_WORDS)


def blank_to_null(text: str) -> str:
    return f"CASE WHEN {text} NOT IN ({_TOKENS}) THEN {text} END"


def to_double(value: str) -> str:
    return f"nanvl(try_cast({value} AS DOUBLE), NULL)"


def to_long(value: str) -> str:
    """Whole numbers only: `3` and `3.0` read as 3, `3.7` as null. Long digits keep full precision."""
    number = f"try_cast({value} AS DOUBLE)"
    return (
        f"CASE WHEN floor({number}) = {number} "
        f"THEN coalesce(try_cast({value} AS BIGINT), try_cast({number} AS BIGINT)) END"
    )


def to_utc(value: str, source: T.DataType) -> str:
    """Zone-free UTC time. Text goes through an instant first, because a direct cast ignores its offset; text without
    a date is no time, because Spark would take the day from the clock."""
    if isinstance(source, T.TimestampNTZType):
        return value
    if isinstance(source, T.StringType):
        value = f"CASE WHEN NOT {value} RLIKE '^\\\\s*T?[0-9]{{1,2}}(:|$)' THEN {value} END"
    return f"try_cast(try_cast({value} AS TIMESTAMP) AS TIMESTAMP_NTZ)"


def rule(value: str, source: T.DataType, target: T.DataType) -> str:
    """SQL text that reads `value`, of type `source`, as `target`."""
    if isinstance(source, T.StringType):
        value = f"({blank_to_null(value)})"
    if target == TIME:
        return to_utc(value, source)
    if target == LONG:
        return value if source == LONG else to_long(value)
    if target == DOUBLE:
        return to_double(value)
    if target == BOOL:
        return f"try_cast({value} AS BOOLEAN)"
    if target == STRING:
        return f"CAST({value} AS STRING)"
    raise TypeError(f"no rule for {target}")


def coerce(name: str, source: T.DataType, target: T.DataType) -> Column:
    return F.expr(rule(f"`{name}`", source, target)).alias(name)
