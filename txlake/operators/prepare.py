"""Bring a delivered frame to its registry schema. All steps are projections: no shuffle, no action."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from txlake.functions.coerce import coerce, to_utc
from txlake.registry import DEFAULTS, ENTITIES, HISTORY_FIELDS, INFERENCE_ORDER, Entity, entity

REJECT = "reject_reason"
# Reason a reader gives for a row it could not read properly; such a row is rejected.
FAULT = "read_fault"


def time_literal(text: str) -> Column:
    return F.lit(text).cast("timestamp_ntz")


def default_value(dtype: T.DataType) -> Column:
    return F.lit(DEFAULTS[dtype]).cast(dtype)


def add_lineage(df: DataFrame, batch_id: str, as_of: str) -> DataFrame:
    """Stamp the batch and load time on every row."""
    return df.withColumns({"BATCH_ID": F.lit(batch_id), "created_at": time_literal(as_of)})


def start_history(df: DataFrame, as_of: str) -> DataFrame:
    """Add the history fields, or fill their nulls: current, open, version 1, effective now."""
    start = {
        "version": F.lit(1).cast("bigint"),
        "effective_date": time_literal(as_of),
        "is_current": F.lit(True),
    }
    types, known = dict(HISTORY_FIELDS), {f.name: f.dataType for f in df.schema}
    filled = {
        name: F.coalesce(coerce(name, known[name], types[name]), value) if name in known else value
        for name, value in start.items()
    }
    if "end_date" not in known:
        filled["end_date"] = F.lit(None).cast("timestamp_ntz")
    return df.withColumns(filled)


def normalize_times(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """Zone-free UTC microseconds for the named columns, or for every zoned time column."""
    names = columns or [f.name for f in df.schema if isinstance(f.dataType, T.TimestampType)]
    return df.withColumns({n: F.expr(to_utc(f"`{n}`", df.schema[n].dataType)) for n in names})


def add_missing(df: DataFrame, kind: str | Entity) -> DataFrame:
    """Registry columns the delivery lacks, with the default of their type."""
    known = df.columns
    absent = {n: default_value(t) for n, t in entity(kind).fields if n not in known}
    return df.withColumns(absent) if absent else df


def coerce_columns(df: DataFrame, kind: str | Entity) -> DataFrame:
    """Registry types; unreadable values become null."""
    types = {f.name: f.dataType for f in df.schema}
    return df.withColumns({n: coerce(n, types[n], t) for n, t in entity(kind).fields if n in types})


def fill_required(df: DataFrame, kind: str | Entity) -> DataFrame:
    """Defaults for null required fields; identity fields are left for `flag_rejects`."""
    e = entity(kind)
    fill = {n: F.coalesce(F.col(n), default_value(t)) for n, t in e.required if n not in e.identity}
    return df.withColumns(fill) if fill else df


def prune(df: DataFrame, kind: str | Entity) -> DataFrame:
    """Registry columns in registry order."""
    known = df.columns
    return df.select(*[n for n in entity(kind).columns if n in known])


def flag_rejects(df: DataFrame, kind: str | Entity) -> DataFrame:
    """Name the null identity fields of a row, or null when it is acceptable."""
    missing = F.array_compact(F.array(*[F.when(F.col(n).isNull(), F.lit(n)) for n in entity(kind).identity]))
    return df.withColumn(REJECT, F.when(F.size(missing) > 0, F.array_join(missing, ",")))


def required_violations(df: DataFrame, kind: str | Entity) -> DataFrame:
    """Rows where any required field is null."""
    return df.filter(reduce(Column.__or__, [F.col(n).isNull() for n in entity(kind).required_columns]))


def check_required(df: DataFrame, kind: str | Entity) -> DataFrame:
    """Strict form: the job fails on the first row with a null required field."""
    checked = {
        n: F.coalesce(F.col(n), F.raise_error(F.lit(f"null in required column {n}")).cast(t))
        for n, t in entity(kind).required
    }
    return df.withColumns(checked)


def infer_entity(columns: list[str]) -> Entity | None:
    """Entity whose signature the column set contains."""
    return next((e for e in INFERENCE_ORDER if set(e.signature) <= set(columns)), None)


def inferred_entity(columns: Column) -> Column:
    """`infer_entity` for an array column of column names."""
    found = F.lit(None).cast("string")
    for e in reversed(INFERENCE_ORDER):
        carried = reduce(Column.__and__, [F.array_contains(columns, c) for c in e.signature])
        found = F.when(carried, F.lit(e.name)).otherwise(found)
    return found


def conform(df: DataFrame, kind: str | Entity | None, batch_id: str, as_of: str) -> DataFrame:
    """The whole chain, keeping rejected rows with their reason. An unknown entity passes unchanged."""
    e = infer_entity(df.columns) if kind is None else (kind if isinstance(kind, Entity) else ENTITIES.get(kind))
    if e is None:
        return df
    df = add_lineage(df, batch_id, as_of)
    if e.has_history:
        df = start_history(df, as_of)
    df = coerce_columns(df, e)
    df = add_missing(df, e)
    df = fill_required(df, e)
    if FAULT not in df.columns:
        return flag_rejects(prune(df, e), e)
    kept = [*prune(df, e).columns, FAULT]
    flagged = flag_rejects(df.select(*kept), e)
    return flagged.withColumn(REJECT, F.coalesce(FAULT, REJECT)).drop(FAULT)


def prepare(df: DataFrame, kind: str | Entity | None, batch_id: str, as_of: str) -> DataFrame:
    """Rows ready for the target table."""
    conformed = conform(df, kind, batch_id, as_of)
    if REJECT not in conformed.columns:
        return conformed
    return conformed.filter(F.col(REJECT).isNull()).drop(REJECT)


def quarantine(df: DataFrame, kind: str | Entity, batch_id: str, as_of: str) -> DataFrame:
    """Rows `prepare` leaves out, with the reason."""
    return conform(df, kind, batch_id, as_of).filter(F.col(REJECT).isNotNull())


def consolidate(frames: list[DataFrame]) -> DataFrame:
    """One table from several deliveries of an entity; a column missing from one of them is null there."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)
