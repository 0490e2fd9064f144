"""Type 2 dimensions: compare a delivery with the current rows, write closed and new versions.

Every step is keyed by the business key. Both sides hold one row per key before they meet, so the
join cannot multiply rows, and the reduction to one row per key combines on the map side, so a key
that fills a large part of a delivery costs one row per map task in the shuffle.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from txlake.operators.prepare import time_literal
from txlake.operators.skew import spread_join
from txlake.registry import DOUBLE, Entity, entity

def one_per_key(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """The greatest row of each key by `order`, then by all other columns; rows with a null key are left out."""
    rest = [c for c in df.columns if c not in keys and c not in order]
    row = F.struct(*order, *rest)
    known = reduce(Column.__and__, [F.col(k).isNotNull() for k in keys])
    picked = df.filter(known).groupBy(*keys).agg(F.max(row).alias("r"))
    return picked.select(*[F.col(c) if c in keys else F.col(f"r.{c}").alias(c) for c in df.columns])


def latest_delivered(incoming: DataFrame, kind: str | Entity) -> DataFrame:
    """One row per business key of a delivery: highest version, then latest date, then a total order."""
    e = entity(kind)
    order = [c for c in ("version", "effective_date", *e.compared) if c in incoming.columns]
    return one_per_key(incoming, list(e.history_key), order)


def current_rows(dim: DataFrame, kind: str | Entity) -> DataFrame:
    """One current row per key, even where a table holds several rows marked current."""
    e = entity(kind)
    order = [c for c in ("version", "effective_date", *e.compared) if c in dim.columns]
    return one_per_key(dim.filter("is_current"), list(e.history_key), order)


def current_of_delivered(incoming: DataFrame, dim: DataFrame, kind: str | Entity) -> DataFrame:
    """Current rows of the delivered keys only.

    A delivery is usually much smaller than the dimension: its keys, sent to the scan, keep the rest of
    the dimension out of the shuffle. Where they are too many to send, both sides meet by key, which is
    the partitioning the following steps need anyway.
    """
    keys = list(entity(kind).history_key)
    return current_rows(dim.join(_distinct_keys(incoming, keys), keys, "left_semi"), kind)


def as_of(dim: DataFrame, *times: str) -> DataFrame:
    """The versions valid at each of the given times, as column `as_of`; one pass over the table."""
    moments = F.explode(F.array(*[time_literal(t) for t in times]))
    valid = (F.col("effective_date") <= F.col("as_of")) & (F.col("end_date").isNull() | (F.col("end_date") > F.col("as_of")))
    return dim.withColumn("as_of", moments).filter(valid)


def _compared(e: Entity, incoming: DataFrame, existing: DataFrame, compare: list[str] | None) -> list[str]:
    names = list(e.compared) if compare is None else compare
    return [c for c in names if c in incoming.columns and c in existing.columns]


def _paired(incoming: DataFrame, current: DataFrame, e: Entity, compare: list[str], how: str) -> DataFrame:
    """Keys with the delivered row `inc`, the stored row `cur` and the names of changed columns."""
    keys = list(e.history_key)
    for side, df in (("incoming", incoming), ("existing", current)):
        lacking = [k for k in keys if k not in df.columns]
        if lacking:
            raise ValueError(f"{side} rows lack business key {lacking}")

    def packed(df: DataFrame, name: str) -> DataFrame:
        # NaN counts as null, so that two missing measures are equal.
        cols = [f"nanvl({f.name}, NULL) AS {f.name}" if f.dataType == DOUBLE else f.name for f in df.schema]
        return df.selectExpr(*keys, f"struct({', '.join(cols)}) AS {name}")

    pairs = packed(incoming, "inc").join(packed(current, "cur"), keys, how)
    differs = ", ".join(f"CASE WHEN NOT inc.{c} <=> cur.{c} THEN '{c}' END" for c in compare)
    return pairs.withColumn("changed_fields", F.expr(f"array_compact(array({differs}))"))


def _change_type() -> Column:
    return (
        F.when(F.col("cur").isNull(), F.lit("new"))
        .when(F.size("changed_fields") > 0, F.lit("changed"))
        .otherwise(F.lit("unchanged"))
    )


def classify(incoming: DataFrame, existing: DataFrame, kind: str | Entity, compare: list[str] | None = None) -> DataFrame:
    """Per delivered key: new, changed or unchanged, and the changed columns as a comma list."""
    e = entity(kind)
    names = _compared(e, incoming, existing, compare)
    pairs = _paired(latest_delivered(incoming, e), current_of_delivered(incoming, existing, e), e, names, "left")
    changed = F.when(F.col("cur").isNotNull(), F.array_join("changed_fields", ","))
    return pairs.select(
        *e.history_key,
        _change_type().alias("change_type"),
        F.nullif(changed, F.lit("")).alias("changed_fields"),
        F.col("cur.version").alias("stored_version"),
    )


def summary(incoming: DataFrame, existing: DataFrame, kind: str | Entity, compare: list[str] | None = None) -> DataFrame:
    return classify(incoming, existing, kind, compare).groupBy("change_type").agg(F.count("*").alias("n"))


def new_keys(incoming: DataFrame, existing: DataFrame, kind: str | Entity) -> DataFrame:
    """Delivered keys without a current row."""
    keys = list(entity(kind).history_key)
    return _distinct_keys(incoming, keys).join(_distinct_keys(existing.filter("is_current"), keys), keys, "left_anti")


def existing_keys(incoming: DataFrame, existing: DataFrame, kind: str | Entity) -> DataFrame:
    """Delivered keys with a current row."""
    keys = list(entity(kind).history_key)
    return _distinct_keys(incoming, keys).join(_distinct_keys(existing.filter("is_current"), keys), keys, "left_semi")


def _distinct_keys(df: DataFrame, keys: list[str]) -> DataFrame:
    return df.select(*keys).dropna(subset=keys).distinct()


def _row(e: Entity, columns: list[str], side: str, changes: dict[str, str]) -> Column:
    """A target row from one side of a pair; `changes` gives SQL texts for columns that differ."""
    known = set(columns)
    values = {n: changes.get(n, f"{side}.{n}" if n in known else "NULL") for n, _ in e.fields}
    return F.expr(f"struct({', '.join(f'CAST({values[n]} AS {t.simpleString()}) AS {n}' for n, t in e.fields)})")


def _version_rows(e: Entity, incoming: DataFrame, existing: DataFrame, at: str) -> tuple[Column, Column, Column]:
    """Row of a new key, closed copy of the stored row, next version of a changed key."""
    moment = f"TIMESTAMP_NTZ '{at}'"
    opened = {"is_current": "true", "end_date": "NULL", "effective_date": moment}
    delivered, stored = incoming.columns, existing.columns
    first = _row(e, delivered, "inc", {**opened, "version": "1"})
    closed = _row(e, stored, "cur", {"is_current": "false", "end_date": moment})
    following = _row(e, delivered, "inc", {**opened, "version": "cur.version + 1"})
    return first, closed, following


def delta(
    incoming: DataFrame, existing: DataFrame, kind: str | Entity, at: str, compare: list[str] | None = None
) -> DataFrame:
    """Rows to write for a delivery: new keys, and for changed keys the closed copy and the next version."""
    e = entity(kind)
    names = _compared(e, incoming, existing, compare)
    pairs = _paired(latest_delivered(incoming, e), current_of_delivered(incoming, existing, e), e, names, "left")
    first, closed, following = _version_rows(e, incoming, existing, at)
    rows = F.when(F.col("cur").isNull(), F.array(first)).when(
        F.size("changed_fields") > 0, F.array(closed, following)
    )
    return pairs.select(F.inline(rows))


def first_load(incoming: DataFrame, kind: str | Entity, at: str) -> DataFrame:
    """Rows for an empty table: current and open, supplied version and date kept."""
    e = entity(kind)
    rows = latest_delivered(incoming, e)
    known = set(rows.columns)
    fill = {"version": "1", "effective_date": f"TIMESTAMP_NTZ '{at}'"}
    values = {n: (f"coalesce({n}, {fill[n]})" if n in fill else n) if n in known else fill.get(n, "NULL") for n in e.columns}
    values |= {"is_current": "true", "end_date": "NULL"}
    return rows.selectExpr(*[f"CAST({values[n]} AS {t.simpleString()}) AS {n}" for n, t in e.fields])


def merge_current(
    incoming: DataFrame,
    existing_current: DataFrame,
    kind: str | Entity,
    at: str,
    compare: list[str] | None = None,
) -> DataFrame:
    """Rows after the merge that stem from current rows and the delivery: one full outer join on the key.

    Keys absent from the delivery stay as they are. Of several current rows of one key, that of `current_rows` counts; the
    others are closed where it starts, so that none is lost. Copies of one row are one row.
    """
    e = entity(kind)
    keys = list(e.history_key)
    names = _compared(e, incoming, existing_current, compare)
    lead = [c for c in ("version", "effective_date", *e.compared) if c in existing_current.columns]
    rest = [*lead, *[c for c in existing_current.columns if c not in keys and c not in lead]]
    best = existing_current.groupBy(*keys).agg(F.max(F.struct(*rest)).alias("r"), F.count("*").alias("n"))
    current = best.select(*keys, "r.*").select(*existing_current.columns)
    # Usually no key is left here, which the adaptive plan sees before it reads the rows again.
    crowded = best.filter(F.col("n") > 1).select(*keys, F.col("r").alias("__r"))
    extra = existing_current.join(crowded, keys).filter(~F.struct(*rest).eqNullSafe(F.col("__r"))).withColumns({
        "is_current": F.lit(False), "end_date": F.greatest("effective_date", F.col("__r.effective_date")),
    })
    pairs = _paired(latest_delivered(incoming, e), current, e, names, "full")
    first, closed, following = _version_rows(e, incoming, current, at)
    kept = _row(e, current.columns, "cur", {})

    rows = (
        F.when(F.col("inc").isNull(), F.array(kept))
        .when(F.col("cur").isNull(), F.array(first))
        .when(F.size("changed_fields") > 0, F.array(closed, following))
        .otherwise(F.array(kept))
    )
    return pairs.select(F.inline(rows)).unionByName(extra.distinct().select(*[F.col(n).cast(t) for n, t in e.fields]))


def merge(
    incoming: DataFrame, existing: DataFrame, kind: str | Entity, at: str, compare: list[str] | None = None
) -> DataFrame:
    """Whole table after the merge: replaced rows closed in place, next versions and new keys added."""
    e = entity(kind)
    history = existing.filter(~F.coalesce(F.col("is_current"), F.lit(False))).select(*e.columns)
    return history.unionByName(merge_current(incoming, existing.filter("is_current"), e, at, compare))


def splices(
    incoming: DataFrame, table: DataFrame, kind: str | Entity, at: str, compare: list[str] | None = None
) -> DataFrame:
    """What a delivery of any age changes, one row per key: `version_row` to insert, the numbers of the version before it and of the
    next one, and whether that one is absorbed, because it says the same.

    The delivered row is valid from `at` to the start of the key's next version. Where the version valid at `at` says the same, nothing
    changes. A delivery that changed nothing left no version, so a still older one that comes after it holds until the next version. Both
    neighbours come from one aggregation per delivered key, combined on the map side.
    """
    e = entity(kind)
    keys, names = list(e.history_key), _compared(e, incoming, table, compare)
    delivered = latest_delivered(incoming, e)
    moment = time_literal(at)
    row, place = F.struct(*[F.col(c) for c in table.columns]), F.struct("effective_date", "version")
    begun = F.col("effective_date") <= moment
    around = table.join(_distinct_keys(delivered, keys), keys, "left_semi").groupBy(*keys).agg(
        F.max_by(F.when(begun, row), F.when(begun, place)).alias("prev"), F.min_by(F.when(~begun, row), F.when(~begun, place)).alias("nxt"),
    )
    doubles = {f.name for f in delivered.schema if f.dataType == DOUBLE}

    def says(side: str) -> Column:
        # NaN counts as null, as in `_paired`.
        pairs = [(f"nanvl(inc.{c}, NULL)", f"nanvl({side}.{c}, NULL)") if c in doubles else (f"inc.{c}", f"{side}.{c}") for c in names]
        same = " AND ".join(f"({a} <=> {b})" for a, b in pairs) or "true"
        return F.expr(f"{side} IS NOT NULL AND {same}")

    met = delivered.select(*keys, F.struct(*[F.col(c) for c in delivered.columns]).alias("inc")).join(around, keys, "left")
    met = met.filter(~says("prev")).withColumn("absorbed", says("nxt"))
    version = _row(e, delivered.columns, "inc", {
        "version": "coalesce(prev.version + 1, nxt.version, 1)", "effective_date": f"TIMESTAMP_NTZ '{at}'",
        "end_date": "if(absorbed, nxt.end_date, nxt.effective_date)", "is_current": "nxt IS NULL OR (absorbed AND nxt.is_current)",
    })
    return met.select(*keys, version.alias("version_row"), F.col("prev.version").alias("before"), F.col("nxt.version").alias("behind"), "absorbed")


def splice(table: DataFrame, changes: DataFrame, kind: str | Entity, at: str) -> DataFrame:
    """The whole table after `splices` of it: the version before is closed, an absorbed one leaves, later ones are renumbered."""
    e = entity(kind)
    keys, moment = list(e.history_key), time_literal(at)
    marks = changes.select(*keys, F.col("before").alias("__before"), F.col("behind").alias("__behind"), F.col("absorbed").alias("__absorbed"))
    rows = spread_join(table.select(*e.columns), marks, keys)
    closed = F.coalesce(F.col("version") == F.col("__before"), F.lit(False))
    gone = F.coalesce(F.col("__absorbed") & (F.col("version") == F.col("__behind")), F.lit(False))
    later = F.coalesce(~F.col("__absorbed") & (F.col("effective_date") > moment), F.lit(False))
    kept = rows.filter(~gone).withColumns({
        "end_date": F.when(closed, moment).otherwise(F.col("end_date")),
        "is_current": F.when(closed, F.lit(False)).otherwise(F.col("is_current")),
        "version": F.col("version") + F.when(later, 1).otherwise(0),
    })
    return kept.select(*[F.col(n).cast(t).alias(n) for n, t in e.fields]).unionByName(changes.select("version_row.*"))


# Versions of a key that one window takes together.
VERSION_SLICE = 1000


def integrity(dim: DataFrame, kind: str | Entity) -> DataFrame:
    """Counts of broken history rules; all zero for a sound dimension.

    An interval overlaps when it ends behind the start of the key's next version, whatever number that has, and is
    inverted when it ends before its own start. Versions of a key are followed in slices of numbers; the first start of the next
    slice that has any is carried over, so that no task holds all versions of a key.
    """
    keys = list(entity(kind).history_key)
    versions = dim.groupBy(*keys, "version").agg(
        F.count("*").alias("copies"),
        F.count_if("is_current").alias("n_current"),
        F.max(F.coalesce("end_date", time_literal("9999-12-31 00:00:00"))).alias("ends"),
        F.min("effective_date").alias("starts"),
        F.count_if(F.col("end_date") < F.col("effective_date")).alias("inverted"),
    ).withColumn("__slice", F.floor(F.col("version") / VERSION_SLICE))
    by_slice, in_slice = Window.partitionBy(*keys).orderBy("__slice"), Window.partitionBy(*keys, "__slice").orderBy("version")
    opening = versions.groupBy(*keys, "__slice").agg(F.min_by("starts", "version").alias("opens"))
    carried = opening.select(*keys, "__slice", F.lead("opens").over(by_slice).alias("carried"))
    per_key = (
        versions.withColumn("next_starts", F.lead("starts").over(in_slice))
        .join(carried, [*keys, "__slice"])
        .withColumn("next_starts", F.coalesce("next_starts", "carried"))
        .groupBy(*keys)
        .agg(
            F.sum("n_current").alias("n_current"),
            (F.max("version") - F.min("version") + 1 - F.count("*")).alias("gaps"),
            F.sum(F.col("copies") - 1).alias("copies"),
            F.count_if(F.col("ends") > F.col("next_starts")).alias("overlaps"),
            F.sum("inverted").alias("inverted"),
        )
    )
    checks = {
        "not_one_current": F.count_if(F.col("n_current") != 1),
        "version_gap": F.count_if(F.col("gaps") != 0),
        "repeated_version": F.count_if(F.col("copies") != 0),
        "overlap": F.coalesce(F.sum("overlaps"), F.lit(0)),
        "inverted": F.coalesce(F.sum("inverted"), F.lit(0)),
    }
    return per_key.agg(*[c.alias(n) for n, c in checks.items()]).unpivot([], list(checks), "check", "defects")
