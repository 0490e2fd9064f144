"""Per-key sequences over time, split so that a hot key does not become one task.

A window partitioned by the key alone sorts every row of that key in one task. Here the windows over
rows are partitioned by key and time slice; what has to cross a slice border is first reduced to one
summary row per key and slice (combined on the map side), carried along the slices by a window over
those summaries, and joined back on key and slice. A key has at most as many summaries as there are
slices, however many rows it has.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from txlake.functions.search import leading
from txlake.registry import Entity, entity


def _slice(micros: Column, width: int) -> Column:
    """Start of the time slice of a moment, both in microseconds."""
    return micros - F.pmod(micros, F.lit(width))


def _micros(time: str) -> Column:
    return F.unix_micros(F.col(time).cast("timestamp"))


def version_index(versions: DataFrame, asked: DataFrame, keys: list[str], start: str, width: int) -> DataFrame:
    """One row per key and asked time slice with the versions that may be valid in it, in order: the last one started in
    a slice before, and those that start in the slice. `asked` has the keys and `__slice`, each pair once.

    Slices without a version are left out. Of versions that start at one moment the greatest counts.
    """
    attributes = [c for c in versions.columns if c not in keys]
    at = _micros(start)
    opened = versions.dropna(subset=[*keys, start]).select(
        *keys, _slice(at, width).alias("__slice"), F.struct(at.alias("t"), F.struct(*attributes).alias("v")).alias("__start")
    )
    # collect_list leaves out the nulls of asked slices.
    per_slice = (
        opened.unionByName(asked.withColumn("__asked", F.lit(True)), allowMissingColumns=True)
        .groupBy(*keys, "__slice")
        .agg(F.sort_array(F.collect_list("__start")).alias("__starts"), F.max("__asked").alias("__asked"))
    )
    earlier = Window.partitionBy(*keys).orderBy("__slice").rangeBetween(Window.unboundedPreceding, -1)
    carried = F.last(F.get("__starts", F.size("__starts") - 1), ignorenulls=True).over(earlier)
    valid = F.concat(F.when(F.col("__carried").isNotNull(), F.array("__carried")).otherwise(F.array()), "__starts")
    return (
        per_slice.withColumn("__carried", carried)
        .filter(F.col("__asked") & (F.col("__carried").isNotNull() | (F.size("__starts") > 0)))
        .select(*keys, "__slice", valid.alias("__versions"))
    )


def asof_join(
    facts: DataFrame,
    versions: DataFrame,
    keys: list[str],
    fact_time: str,
    start: str = "effective_date",
    end: str = "end_date",
    slice_seconds: int = 86_400,
) -> DataFrame:
    """Facts with the version valid at their time: start <= t < end, nulls where there is none.

    Versions of a key must not overlap; `scd2.integrity` reports where they do. Instead of a range join, which
    compares each fact with every version of its key, facts are joined by key and time slice with an index that has one row for
    each key and slice in which facts lie, and look their version up in its short list. Facts are neither sorted nor put in a window:
    their distinct keys and slices are combined on the map side, then they are shuffled once into a hash join. The index is dealt by key alone
    until then, so this join shuffles both sides, and the adaptive plan splits a hot key and day.
    """
    width = slice_seconds * 1_000_000
    attributes = [c for c in versions.columns if c not in keys]
    placed = facts.select(*keys, F.struct("*").alias("__f"), _micros(fact_time).alias("__t"))
    placed = placed.withColumn("__slice", _slice(F.col("__t"), width))
    index = version_index(versions, placed.select(*keys, "__slice").distinct(), keys, start, width)
    met = placed.join(index.hint("shuffle_hash"), [*keys, "__slice"], "left")
    started = leading(F.col("__versions"), lambda v: v["t"] <= F.col("__t"))
    found = met.select("__f", "__t", F.get("__versions", started - 1)["v"].alias("__v"))
    until = F.unix_micros(F.col(f"__v.{end}").cast("timestamp"))
    valid = F.when(until.isNull() | (F.col("__t") < until), F.col("__v"))
    return found.select("__f", valid.alias("__v")).select("__f.*", *[F.col(f"__v.{c}").alias(c) for c in attributes])


def rebuild(log: DataFrame, kind: str | Entity, slice_unit: str = "day") -> DataFrame:
    """Version chain from a change log: no-op entries dropped, versions numbered, intervals closed.

    Of several entries of a key at one time the greatest (version, then compared columns) counts.
    """
    e = entity(kind)
    keys, compared = list(e.history_key), [c for c in e.compared if c in log.columns]
    state = F.struct(*compared)
    entries = (
        log.dropna(subset=[*keys, "effective_date"])
        .groupBy(*keys, "effective_date")
        .agg(F.max(F.struct("version", state.alias("state"))).alias("r"))
        .select(*keys, "effective_date", F.col("r.state").alias("state"))
        .withColumn("__slice", F.date_trunc(slice_unit, "effective_date"))
    )
    by_key = Window.partitionBy(*keys).orderBy("__slice")
    by_slice = Window.partitionBy(*keys, "__slice").orderBy("effective_date")

    # 1. Drop entries equal to the one before; the first of a slice looks at the slice before.
    ends = entries.groupBy(*keys, "__slice").agg(F.max_by("state", "effective_date").alias("closing"))
    before = ends.select(*keys, "__slice", F.lag("closing").over(by_key).alias("opening"))
    changes = (
        entries.withColumn("previous", F.lag("state").over(by_slice))
        .join(before, [*keys, "__slice"])
        .filter(~F.col("state").eqNullSafe(F.coalesce("previous", "opening")))
        .select(*keys, "__slice", "effective_date", "state")
    )

    # 2. Number and close what is left, again with one summary per slice.
    counts = changes.groupBy(*keys, "__slice").agg(
        F.count("*").alias("n"), F.min("effective_date").alias("opens")
    )
    earlier = by_key.rowsBetween(Window.unboundedPreceding, -1)
    borders = counts.select(
        *keys,
        "__slice",
        F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("offset"),
        F.lead("opens").over(by_key).alias("next_opens"),
    )
    end = F.coalesce(F.lead("effective_date").over(by_slice), F.col("next_opens"))
    return (
        changes.join(borders, [*keys, "__slice"])
        .withColumns({
            "version": (F.col("offset") + F.row_number().over(by_slice)).cast("bigint"),
            "end_date": end,
        })
        .select(
            *keys, *[F.col(f"state.{c}").alias(c) for c in compared], "version", "effective_date", "end_date",
            F.col("end_date").isNull().alias("is_current"),
        )
    )


def trailing_count(
    df: DataFrame, keys: list[str], time: str, span_seconds: int, name: str, slices_per_span: int = 72
) -> DataFrame:
    """Rows of the same key within `[t - span, t]`, the row itself included, as column `name`.

    The span is cut into equal slices. A row counts its own slice up to its time, the full slices
    between, and the tail of the slice one span earlier. For the tail every row is sent a second
    time, moved one span ahead: it then falls in the slice of the rows that need it.
    """
    width = span_seconds * 1_000_000 // slices_per_span
    span = width * slices_per_span
    if span != span_seconds * 1_000_000:
        raise ValueError("the span must be a whole number of slices")
    places = F.array(
        F.struct(F.lit(0).cast("bigint").alias("ahead"), F.lit(True).alias("own")),
        F.struct(F.lit(span).cast("bigint").alias("ahead"), F.lit(False).alias("own")),
    )
    placed = (
        df.select(*keys, F.struct("*").alias("__f"), _micros(time).alias("__us"))
        .select(*keys, "__f", "__us", F.inline(places))
        # The moved copy only marks a time; it carries no payload.
        .select(*keys, "own", F.when(F.col("own"), F.col("__f")).alias("__f"), (F.col("__us") + F.col("ahead")).alias("__at"))
        .withColumn("__slice", _slice(F.col("__at"), width))
    )

    # Rows in the full slices between, as one more row of each slice that has rows of its own.
    per_slice = df.groupBy(*keys, _slice(_micros(time), width).alias("__slice")).agg(F.count("*").alias("n"))
    between = Window.partitionBy(*keys).orderBy("__slice").rangeBetween(-(slices_per_span - 1) * width, -width)
    full = per_slice.select(*keys, "__slice", F.coalesce(F.sum("n").over(between), F.lit(0)).alias("__full"))

    whole = Window.partitionBy(*keys, "__slice")
    up_to_here = whole.orderBy("__at").rangeBetween(Window.unboundedPreceding, 0)
    before_here = whole.orderBy("__at").rangeBetween(Window.unboundedPreceding, -1)
    moved = ~F.col("own")
    counted = placed.unionByName(full, allowMissingColumns=True).withColumns({
        "__own": F.count_if("own").over(up_to_here),
        "__tail": F.count_if(moved).over(whole) - F.count_if(moved).over(before_here),
        "__between": F.max("__full").over(whole),
    })
    total = F.col("__own") + F.col("__between") + F.col("__tail")
    return counted.filter("own").select("__f", total.cast("bigint").alias(name)).select("__f.*", name)


def sessions(df: DataFrame, keys: list[str], time: str, gap_seconds: int, amount: str) -> DataFrame:
    """Activity sessions per key: a new one starts when more than `gap_seconds` pass without a row.

    Rows within one gap-wide slice always belong together, so the slices are summed first (combined
    on the map side) and only the summaries are ordered per key.
    """
    micros = _micros(time)
    gap = gap_seconds * 1_000_000
    slices = df.groupBy(*keys, _slice(micros, gap).alias("__slice")).agg(
        F.min(time).alias("first"), F.max(time).alias("last"), F.count("*").alias("n"), F.sum(amount).alias("total"),
    )
    ordered = Window.partitionBy(*keys).orderBy("__slice")
    idle = _micros("first") - F.unix_micros(F.lag("last").over(ordered).cast("timestamp"))
    starts = slices.withColumn("__starts", F.coalesce(idle > gap, F.lit(True)).cast("bigint"))
    numbered = starts.withColumn("__session", F.sum("__starts").over(ordered.rowsBetween(Window.unboundedPreceding, 0)))
    return (
        numbered.groupBy(*keys, "__session")
        .agg(
            F.min("first").alias("session_start"), F.max("last").alias("session_last"),
            F.sum("n").alias("n_tx"), F.round(F.sum("total"), 2).alias("amount"),
        )
        .drop("__session")
    )
