"""Event-time counts, sessions, duplicate suppression and late rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from txlake.registry import STATS_INTERVAL
from txlake.streaming.runs import each_batch, folders, write_epoch


def event_time(df: DataFrame, column: str = "ts") -> DataFrame:
    """Watermarks need a zoned time; the session zone is UTC."""
    return df.withColumn(column, F.col(column).cast("timestamp"))


def tumbling_counts(stream: DataFrame, interval: str = STATS_INTERVAL) -> DataFrame:
    """Events per interval and type. State is one row per interval and type, whatever the number of events."""
    return (
        event_time(stream)
        .groupBy(F.window("ts", interval).alias("w"), "event_type")
        .agg(F.count("*").alias("n"))
        .select(F.col("w.start").cast("timestamp_ntz").alias("window_start"), "event_type", "n")
    )


def latest_counts(spark: SparkSession, target: str) -> DataFrame:
    """Last value that each stream wrote for an interval and type, added up over the streams."""
    fields = "window_start TIMESTAMP_NTZ, event_type STRING, n BIGINT, stream STRING, epoch BIGINT"
    rows = spark.read.schema(fields).parquet(target)
    last = rows.groupBy("stream", "window_start", "event_type").agg(F.max_by("n", "epoch").alias("n"))
    return last.groupBy("window_start", "event_type").agg(F.sum("n").alias("n"))


def run_counts(stream: DataFrame, name: str = "counts", base: str | None = None) -> DataFrame:
    """Counts of all that is available: changed groups are appended per micro-batch, readers take the last.

    With the same `base` folder a later call goes on where the one before stopped.
    """
    target, checkpoint = (f"{base}/data", f"{base}/checkpoint") if base else folders(stream.sparkSession, name)
    each_batch(tumbling_counts(stream), write_epoch(target), checkpoint, mode="update")
    return latest_counts(stream.sparkSession, target)


def drop_repeats(stream: DataFrame, key: str = "event_id", delay: str = "10 minutes") -> DataFrame:
    """One event per id among those that arrive within the delay of each other.

    State is bounded by the delay, at the price that Spark discards events older than it; where every
    event has to be kept, `loads.append_unseen` looks into the stored days instead.
    """
    return event_time(stream).withWatermark("ts", delay).dropDuplicatesWithinWatermark([key])


def session_counts(stream: DataFrame, key: str, gap: str = "30 minutes", delay: str = "10 minutes") -> DataFrame:
    """Closed activity sessions of a stream; `history.sessions` is the form for stored rows, without a delay."""
    return (
        event_time(stream)
        .withWatermark("ts", delay)
        .groupBy(F.session_window("ts", gap).alias("w"), key)
        .agg(F.count("*").alias("n"))
        .select(
            key, F.col("w.start").cast("timestamp_ntz").alias("session_start"),
            F.col("w.end").cast("timestamp_ntz").alias("session_end"), "n",
        )
    )


# Micro-batch numbers lie between minus and plus half of two to this power.
_LEVELS = 42


def earlier_max(tops: DataFrame, index: str, value: str) -> DataFrame:
    """index and `seen`, the greatest value of all smaller indexes, for each index that has any; one row per index comes in.

    What lies before an index is one aligned block of a power of two for each bit that is set in it. Maxima of all blocks are combined on the map
    side, and an index asks for its blocks by an equi-join: no window, no task that sees all indexes.
    """
    placed = tops.select(index, value, (F.col(index).cast("bigint") + F.lit(1 << (_LEVELS - 1))).alias("__u")).filter("__u IS NOT NULL")
    levels = F.sequence(F.lit(0), F.lit(_LEVELS - 1))
    maxima = (
        placed.select(F.col(value).alias("__top"), "__u", F.explode(levels).alias("__level"))
        .groupBy("__level", F.expr("shiftright(__u, __level)").alias("__block")).agg(F.max("__top").alias("__top"))
    )
    asked = placed.select(index, "__u", F.explode(levels).alias("__level")).filter("shiftright(__u, __level) % 2 = 1")
    asked = asked.select(index, "__level", F.expr("shiftright(__u, __level) - 1").alias("__block"))
    return asked.join(maxima, ["__level", "__block"]).groupBy(index).agg(F.max("__top").alias("seen"))


def late_rows(df: DataFrame, batch: str, time: str, delay_seconds: int) -> DataFrame:
    """Marks rows older than the greatest time of all earlier micro-batches less the delay. No row is dropped; a row
    without a micro-batch is not late. The running maximum needs one value per micro-batch (`earlier_max`).
    """
    tops = df.groupBy(batch).agg(F.max(time).alias("__time"))
    seen = earlier_max(tops, batch, "__time").withColumnRenamed("seen", "__seen")
    limit = F.col("__seen") - F.make_dt_interval(secs=F.lit(delay_seconds))
    return df.join(seen, batch, "left").select(
        *df.columns, F.coalesce(F.col(time) < limit, F.lit(False)).alias("is_late")
    )
