"""Streams that feed the tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from txlake.operators.facts import dedup
from txlake.operators.prepare import REJECT, conform
from txlake.sources.id_index import IdIndex
from txlake.sources.tables import DimensionTable, with_day
from txlake.streaming.object_events import broken, file_events, pane_counters
from txlake.streaming.runs import Step, each_batch, read_written, write_epoch


def quarantine_folder(target: str) -> str:
    """Where a stream puts the rows that `target` does not take, with the reason."""
    return f"{target.rstrip('/')}_quarantine"


def _split(accepted: Step, rejected: Step) -> Step:
    """Step for conformed rows: those without and those with a reason to reject, computed once."""

    def step(batch: DataFrame, stream: str, epoch: int) -> None:
        held = batch.persist()
        try:
            rejected(held.filter(F.col(REJECT).isNotNull()), stream, epoch)
            accepted(held.filter(F.col(REJECT).isNull()).drop(REJECT), stream, epoch)
        finally:
            held.unpersist()

    return step


def append_transactions(stream: DataFrame, target: str, checkpoint: str, batch_id: str, at: str) -> None:
    """Conformed transactions appended by day. Late rows are kept: there is no watermark. Rows without identity go
    to the quarantine."""
    rows = with_day(conform(stream, "transactions", batch_id, at), "transactions")
    each_batch(rows, _split(write_epoch(target, ("tx_date",)), write_epoch(quarantine_folder(target))), checkpoint)


def append_unseen(stream: DataFrame, target: str, checkpoint: str, key: str, time: str) -> None:
    """Append each id once, however late its copies come and whatever their time; no row is dropped for its age.

    A micro-batch looks for its ids in an index beside the target, of which it reads the buckets they fall in. What an earlier attempt of
    the micro-batch claimed and wrote is claimed and written again, in its place. Rows without id go to the quarantine.
    """
    spark = stream.sparkSession
    others = [c for c in stream.columns if c != key]
    index = IdIndex(spark, f"{target.rstrip('/')}_ids", key, stream.schema[key].dataType.simpleString())

    def append(batch: DataFrame, stream_id: str, epoch: int) -> None:
        claimed = index.claim(batch, f"{stream_id}-{epoch}")
        fresh = dedup(batch, key, others).join(claimed, key, "left_semi").withColumn("day", F.to_date(time))
        write_epoch(target, ("day",))(fresh, stream_id, epoch)

    checked = stream.withColumn(REJECT, F.when(F.col(key).isNull(), F.lit(key)))
    each_batch(checked, _split(append, write_epoch(quarantine_folder(target))), checkpoint)


def queue_files(messages: DataFrame, target: str, checkpoint: str) -> None:
    """Work queue: one entry per file to load, written per micro-batch."""
    each_batch(file_events(messages).withColumn("status", F.lit("queued")), write_epoch(target), checkpoint)


def counters_folder(target: str) -> str:
    """Where `listen` puts its counts."""
    return f"{target.rstrip('/')}_counters"


def listen(messages: DataFrame, target: str, checkpoint: str) -> None:
    """Loader records of a stream of notifications, with what the stream itself saw.

    Of each micro-batch, its records go to `target`, messages that are no JSON to the quarantine, and the messages processed, files accepted and
    errors of each interval beside it. These counts are the micro-batch's own, and add up over micro-batches and streams
    (`read_counters`). So there is no state to hold, a late message counts in its interval, and a repeated micro-batch
    replaces records, rejects and counts alike.
    """

    def step(batch: DataFrame, stream: str, epoch: int) -> None:
        held = batch.persist()
        try:
            write_epoch(quarantine_folder(target))(broken(held), stream, epoch)
            write_epoch(counters_folder(target))(pane_counters(held), stream, epoch)
            write_epoch(target)(file_events(held), stream, epoch)
        finally:
            held.unpersist()

    each_batch(messages, step, checkpoint)


def read_counters(spark: SparkSession, target: str) -> DataFrame:
    """window_start, processed, created, errors: what all streams into `target` have counted so far."""
    fields = "window_start TIMESTAMP_NTZ, processed BIGINT, created BIGINT, errors BIGINT"
    rows = read_written(spark, counters_folder(target), fields)
    return rows.groupBy("window_start").agg(*[F.sum(c).alias(c) for c in ("processed", "created", "errors")])


def merge_dimension(
    stream: DataFrame, table: DimensionTable, checkpoint: str, name: str, at: str | Callable[[DataFrame], str],
    compare: list[str] | None = None, quarantine: str | None = None,
) -> None:
    """Merge every micro-batch into a dimension; the batch id holds stream and epoch, so a replay is a no-op.

    `at` is the time from which the merged versions are valid: one text, or a function that reads it from the rows of a
    micro-batch, as `latest_time` does. Rows without identity go to the quarantine.
    """

    def step(batch: DataFrame, stream_id: str, epoch: int) -> None:
        batch_id = f"{name}-{stream_id}-{epoch}"
        moment = at if isinstance(at, str) else at(batch)

        def merge(rows: DataFrame, *_) -> None:
            table.load(rows, batch_id, moment, compare)

        rejected = write_epoch(quarantine or quarantine_folder(table.data))
        _split(merge, rejected)(conform(batch, table.entity, batch_id, moment), stream_id, epoch)

    each_batch(stream, step, checkpoint)


def latest_time(column: str) -> Callable[[DataFrame], str]:
    """Effective time of a micro-batch: the greatest time in it. An empty micro-batch changes nothing, so any time will do."""

    def read(batch: DataFrame) -> str:
        return str(batch.agg(F.max(column)).first()[0] or "1970-01-01 00:00:00")

    return read
