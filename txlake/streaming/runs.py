"""Running a stream over what is available, into Parquet folders that executors write themselves."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from txlake.plans.session import workspace


def read_folder(spark: SparkSession, path: str, schema, pattern: str = "*.parquet", files_per_batch: int | None = None):
    """Stream of the files of a folder."""
    reader = spark.readStream.schema(schema).option("pathGlobFilter", pattern)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.parquet(path)


def read_topic(spark: SparkSession, servers: str, topic: str, start: str = "latest") -> DataFrame:
    """Stream of the messages of a Kafka topic; needs Spark's Kafka connector on the class path.

    Positions are kept in the checkpoint of the query, so no message is lost between runs.
    """
    source = spark.readStream.format("kafka").option("kafka.bootstrap.servers", servers)
    rows = source.option("subscribe", topic).option("startingOffsets", start).load()
    return rows.selectExpr(
        "concat(topic, '-', partition, '-', offset) AS event_id", "timestamp AS ts", "CAST(value AS STRING) AS payload"
    )


# A micro-batch is named by its stream and its epoch. Spark keeps the stream's id in the checkpoint, so a restart has the
# same id, and a stream with a new checkpoint, whose epochs begin again at 0, another one.
Step = Callable[[DataFrame, str, int], None]


def append_available(df: DataFrame, target: str, checkpoint: str, partition_by: tuple[str, ...] = ()) -> None:
    """Append the rows of a stream to a folder, each input once; several streams may share the folder."""
    each_batch(df, write_epoch(target, partition_by), checkpoint)


def each_batch(df: DataFrame, step: Step, checkpoint: str, mode: str = "append") -> None:
    """Call `step(rows, stream id, epoch)` for every micro-batch. It may be called again for a batch, so it must be repeatable."""

    def named(batch: DataFrame, epoch: int) -> None:
        step(batch, batch.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId"), epoch)

    writer = df.writeStream.foreachBatch(named).option("checkpointLocation", checkpoint).outputMode(mode)
    _finish(writer.trigger(availableNow=True).start())


def write_epoch(target: str, partition_by: tuple[str, ...] = ()) -> Step:
    """Step that writes a micro-batch to its own partition; a repeated batch replaces what it wrote."""

    def step(batch: DataFrame, stream: str, epoch: int) -> None:
        batch.write.mode("overwrite").partitionBy(*partition_by).parquet(f"{target}/stream={stream}/epoch={epoch}")

    return step


def read_written(spark: SparkSession, target: str, schema) -> DataFrame:
    """What the streams of a folder wrote, without the names of the micro-batches."""
    return spark.read.schema(schema).parquet(target).drop("stream", "epoch")


def _finish(query) -> None:
    try:
        query.awaitTermination()
    finally:
        query.stop()


def folders(spark: SparkSession, name: str) -> tuple[str, str]:
    """New target and checkpoint folders for one run."""
    base = workspace(spark, name)
    return f"{base}/data", f"{base}/checkpoint"
