"""Object-created notifications: parse, filter, route. The same functions serve batch and stream frames."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from txlake.functions.keys import decode_key, drop_bucket_prefix, entity_of_csv_key, object_uri
from txlake.registry import CREATED_EVENT_PREFIX, RAW_BUCKET, STATS_SECONDS

# Field names of a notification and constants of the derived record.
NOTIFICATION_SCHEMA = (
    "EventName STRING, Records ARRAY<STRUCT<EventName: STRING, s3: STRUCT<bucket: STRUCT<name: STRING>, "
    "object: STRUCT<key: STRING, size: BIGINT>>>>"
)
SOURCE = "minio_kafka_notification"
DATASET_FOLDER = "creditcard_files"

NOT_JSON = "not JSON"


def is_json(payload: Column) -> Column:
    return F.get_json_object(payload, "$").isNotNull()


def parse(messages: DataFrame, payload: str = "payload") -> DataFrame:
    """Adds `event_name`, `records` and `is_json`. Text that is not a JSON object has neither name nor records."""
    parsed = F.from_json(F.col(payload), NOTIFICATION_SCHEMA)
    return messages.withColumns({"__n": parsed, "is_json": is_json(F.col(payload))}).withColumns({
        "event_name": F.coalesce(F.col("__n.EventName"), F.lit("")),
        "records": F.coalesce(F.col("__n.Records"), F.array()),
    }).drop("__n")


def relevant(parsed: DataFrame) -> DataFrame:
    """Object-created messages."""
    return parsed.filter(F.col("event_name").startswith(CREATED_EVENT_PREFIX))


def records(parsed: DataFrame) -> DataFrame:
    """One row per record of a message, with defaults for what the record leaves out."""
    others = [c for c in parsed.columns if c != "records"]
    # The outer form keeps the null test behind the explode, where it does not repeat the parsing.
    r = parsed.select(*others, F.explode_outer("records").alias("r")).filter("r IS NOT NULL")
    return r.select(
        *others,
        F.coalesce("r.s3.bucket.name", F.lit("")).alias("bucket"),
        F.coalesce("r.s3.object.key", F.lit("")).alias("raw_key"),
        F.coalesce("r.s3.object.size", F.lit(0).cast("bigint")).alias("size"),
        F.coalesce("r.EventName", F.lit("")).alias("record_event_name"),
    )


def clean_key(raw_key: Column, bucket: str = RAW_BUCKET) -> Column:
    return drop_bucket_prefix(decode_key(raw_key), bucket)


def keyed(rows: DataFrame, bucket: str = RAW_BUCKET) -> DataFrame:
    """Records of the watched bucket with their clean key and entity; the entity is null unless the key is a csv."""
    clean = rows.filter(F.col("bucket") == bucket).withColumn("file_key", clean_key(F.col("raw_key"), bucket))
    return clean.withColumn("file_type", entity_of_csv_key(F.col("file_key")))


def metadata(routed: DataFrame, processed_at: Column) -> DataFrame:
    """Record handed to the loader for each routed file."""
    return routed.filter(F.col("file_type").isNotNull()).select(
        "event_id",
        "file_key",
        object_uri(F.col("bucket"), F.col("file_key")).alias("file_path"),
        F.col("size").alias("file_size_bytes"),
        F.col("bucket").alias("bucket_name"),
        "file_type",
        F.col("record_event_name").alias("event_name"),
        F.date_format(processed_at, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS").alias("processed_at"),
        F.lit(SOURCE).alias("source"),
        object_uri(F.col("bucket"), F.lit(DATASET_FOLDER)).alias("dataset_uri"),
    )


def file_events(messages: DataFrame) -> DataFrame:
    """Messages to loader records.

    The records of other messages are emptied rather than filtered out beforehand: a filter on the
    event name would make Spark parse every message once for the filter and again for the records.
    """
    parsed = parse(messages)
    created = F.col("event_name").startswith(CREATED_EVENT_PREFIX)
    kept = parsed.withColumn("records", F.when(created, F.col("records")))
    return metadata(keyed(records(kept)), F.col("ts"))


def broken(messages: DataFrame, payload: str = "payload") -> DataFrame:
    """Messages whose payload is no JSON, or null, with the reason."""
    return messages.filter(~is_json(F.col(payload))).withColumn("reject_reason", F.lit(NOT_JSON))


def _tallied(messages: DataFrame) -> DataFrame:
    """Adds `accepted`, the number of a message's files that are handed to the loader."""
    created = F.col("event_name").startswith(CREATED_EVENT_PREFIX)
    accepted = F.when(created, F.size(F.filter("records", _routes_to_entity))).otherwise(F.lit(0))
    return parse(messages).withColumn("accepted", accepted)


def _totals() -> list[Column]:
    return [
        F.count_if("is_json").alias("processed"),
        F.coalesce(F.sum("accepted"), F.lit(0)).cast("bigint").alias("created"),
        F.count_if(~F.col("is_json")).alias("errors"),
    ]


def counters(messages: DataFrame) -> DataFrame:
    """Messages processed, files accepted, texts that failed to parse."""
    return _tallied(messages).agg(*_totals())


def pane_counters(messages: DataFrame, seconds: int = STATS_SECONDS) -> DataFrame:
    """`counters` for every interval of the messages' time; messages without a time count in an interval of null."""
    at = F.unix_seconds(F.col("ts").cast("timestamp"))
    start = F.timestamp_seconds(at - F.pmod(at, F.lit(seconds))).cast("timestamp_ntz")
    return _tallied(messages).groupBy(start.alias("window_start")).agg(*_totals())


def _routes_to_entity(record: Column) -> Column:
    key = clean_key(record["s3"]["object"]["key"])
    return (record["s3"]["bucket"]["name"] == RAW_BUCKET) & entity_of_csv_key(key).isNotNull()
