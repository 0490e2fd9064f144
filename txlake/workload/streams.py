"""Queries on notifications and streams. Each stream reads the data folder and writes to a new one."""

from __future__ import annotations

from pyspark.sql import functions as F

from txlake.fixtures import SCHEMAS, VIEWS
from txlake.plans.session import workspace
from txlake.sources.tables import DimensionTable
from txlake.streaming import loads, object_events, runs, windows
from txlake.workload.deliveries import AS_OF, BATCH, FIRST_BATCH, LOADED, source_columns, stored
from txlake.workload.oracle_frames import stamp
from txlake.workload.registry import query


def _event_stream(fx):
    return runs.read_folder(fx.spark, fx.sf_dir, SCHEMAS["events"], "events.parquet")


def _stream_of(fx, view):
    return fx.spark.sql(VIEWS[view], events=_event_stream(fx))


# ---- Notifications ----


@query(
    "object_event_parse",
    "SELECT event_id, coalesce(event_name, '') AS event_name, bucket, raw_key, size FROM {notes} WHERE is_json",
)
def _(fx):
    parsed = object_events.records(object_events.parse(fx["notifications"]))
    return parsed.select("event_id", "event_name", "bucket", "raw_key", "size")


@query("object_event_relevant", "SELECT event_id, event_name FROM {notes} WHERE event_name LIKE 's3:ObjectCreated:%'")
def _(fx):
    return object_events.relevant(object_events.parse(fx["notifications"])).select("event_id", "event_name")


@query("object_event_keys", "SELECT event_id, bucket, raw_key, file_key, file_type FROM {note_keys}")
def _(fx):
    parsed = object_events.relevant(object_events.parse(fx["notifications"]))
    rows = object_events.keyed(object_events.records(parsed))
    return rows.select("event_id", "bucket", "raw_key", "file_key", "file_type")


@query("object_event_metadata", "SELECT * FROM {loader_records}")
def _(fx):
    return object_events.file_events(fx["notifications"])


@query(
    "event_counters",
    "SELECT (SELECT count(*) FROM {notes} WHERE is_json) AS processed, (SELECT count(*) FROM {loader_records}) AS created, "
    "(SELECT count(*) FROM {notes} WHERE NOT is_json) AS errors",
)
def _(fx):
    return object_events.counters(fx["notifications"])


# ---- Streams ----


@query("stream_object_events", "SELECT * FROM {loader_records}")
def _(fx):
    target, checkpoint = runs.folders(fx.spark, "object-events")
    found = object_events.file_events(_stream_of(fx, "notifications"))
    runs.append_available(found, target, checkpoint)
    return runs.read_written(fx.spark, target, found.schema)


@query("stream_work_queue", "SELECT event_id, file_key, file_type, 'queued' AS status FROM {loader_records}")
def _(fx):
    """Two streams, each with a checkpoint of its own, fill one queue."""
    target, checkpoint = runs.folders(fx.spark, "work-queue")
    for part in (0, 1):
        messages = _stream_of(fx, "notifications").filter(F.col("event_id") % 2 == part)
        loads.queue_files(messages, target, f"{checkpoint}-{part}")
    return runs.read_written(fx.spark, target, "event_id BIGINT, file_key STRING, file_type STRING, status STRING")


def _listened(fx):
    """Folder that two streams, each with a checkpoint of its own, fill from notifications."""
    target, checkpoint = runs.folders(fx.spark, "listener")
    for part in (0, 1):
        loads.listen(_stream_of(fx, "notifications").filter(F.col("event_id") % 2 == part), target, f"{checkpoint}-{part}")
    return target


@query(
    "stream_event_counters",
    """
SELECT time_bucket(INTERVAL 5 MINUTE, n.ts) AS window_start, count(*) FILTER (WHERE n.is_json) AS processed,
       count(l.event_id) AS created, count(*) FILTER (WHERE NOT n.is_json) AS errors
FROM {notes} n LEFT JOIN {loader_records} l ON n.event_id = l.event_id GROUP BY 1""",
)
def _(fx):
    return loads.read_counters(fx.spark, _listened(fx))


@query("stream_event_quarantine", "SELECT event_id, ts, 'not JSON' AS reject_reason FROM {notes} WHERE NOT is_json")
def _(fx):
    fields = "event_id BIGINT, ts TIMESTAMP_NTZ, reject_reason STRING"
    return runs.read_written(fx.spark, loads.quarantine_folder(_listened(fx)), fields)


@query("stream_dedup", "SELECT event_id, ts, user_id, event_type FROM {events}")
def _(fx):
    """Every event arrives twice."""
    target, checkpoint = runs.folders(fx.spark, "dedup")
    twice = _event_stream(fx).withColumn("copy", F.explode(F.array(F.lit(1), F.lit(2))))
    once = windows.drop_repeats(twice).select("event_id", F.col("ts").cast("timestamp_ntz").alias("ts"), "user_id", "event_type")
    runs.append_available(once, target, checkpoint)
    return runs.read_written(fx.spark, target, once.schema)


@query("stream_append_unseen", "SELECT event_id, ts, user_id, event_type FROM {events}")
def _(fx):
    """A second stream, with a checkpoint of its own, brings new events and repeats stored ids with another time."""
    base = workspace(fx.spark, "unseen")
    events = fx["events"].select("event_id", "ts", "user_id", "event_type")
    is_even = F.col("event_id") % 2 == 0
    later = F.when(is_even, F.col("ts") + F.make_dt_interval(days=F.lit(1))).otherwise(F.col("ts"))
    for name, landed in (("first", events.filter(is_even)), ("second", events.withColumn("ts", later))):
        landed.write.parquet(f"{base}/{name}")
        stream = runs.read_folder(fx.spark, f"{base}/{name}", events.schema)
        loads.append_unseen(stream, f"{base}/data", f"{base}/checkpoint-{name}", "event_id", "ts")
    return runs.read_written(fx.spark, f"{base}/data", events.schema).select(*events.columns)


@query(
    "stream_tumbling_counts",
    "SELECT time_bucket(INTERVAL 5 MINUTE, ts) AS window_start, event_type, count(*) AS n FROM {events} GROUP BY 1, 2",
)
def _(fx):
    return windows.run_counts(_event_stream(fx))


@query(
    "stream_fact_append",
    f"SELECT *, 'batch-2' AS BATCH_ID, {stamp(AS_OF)} AS created_at FROM {{tx}}",
)
def _(fx):
    target, checkpoint = runs.folders(fx.spark, "fact-stream")
    loads.append_transactions(_stream_of(fx, "tx"), target, checkpoint, BATCH, AS_OF)
    columns = "TRANSACTION_ID STRING, TX_DATETIME TIMESTAMP_NTZ, CUSTOMER_ID BIGINT, TERMINAL_ID BIGINT, TX_AMOUNT DOUBLE"
    rows = runs.read_written(fx.spark, target, f"{columns}, BATCH_ID STRING, created_at TIMESTAMP_NTZ, tx_date DATE")
    return rows.drop("tx_date")


@query(
    "stream_quarantine",
    "SELECT TRANSACTION_ID, TX_DATETIME, 'CUSTOMER_ID' AS reject_reason FROM {tx} WHERE CUSTOMER_ID % 10 = 0",
)
def _(fx):
    """Transactions without customer, kept apart by two streams on the same table."""
    target, checkpoint = runs.folders(fx.spark, "fact-rejects")
    customer = F.when(F.col("CUSTOMER_ID") % 10 != 0, F.col("CUSTOMER_ID"))
    for part in (0, 1):
        rows = _stream_of(fx, "tx").filter(F.pmod(F.xxhash64("TRANSACTION_ID"), F.lit(2)) == part)
        loads.append_transactions(rows.withColumn("CUSTOMER_ID", customer), target, f"{checkpoint}-{part}", BATCH, AS_OF)
    fields = "TRANSACTION_ID STRING, TX_DATETIME TIMESTAMP_NTZ, reject_reason STRING"
    return runs.read_written(fx.spark, loads.quarantine_folder(target), fields)


@query("stream_scd2_merge", "SELECT * REPLACE (replace(BATCH_ID, 'batch-2', 'customers-0') AS BATCH_ID) FROM {merged_c}")
def _(fx):
    """The second delivery lands in two folders and is merged by two streams, each with a checkpoint of its own."""
    base = workspace(fx.spark, "scd2-stream")
    table = DimensionTable(fx.spark, "customers", base)
    table.load(stored(fx, "customers"), FIRST_BATCH, LOADED)
    landed = fx["customers_v2"]
    for part in (0, 1):
        landed.filter(F.col("CUSTOMER_ID") % 2 == part).write.parquet(f"{base}/landing-{part}")
        stream = runs.read_folder(fx.spark, f"{base}/landing-{part}", landed.schema)
        loads.merge_dimension(stream, table, f"{base}/checkpoint-{part}", "customers", AS_OF, source_columns(fx, "customers"))
    # The id of a stream is new in every run.
    return table.read().withColumn("BATCH_ID", F.regexp_replace("BATCH_ID", "^customers-.*-", "customers-"))


@query(
    "late_rows_split",
    """
SELECT a.event_id, a.micro_batch, coalesce(a.ts < l.seen - INTERVAL 1 HOUR, FALSE) AS is_late
FROM (SELECT *, (event_id + CASE WHEN event_id % 20 = 0 THEN 200 ELSE 0 END) // 500 AS micro_batch FROM {events}) a
JOIN (SELECT micro_batch, max(top) OVER (ORDER BY micro_batch ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS seen
      FROM (SELECT (event_id + CASE WHEN event_id % 20 = 0 THEN 200 ELSE 0 END) // 500 AS micro_batch, max(ts) AS top
            FROM {events} GROUP BY 1)) l ON a.micro_batch = l.micro_batch""",
)
def _(fx):
    """One event in twenty arrives 200 places late."""
    arrived = fx["events"].select(
        "event_id", "ts",
        F.expr("(event_id + CASE WHEN event_id % 20 = 0 THEN 200 ELSE 0 END) div 500").alias("micro_batch"),
    )
    return windows.late_rows(arrived, "micro_batch", "ts", 3600).select("event_id", "micro_batch", "is_late")
