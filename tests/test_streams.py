"""Streams give what the batch forms give, also after a restart and a repeated micro-batch."""

from datetime import datetime, timedelta

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from txlake.fixtures import SCHEMAS, Frames
from txlake.operators.prepare import prepare
from txlake.plans.session import workspace
from txlake.sources.tables import DimensionTable
from txlake.streaming import loads, object_events, runs, windows

AT = "2024-03-01 00:00:00"


def same(a, b):
    assert a.columns == b.columns
    assert a.exceptAll(b).isEmpty() and b.exceptAll(a).isEmpty()


@pytest.fixture(scope="module")
def landed(spark, sf_dir):
    """Events as several files, in time order."""
    path = workspace(spark, "landed")
    events = Frames(spark, sf_dir)["events"]
    quarter = F.ntile(4).over(Window.orderBy("ts"))
    parts = events.withColumn("part", quarter)
    for i in range(1, 5):
        parts.filter(F.col("part") == i).drop("part").coalesce(1).write.mode("append").parquet(path)
    return path


def stream(spark, path, files=1):
    return runs.read_folder(spark, path, SCHEMAS["events"], files_per_batch=files)


def test_counts_over_several_batches(spark, landed):
    got = windows.run_counts(stream(spark, landed))
    want = windows.tumbling_counts(spark.read.schema(SCHEMAS["events"]).parquet(landed))
    same(got, want)


def test_restart_reads_only_new_files(spark, landed):
    base = workspace(spark, "restart")
    source, target, checkpoint = f"{base}/in", f"{base}/out", f"{base}/checkpoint"
    events = spark.read.schema(SCHEMAS["events"]).parquet(landed)
    first, second = events.filter("event_id % 2 = 0"), events.filter("event_id % 2 = 1")
    for part in (first, second):
        part.write.mode("append").parquet(source)
        runs.append_available(stream(spark, source, None), target, checkpoint)
    same(runs.read_written(spark, target, SCHEMAS["events"]), events)


def test_repeated_epoch_replaces_itself(spark):
    target = workspace(spark, "epochs")
    step = runs.write_epoch(target)
    for _ in range(2):
        step(spark.range(10), "a", 0)
    step(spark.range(5), "a", 1)
    step(spark.range(7), "b", 0)
    assert spark.read.parquet(target).count() == 22


def test_a_new_checkpoint_neither_deletes_nor_skips(spark):
    """Two streams with different inputs fill the same targets."""
    base = workspace(spark, "two-streams")
    schema = "event_id BIGINT, ts TIMESTAMP_NTZ"
    t0 = datetime(2024, 1, 1)
    inputs = {"a": [(1, t0), (2, t0), (None, t0)], "b": [(3, t0), (4, None), (4, None), (1, t0 + timedelta(days=3))]}
    for name, rows in inputs.items():
        spark.createDataFrame(rows, schema).coalesce(1).write.parquet(f"{base}/{name}")
        for _ in range(2):
            source = runs.read_folder(spark, f"{base}/{name}", schema)
            loads.append_unseen(source, f"{base}/out", f"{base}/checkpoint-{name}", "event_id", "ts")
        runs.append_available(runs.read_folder(spark, f"{base}/{name}", schema), f"{base}/all", f"{base}/cp-all-{name}")
    assert sorted(r.event_id for r in runs.read_written(spark, f"{base}/out", schema).collect()) == [1, 2, 3, 4]
    assert spark.read.parquet(loads.quarantine_folder(f"{base}/out")).count() == 1
    assert spark.read.parquet(f"{base}/all").count() == 7


def test_counts_resume_and_add_up_over_streams(spark, landed):
    base = workspace(spark, "resume")
    events = spark.read.schema(SCHEMAS["events"]).parquet(landed)
    for part in (events.filter("event_id % 2 = 0"), events.filter("event_id % 2 = 1")):
        part.write.mode("append").parquet(f"{base}/in")
        got = windows.run_counts(stream(spark, f"{base}/in", None), base=f"{base}/counts")
    same(got, windows.tumbling_counts(events))


def test_effective_time_of_each_micro_batch(spark):
    base = workspace(spark, "times")
    table = DimensionTable(spark, "terminals", base)
    schema = "TERMINAL_ID BIGINT, CITY STRING, REGION STRING, changed TIMESTAMP_NTZ"
    for i, city in enumerate("abc"):
        row = spark.createDataFrame([(1, city, "r", datetime(2024, 1 + i, 1)), (None, "x", "r", datetime(2024, 1, 1))], schema)
        row.coalesce(1).write.parquet(f"{base}/in{i}")
        source = runs.read_folder(spark, f"{base}/in{i}", schema)
        loads.merge_dimension(source, table, f"{base}/cp{i}", "s", loads.latest_time("changed"), ["CITY", "REGION"])
    chain = [(r.CITY, str(r.effective_date)[:7], str(r.end_date)[:7]) for r in table.read().orderBy("version").collect()]
    assert chain == [("a", "2024-01", "2024-02"), ("b", "2024-02", "2024-03"), ("c", "2024-03", "None")]
    assert spark.read.parquet(loads.quarantine_folder(table.data)).count() == 3
    # A micro-batch of older rows stops nothing: its version goes into the middle of the chain.
    spark.createDataFrame([(1, "d", "r", datetime(2024, 2, 15))], schema).write.parquet(f"{base}/in3")
    loads.merge_dimension(runs.read_folder(spark, f"{base}/in3", schema), table, f"{base}/cp3", "s", loads.latest_time("changed"), ["CITY", "REGION"])
    chain = [(r.CITY, r.version, str(r.effective_date)[:10], str(r.end_date)[:10]) for r in table.read().orderBy("version").collect()]
    assert chain == [("a", 1, "2024-01-01", "2024-02-01"), ("b", 2, "2024-02-01", "2024-02-15"), ("d", 3, "2024-02-15", "2024-03-01"),
                     ("c", 4, "2024-03-01", "None")]


def test_repeats_are_dropped_across_batches(spark, landed):
    base = workspace(spark, "repeats")
    events = spark.read.schema(SCHEMAS["events"]).parquet(landed)
    source = f"{base}/in"
    for _ in range(2):
        events.coalesce(1).write.mode("append").parquet(source)
    once = windows.drop_repeats(stream(spark, source, None), delay="40 days").select("event_id")
    runs.append_available(once, f"{base}/out", f"{base}/checkpoint")
    assert spark.read.parquet(f"{base}/out").count() == events.count()


def test_unseen_ids_survive_a_repeated_batch(spark, landed):
    """Old events that come after newer ones are kept, copies are not, and a lost commit changes nothing."""
    base = workspace(spark, "unseen")
    events = spark.read.schema(SCHEMAS["events"]).parquet(landed)
    for part in (events.filter("event_id >= 500"), events, events.filter("event_id < 10")):
        part.coalesce(1).write.mode("append").parquet(f"{base}/in")
        for checkpoint in ("a", "b"):
            loads.append_unseen(stream(spark, f"{base}/in"), f"{base}/out", f"{base}/{checkpoint}", "event_id", "ts")
    same(runs.read_written(spark, f"{base}/out", SCHEMAS["events"]).select(*events.columns), events)


def test_transactions_keep_late_rows(spark, landed):
    base = workspace(spark, "late")
    tx = stream(spark, landed).selectExpr(
        "concat('tx-', event_id) AS TRANSACTION_ID", "ts - make_dt_interval(event_id % 7) AS TX_DATETIME",
        "user_id AS CUSTOMER_ID", "event_id % 10 AS TERMINAL_ID", "value AS TX_AMOUNT",
    )
    loads.append_transactions(tx, f"{base}/out", f"{base}/checkpoint", "b", AT)
    out = spark.read.parquet(f"{base}/out")
    assert out.count() == spark.read.parquet(landed).count()
    assert out.select("TRANSACTION_ID").distinct().count() == out.count()


def test_closed_sessions_equal_the_batch(spark, landed):
    base = workspace(spark, "sessions")
    got_stream = windows.session_counts(stream(spark, landed), "user_id")
    runs.append_available(got_stream, f"{base}/out", f"{base}/checkpoint")
    got = runs.read_written(spark, f"{base}/out", got_stream.schema)
    want = windows.session_counts(spark.read.schema(SCHEMAS["events"]).parquet(landed), "user_id")
    assert got.exceptAll(want).isEmpty()
    assert want.count() - got.count() < want.count() * 0.05


def test_dimension_stream_in_steps(spark):
    """Two files, one micro-batch each; a key changes in both."""
    base = workspace(spark, "steps")
    table = DimensionTable(spark, "terminals", base)
    schema = "TERMINAL_ID BIGINT, CITY STRING, REGION STRING"
    table.load(prepare(spark.createDataFrame([(1, "a", "r"), (2, "a", "r")], schema), "terminals", "b0", AT), "b0", AT)
    source = f"{base}/in"
    for rows in ([(1, "b", "r"), (3, "a", "r")], [(1, "c", "r")]):
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(source)
        steps = runs.read_folder(spark, source, schema, files_per_batch=1)
        loads.merge_dimension(steps, table, f"{base}/checkpoint", "s", "2024-04-01 00:00:00", ["CITY", "REGION"])
    state = sorted((r["TERMINAL_ID"], r["CITY"], r["version"], r["is_current"]) for r in table.read().collect())
    assert state == [(1, "a", 1, False), (1, "b", 2, False), (1, "c", 3, True), (2, "a", 1, True), (3, "a", 1, True)]


MESSAGES = [
    ('{"EventName":"s3:ObjectCreated:Put","Records":[{"EventName":"x","s3":{"bucket":{"name":"raw-data"},'
     '"object":{"key":"raw-data%2Fcustomers%2Fa+b.csv","size":5}}},{"s3":{"bucket":{"name":"raw-data"},'
     '"object":{"key":"terminals/t.csv"}}},{"s3":{"bucket":{"name":"other"},"object":{"key":"terminals/t.csv"}}}]}'),
    '{"EventName":"s3:ObjectCreated:Put","Records":[{"s3":{"bucket":{"name":"raw-data"},"object":{"key":"customers/a.CSV"}}}]}',
    '{"EventName":"s3:ObjectRemoved:Delete","Records":[{"s3":{"bucket":{"name":"raw-data"},"object":{"key":"customers/a.csv"}}}]}',
    '{"EventName":"s3:ObjectCreated:Put"}',
    '{"Records":[]}',
    "[1, 2]",
    '"text"',
    "not json",
]


def test_notifications(spark):
    rows = [(i, datetime(2024, 1, 1) + timedelta(seconds=i), m) for i, m in enumerate(MESSAGES)]
    messages = spark.createDataFrame(rows, "event_id BIGINT, ts TIMESTAMP_NTZ, payload STRING")
    out = [tuple(r) for r in object_events.file_events(messages).orderBy("file_key").collect()]
    assert [(r[1], r[2], r[3], r[5], r[6]) for r in out] == [
        ("customers/a+b.csv", "s3://raw-data/customers/a+b.csv", 5, "customers", "x"),
        ("terminals/t.csv", "s3://raw-data/terminals/t.csv", 0, "terminals", ""),
    ]
    counts = object_events.counters(messages).first()
    assert (counts["processed"], counts["created"], counts["errors"]) == (7, 2, 1)


def test_listener_counts_what_it_saw(spark):
    """Over two runs of one stream, a repeated micro-batch and a late message; nulls in time and payload."""
    base = workspace(spark, "listener")
    target, checkpoint = f"{base}/out", f"{base}/checkpoint"
    fields = "event_id BIGINT, ts TIMESTAMP_NTZ, payload STRING"
    t0 = datetime(2024, 1, 1)
    rows = [(i, t0 + timedelta(seconds=100 * i), m) for i, m in enumerate(MESSAGES)] + [(90, None, "broken"), (91, t0, None)]
    late = [(92, t0 - timedelta(days=3), "broken"), (93, t0 + timedelta(seconds=299), MESSAGES[-1])]
    for part in (rows, late):
        spark.createDataFrame(part, fields).coalesce(1).write.mode("append").parquet(f"{base}/in")
        loads.listen(runs.read_folder(spark, f"{base}/in", fields), target, checkpoint)
    everything = spark.createDataFrame(rows + late, fields)
    got = loads.read_counters(spark, target)
    same(got, object_events.pane_counters(everything))
    whole = object_events.counters(everything).first()
    assert [sum(r[c] for r in got.collect()) for c in whole.asDict()] == list(whole)
    assert got.filter("window_start IS NULL").first()["errors"] == 1
    assert {r["window_start"].second for r in got.dropna().collect()} == {0}
    rejected = runs.read_written(spark, loads.quarantine_folder(target), f"{fields}, reject_reason STRING")
    assert {r["event_id"] for r in rejected.collect()} == {len(MESSAGES) - 1, 90, 91, 92, 93}
    same(runs.read_written(spark, target, object_events.file_events(everything).schema), object_events.file_events(everything))
    # The same stream and epoch again.
    stream_id, epoch = spark.read.parquet(loads.counters_folder(target)).select("stream", "epoch").filter("epoch = 1").first()
    again = object_events.pane_counters(spark.createDataFrame(late, fields))
    runs.write_epoch(loads.counters_folder(target))(again, stream_id, epoch)
    same(loads.read_counters(spark, target), object_events.pane_counters(everything))


def test_late_rows_across_groups(spark):
    """The running maximum must not depend on where the numbers of the batches begin."""
    t0 = datetime(2024, 1, 1)
    rows = [(b, t0 + timedelta(minutes=10 * b - (300 if b % 7 == 0 else 0))) for b in range(60)]
    df = spark.createDataFrame(rows, "b BIGINT, t TIMESTAMP_NTZ")
    want, top = {}, None
    for b, t in rows:
        want[b] = top is not None and t < top - timedelta(hours=1)
        top = max(top, t) if top else t
    unknown = spark.createDataFrame([(None, t0)], df.schema)
    assert [r["is_late"] for r in windows.late_rows(df.union(unknown), "b", "t", 3600).filter("b IS NULL").collect()] == [False]
    for shift in (0, -31, 1 << 33):
        moved = df.withColumn("b", F.col("b") + shift)
        found = windows.late_rows(moved, "b", "t", 3600)
        assert {r["b"] - shift: r["is_late"] for r in found.collect()} == want
        assert "Window" not in found._jdf.queryExecution().executedPlan().toString()


def test_queue_rows_are_marked(spark, sf_dir):
    from txlake.workload import QUERIES

    assert QUERIES["stream_work_queue"](spark, sf_dir).filter(F.col("status") != "queued").isEmpty()
