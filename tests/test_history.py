"""Sliced per-key sequences against brute force, with one key holding a third of the rows."""

import random
from bisect import bisect_right
from datetime import datetime, timedelta

import pytest

from txlake.operators import facts, history, scd2

T0 = datetime(2024, 1, 1)


@pytest.fixture(scope="module")
def events():
    r = random.Random(7)
    out = []
    for i in range(900):
        key = 1 if i % 3 == 0 else r.randrange(2, 30)
        # Whole minutes make equal times and exact span borders frequent.
        out.append((i, key, T0 + timedelta(minutes=r.randrange(0, 4 * 24 * 60)), round(r.uniform(1, 100), 2)))
    return out


@pytest.fixture(scope="module")
def frame(spark, events):
    return spark.createDataFrame(events, "id BIGINT, k BIGINT, t TIMESTAMP_NTZ, v DOUBLE").repartition(6)


def by_key(events):
    grouped = {}
    for row in events:
        grouped.setdefault(row[1], []).append(row)
    return grouped


@pytest.mark.parametrize("slices", [1, 4, 72])
def test_trailing_count(frame, events, slices):
    span = timedelta(hours=6)
    expected = {
        e[0]: sum(e[2] - span <= o[2] <= e[2] for o in group) for group in by_key(events).values() for e in group
    }
    out = history.trailing_count(frame, ["k"], "t", 6 * 3600, "n", slices)
    assert {r["id"]: r["n"] for r in out.collect()} == expected
    assert out.columns == ["id", "k", "t", "v", "n"]


def test_trailing_count_keeps_rows_without_key(spark):
    df = spark.createDataFrame([(None, T0), (None, T0 + timedelta(hours=1)), (1, T0)], "k BIGINT, t TIMESTAMP_NTZ")
    assert sorted(r["n"] for r in history.trailing_count(df, ["k"], "t", 7200, "n").collect()) == [1, 1, 2]


def test_sessions(frame, events):
    gap = timedelta(minutes=30)
    expected = []
    for key, group in by_key(events).items():
        current = []
        for e in sorted(group, key=lambda e: (e[2], e[0])):
            if current and e[2] - current[-1][2] > gap:
                expected.append((key, current[0][2], current[-1][2], len(current)))
                current = []
            current.append(e)
        expected.append((key, current[0][2], current[-1][2], len(current)))
    out = history.sessions(frame, ["k"], "t", 1800, "v")
    got = [(r["k"], r["session_start"], r["session_last"], r["n_tx"]) for r in out.collect()]
    assert sorted(got) == sorted(expected)


@pytest.mark.parametrize("slice_seconds", [3600, 86_400, 30 * 86_400])
def test_asof_join(spark, frame, events, slice_seconds):
    r = random.Random(3)
    versions = []
    for key in range(1, 25):
        starts = sorted({T0 + timedelta(minutes=r.randrange(-3000, 4 * 24 * 60)) for _ in range(40 if key == 1 else 3)})
        for n, start in enumerate(starts):
            end = starts[n + 1] if n + 1 < len(starts) else (None if key % 2 else start + timedelta(hours=5))
            versions.append((key, n + 1, start, end))
    dim = spark.createDataFrame(versions, "k BIGINT, version BIGINT, effective_date TIMESTAMP_NTZ, end_date TIMESTAMP_NTZ")
    expected = {}
    for i, key, t, _ in events:
        own = [v for v in versions if v[0] == key]
        at = bisect_right([v[2] for v in own], t) - 1
        hit = own[at] if at >= 0 and (own[at][3] is None or t < own[at][3]) else None
        expected[i] = hit[1] if hit else None
    out = history.asof_join(frame, dim, ["k"], "t", slice_seconds=slice_seconds)
    assert {r["id"]: r["version"] for r in out.collect()} == expected


def test_rebuild_hot_key(spark):
    """A key with a change almost every minute over several days, with no-ops and repeated times."""
    r = random.Random(5)
    log = []
    for key, n in ((1, 400), (2, 5), (3, 1)):
        for i in range(n):
            log.append((key, r.choice("ab"), "r", float(r.randrange(2)), T0 + timedelta(minutes=r.randrange(0, 4000)), i))
    schema = "TERMINAL_ID BIGINT, CITY STRING, REGION STRING, x_terminal_id DOUBLE, effective_date TIMESTAMP_NTZ, version BIGINT"
    out = history.rebuild(spark.createDataFrame(log, schema).repartition(5), "terminals")
    expected = []
    for key in (1, 2, 3):
        latest = {}
        for row in log:
            if row[0] == key and (row[4] not in latest or row[5] > latest[row[4]][5]):
                latest[row[4]] = row
        chain = []
        for at in sorted(latest):
            state = latest[at][1:4]
            if not chain or chain[-1][0] != state:
                chain.append((state, at))
        for n, (state, at) in enumerate(chain):
            expected.append((key, *state, n + 1, at, chain[n + 1][1] if n + 1 < len(chain) else None))
    got = [
        (r["TERMINAL_ID"], r["CITY"], r["REGION"], r["x_terminal_id"], r["version"], r["effective_date"], r["end_date"])
        for r in out.collect()
    ]
    assert sorted(got, key=str) == sorted(expected, key=str)


def test_dedup_of_many_copies(spark):
    rows = [("hot", T0, 1.0, 1, 1)] * 500 + [("hot", T0, 2.0, 1, 1), ("x", T0, 1.0, 2, 2)]
    schema = "TRANSACTION_ID STRING, TX_DATETIME TIMESTAMP_NTZ, TX_AMOUNT DOUBLE, CUSTOMER_ID BIGINT, TERMINAL_ID BIGINT"
    df = spark.createDataFrame(rows, schema).repartition(4)
    assert sorted(tuple(r) for r in facts.dedup(df).collect()) == [("hot", T0, 2.0, 1, 1), ("x", T0, 1.0, 2, 2)]


def test_rebuilt_history_is_sound(spark, sf_dir):
    from txlake.workload import QUERIES

    out = QUERIES["scd2_rebuild_history"](spark, sf_dir)
    assert all(r["defects"] == 0 for r in scd2.integrity(out, "customers").collect())
