"""Stored tables: repeated loads, interrupted loads, catalog definitions."""

import os
import random

import pytest
from pyspark.sql import functions as F

from txlake.operators import facts, scd2
from txlake.operators.prepare import prepare
from txlake.plans.session import workspace
from txlake.sources import tables
from txlake.sources.id_index import IdIndex
from txlake.sources.tables import DimensionTable

DAY1, DAY2, DAY3 = "2024-01-01 00:00:00", "2024-02-01 00:00:00", "2024-03-01 00:00:00"


def batch(spark, rows, name, at):
    df = spark.createDataFrame(rows, "TERMINAL_ID BIGINT, CITY STRING, REGION STRING")
    return prepare(df, "terminals", name, at)


def state(table):
    return sorted((r["TERMINAL_ID"], r["CITY"], r["version"], r["is_current"]) for r in table.read().collect())


@pytest.fixture
def table(spark):
    return DimensionTable(spark, "terminals", workspace(spark, "test"))


COMPARE = ["CITY", "REGION"]


def test_batches_and_replay(spark, table):
    assert table.read() is None
    assert table.load(batch(spark, [(1, "a", "r"), (2, "a", "r")], "b1", DAY1), "b1", DAY1) == (2, "success")
    second = batch(spark, [(1, "b", "r"), (3, "a", "r")], "b2", DAY2)
    assert table.load(second, "b2", DAY2, COMPARE) == (3, "success")
    assert table.load(second, "b2", DAY2, COMPARE) == (0, "already_loaded")
    assert table.load(second, "b3", DAY3, COMPARE) == (0, "no_changes")
    third = batch(spark, [(1, "c", "r")], "b4", DAY3)
    assert table.load(third, "b4", DAY3, COMPARE) == (2, "success")
    assert state(table) == [(1, "a", 1, False), (1, "b", 2, False), (1, "c", 3, True), (2, "a", 1, True), (3, "a", 1, True)]
    assert table.history().count() == 2


def test_interrupted_load_is_invisible_and_repeatable(spark, table):
    table.load(batch(spark, [(1, "a", "r")], "b1", DAY1), "b1", DAY1)
    # Files of a load that died before its commit.
    junk = batch(spark, [(1, "zzz", "r"), (7, "zzz", "r")], "b2", DAY2).withColumns(
        {"effective_day": F.to_date("effective_date"), "is_current": F.col("TERMINAL_ID") == 7}
    )
    junk.withColumn("key_bucket", F.lit(3)).write.partitionBy("key_bucket", "is_current", "effective_day").parquet(f"{table.data}/loaded_by=b2")
    assert state(table) == [(1, "a", 1, True)]
    assert table.load(batch(spark, [(1, "b", "r")], "b2", DAY2), "b2", DAY2, COMPARE) == (2, "success")
    assert state(table) == [(1, "a", 1, False), (1, "b", 2, True)]


def files_of(table):
    folder = table.data.removeprefix("file:")
    return sum(name.endswith(".parquet") for _, _, names in os.walk(folder) for name in names)


def test_a_load_rewrites_the_buckets_it_changes(spark, table, monkeypatch):
    monkeypatch.setattr(tables, "ROWS_PER_BUCKET", 13)
    many = [(i, "a", "r") for i in range(200)]
    table.load(batch(spark, many, "b1", DAY1), "b1", DAY1)
    before = files_of(table)
    assert before == 16
    assert table.load(batch(spark, many, "b2", DAY2), "b2", DAY2, COMPARE) == (0, "no_changes")
    assert files_of(table) == before
    assert table.load(batch(spark, [(5, "b", "r")], "b3", DAY2), "b3", DAY2, COMPARE) == (2, "success")
    # The closed row, the next version, and the untouched rows of the same bucket, which lie in another day.
    assert files_of(table) == before + 3
    assert table.current().count() == 200 and table.history().count() == 1


DAYS = [f"2024-0{m}-01 00:00:00" for m in range(1, 8)]


def chains(table):
    """Per key the versions in order: city, number, start, end, whether current."""
    out = {}
    for r in table.read().orderBy("TERMINAL_ID", "version").collect():
        out.setdefault(r.TERMINAL_ID, []).append((r.CITY, r.version, str(r.effective_date), str(r.end_date or "")[:19], r.is_current))
    return out


@pytest.mark.parametrize("buckets", [1, 3])
def test_older_deliveries_go_into_the_chain(spark, buckets):
    """Two deliveries in reverse order give the table of the order; repeated, changed and new keys, one key delivered once only."""
    first = [(1, "a", "r"), (2, "a", "r"), (3, "a", "r"), (4, "a", "r")]
    second = [(1, "b", "r"), (2, "a", "r"), (3, "b", "r"), (5, "e", "r")]
    third = [(1, "b", "r"), (2, "c", "r"), (3, "c", "r"), (5, "e", "r")]
    found = []
    for order in ([0, 1, 2], [0, 2, 1], [2, 1, 0], [1, 0, 2]):
        table = DimensionTable(spark, "terminals", workspace(spark, "late"), buckets)
        for i in order:
            rows = batch(spark, [first, second, third][i], f"b{i}", DAYS[i])
            assert table.load(rows, f"b{i}", DAYS[i], COMPARE)[1] == "success"
            assert table.load(rows, f"b{i}", DAYS[i], COMPARE)[1] == "already_loaded"
        found.append(chains(table))
        assert {r.defects for r in scd2.integrity(table.read(), "terminals").collect()} == {0}
    assert found[0] == found[1] == found[2] == found[3]
    assert found[0][1] == [("a", 1, DAYS[0], DAYS[1], False), ("b", 2, DAYS[1], "", True)]
    assert found[0][3] == [("a", 1, DAYS[0], DAYS[1], False), ("b", 2, DAYS[1], DAYS[2], False), ("c", 3, DAYS[2], "", True)]


def test_deliveries_of_any_age_against_plain_python(spark):
    """Every delivery is put into its key's chain; what says the same as the version before it changes nothing, what the next one says too absorbs that."""
    rnd = random.Random(8)
    table, expected = DimensionTable(spark, "terminals", workspace(spark, "late"), 2), {}
    days = [f"2024-01-{d:02d} 00:00:00" for d in range(1, 29)]
    order = rnd.sample(range(28), 9)
    for n, day in enumerate(order):
        rows = [(k, rnd.choice("ab"), "r") for k in range(6) if rnd.random() < 0.7]
        status = table.load(batch(spark, rows, f"b{n}", days[day]), f"b{n}", days[day], COMPARE)
        changed = 0
        for key, city, _ in rows:
            chain = expected.setdefault(key, [])
            i = sum(start <= day for start, _ in chain)
            if i and chain[i - 1][1] == city:
                continue
            changed += 1
            if i < len(chain) and chain[i][1] == city:
                chain.pop(i)
            chain.insert(i, (day, city))
        assert (status[1] == "success") == (changed > 0)
    ends = {k: [*(days[d] for d, _ in c[1:]), ""] for k, c in expected.items()}
    assert chains(table) == {
        k: [(city, i + 1, days[d], ends[k][i], i + 1 == len(c)) for i, (d, city) in enumerate(c)] for k, c in expected.items()
    }


def test_batch_ids_may_hold_any_text(spark, table):
    for i, name in enumerate(("2024/03:01 x", "a%b=c")):
        rows = batch(spark, [(1, f"c{i}", "r")], name, DAY1)
        assert table.load(rows, name, DAY1, COMPARE)[1] == "success"
        assert table.load(rows, name, DAY1, COMPARE)[1] == "already_loaded"
    assert state(table) == [(1, "c0", 1, False), (1, "c1", 2, True)]


def test_current_read_is_pruned(spark, table):
    table.load(batch(spark, [(1, "a", "r")], "b1", DAY1), "b1", DAY1)
    plan = table.current().filter("CITY = 'a'")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(is_current" in plan and "PushedFilters: [IsNotNull(CITY), EqualTo(CITY,a)]" in plan


def test_fact_batch_replaces_itself_only(spark):
    root = workspace(spark, "facts")
    schema = "TRANSACTION_ID STRING, TX_DATETIME STRING, CUSTOMER_ID BIGINT, TERMINAL_ID BIGINT, TX_AMOUNT DOUBLE"
    rows = [(f"t{i}", f"2024-01-0{1 + i % 3} 10:00:00", i, i, 1.0) for i in range(30)]
    df = spark.createDataFrame(rows, schema)
    for name in ("b1", "b2", "b1"):
        assert tables.append(prepare(df, "transactions", name, DAY1), "transactions", root) == 30
    stored = tables.read_appended(spark, "transactions", root)
    assert {r["BATCH_ID"]: r["count"] for r in stored.groupBy("BATCH_ID").count().collect()} == {"b1": 30, "b2": 30}
    plan = stored.filter("tx_date = DATE '2024-01-02' AND TX_AMOUNT > 5")._jdf.queryExecution().executedPlan().toString()
    assert "tx_date" in plan.split("PartitionFilters")[1][:60] and "GreaterThan(TX_AMOUNT,5.0)" in plan


def test_loads_of_nothing(spark):
    """Empty when planned, or only when the rows have been computed."""
    root = workspace(spark, "nothing")
    schema = "TRANSACTION_ID STRING, TX_DATETIME STRING, CUSTOMER_ID BIGINT, TERMINAL_ID BIGINT, TX_AMOUNT DOUBLE"
    some = prepare(spark.createDataFrame([("a", "2024-01-01 00:00:00", 1, 1, 1.0)], schema), "transactions", "b", DAY1)
    for rows in (facts.unseen(some, some), some.limit(0), spark.createDataFrame([], some.schema)):
        assert tables.upsert(rows, "transactions", root, "b", DAY1) == ("transactions", 0, "empty")
    dim = DimensionTable(spark, "terminals", root)
    assert dim.load(batch(spark, [(1, "a", "r")], "b", DAY1).limit(0), "b", DAY1) == (0, "empty")


def test_catalog_tables_are_created_once(spark):
    where = workspace(spark, "catalog")
    names = tables.create_tables(spark, "t_catalog", where)
    tables.insert(batch(spark, [(1, "a", "r")], "b1", DAY1), "t_catalog", "terminals")
    assert tables.create_tables(spark, "t_catalog", where) == names
    assert spark.table("t_catalog.dim_terminals").count() == 1
    assert {r["partition"] for r in spark.sql("SHOW PARTITIONS t_catalog.dim_terminals").collect()} == {"effective_day=2024-01-01"}
    spark.sql("DROP DATABASE t_catalog CASCADE")


def test_bucketed_profiles_join_without_exchange(spark):
    where = workspace(spark, "catalog")
    tables.create_tables(spark, "t_buckets", where)
    rows = [(i, "a,b", 1.0) for i in range(200)]
    df = spark.createDataFrame(rows, "CUSTOMER_ID BIGINT, TRAVEL_REGIONS STRING, AVG_TRAVEL_DISTANCE_KM DOUBLE")
    tables.insert(prepare(df, "travel_profiles", "b1", DAY1), "t_buckets", "travel_profiles")
    t = spark.table("t_buckets.dim_travel_profiles")
    counted = t.groupBy("CUSTOMER_ID").count()
    assert counted.count() == 200
    assert "Exchange" not in counted._jdf.queryExecution().sparkPlan().toString()
    spark.sql("DROP DATABASE t_buckets CASCADE")


def test_dispatch(spark):
    root = workspace(spark, "dispatch")
    rows = batch(spark, [(1, "a", "r")], "b1", DAY1)
    assert tables.upsert(rows, "terminals", root, "b1", DAY1) == ("terminals", 1, "success")
    assert tables.upsert(rows, "merchants", root, "b1", DAY1) == ("merchants", 0, "failed")
    assert tables.upsert(rows.limit(0), "terminals", root, "b2", DAY1) == ("terminals", 0, "empty")


def test_a_delivery_reads_the_id_buckets_it_falls_in(spark):
    """Files of the index that few ids open, out of many; claims of the same owner do not count, those of others do."""
    folder = workspace(spark, "ids")
    index = IdIndex(spark, folder, "ID", "bigint", buckets=64)
    index.claim(spark.range(0, 100_000).toDF("ID"), "b1")
    index.claim(spark.range(100_000, 101_000).toDF("ID"), "b2")

    def opened(delivered):
        held = index.held(delivered, "b3")
        return held, {r[0] for r in held.select(F.input_file_name()).distinct().collect()}

    _, every = opened(spark.range(0, 100_000).toDF("ID"))
    few = spark.createDataFrame([(5,), (5,), (100_500,), (999_999,), (None,)], "ID long")
    held, files = opened(few)
    assert len(every) == 128 and len(files) <= 6
    assert {r.ID for r in few.dropna().join(held, "ID", "left_anti").collect()} == {999_999}
    assert {r.ID for r in few.dropna().join(index.held(few, "b2"), "ID", "left_anti").collect()} == {100_500, 999_999}
    # Claimed again, the owner's ids are replaced, without those of others; the number of buckets stays.
    mine = index.claim(spark.range(99_000, 101_000).toDF("ID"), "b2")
    assert {r.ID for r in mine.collect()} == set(range(100_000, 101_000))
    again = IdIndex(spark, folder, "ID", "bigint", buckets=7)
    assert again.held(spark.range(0, 200_000).toDF("ID"), "b3").count() == 101_000
