"""Scenarios of a seven-key dimension, and rules that must hold after any merge."""

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from txlake.fixtures import Frames
from txlake.operators import scd2
from txlake.operators.prepare import prepare
from txlake.workload.deliveries import AS_OF, delivered, merged, source_columns, stored

DAY1, DAY2 = "2024-01-01 00:00:00", "2024-02-01 00:00:00"


def terminals(spark, rows, batch, at):
    """Rows of (key, x as text); the place is the same for all."""
    df = spark.createDataFrame(rows, "TERMINAL_ID BIGINT, x_terminal_id STRING")
    full = df.withColumns({"CITY": F.lit("c"), "REGION": F.lit("r")})
    return prepare(full, "terminals", batch, at)


@pytest.fixture(scope="module")
def scenario(spark):
    base = terminals(spark, [(1, "1"), (2, "1"), (3, None), (4, None), (5, "1"), (6, "1"), (7, "1")], "b1", DAY1)
    incoming = terminals(
        spark, [(1, "1"), (2, "2"), (3, None), (4, "2"), (5, None), (6, "NaN"), (8, "1"), (8, "2"), (None, "1")], "b2", DAY2
    )
    return base, incoming


COMPARE = ["CITY", "REGION", "x_terminal_id"]


def rows(df, *columns):
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=str)


def test_delta(scenario):
    base, incoming = scenario
    out = scd2.delta(incoming, base, "terminals", DAY2, COMPARE)
    expected = [(k, v, c) for k in (2, 4, 5, 6) for v, c in ((1, False), (2, True))] + [(8, 1, True)]
    assert rows(out, "TERMINAL_ID", "version", "is_current") == sorted(expected, key=str)
    closed = out.filter("NOT is_current")
    assert {r["BATCH_ID"] for r in closed.collect()} == {"b1"}
    assert closed.filter("end_date = TIMESTAMP_NTZ '2024-02-01 00:00:00'").count() == 4
    assert out.filter("TERMINAL_ID = 8").first()["x_terminal_id"] == 2.0


def test_merge_state(scenario):
    base, incoming = scenario
    out = scd2.merge(incoming, base, "terminals", DAY2, COMPARE)
    expected = [(k, 1, k in (1, 3, 7, 8)) for k in range(1, 9)] + [(k, 2, True) for k in (2, 4, 5, 6)]
    assert rows(out, "TERMINAL_ID", "version", "is_current") == sorted(expected, key=str)


def test_merge_again_changes_nothing(scenario):
    base, incoming = scenario
    once = scd2.merge(incoming, base, "terminals", DAY2, COMPARE)
    twice = scd2.merge(incoming, once, "terminals", "2024-03-01 00:00:00", COMPARE)
    assert rows(once, "*") == rows(twice, "*")
    assert scd2.delta(incoming, once, "terminals", "2024-03-01 00:00:00", COMPARE).count() == 0


def test_first_load_keeps_supplied_version(spark):
    df = spark.createDataFrame([(1, "c", "r", 4)], "TERMINAL_ID BIGINT, CITY STRING, REGION STRING, version BIGINT")
    out = scd2.first_load(prepare(df, "terminals", "b1", DAY1), "terminals", DAY1).first()
    assert (out["version"], out["is_current"], out["end_date"]) == (4, True, None)


def test_new_key_restarts_at_version_one(spark, scenario):
    base, _ = scenario
    df = spark.createDataFrame([(99, "c", "r", 4)], "TERMINAL_ID BIGINT, CITY STRING, REGION STRING, version BIGINT")
    out = scd2.delta(prepare(df, "terminals", "b2", DAY2), base, "terminals", DAY2, ["CITY", "REGION"]).first()
    assert out["version"] == 1 and str(out["effective_date"]) == DAY2


def test_absent_measure_is_no_change(spark, scenario):
    """A column the delivery lacks is filled by the preparation, but not compared."""
    base, _ = scenario
    df = spark.createDataFrame([(1, "c", "r")], "TERMINAL_ID BIGINT, CITY STRING, REGION STRING")
    incoming = prepare(df, "terminals", "b2", DAY2)
    assert scd2.delta(incoming, base, "terminals", DAY2, ["CITY", "REGION"]).isEmpty()


def test_missing_key_column_fails(scenario):
    base, incoming = scenario
    with pytest.raises((ValueError, PySparkException)):
        scd2.delta(incoming.drop("TERMINAL_ID"), base, "terminals", DAY2).collect()


def test_several_current_rows(scenario):
    """View, delta and merge pick the highest version; the merge closes the others, also where nothing was delivered."""
    base, incoming = scenario
    doubled = base.unionByName(base.filter("TERMINAL_ID = 2").withColumn("version", F.lit(5).cast("bigint")))
    assert scd2.current_rows(doubled, "terminals").filter("TERMINAL_ID = 2").first()["version"] == 5
    for delivery, chain in ((incoming, [(1, False), (5, False), (6, True)]), (incoming.limit(0), [(1, False), (5, True)])):
        after = scd2.merge(delivery, doubled, "terminals", DAY2, COMPARE).filter("TERMINAL_ID = 2").orderBy("version").collect()
        assert [(r["version"], r["is_current"]) for r in after] == chain
        assert all((r["end_date"] is None) == r["is_current"] for r in after)
    defects = {r["check"]: r["defects"] for r in scd2.integrity(doubled, "terminals").collect()}
    assert defects["not_one_current"] == 1 and defects["version_gap"] == 1


def test_integrity_sees_each_defect(scenario):
    base, incoming = scenario
    good = scd2.merge(incoming, base, "terminals", DAY2, COMPARE)
    assert all(r["defects"] == 0 for r in scd2.integrity(good, "terminals").collect())
    late = good.withColumn(
        "end_date", F.when(F.col("end_date").isNotNull(), F.lit("2024-05-01 00:00:00").cast("timestamp_ntz"))
    )
    twice = good.unionByName(good.filter("TERMINAL_ID = 2 AND version = 1"))
    assert {r["check"]: r["defects"] for r in scd2.integrity(late, "terminals").collect()}["overlap"] == 4
    assert {r["check"]: r["defects"] for r in scd2.integrity(twice, "terminals").collect()}["repeated_version"] == 1


def test_delta_applied_to_base_is_the_merge(spark, sf_dir):
    fx = Frames(spark, sf_dir)
    base, incoming = stored(fx, "customers"), delivered(fx, "customers")
    delta = scd2.delta(incoming, base, "customers", AS_OF, source_columns(fx, "customers"))
    closed = delta.filter("NOT is_current").select("CUSTOMER_ID")
    applied = base.join(closed, "CUSTOMER_ID", "left_anti").unionByName(delta)
    table = merged(fx, "customers")
    assert applied.exceptAll(table).isEmpty() and table.exceptAll(applied).isEmpty()
