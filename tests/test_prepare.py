"""Dirty values, missing and extra columns."""

from datetime import datetime

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from txlake.operators import prepare as p
from txlake.registry import ENTITIES

AT = "2024-03-01 00:00:00"
TX = "TRANSACTION_ID STRING, TX_DATETIME STRING, CUSTOMER_ID STRING, TERMINAL_ID STRING, TX_AMOUNT STRING, IS_NEW_REGION STRING"


def tx(spark, **values):
    row = {"TRANSACTION_ID": "a", "TX_DATETIME": "2024-01-01 10:00:00", "CUSTOMER_ID": "1", "TERMINAL_ID": "2",
           "TX_AMOUNT": "1.5", "IS_NEW_REGION": "true", **values}
    return spark.createDataFrame([tuple(row.values())], TX)


def prepared(spark, **values):
    return p.prepare(tx(spark, **values), "transactions", "b", AT).first()


@pytest.mark.parametrize("text", ["", "NA", "N/A", "NaN", "nan", "NULL", "null", "None", "abc"])
def test_unreadable_amount_becomes_the_default(spark, text):
    assert prepared(spark, TX_AMOUNT=text)["TX_AMOUNT"] == 0.0


@pytest.mark.parametrize("text", ["", "NA", "3.7", "abc"])
def test_row_without_key_is_quarantined(spark, text):
    assert prepared(spark, CUSTOMER_ID=text) is None
    assert p.quarantine(tx(spark, CUSTOMER_ID=text), "transactions", "b", AT).first()[p.REJECT] == "CUSTOMER_ID"


@pytest.mark.parametrize("text,value", [("3", 3), ("3.0", 3), (" 4 ", 4), ("9007199254740993", 9007199254740993)])
def test_whole_numbers(spark, text, value):
    assert prepared(spark, CUSTOMER_ID=text)["CUSTOMER_ID"] == value


@pytest.mark.parametrize(
    "text,value",
    [
        ("2024-01-01T12:05:01", datetime(2024, 1, 1, 12, 5, 1)),
        ("2024-01-01T12:05:01+02:00", datetime(2024, 1, 1, 10, 5, 1)),
        ("2024-01-01T12:05:01Z", datetime(2024, 1, 1, 12, 5, 1)),
        ("2024-01-01 12:05:01.123456", datetime(2024, 1, 1, 12, 5, 1, 123456)),
    ],
)
def test_times(spark, text, value):
    assert prepared(spark, TX_DATETIME=text)["TX_DATETIME"] == value


def test_junk_time_is_quarantined(spark):
    assert prepared(spark, TX_DATETIME="junk") is None


@pytest.mark.parametrize("text,value", [("True", True), ("False", False), ("0", False), ("1", True), ("maybe", None), ("", None)])
def test_booleans(spark, text, value):
    assert prepared(spark, IS_NEW_REGION=text)["IS_NEW_REGION"] is value


def test_columns_missing_extra_and_reordered(spark):
    df = tx(spark).select("TX_AMOUNT", "TERMINAL_ID", F.lit("x").alias("extra"), "CUSTOMER_ID", "TX_DATETIME", "TRANSACTION_ID")
    out = p.prepare(df, "transactions", "b", AT)
    assert out.columns == ENTITIES["transactions"].columns
    assert [f.dataType for f in out.schema] == [t for _, t in ENTITIES["transactions"].fields]
    row = out.first()
    assert (row["TX_TIME_SECONDS"], row["TERMINAL_CITY"], row["IS_NEW_REGION"], row["BATCH_ID"]) == (0, "", False, "b")


def test_valid_and_quarantined_make_the_input(spark, sf_dir):
    from txlake.fixtures import Frames

    raw = Frames(spark, sf_dir)["tx_raw"]
    good, bad = p.prepare(raw, "transactions", "b", AT), p.quarantine(raw, "transactions", "b", AT)
    assert good.count() + bad.count() == raw.count()
    assert p.required_violations(good, "transactions").isEmpty()


def test_strict_check_fails_the_job(spark):
    typed = p.coerce_columns(tx(spark, TX_AMOUNT="abc"), "transactions")
    with pytest.raises(PySparkException, match="TX_AMOUNT"):
        p.check_required(typed, "transactions").collect()
    assert p.check_required(p.fill_required(typed, "transactions"), "transactions").count() == 1


def test_history_fields_keep_supplied_values(spark):
    df = spark.createDataFrame([("1", "c", "r", "3", None)], "TERMINAL_ID STRING, CITY STRING, REGION STRING, version STRING, effective_date STRING")
    row = p.prepare(df, "terminals", "b", AT).first()
    assert (row["version"], str(row["effective_date"]), row["is_current"], row["end_date"]) == (3, AT, True, None)


def test_null_required_text_becomes_empty(spark):
    df = spark.createDataFrame([(1, None, "r")], "TERMINAL_ID BIGINT, CITY STRING, REGION STRING")
    assert p.prepare(df, "terminals", "b", AT).first()["CITY"] == ""


def test_inference_order_and_unknown(spark):
    both = [*ENTITIES["transactions"].signature, *ENTITIES["customers"].signature]
    assert p.infer_entity(both).name == "transactions"
    assert p.infer_entity(["a"]) is None
    odd = spark.createDataFrame([(1,)], "a INT")
    assert p.prepare(odd, None, "b", AT).columns == ["a"]
    assert p.prepare(odd, "merchants", "b", AT).columns == ["a"]


def test_zoned_times_are_normalized(spark):
    df = spark.sql("SELECT TIMESTAMP '2024-01-01 10:00:00' AS at, TIMESTAMP_NTZ '2024-01-01 10:00:00' AS plain, 1 AS n")
    out = p.normalize_times(df)
    assert [t for _, t in out.dtypes] == ["timestamp_ntz", "timestamp_ntz", "int"]


def test_consolidate_fills_missing_columns(spark):
    a = spark.createDataFrame([(1, "x")], "k INT, a STRING")
    b = spark.createDataFrame([(2,)], "k INT")
    assert sorted(map(tuple, p.consolidate([a, b]).collect())) == [(1, "x"), (2, None)]
