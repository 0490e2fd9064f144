"""Cases that clean fixtures never ask for: dated profiles, several versions, times without a date, odd spans, broken histories."""

from datetime import datetime

import pytest

from txlake.functions.coerce import coerce
from txlake.operators import enrich, scd2, signals
from txlake.registry import STRING, TIME

T = datetime


@pytest.fixture(scope="module")
def places(spark):
    customers = spark.createDataFrame(
        [(1, "r1", 0.0, 0.0, 5.0, 1, True), (1, "r2", 1.0, 1.0, 9.0, 2, True), (1, "r0", 1.0, 1.0, 1.0, 3, False)],
        "CUSTOMER_ID long, HOME_REGION string, x_customer_id double, y_customer_id double, mean_amount double, version long, is_current boolean",
    )
    terminals = spark.createDataFrame(
        [(7, "c", "r1", 0.0, 0.0), (7, "c", "r1", 0.0, 0.0)],
        "TERMINAL_ID long, CITY string, REGION string, x_terminal_id double, y_terminal_id double",
    )
    profiles = spark.createDataFrame(
        [(1, "Z", T(2024, 1, 1)), (1, "r1,B", T(2024, 5, 1)), (1, "Y", None)], "CUSTOMER_ID long, TRAVEL_REGIONS string, created_at timestamp_ntz"
    )
    middle = spark.createDataFrame([("r1", 0.0, 0.0), ("r2", 1.0, 0.0), ("B", 2.0, 0.0), ("Z", 50.0, 0.0)], "region string, x double, y double")
    return customers, terminals, profiles, middle


def test_latest_profile_and_current_version(spark, places):
    customers, terminals, profiles, middle = places
    tx = spark.createDataFrame(
        [("t1", T(2024, 6, 1), 1, 7, 30.0)], "TRANSACTION_ID string, TX_DATETIME timestamp_ntz, CUSTOMER_ID long, TERMINAL_ID long, TX_AMOUNT double"
    )
    row, = enrich.enrich(tx, customers, terminals, profiles, middle, "2024-01-01 00:00:00").collect()
    assert row.CUSTOMER_TRAVEL_REGIONS == "r1,B" and row.IS_NEW_REGION is False
    usual, = signals.usual(customers, enrich.travel_distance(customers, profiles, middle)).collect()
    assert usual.USUAL_AMOUNT == 9.0 and 100 < usual.AVG_TRAVEL_DISTANCE_KM < 120
    high, = signals.high_amount(tx, customers).collect()
    assert high.IS_HIGH_AMOUNT is True


@pytest.mark.parametrize("text,ok", [("12:30", False), ("T12:30:00", False), ("2024-03-01 12:30:00", True), ("2024-03-01", True), ("n/a", False), ("<NA>", False)])
def test_times_need_a_date(spark, text, ok):
    value = spark.createDataFrame([(text,)], "t string").select(coerce("t", STRING, TIME)).first()[0]
    assert (value is not None) == ok


def test_windows_whose_span_is_no_multiple_of_the_step(spark):
    tx = spark.createDataFrame([(1, T(2024, 1, 1, 0, 5), 2.0), (1, T(2024, 1, 1, 0, 35), 3.0)], "CUSTOMER_ID long, TX_DATETIME timestamp_ntz, TX_AMOUNT double")
    found = {(r.window_start.strftime("%H:%M"), r.n_tx) for r in signals.sliding_spend(tx, "40 minutes", "30 minutes").collect()}
    assert found == {("23:30", 1), ("00:00", 2), ("00:30", 1)}


def test_integrity_finds_defects(spark, monkeypatch):
    monkeypatch.setattr(scd2, "VERSION_SLICE", 2)
    rows = [
        (1, 1, T(2024, 1, 1), T(2024, 6, 1), False), (1, 3, T(2024, 2, 1), None, True),
        (2, 1, T(2024, 3, 1), T(2024, 2, 1), False), (2, 2, T(2024, 4, 1), None, True),
        (3, 1, T(2024, 1, 1), None, True), (3, 2, T(2024, 2, 1), None, True), (3, 2, T(2024, 2, 1), None, True),
    ]
    dim = spark.createDataFrame(rows, "CUSTOMER_ID long, version long, effective_date timestamp_ntz, end_date timestamp_ntz, is_current boolean")
    found = {r.check: r.defects for r in scd2.integrity(dim, "customers").collect()}
    assert found == {"not_one_current": 1, "version_gap": 1, "repeated_version": 1, "overlap": 2, "inverted": 1}
