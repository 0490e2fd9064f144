"""Fraud-pattern signals on enriched transactions."""

from __future__ import annotations

from functools import reduce
from math import gcd

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from txlake.operators.enrich import behavior_profile, one_each
from txlake.operators.history import trailing_count
from txlake.operators.skew import spread_join

HIGH_AMOUNT_FACTOR = 3.0
HIGH_Z = 3.0
BURST_ROWS = 3
BURST_SECONDS = 6 * 3600


def high_amount(tx: DataFrame, customers: DataFrame) -> DataFrame:
    """Amount against the customer's profile mean and against the customer's own transactions."""
    own = behavior_profile(tx).select("CUSTOMER_ID", F.col("mean_amount").alias("__avg"), F.col("std_amount").alias("__std"))
    base = one_each(customers, "CUSTOMER_ID", ["mean_amount"]).withColumnRenamed("mean_amount", "__profile")
    known = own.join(base, "CUSTOMER_ID", "left")
    return spread_join(tx, known, "CUSTOMER_ID").select(
        *tx.columns,
        (F.col("TX_AMOUNT") > HIGH_AMOUNT_FACTOR * F.col("__profile")).alias("IS_HIGH_AMOUNT"),
        (F.col("TX_AMOUNT") > F.col("__avg") + HIGH_Z * F.col("__std")).alias("IS_HIGH_Z"),
    )


def geo_risk() -> Column:
    """New region, or farther from home than the customer usually travels."""
    far = F.col("DISTANCE_FROM_HOME_KM") > F.col("AVG_TRAVEL_DISTANCE_KM")
    return F.coalesce(F.col("IS_NEW_REGION") | far, F.lit(False))


def geo(enriched: DataFrame) -> DataFrame:
    """Enriched transactions that kept AVG_TRAVEL_DISTANCE_KM, with the geographic signal."""
    return enriched.withColumn("IS_GEO_RISK", geo_risk())


def burst(tx: DataFrame, rows: int = BURST_ROWS, seconds: int = BURST_SECONDS) -> DataFrame:
    """At least `rows` transactions of the customer in the trailing span, the row itself included."""
    counted = trailing_count(tx, ["CUSTOMER_ID"], "TX_DATETIME", seconds, "N_RECENT")
    return counted.withColumn("IS_BURST", F.col("N_RECENT") >= rows)


def usual(customers: DataFrame, travel: DataFrame) -> DataFrame:
    """What is usual for a customer: profile mean and travel distance, one row each."""
    amounts = one_each(customers, "CUSTOMER_ID", ["mean_amount"]).withColumnRenamed("mean_amount", "USUAL_AMOUNT")
    return amounts.join(travel, "CUSTOMER_ID", "left")


SCORE_INPUTS = ("IS_BURST", "USUAL_AMOUNT", "AVG_TRAVEL_DISTANCE_KM")


def score(enriched: DataFrame) -> DataFrame:
    """Number of signals raised per transaction, 0 to 3, from enriched transactions that kept SCORE_INPUTS.

    The trailing count belongs before the enrichment: it then reads three columns of the transactions
    and not the result of the joins.
    """
    high = F.coalesce(F.col("TX_AMOUNT") > HIGH_AMOUNT_FACTOR * F.col("USUAL_AMOUNT"), F.lit(False))
    flags = {"IS_HIGH_AMOUNT": high, "IS_GEO_RISK": geo_risk(), "IS_BURST": F.col("IS_BURST")}
    flagged = enriched.select("TRANSACTION_ID", "CUSTOMER_ID", *[c.alias(n) for n, c in flags.items()])
    total = reduce(Column.__add__, [F.col(n).cast("int") for n in flags])
    return flagged.withColumn("score", total)


def top_customers(scored: DataFrame, n: int = 20) -> DataFrame:
    """Customers with the highest sum of scores; ties by id."""
    totals = scored.groupBy("CUSTOMER_ID").agg(F.sum("score").alias("total_score"), F.count("*").alias("n_tx"))
    return totals.orderBy(F.desc("total_score"), "CUSTOMER_ID").limit(n)


def region_risk(enriched: DataFrame) -> DataFrame:
    return enriched.groupBy("TERMINAL_REGION", "IS_NEW_REGION").agg(
        F.count("*").alias("n_tx"),
        F.round(F.sum("TX_AMOUNT"), 2).alias("amount"),
        F.round(F.avg("DISTANCE_FROM_HOME_KM"), 4).alias("avg_distance_km"),
    )


_SECONDS = {"second": 1, "minute": 60, "hour": 3600, "day": 86_400, "week": 604_800}


def seconds_of(interval: str) -> int:
    """`15 minutes` and the like in seconds."""
    number, unit = interval.split()
    return int(number) * _SECONDS[unit.rstrip("s")]


def sliding_spend(tx: DataFrame, span: str = "1 hour", step: str = "15 minutes") -> DataFrame:
    """Spend per customer in overlapping windows.

    Rows are summed first per pane, the longest stretch that windows of any length hold or lack as a whole (map-side); only
    those sums are spread over the windows that cover them.
    """
    width = f"{gcd(seconds_of(span), seconds_of(step))} seconds"
    pane = tx.groupBy("CUSTOMER_ID", F.window(F.col("TX_DATETIME").cast("timestamp"), width).alias("w")).agg(
        F.count("*").alias("n"), F.sum("TX_AMOUNT").alias("amount")
    )
    covered = pane.select("CUSTOMER_ID", "n", "amount", F.window(F.col("w.start"), span, step).alias("w"))
    return covered.groupBy("CUSTOMER_ID", "w").agg(
        F.sum("n").alias("n_tx"), F.round(F.sum("amount"), 2).alias("amount")
    ).select("CUSTOMER_ID", F.col("w.start").cast("timestamp_ntz").alias("window_start"), "n_tx", "amount")
