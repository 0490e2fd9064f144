"""Fact tables: de-duplication, loads that can be repeated, star and point-in-time joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from txlake.operators.history import asof_join
from txlake.operators.scd2 import one_per_key
from txlake.operators.skew import spread_join

WINNER_ORDER = ["TX_DATETIME", "TX_AMOUNT", "CUSTOMER_ID", "TERMINAL_ID"]


def dedup(tx: DataFrame, key: str = "TRANSACTION_ID", order: list[str] | None = None) -> DataFrame:
    """One row per id, the greatest by a total order. Copies collapse on the map side."""
    return one_per_key(tx, [key], order or WINNER_ORDER)


def unseen(incoming: DataFrame, target: DataFrame, key: str = "TRANSACTION_ID", order: list[str] | None = None) -> DataFrame:
    """Delivered rows whose id the target does not hold, once each; of the target only the ids are read."""
    return dedup(incoming, key, order).join(target.select(key).distinct(), key, "left_anti")


def idempotent_append(target: DataFrame, incoming: DataFrame, key: str = "TRANSACTION_ID") -> DataFrame:
    """Target after an append that ignores ids already there; repeating it changes nothing."""
    return target.unionByName(unseen(incoming, target, key).select(*target.columns))


def point_in_time(tx: DataFrame, dim: DataFrame, key: str, slice_seconds: int = 86_400) -> DataFrame:
    """Transactions with the dimension version valid when they happened."""
    return asof_join(tx, dim, [key], "TX_DATETIME", slice_seconds=slice_seconds)


def star_spend(tx: DataFrame, customers: DataFrame, terminals: DataFrame) -> DataFrame:
    """Spend by home region and terminal region over the current dimension rows.

    Amounts are summed per customer and terminal before the joins, so a hot customer or terminal
    meets its dimension row once per partner and not once per transaction.
    """
    home = customers.filter("is_current").select("CUSTOMER_ID", "HOME_REGION")
    place = terminals.filter("is_current").select("TERMINAL_ID", F.col("REGION").alias("TERMINAL_REGION"))
    partial = tx.groupBy("CUSTOMER_ID", "TERMINAL_ID").agg(
        F.count("*").alias("n"), F.sum("TX_AMOUNT").alias("amount")
    )
    return (
        partial.join(home, "CUSTOMER_ID").join(place, "TERMINAL_ID")
        .groupBy("HOME_REGION", "TERMINAL_REGION")
        .agg(F.sum("n").alias("n_tx"), F.round(F.sum("amount"), 2).alias("amount"))
    )


def orphans(tx: DataFrame, customers: DataFrame, terminals: DataFrame) -> DataFrame:
    """Transactions whose customer or terminal has no current row, with what is missing."""
    known_c = customers.filter("is_current").select("CUSTOMER_ID").distinct().withColumn("__c", F.lit(True))
    known_t = terminals.filter("is_current").select("TERMINAL_ID").distinct().withColumn("__t", F.lit(True))
    missing = F.concat_ws(
        ",",
        F.when(F.col("__c").isNull(), F.lit("customer")),
        F.when(F.col("__t").isNull(), F.lit("terminal")),
    )
    return (
        spread_join(spread_join(tx, known_c, "CUSTOMER_ID"), known_t, "TERMINAL_ID")
        .select(*tx.columns, missing.alias("missing"))
        .filter("missing <> ''")
    )
