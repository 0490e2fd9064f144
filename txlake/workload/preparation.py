"""Queries on the steps that bring a delivery to its schema."""

from __future__ import annotations

from pyspark.sql import functions as F

from txlake.operators import prepare as p
from txlake.workload.deliveries import AS_OF, BATCH
from txlake.workload.oracle_frames import C_COLS, TOKENS, stamp
from txlake.workload.registry import query

_T = "CAST(NULL AS TIMESTAMP)"
_LINEAGE = f"'batch-2' AS BATCH_ID, {stamp(AS_OF)} AS created_at"
_TX_DEFAULTS = (
    "CAST(0 AS BIGINT) AS TX_TIME_SECONDS, CAST(0 AS BIGINT) AS TX_TIME_DAYS, 0e0 AS DISTANCE_FROM_HOME_KM, '' AS TERMINAL_CITY, "
    "'' AS TERMINAL_REGION, 0e0 AS AVG_REGION_DISTANCE_KM, FALSE AS IS_NEW_REGION, '' AS CUSTOMER_TRAVEL_REGIONS"
)
_IDENTIFIED = "TX_DATETIME IS NOT NULL AND CUSTOMER_ID IS NOT NULL AND TERMINAL_ID IS NOT NULL"


@query("lineage_columns", f"SELECT *, {_LINEAGE} FROM {{tx}}")
def _(fx):
    return p.add_lineage(fx["tx"], BATCH, AS_OF)


@query(
    "scd2_init",
    f"SELECT {', '.join(C_COLS)}, coalesce(version, 1) AS version, coalesce(effective_date, {stamp(AS_OF)}) AS effective_date, "
    f"{_T} AS end_date, TRUE AS is_current FROM {{customers_v2}} UNION ALL "
    f"SELECT {', '.join(C_COLS)}, 1, {stamp(AS_OF)}, {_T}, TRUE FROM {{customers_v1}}",
)
def _(fx):
    """History fields filled where a delivery has them and added where it has none."""
    bare = fx["customers_v1"].select(*C_COLS)
    out = p.start_history(fx["customers_v2"], AS_OF)
    return out.unionByName(p.start_history(bare, AS_OF))


@query(
    "normalize_timestamps",
    f"""
SELECT TRANSACTION_ID, CASE TERMINAL_ID WHEN '1' THEN told - INTERVAL 2 HOUR WHEN '2' THEN told + INTERVAL 330 MINUTE ELSE told END AS TX_DATETIME
FROM (SELECT *, CASE WHEN TX_DATETIME NOT IN {TOKENS} THEN TRY_CAST(TX_DATETIME AS TIMESTAMP) END AS told FROM {{tx_raw}})""",
)
def _(fx):
    """Text times with offsets, with a T, and unreadable ones."""
    text = (
        F.when(F.col("TERMINAL_ID") == "1", F.concat("TX_DATETIME", F.lit("+02:00")))
        .when(F.col("TERMINAL_ID") == "2", F.concat(F.replace("TX_DATETIME", F.lit(" "), F.lit("T")), F.lit("-05:30")))
        .when(F.col("TERMINAL_ID") == "3", F.concat(F.replace("TX_DATETIME", F.lit(" "), F.lit("T")), F.lit("Z")))
        .otherwise(F.col("TX_DATETIME"))
    )
    raw = fx["tx_raw"].select("TRANSACTION_ID", text.alias("TX_DATETIME"))
    return p.normalize_times(raw, ["TX_DATETIME"])


@query(
    "add_missing_columns",
    f"SELECT CUSTOMER_ID, HOME_CITY, x_customer_id, '' AS HOME_REGION, 0e0 AS y_customer_id, 0e0 AS mean_amount, 0e0 AS std_amount, "
    f"0e0 AS mean_nb_tx_per_day, CAST(0 AS BIGINT) AS version, {_T} AS effective_date, {_T} AS end_date, FALSE AS is_current, "
    f"'' AS BATCH_ID, {_T} AS created_at FROM {{customers_v1}}",
)
def _(fx):
    return p.add_missing(fx["customers_v1"].select("CUSTOMER_ID", "HOME_CITY", "x_customer_id"), "customers")


@query("coerce_types", "SELECT * FROM {tx_typed}")
def _(fx):
    return p.coerce_columns(fx["tx_raw"], "transactions")


@query("fill_required", "SELECT * REPLACE (coalesce(TX_AMOUNT, 0e0) AS TX_AMOUNT) FROM {tx_typed}")
def _(fx):
    return p.fill_required(p.coerce_columns(fx["tx_raw"], "transactions"), "transactions")


@query("schema_prune", "SELECT CUSTOMER_ID, TRAVEL_REGIONS FROM {travel_profiles}")
def _(fx):
    return p.prune(fx["travel_profiles"], "travel_profiles")


@query("required_violations", f"SELECT * FROM {{tx_typed}} WHERE NOT ({_IDENTIFIED} AND TX_AMOUNT IS NOT NULL)")
def _(fx):
    return p.required_violations(p.coerce_columns(fx["tx_raw"], "transactions"), "transactions")


@query("prepare_customers", "SELECT * FROM {inc_c}")
def _(fx):
    return p.prepare(fx["customers_v2"], "customers", BATCH, AS_OF)


@query("prepare_terminals", "SELECT * FROM {inc_t}")
def _(fx):
    """Entity recognised by its columns."""
    return p.prepare(fx["terminals_v2"], None, BATCH, AS_OF)


@query(
    "prepare_travel_profiles",
    f"SELECT CUSTOMER_ID, TRAVEL_REGIONS, 0e0 AS AVG_TRAVEL_DISTANCE_KM, {_LINEAGE} FROM {{travel_profiles}}",
)
def _(fx):
    return p.prepare(fx["travel_profiles"], "travel_profiles", BATCH, AS_OF)


@query(
    "prepare_transactions",
    f"SELECT * REPLACE (coalesce(TX_AMOUNT, 0e0) AS TX_AMOUNT), {_TX_DEFAULTS}, {_LINEAGE} FROM {{tx_typed}} WHERE {_IDENTIFIED}",
)
def _(fx):
    return p.prepare(fx["tx_raw"], "transactions", BATCH, AS_OF)


@query(
    "prepare_quarantine",
    "SELECT TRANSACTION_ID, concat_ws(',', CASE WHEN TX_DATETIME IS NULL THEN 'TX_DATETIME' END, "
    f"CASE WHEN CUSTOMER_ID IS NULL THEN 'CUSTOMER_ID' END) AS reject_reason FROM {{tx_typed}} WHERE NOT ({_IDENTIFIED})",
)
def _(fx):
    """Rows without an identity, which no default can repair."""
    return p.quarantine(fx["tx_raw"], "transactions", BATCH, AS_OF).select("TRANSACTION_ID", p.REJECT)
