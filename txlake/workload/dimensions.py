"""Queries on type 2 dimensions."""

from __future__ import annotations

from txlake.operators import facts, history, scd2
from txlake.registry import CUSTOMERS
from txlake.workload.deliveries import AS_OF, delivered, delta, merged, shifted_tx, source_columns, stored
from txlake.workload.oracle_frames import CUSTOMER_COMPARED, stamp
from txlake.workload.registry import query

_C_ORDER = ", ".join(f"{c} DESC NULLS LAST" for c in CUSTOMER_COMPARED)


@query("incoming_latest_per_key", "SELECT * FROM {latest_c}")
def _(fx):
    return scd2.latest_delivered(delivered(fx, "customers"), "customers")


@query("scd2_classify", "SELECT * FROM {class_c}")
def _(fx):
    return scd2.classify(delivered(fx, "customers"), stored(fx, "customers"), "customers", source_columns(fx, "customers"))


@query("scd2_changed_fields", "SELECT CUSTOMER_ID, changed_fields FROM {class_c} WHERE change_type = 'changed'")
def _(fx):
    out = scd2.classify(delivered(fx, "customers"), stored(fx, "customers"), "customers")
    return out.filter("change_type = 'changed'").select("CUSTOMER_ID", "changed_fields")


@query("scd2_new_keys", "SELECT CUSTOMER_ID FROM {class_c} WHERE change_type = 'new'")
def _(fx):
    return scd2.new_keys(delivered(fx, "customers"), stored(fx, "customers"), "customers")


@query("scd2_existing_keys", "SELECT CUSTOMER_ID FROM {class_c} WHERE change_type <> 'new'")
def _(fx):
    return scd2.existing_keys(delivered(fx, "customers"), stored(fx, "customers"), "customers")


@query("scd2_summary", "SELECT change_type, count(*) AS n FROM {class_c} GROUP BY 1")
def _(fx):
    return scd2.summary(delivered(fx, "customers"), stored(fx, "customers"), "customers", source_columns(fx, "customers"))


@query("scd2_delta_customers", "SELECT * FROM {delta_c}")
def _(fx):
    return delta(fx, "customers")


@query("scd2_delta_terminals", "SELECT * FROM {delta_t}")
def _(fx):
    return delta(fx, "terminals")


@query("scd2_merge_customers", "SELECT * FROM {merged_c}")
def _(fx):
    return merged(fx, "customers")


@query("scd2_merge_terminals", "SELECT * FROM {merged_t}")
def _(fx):
    return merged(fx, "terminals")


@query("scd2_first_load", "SELECT * FROM {latest_c}")
def _(fx):
    return scd2.first_load(delivered(fx, "customers"), "customers", AS_OF)


@query("scd2_noop", "SELECT 'unchanged' AS change_type, count(*) AS n FROM {latest_c}")
def _(fx):
    """The same delivery again, against the table it produced: no key is new or changed."""
    return scd2.summary(delivered(fx, "customers"), merged(fx, "customers"), "customers", source_columns(fx, "customers"))


@query("dim_current_view", "SELECT * FROM {merged_c} WHERE is_current")
def _(fx):
    return scd2.current_rows(merged(fx, "customers"), "customers")


@query(
    "dim_as_of",
    " UNION ALL ".join(
        f"SELECT {stamp(t)} AS as_of, * FROM {{merged_c}} WHERE effective_date <= {stamp(t)} "
        f"AND (end_date IS NULL OR end_date > {stamp(t)})"
        for t in ("2024-02-15 00:00:00", "2024-03-02 00:00:00")
    ),
)
def _(fx):
    return scd2.as_of(merged(fx, "customers"), "2024-02-15 00:00:00", "2024-03-02 00:00:00")


# Defects put into the merged customers, in the words of both engines.
_DEFECTS = (
    "version + CASE WHEN CUSTOMER_ID % 10 IN (2, 7) AND is_current THEN 5 ELSE 0 END AS version",
    "CASE WHEN CUSTOMER_ID % 10 IN (3, 7) AND version > 1 THEN effective_date - INTERVAL '400' DAY ELSE effective_date END"
    " AS effective_date",
    "CASE WHEN CUSTOMER_ID % 10 = 4 AND NOT is_current THEN effective_date - INTERVAL '1' DAY ELSE end_date END AS end_date",
    "is_current OR CUSTOMER_ID % 10 = 5 AS is_current",
)
_DEFECTIVE = ", ".join(_DEFECTS)


@query(
    "scd2_integrity",
    f"""
SELECT * FROM (WITH d AS (
  SELECT CUSTOMER_ID, {_DEFECTIVE} FROM {{merged_c}}
  UNION ALL SELECT CUSTOMER_ID, version, effective_date, end_date, is_current FROM {{merged_c}} WHERE CUSTOMER_ID % 10 = 6),
v AS (SELECT CUSTOMER_ID, version, count(*) FILTER (is_current) AS n_current, min(effective_date) AS starts,
             max(coalesce(end_date, TIMESTAMP '9999-12-31')) AS ends FROM d GROUP BY 1, 2),
n AS (SELECT *, lead(starts) OVER (PARTITION BY CUSTOMER_ID ORDER BY version) AS nxt FROM v)
SELECT 'not_one_current' AS "check", (SELECT count(*) FROM (SELECT CUSTOMER_ID FROM d GROUP BY 1
       HAVING count(*) FILTER (is_current) <> 1)) AS defects
UNION ALL SELECT 'version_gap', (SELECT count(*) FROM (SELECT CUSTOMER_ID FROM d GROUP BY 1
       HAVING max(version) - min(version) + 1 <> count(DISTINCT version)))
UNION ALL SELECT 'repeated_version', (SELECT count(DISTINCT CUSTOMER_ID) FROM (SELECT CUSTOMER_ID FROM d
       GROUP BY CUSTOMER_ID, version HAVING count(*) > 1))
UNION ALL SELECT 'overlap', (SELECT count(*) FROM n WHERE ends > nxt)
UNION ALL SELECT 'inverted', (SELECT count(*) FROM d WHERE end_date < effective_date))""",
)
def _(fx):
    """A dimension with gaps, overlaps across them, inverted intervals, two current rows and repeated versions."""
    rows = merged(fx, "customers")
    repeated = rows.filter("CUSTOMER_ID % 10 = 6").select("CUSTOMER_ID", "version", "effective_date", "end_date", "is_current")
    return scd2.integrity(rows.selectExpr("CUSTOMER_ID", *_DEFECTS).unionByName(repeated), "customers")


@query(
    "scd2_rebuild_history",
    f"""
SELECT * FROM (WITH log AS (
  SELECT CUSTOMER_ID, {', '.join(CUSTOMER_COMPARED)}, version, effective_date FROM {{customers_v1}}
  UNION ALL SELECT CUSTOMER_ID, {', '.join(CUSTOMER_COMPARED)}, version, effective_date FROM {{customers_v2}}),
entries AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY CUSTOMER_ID, effective_date
                           ORDER BY version DESC, {_C_ORDER}) AS rn FROM log) WHERE rn = 1),
kept AS (SELECT * FROM (SELECT *, row_number() OVER w AS pos,
         {' OR '.join(f'{c} IS DISTINCT FROM lag({c}) OVER w' for c in CUSTOMER_COMPARED)} AS differs
         FROM entries WINDOW w AS (PARTITION BY CUSTOMER_ID ORDER BY effective_date)) WHERE pos = 1 OR differs),
chain AS (SELECT *, row_number() OVER w AS v, lead(effective_date) OVER w AS nxt FROM kept
          WINDOW w AS (PARTITION BY CUSTOMER_ID ORDER BY effective_date))
SELECT CUSTOMER_ID, {', '.join(CUSTOMER_COMPARED)}, CAST(v AS BIGINT) AS version, effective_date, nxt AS end_date,
       nxt IS NULL AS is_current FROM chain)""",
)
def _(fx):
    """Version chain from both deliveries read as one change log."""
    columns = ["CUSTOMER_ID", *CUSTOMERS.compared, "version", "effective_date"]
    log = fx["customers_v1"].select(*columns).unionByName(fx["customers_v2"].select(*columns))
    return history.rebuild(log, "customers")


@query(
    "tx_point_in_time",
    """
SELECT t.TRANSACTION_ID, t.CUSTOMER_ID, t.at AS TX_DATETIME, d.version, d.HOME_REGION, d.mean_amount, d.effective_date, d.end_date
FROM (SELECT *, TX_DATETIME + INTERVAL 50 DAY AS at FROM {tx}) t
LEFT JOIN {merged_c} d ON t.CUSTOMER_ID = d.CUSTOMER_ID AND d.effective_date <= t.at
     AND (d.end_date IS NULL OR t.at < d.end_date)""",
)
def _(fx):
    table = merged(fx, "customers").select(
        "CUSTOMER_ID", "version", "HOME_REGION", "mean_amount", "effective_date", "end_date"
    )
    tx = shifted_tx(fx).select("TRANSACTION_ID", "CUSTOMER_ID", "TX_DATETIME")
    return facts.point_in_time(tx, table, "CUSTOMER_ID")
