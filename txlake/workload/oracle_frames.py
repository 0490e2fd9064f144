"""Frames the DuckDB statements share. Written independently of the Spark operators."""

from __future__ import annotations

AS_OF = "2024-03-01 00:00:00"
LOADED = "2024-01-01 00:00:00"
START = "2024-01-01 00:00:00"

TOKENS = "('', 'NA', 'N/A', 'NaN', 'nan', 'NULL', 'null', 'None')"
CUSTOMER_COMPARED = [
    "HOME_CITY", "HOME_REGION", "x_customer_id", "y_customer_id", "mean_amount", "std_amount", "mean_nb_tx_per_day",
]
TERMINAL_COMPARED = ["CITY", "REGION", "x_terminal_id", "y_terminal_id"]


def haversine(x1: str, y1: str, x2: str, y2: str) -> str:
    a = (
        f"(pow(sin((radians({y2}) - radians({y1})) / 2e0), 2e0) + cos(radians({y1})) * cos(radians({y2})) "
        f"* pow(sin((radians({x2}) - radians({x1})) / 2e0), 2e0))"
    )
    return f"round(6371e0 * 2e0 * atan2(sqrt({a}), sqrt(greatest(1e0 - {a}, 0e0))), 2)"


def stamp(text: str) -> str:
    return f"TIMESTAMP '{text}'"


def changed_list(compared: list[str]) -> str:
    """Comma list of the columns that differ between `i` and `c`."""
    parts = ", ".join(f"CASE WHEN i.{c} IS DISTINCT FROM c.{c} THEN '{c}' END" for c in compared)
    return f"concat_ws(',', {parts})"


def _delivered(view: str, columns: list[str], batch: str, at: str) -> str:
    """Prepared delivery: history fields filled, lineage stamped."""
    return (
        f"SELECT {', '.join(columns)}, version, effective_date, CAST(NULL AS TIMESTAMP) AS end_date, TRUE AS is_current, "
        f"'{batch}' AS BATCH_ID, {stamp(at)} AS created_at FROM {{{view}}}"
    )


def _latest(view: str, key: str, compared: list[str]) -> str:
    order = ", ".join(f"{c} DESC NULLS LAST" for c in ["version", "effective_date", *compared])
    return (
        f"SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY {key} ORDER BY {order}) AS rn "
        f"FROM {{{view}}} WHERE {key} IS NOT NULL) WHERE rn = 1"
    )


def _classified(latest: str, dim: str, key: str, compared: list[str]) -> str:
    return (
        f"SELECT i.{key}, CASE WHEN c.{key} IS NULL THEN 'new' WHEN {changed_list(compared)} <> '' THEN 'changed' "
        f"ELSE 'unchanged' END AS change_type, CASE WHEN c.{key} IS NOT NULL THEN nullif({changed_list(compared)}, '') END "
        f"AS changed_fields, c.version AS stored_version "
        f"FROM {{{latest}}} i LEFT JOIN (SELECT * FROM {{{dim}}} WHERE is_current) c ON i.{key} = c.{key}"
    )


def _delta(cls: str, latest: str, dim: str, key: str, columns: list[str]) -> str:
    cols = ", ".join(columns)
    icols = ", ".join(f"i.{c}" for c in columns)
    return (
        f"SELECT {cols}, version, effective_date, {stamp(AS_OF)} AS end_date, FALSE AS is_current, BATCH_ID, created_at "
        f"FROM {{{dim}}} WHERE is_current AND {key} IN (SELECT {key} FROM {{{cls}}} WHERE change_type = 'changed') "
        f"UNION ALL SELECT {icols}, CAST(coalesce(k.stored_version, 0) + 1 AS BIGINT), {stamp(AS_OF)}, "
        f"CAST(NULL AS TIMESTAMP), TRUE, i.BATCH_ID, i.created_at FROM {{{latest}}} i JOIN {{{cls}}} k "
        f"ON i.{key} = k.{key} WHERE k.change_type <> 'unchanged'"
    )


def _merged(delta: str, cls: str, dim: str, key: str) -> str:
    return (
        f"SELECT * FROM {{{dim}}} WHERE NOT (is_current AND {key} IN (SELECT {key} FROM {{{cls}}} "
        f"WHERE change_type = 'changed')) UNION ALL SELECT * FROM {{{delta}}}"
    )


C_COLS = ["CUSTOMER_ID", *CUSTOMER_COMPARED]
T_COLS = ["TERMINAL_ID", *TERMINAL_COMPARED]

ORACLE_FRAMES = {
    "dim_c": _delivered("customers_v1", C_COLS, "batch-1", LOADED),
    "dim_t": _delivered("terminals_v1", T_COLS, "batch-1", LOADED),
    "inc_c": _delivered("customers_v2", C_COLS, "batch-2", AS_OF),
    "inc_t": _delivered("terminals_v2", T_COLS, "batch-2", AS_OF),
    "latest_c": _latest("inc_c", "CUSTOMER_ID", CUSTOMER_COMPARED),
    "latest_t": _latest("inc_t", "TERMINAL_ID", TERMINAL_COMPARED),
    "class_c": _classified("latest_c", "dim_c", "CUSTOMER_ID", CUSTOMER_COMPARED),
    "class_t": _classified("latest_t", "dim_t", "TERMINAL_ID", TERMINAL_COMPARED),
    "delta_c": _delta("class_c", "latest_c", "dim_c", "CUSTOMER_ID", C_COLS),
    "delta_t": _delta("class_t", "latest_t", "dim_t", "TERMINAL_ID", T_COLS),
    "merged_c": _merged("delta_c", "class_c", "dim_c", "CUSTOMER_ID"),
    "merged_t": _merged("delta_t", "class_t", "dim_t", "TERMINAL_ID"),
    "centroid": "SELECT region, avg(x) AS x, avg(y) AS y FROM {geo} GROUP BY region",
    "enriched": f"""
SELECT t.TRANSACTION_ID, t.TX_DATETIME, t.CUSTOMER_ID, t.TERMINAL_ID, t.TX_AMOUNT,
       CAST(floor(epoch_us(t.TX_DATETIME - {stamp(START)}) / 1000000) AS BIGINT) AS TX_TIME_SECONDS,
       CAST(CAST(t.TX_DATETIME AS DATE) - DATE '2024-01-01' AS BIGINT) AS TX_TIME_DAYS,
       {haversine('c.x_customer_id', 'c.y_customer_id', 'm.x_terminal_id', 'm.y_terminal_id')} AS DISTANCE_FROM_HOME_KM,
       m.CITY AS TERMINAL_CITY, m.REGION AS TERMINAL_REGION,
       {haversine('h.x', 'h.y', 'g.x', 'g.y')} AS AVG_REGION_DISTANCE_KM,
       NOT list_contains(string_split(p.TRAVEL_REGIONS, ','), m.REGION) AS IS_NEW_REGION,
       p.TRAVEL_REGIONS AS CUSTOMER_TRAVEL_REGIONS
FROM {{tx}} t LEFT JOIN {{customers_v1}} c ON t.CUSTOMER_ID = c.CUSTOMER_ID
LEFT JOIN {{terminals_v1}} m ON t.TERMINAL_ID = m.TERMINAL_ID
LEFT JOIN {{travel_profiles}} p ON t.CUSTOMER_ID = p.CUSTOMER_ID
LEFT JOIN {{centroid}} h ON c.HOME_REGION = h.region
LEFT JOIN {{centroid}} g ON m.REGION = g.region""",
    "travel_km": f"""
SELECT p.CUSTOMER_ID, round(avg({haversine('h.x', 'h.y', 'g.x', 'g.y')}), 2) AS AVG_TRAVEL_DISTANCE_KM
FROM (SELECT CUSTOMER_ID, HOME_REGION, unnest(string_split(TRAVEL_REGIONS, ',')) AS region FROM {{travel_profiles}}) p
JOIN {{centroid}} h ON p.HOME_REGION = h.region JOIN {{centroid}} g ON p.region = g.region
GROUP BY p.CUSTOMER_ID""",
    "scored": """
SELECT e.TRANSACTION_ID, e.CUSTOMER_ID,
       coalesce(e.TX_AMOUNT > 3e0 * c.mean_amount, FALSE) AS IS_HIGH_AMOUNT,
       coalesce(e.IS_NEW_REGION OR e.DISTANCE_FROM_HOME_KM > k.AVG_TRAVEL_DISTANCE_KM, FALSE) AS IS_GEO_RISK,
       count(*) OVER (PARTITION BY e.CUSTOMER_ID ORDER BY e.TX_DATETIME
                      RANGE BETWEEN INTERVAL 6 HOUR PRECEDING AND CURRENT ROW) >= 3 AS IS_BURST
FROM {enriched} e LEFT JOIN {customers_v1} c ON e.CUSTOMER_ID = c.CUSTOMER_ID
LEFT JOIN {travel_km} k ON e.CUSTOMER_ID = k.CUSTOMER_ID""",
    # Landed files with their verdict.
    "judged": """
SELECT f.*, CASE WHEN folder = 'misc' THEN NULL ELSE folder END AS entity,
       file_key LIKE '%.csv' AS is_csv, lower(file_key) LIKE '%.csv' AS is_csv_any_case,
       CASE WHEN folder = 'misc' THEN NULL ELSE (SELECT coalesce(string_agg(n, ',' ORDER BY n), '') FROM (SELECT unnest(
            CASE folder WHEN 'customers' THEN ['CUSTOMER_ID', 'HOME_CITY', 'HOME_REGION']
                        WHEN 'terminals' THEN ['TERMINAL_ID', 'CITY', 'REGION']
                        WHEN 'travel_profiles' THEN ['CUSTOMER_ID']
                        ELSE ['TRANSACTION_ID', 'TX_DATETIME', 'CUSTOMER_ID', 'TERMINAL_ID', 'TX_AMOUNT'] END) AS n)
            WHERE NOT list_contains(string_split(f.header, ','), n)) END AS missing_columns
FROM {landing_files} f""",
    "reasoned": """
SELECT *, CASE WHEN entity IS NULL THEN 'unknown type' WHEN NOT is_csv THEN 'wrong extension'
               WHEN missing_columns <> '' THEN 'missing columns' END AS reason
FROM {judged}""",
    # Notifications, read with the engine's own JSON functions.
    "notes": """
SELECT event_id, ts, json_valid(payload) AS is_json,
       CASE WHEN json_valid(payload) THEN json_extract_string(payload, '$.EventName') END AS event_name,
       CASE WHEN json_valid(payload) THEN json_extract_string(payload, '$.Records[0].s3.bucket.name') END AS bucket,
       CASE WHEN json_valid(payload) THEN json_extract_string(payload, '$.Records[0].s3.object.key') END AS raw_key,
       CASE WHEN json_valid(payload) THEN CAST(json_extract_string(payload, '$.Records[0].s3.object.size') AS BIGINT) END AS size
FROM {notifications}""",
    "note_keys": """
SELECT *, CASE WHEN file_key LIKE '%.csv' AND split_part(file_key, '/', 1) IN ('customers', 'terminals', 'transactions', 'travel_profiles')
               THEN split_part(file_key, '/', 1) END AS file_type
FROM (SELECT *, regexp_replace(url_decode(raw_key), '^raw-data/', '') AS file_key
      FROM {notes} WHERE is_json AND event_name LIKE 's3:ObjectCreated:%' AND bucket = 'raw-data')""",
    "loader_records": """
SELECT event_id, file_key, 's3://raw-data/' || file_key AS file_path, size AS file_size_bytes, bucket AS bucket_name, file_type,
       '' AS event_name, strftime(ts, '%Y-%m-%dT%H:%M:%S.%f') AS processed_at, 'minio_kafka_notification' AS source,
       's3://raw-data/creditcard_files' AS dataset_uri
FROM {note_keys} WHERE file_type IS NOT NULL""",
    # Text transactions after tolerant conversion.
    "tx_typed": f"""
SELECT TRANSACTION_ID, TRY_CAST(TX_DATETIME AS TIMESTAMP) AS TX_DATETIME,
       CASE WHEN floor(cid) = cid THEN CAST(cid AS BIGINT) END AS CUSTOMER_ID,
       TRY_CAST(TERMINAL_ID AS BIGINT) AS TERMINAL_ID,
       CASE WHEN NOT isnan(amount) THEN amount END AS TX_AMOUNT
FROM (SELECT *, TRY_CAST(CUSTOMER_ID AS DOUBLE) AS cid,
             CASE WHEN TX_AMOUNT NOT IN {TOKENS} THEN TRY_CAST(TX_AMOUNT AS DOUBLE) END AS amount FROM {{tx_raw}})""",
}
