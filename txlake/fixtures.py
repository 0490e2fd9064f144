"""Entity frames derived from the driver's tables.

One SQL text per frame serves Spark (as a DataFrame) and the DuckDB oracles (as a common table
expression). Names in braces are other frames or driver tables; `{TS}` is the zone-free time type.
Literals with an exponent make both engines compute in doubles.
"""

from __future__ import annotations

from string import Formatter

from pyspark.sql import DataFrame, SparkSession

from txlake.plans.session import configure

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()

# Declared schemas spare a job per table that would read file footers.
SCHEMAS = {
    "region": "r_regionkey INT, r_name STRING",
    "nation": "n_nationkey INT, n_name STRING, n_regionkey INT",
    "customer": "c_custkey BIGINT, c_name STRING, c_nationkey INT, c_acctbal DOUBLE, c_mktsegment STRING",
    "supplier": "s_suppkey BIGINT, s_name STRING, s_nationkey INT, s_acctbal DOUBLE",
    "orders": "o_orderkey BIGINT, o_custkey BIGINT, o_orderstatus STRING, o_totalprice DOUBLE, "
    "o_orderdate TIMESTAMP_NTZ, o_orderpriority STRING",
    "lineitem": "l_orderkey BIGINT, l_partkey BIGINT, l_suppkey BIGINT, l_linenumber INT, l_quantity DOUBLE, "
    "l_extendedprice DOUBLE, l_discount DOUBLE, l_tax DOUBLE, l_returnflag STRING, l_linestatus STRING, "
    "l_shipdate TIMESTAMP_NTZ",
    "events": "event_id BIGINT, ts TIMESTAMP_NTZ, user_id BIGINT, event_type STRING, value DOUBLE, props STRING",
}

VIEWS = {
    "geo": """
SELECT n_nationkey, n_name AS city, r_name AS region,
       CAST(n_nationkey AS DOUBLE) * 0.25e0 - 3.0e0 AS x,
       CAST((n_nationkey * 7) % 25 AS DOUBLE) * 0.3e0 + 4.5e0 AS y
FROM {nation} JOIN {region} ON n_regionkey = r_regionkey""",
    "customers_v1": """
SELECT c_custkey AS CUSTOMER_ID, city AS HOME_CITY, region AS HOME_REGION,
       x + CAST(c_custkey % 41 - 20 AS DOUBLE) / 1000e0 AS x_customer_id,
       y + CAST(c_custkey % 37 - 18 AS DOUBLE) / 1000e0 AS y_customer_id,
       CAST(10 + (c_custkey * 37) % 190 AS DOUBLE) AS mean_amount,
       CASE WHEN c_custkey % 10 IN (4, 5) THEN NULL
            ELSE CAST(10 + (c_custkey * 37) % 190 AS DOUBLE) / 2e0 END AS std_amount,
       CAST(1 + c_custkey % 5 AS DOUBLE) AS mean_nb_tx_per_day,
       CAST(1 AS BIGINT) AS version,
       CAST('2024-01-01 00:00:00' AS {TS}) AS effective_date,
       CAST(NULL AS {TS}) AS end_date, TRUE AS is_current
FROM {customer} JOIN {geo} ON c_nationkey = n_nationkey""",
    # Second delivery: changed, unchanged, null changes, new keys, absent keys, repeated keys.
    "customers_v2": """
SELECT b.CUSTOMER_ID,
       CASE WHEN m = 0 THEN g.city ELSE HOME_CITY END AS HOME_CITY,
       CASE WHEN m = 0 THEN g.region ELSE HOME_REGION END AS HOME_REGION,
       x_customer_id, y_customer_id,
       CASE WHEN m = 1 THEN mean_amount + 5e0 ELSE mean_amount END AS mean_amount,
       CASE WHEN m = 2 THEN NULL WHEN m = 5 THEN mean_amount / 2e0 ELSE std_amount END AS std_amount,
       mean_nb_tx_per_day, CAST(1 AS BIGINT) AS version,
       CAST('2024-02-01 00:00:00' AS {TS}) AS effective_date
FROM (SELECT v.*, v.CUSTOMER_ID % 10 AS m, c_nationkey
      FROM {customers_v1} v JOIN {customer} ON c_custkey = v.CUSTOMER_ID) b
JOIN {geo} g ON g.n_nationkey = (b.c_nationkey + 1) % 25
WHERE m <> 9
UNION ALL
SELECT CUSTOMER_ID + 1000000, HOME_CITY, HOME_REGION, x_customer_id, y_customer_id, mean_amount, std_amount,
       mean_nb_tx_per_day, CAST(1 AS BIGINT), CAST('2024-02-01 00:00:00' AS {TS})
FROM {customers_v1} WHERE CUSTOMER_ID % 20 = 0
UNION ALL
SELECT CUSTOMER_ID, HOME_CITY, HOME_REGION, x_customer_id, y_customer_id, mean_amount + 1e0, std_amount,
       mean_nb_tx_per_day, CAST(2 AS BIGINT), CAST('2024-02-02 00:00:00' AS {TS})
FROM {customers_v1} WHERE CUSTOMER_ID % 100 = 3""",
    "terminals_v1": """
SELECT s_suppkey AS TERMINAL_ID, city AS CITY, region AS REGION,
       x + CAST(s_suppkey % 41 - 20 AS DOUBLE) / 1000e0 AS x_terminal_id,
       y + CAST(s_suppkey % 37 - 18 AS DOUBLE) / 1000e0 AS y_terminal_id,
       CAST(1 AS BIGINT) AS version, CAST('2024-01-01 00:00:00' AS {TS}) AS effective_date,
       CAST(NULL AS {TS}) AS end_date, TRUE AS is_current
FROM {supplier} JOIN {geo} ON s_nationkey = n_nationkey""",
    "terminals_v2": """
SELECT TERMINAL_ID, CITY, REGION,
       CASE WHEN TERMINAL_ID % 10 = 0 THEN x_terminal_id + 0.5e0 ELSE x_terminal_id END AS x_terminal_id,
       y_terminal_id, version, CAST('2024-02-01 00:00:00' AS {TS}) AS effective_date
FROM {terminals_v1} WHERE TERMINAL_ID % 10 <> 9
UNION ALL
SELECT TERMINAL_ID + 1000000, CITY, REGION, x_terminal_id, y_terminal_id, version,
       CAST('2024-02-01 00:00:00' AS {TS})
FROM {terminals_v1} WHERE TERMINAL_ID % 20 = 0""",
    "travel_profiles": """
SELECT v.CUSTOMER_ID, v.HOME_REGION,
       CASE WHEN v.HOME_REGION = r.r_name THEN r.r_name
            ELSE least(v.HOME_REGION, r.r_name) || ',' || greatest(v.HOME_REGION, r.r_name) END AS TRAVEL_REGIONS
FROM {customers_v1} v JOIN {region} r ON r.r_regionkey = v.CUSTOMER_ID % 5""",
    "tx": """
SELECT 'tx-' || CAST(event_id AS STRING) AS TRANSACTION_ID, ts AS TX_DATETIME, user_id AS CUSTOMER_ID,
       event_id % 10 AS TERMINAL_ID, value AS TX_AMOUNT
FROM {events}""",
    # Transactions with repeated ids.
    "tx_dup": """
SELECT CAST(l_orderkey AS STRING) || '-' || CAST(l_linenumber AS STRING) AS TRANSACTION_ID, l_shipdate AS TX_DATETIME,
       o_custkey AS CUSTOMER_ID, l_suppkey AS TERMINAL_ID, l_extendedprice AS TX_AMOUNT
FROM {lineitem} JOIN {orders} ON l_orderkey = o_orderkey""",
    # Text columns with unreadable values.
    "tx_raw": """
SELECT 'tx-' || CAST(event_id AS STRING) AS TRANSACTION_ID,
       CASE WHEN event_id % 50 = 7 THEN 'junk' ELSE CAST(ts AS STRING) END AS TX_DATETIME,
       CASE WHEN event_id % 50 = 3 THEN NULL WHEN event_id % 50 = 4 THEN '3.7' ELSE CAST(user_id AS STRING) END AS CUSTOMER_ID,
       CAST(event_id % 10 AS STRING) AS TERMINAL_ID,
       CASE event_id % 50 WHEN 0 THEN 'N/A' WHEN 1 THEN '' WHEN 2 THEN 'abc' WHEN 5 THEN 'NaN'
            ELSE CAST(value AS STRING) END AS TX_AMOUNT
FROM {events}""",
    # One landed file per order: manifest facts and the header line of the file.
    "landing_files": """
SELECT 's3://raw-data/' || t || '/' || stem || ext AS s3_path, t || '/' || stem || ext AS file_key, t AS folder,
       rows_n, batch_id, batch_num, landed_at,
       CASE WHEN short_one THEN 'HOME_CITY,CITY,TX_AMOUNT' ELSE full_header END AS header
FROM (SELECT 'part_' || CAST(o_orderkey AS STRING) AS stem, o_orderdate AS landed_at,
             CAST((o_orderkey * 7) % 250 AS BIGINT) AS rows_n,
             'batch-' || CAST(o_custkey % 20 AS STRING) AS batch_id,
             CAST(1 + o_orderkey % 1200 AS BIGINT) AS batch_num,
             o_orderkey % 3 = 2 AS short_one,
             CASE o_orderkey % 5 WHEN 0 THEN 'customers' WHEN 1 THEN 'terminals' WHEN 2 THEN 'transactions'
                  WHEN 3 THEN 'travel_profiles' ELSE 'misc' END AS t,
             CASE o_orderkey % 7 WHEN 6 THEN '.txt' WHEN 5 THEN '.CSV' ELSE '.csv' END AS ext,
             CASE o_orderkey % 5 WHEN 0 THEN 'HOME_CITY,CUSTOMER_ID,HOME_REGION,x_customer_id,y_customer_id'
                  WHEN 1 THEN 'TERMINAL_ID,CITY,REGION,x_terminal_id,y_terminal_id'
                  WHEN 2 THEN 'TRANSACTION_ID,TX_DATETIME,CUSTOMER_ID,TERMINAL_ID,TX_AMOUNT'
                  ELSE 'CUSTOMER_ID,TRAVEL_REGIONS,AVG_TRAVEL_DISTANCE_KM' END AS full_header
      FROM {orders}) f""",
    # JSON text, one message per event.
    "notifications": """
SELECT event_id, ts,
       CASE WHEN event_id % 50 = 49 THEN 'not json' ELSE
       '{{"EventName":"' || CASE event_type WHEN 'error' THEN 's3:ObjectRemoved:Delete' WHEN 'view' THEN 's3:ObjectAccessed:Get'
                                WHEN 'click' THEN 's3:ObjectCreated:CompleteMultipartUpload' ELSE 's3:ObjectCreated:Put' END
       || '","Records":[{{"s3":{{"bucket":{{"name":"' || CASE WHEN event_type = 'signup' AND event_id % 2 = 0 THEN 'other' ELSE 'raw-data' END
       || '"}},"object":{{"key":"' || CASE WHEN event_id % 4 = 0 THEN 'raw-data%2F' ELSE '' END
       || CASE event_id % 5 WHEN 0 THEN 'customers' WHEN 1 THEN 'terminals' WHEN 2 THEN 'transactions' WHEN 3 THEN 'travel_profiles' ELSE 'misc' END
       || '%2Fa+b_' || CAST(event_id AS STRING) || CASE WHEN event_id % 11 = 0 THEN '.txt' ELSE '.csv' END
       || '","size":' || CAST(event_id * 3 AS STRING) || '}}}}}}]}}' END AS payload
FROM {events}""",
}


def _names_in(text: str) -> list[str]:
    return [field for _, field, _, _ in Formatter().parse(text) if field and field != "TS"]


class Frames:
    """Driver tables and derived frames of one data folder, by name."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = configure(spark)
        self.sf_dir = sf_dir
        self._known: dict[str, DataFrame] = {}

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self._known:
            if name in VIEWS:
                text = VIEWS[name].replace("{TS}", "TIMESTAMP_NTZ")
                self._known[name] = self.spark.sql(text, **{n: self[n] for n in _names_in(text)})
            else:
                reader = self.spark.read.schema(SCHEMAS[name]) if name in SCHEMAS else self.spark.read
                self._known[name] = reader.parquet(f"{self.sf_dir}/{name}.parquet")
        return self._known[name]


def with_views(body: str, extra: dict[str, str] | None = None) -> str:
    """DuckDB statement: `body` preceded by the frames it names in braces, in order of dependence.

    `extra` adds frames of the caller's own.
    """
    texts = {**VIEWS, **(extra or {})}
    ordered: list[str] = []

    def visit(text: str) -> None:
        for name in _names_in(text):
            if name in texts and name not in ordered:
                visit(texts[name])
                ordered.append(name)

    visit(body)
    names = {n: n for n in [*TABLES, *texts]}
    rendered = {n: texts[n].format(TS="TIMESTAMP", **names) for n in ordered}
    prefix = ",\n".join(f"{n} AS ({rendered[n]})" for n in ordered)
    return (f"WITH {prefix}\n" if prefix else "") + body.format(TS="TIMESTAMP", **names)
