"""Run named queries in Spark and DuckDB and compare the rows as multisets."""

from __future__ import annotations

import math
from collections import Counter

import duckdb

from txlake.fixtures import TABLES


def open_duckdb(sf_dir: str):
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return con


def _norm(value):
    if isinstance(value, float):
        # Exact, but for the sign of zero.
        return None if math.isnan(value) else value + 0.0
    return value


def rows_of_spark(df):
    names = sorted(df.columns)
    return names, Counter(tuple(_norm(v) for v in r) for r in df.select(*[f"`{n}`" for n in names]).collect())


def rows_of_duckdb(con, sql):
    cur = con.execute(sql)
    names = [d[0] for d in cur.description]
    order = sorted(range(len(names)), key=lambda i: names[i])
    rows = Counter(tuple(_norm(r[i]) for i in order) for r in cur.fetchall())
    return [names[i] for i in order], rows


def difference(df, con, sql) -> str | None:
    """None when equal, else a short description."""
    spark_names, spark_rows = rows_of_spark(df)
    duck_names, duck_rows = rows_of_duckdb(con, sql)
    if spark_names != duck_names:
        return f"columns {spark_names} != {duck_names}"
    if spark_rows != duck_rows:
        only_spark, only_duck = spark_rows - duck_rows, duck_rows - spark_rows
        return (
            f"rows {sum(spark_rows.values())} / {sum(duck_rows.values())}; only in Spark "
            f"{list(only_spark.items())[:3]}; only in DuckDB {list(only_duck.items())[:3]}"
        )
    types = {"BIGINT": "bigint", "DOUBLE": "double", "VARCHAR": "string", "BOOLEAN": "boolean", "TIMESTAMP": "timestamp_ntz",
             "DATE": "date", "INTEGER": "int"}
    described = {r[0]: types.get(r[1], r[1]) for r in con.execute(f"DESCRIBE {sql}").fetchall()}
    actual = {f.name: f.dataType.simpleString() for f in df.schema}
    if described != actual:
        return f"types {[(k, actual[k], described[k]) for k in actual if actual[k] != described[k]]}"
    return None
