"""Queries that load tables and report on the load."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from txlake import jobs
from txlake.operators import ingest, quality
from txlake.operators.prepare import prepare, time_literal
from txlake.plans.session import workspace
from txlake.registry import ENTITIES, TRANSACTIONS
from txlake.sources import csv_files, ledger, manifest, tables
from txlake.workload.deliveries import AS_OF, BATCH, FIRST_BATCH, LOADED, delivered, enriched, source_columns, stored
from txlake.workload.oracle_frames import stamp
from txlake.workload.registry import query

_PREPARED = f"SELECT e.*, 'batch-2' AS BATCH_ID, {stamp(AS_OF)} AS created_at FROM {{enriched}} e"


@query("fact_append", _PREPARED)
def _(fx):
    """Enriched transactions appended to the fact table and read back."""
    root = workspace(fx.spark, "facts")
    tables.append(prepare(enriched(fx), "transactions", BATCH, AS_OF), "transactions", root)
    return tables.read_appended(fx.spark, "transactions", root).select(*TRANSACTIONS.columns)


@query(
    "fact_daily_partitions",
    "SELECT CAST(TX_DATETIME AS DATE) AS tx_date, count(*) AS n_rows, round(sum(TX_AMOUNT), 2) AS amount FROM {tx} GROUP BY 1",
)
def _(fx):
    """Rows per stored day, from tables partitioned by it."""
    root = workspace(fx.spark, "facts")
    tables.append(prepare(fx["tx"], "transactions", BATCH, AS_OF), "transactions", root)
    stored_rows = tables.read_appended(fx.spark, "transactions", root)
    return stored_rows.groupBy("tx_date").agg(F.count("*").alias("n_rows"), F.round(F.sum("TX_AMOUNT"), 2).alias("amount"))


_APPENDED = (
    "SELECT 'transactions' AS entity, (SELECT count(*) FROM {tx}) AS records, 'success' AS status "
    "UNION ALL SELECT 'travel_profiles', (SELECT count(*) FROM {travel_profiles}), 'success' "
    "UNION ALL SELECT 'customers', 0, 'empty' UNION ALL SELECT 'merchants', 0, 'failed'"
)


def _appended(fx):
    """Two appended tables, an empty entity, and one without a table."""
    root = workspace(fx.spark, "status")
    batch = {
        "transactions": prepare(fx["tx"], "transactions", BATCH, AS_OF),
        "travel_profiles": prepare(fx["travel_profiles"], "travel_profiles", BATCH, AS_OF),
        "customers": delivered(fx, "customers").filter("mean_amount < 0 AND mean_amount > 0"),
        "merchants": fx["tx"],
    }
    return tables.status_frame(fx.spark, [tables.upsert(df, kind, root, BATCH, AS_OF) for kind, df in batch.items()])


@query("append_status", _APPENDED)
def _(fx):
    return _appended(fx)


@query(
    "upsert_summary",
    "SELECT CAST(sum(records) AS BIGINT) AS total_records, string_agg(entity, ',' ORDER BY entity) FILTER (records > 0) AS entities "
    f"FROM ({_APPENDED})",
)
def _(fx):
    return quality.upsert_summary(_appended(fx))


def _upserted(fx):
    """First load of both dimensions, a second delivery, the same customers once more, and the appended tables."""
    root = workspace(fx.spark, "upsert")
    out = []
    for kind in ("customers", "terminals"):
        tables.upsert(stored(fx, kind), kind, root, FIRST_BATCH, LOADED)
        out.append(tables.upsert(delivered(fx, kind), kind, root, BATCH, AS_OF, source_columns(fx, kind)))
    again = tables.upsert(delivered(fx, "customers"), "customers", root, "batch-3", AS_OF, source_columns(fx, "customers"))
    out.append(("customers again", *again[1:]))
    out.append(tables.upsert(prepare(fx["travel_profiles"], "travel_profiles", BATCH, AS_OF), "travel_profiles", root, BATCH, AS_OF))
    out.append(tables.upsert(prepare(fx["tx"], "transactions", BATCH, AS_OF), "transactions", root, BATCH, AS_OF))
    return tables.status_frame(fx.spark, out)


_STATUSES = (
    "SELECT 'customers' AS entity, (SELECT count(*) FROM {delta_c}) AS records, 'success' AS status "
    "UNION ALL SELECT 'terminals', (SELECT count(*) FROM {delta_t}), 'success' "
    "UNION ALL SELECT 'customers again', 0, 'no_changes' "
    "UNION ALL SELECT 'travel_profiles', (SELECT count(*) FROM {travel_profiles}), 'success' "
    "UNION ALL SELECT 'transactions', (SELECT count(*) FROM {tx}), 'success'"
)


@query("upsert_dispatch_status", _STATUSES)
def _(fx):
    return _upserted(fx)


def _landing(fx) -> str:
    """Landing folder of one batch: CSV files of all entities and a manifest that lists them."""
    root = workspace(fx.spark, "landing")
    for kind in ("customers", "terminals"):
        csv_files.write(fx[f"{kind}_v2"], f"{root}/{kind}", rows_per_file=5000)
    csv_files.write(
        fx["travel_profiles"].select("CUSTOMER_ID", "TRAVEL_REGIONS", F.lit(None).cast("double").alias("AVG_TRAVEL_DISTANCE_KM")),
        f"{root}/travel_profiles", rows_per_file=5000,
    )
    csv_files.write(fx["tx"], f"{root}/transactions", rows_per_file=5000)
    parts = F.regexp_extract("file_path", "(([^/]+)/[^/]+)$", 1), F.regexp_extract("file_path", "(([^/]+)/[^/]+)$", 2)
    listed = csv_files.headers(fx.spark, root).select(
        F.concat(F.lit("s3://raw-data/"), parts[0]).alias("s3_path"), parts[0].alias("file_key"), parts[1].alias("folder"),
        F.lit(None).cast("bigint").alias("rows_n"), F.lit(BATCH).alias("batch_id"), F.lit(None).cast("bigint").alias("batch_num"),
    )
    manifest.write(manifest.build(listed, AS_OF), f"{root}/metadata")
    return root


_LOADED = (
    "SELECT 'customers' AS entity, count(*) AS records, 'success' AS status FROM {latest_c} "
    "UNION ALL SELECT 'terminals', count(*), 'success' FROM {latest_t} "
    "UNION ALL SELECT 'transactions', count(*), 'success' FROM {tx} "
    "UNION ALL SELECT 'travel_profiles', count(*), 'success' FROM {travel_profiles}"
)


@query("load_batch", _LOADED)
def _(fx):
    """A landed batch of all four entities loaded into empty tables."""
    return jobs.load_batch(fx.spark, _landing(fx), workspace(fx.spark, "lake"), BATCH, AS_OF)


@query(
    "load_report",
    "SELECT 'customers' AS entity, count(*) AS n_rows, CAST(0 AS BIGINT) AS n_rejected, count(DISTINCT CUSTOMER_ID) AS n_keys FROM {customers_v2} "
    "UNION ALL SELECT 'terminals', count(*), 0, count(DISTINCT TERMINAL_ID) FROM {terminals_v2} "
    "UNION ALL SELECT 'transactions', count(*), 0, NULL FROM {tx} "
    "UNION ALL SELECT 'travel_profiles', count(*), 0, count(DISTINCT CUSTOMER_ID) FROM {travel_profiles}",
)
def _(fx):
    """Quality counts that the load of a landed batch leaves behind."""
    lake = workspace(fx.spark, "lake")
    jobs.load_batch(fx.spark, _landing(fx), lake, BATCH, AS_OF)
    return jobs.report(fx.spark, lake, BATCH).select("entity", "n_rows", "n_rejected", "n_keys")


@query(
    "ledger_entries",
    "SELECT file_key, entity, CASE WHEN reason IS NULL THEN 'loaded' ELSE 'rejected' END AS status, reason FROM {reasoned} "
    "WHERE reason IS NOT NULL OR entity <> 'terminals'",
)
def _(fx):
    """Ledger of a run in which the terminals failed: their files stay open, all others are settled."""
    lake = workspace(fx.spark, "ledger")
    statuses = [(k, 1, "failed" if k == "terminals" else "success") for k in ENTITIES]
    entries = ledger.finished(ingest.judge(fx["landing_files"]), tables.status_frame(fx.spark, statuses))
    ledger.record(entries, lake, BATCH, 0)
    return ledger.read(fx.spark, lake).drop("batch_id", "run")


@query("dimension_table", "SELECT * FROM {merged_c}")
def _(fx):
    """Stored dimension after two batches, the second delivered twice."""
    table = tables.DimensionTable(fx.spark, "customers", workspace(fx.spark, "dimension"))
    table.load(stored(fx, "customers"), FIRST_BATCH, LOADED)
    for _ in range(2):
        table.load(delivered(fx, "customers"), BATCH, AS_OF, source_columns(fx, "customers"))
    return table.read()


@query("dimension_late_delivery", "SELECT * FROM {merged_c}")
def _(fx):
    """The second batch is loaded first; the older one goes into the chains and gives the table of the usual order."""
    table = tables.DimensionTable(fx.spark, "customers", workspace(fx.spark, "late"))
    # As a merge would, and a first load would not, number and date the rows by the load.
    second = delivered(fx, "customers").withColumns({"version": F.lit(1).cast("bigint"), "effective_date": time_literal(AS_OF)})
    table.load(second, BATCH, AS_OF)
    table.load(stored(fx, "customers"), FIRST_BATCH, LOADED, source_columns(fx, "customers"))
    return table.read()


@query(
    "table_catalog_columns",
    " UNION ALL ".join(
        f"SELECT '{e.table}' AS table_name, '{n}' AS column_name, '{t.simpleString()}' AS data_type, "
        f"(SELECT count({n}) FROM {source}) AS n_filled"
        for kind, source in (
            ("customers", "{inc_c}"), ("terminals", "{inc_t}"), ("transactions", f"({_PREPARED})"),
            # The delivery has no distance; the preparation fills it in.
            ("travel_profiles", "(SELECT CUSTOMER_ID, TRAVEL_REGIONS, 0e0 AS AVG_TRAVEL_DISTANCE_KM, 'b' AS BATCH_ID, 0 AS created_at FROM {travel_profiles})"),
        )
        for e in (ENTITIES[kind],)
        for n, t in e.fields
    ),
)
def _(fx):
    """Columns and types of the four tables in the catalog, with the number of filled rows after a load."""
    database = f"txlake_{uuid.uuid4().hex}"
    location = workspace(fx.spark, "catalog")
    for _ in range(2):
        tables.create_tables(fx.spark, database, location)
    prepared = {kind: delivered(fx, kind) for kind in ("customers", "terminals")}
    prepared["transactions"] = prepare(enriched(fx), "transactions", BATCH, AS_OF)
    prepared["travel_profiles"] = prepare(fx["travel_profiles"].drop("AVG_TRAVEL_DISTANCE_KM"), "travel_profiles", BATCH, AS_OF)
    parts = []
    for kind, rows in prepared.items():
        tables.insert(rows, database, kind)
        e = ENTITIES[kind]
        table = fx.spark.table(f"{database}.{e.table}")
        types = {f.name: f.dataType.simpleString() for f in table.schema}
        filled = table.agg(*[F.count(c).alias(c) for c in e.columns]).unpivot([], e.columns, "column_name", "n_filled")
        kinds = F.create_map(*[F.lit(x) for c in e.columns for x in (c, types[c])])
        parts.append(filled.select(F.lit(e.table).alias("table_name"), "column_name", kinds[F.col("column_name")].alias("data_type"), "n_filled"))
    return quality.union_all(parts)


@query(
    "travel_bucket_layout",
    "SELECT count(*) AS n_rows, count(DISTINCT CUSTOMER_ID) AS n_keys, CAST(0 AS BIGINT) AS split_keys, TRUE AS within_16 FROM {travel_profiles}",
)
def _(fx):
    """Bucketed table: every key in one bucket, at most 16 buckets. Bucket numbers are layout, not results."""
    database = f"txlake_{uuid.uuid4().hex}"
    tables.create_tables(fx.spark, database, workspace(fx.spark, "buckets"))
    tables.insert(prepare(fx["travel_profiles"], "travel_profiles", BATCH, AS_OF), database, "travel_profiles")
    bucket = F.regexp_extract("_metadata.file_name", r"_(\d{5})\.c", 1)
    placed = fx.spark.table(f"{database}.{ENTITIES['travel_profiles'].table}").select("CUSTOMER_ID", bucket.alias("bucket"))
    per_key = placed.groupBy("CUSTOMER_ID").agg(F.count("*").alias("n"), F.min("bucket").alias("lo"), F.max("bucket").alias("hi"))
    return per_key.agg(
        F.sum("n").alias("n_rows"), F.count("*").alias("n_keys"),
        F.count_if(F.col("lo") != F.col("hi")).alias("split_keys"),
        (F.max(F.col("hi").cast("int")) < 16).alias("within_16"),
    )
