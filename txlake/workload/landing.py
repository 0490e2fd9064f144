"""Queries on landed files: manifests, routing, validation, staging, CSV scans."""

from __future__ import annotations

from pyspark.sql import functions as F

from txlake.operators import ingest
from txlake.operators.prepare import consolidate, prepare
from txlake.plans.session import workspace
from txlake.registry import RAW_BUCKET
from txlake.sources import csv_files, manifest, staging
from txlake.workload.deliveries import AS_OF, BATCH, FIRST_BATCH, LOADED
from txlake.workload.oracle_frames import stamp
from txlake.workload.registry import query


def _written_manifests(fx):
    documents = manifest.build(fx["landing_files"], LOADED)
    return manifest.read(fx.spark, manifest.write(documents, workspace(fx.spark, "manifests")))


@query("manifest_files", "SELECT batch_id, folder, s3_path, file_key, rows_n, batch_num FROM {landing_files}")
def _(fx):
    """Manifests written as JSON and read back, one row per listed file."""
    return manifest.listed_files(_written_manifests(fx))


@query(
    "manifest_batch_files",
    "SELECT batch_id, folder, s3_path, file_key, rows_n, batch_num FROM {landing_files} WHERE batch_id = 'batch-7'",
)
def _(fx):
    """Files of the running batch only."""
    return manifest.listed_files(_written_manifests(fx), "batch-7")


@query(
    "manifest_build",
    "SELECT batch_id, CAST(ceil(count(*) / 1000e0) AS BIGINT) AS n_documents, count(*) AS n_files, "
    "CAST(sum(rows_n) AS BIGINT) AS n_rows FROM {landing_files} GROUP BY 1",
)
def _(fx):
    documents = manifest.build(fx["landing_files"], LOADED).select(
        "document_num", F.from_json("document", manifest.MANIFEST_SCHEMA).alias("m")
    )
    listed = F.aggregate("m.files", F.lit(0).cast("bigint"), lambda total, f: total + f["rows"])
    return documents.groupBy(F.col("m.batch_id").alias("batch_id")).agg(
        F.countDistinct("document_num").alias("n_documents"),
        F.sum(F.size("m.files")).alias("n_files"),
        F.sum(listed).alias("n_rows"),
    )


@query(
    "manifest_stats",
    "SELECT batch_id, folder, count(*) AS n_files, CAST(sum(rows_n) AS BIGINT) AS n_rows FROM {landing_files} GROUP BY 1, 2",
)
def _(fx):
    return ingest.batch_stats(fx["landing_files"])


@query("file_type_route", "SELECT file_key, entity, is_csv, is_csv_any_case FROM {judged}")
def _(fx):
    return ingest.route(fx["landing_files"]).select("file_key", "entity", "is_csv", "is_csv_any_case")


@query(
    "header_validation",
    "SELECT file_key, entity, missing_columns, is_csv_any_case AND coalesce(missing_columns = '', FALSE) AS is_valid FROM {judged}",
)
def _(fx):
    return ingest.validate_headers(fx["landing_files"]).select("file_key", "entity", "missing_columns", "is_valid")


# Terminals need more than by default, customers less, transactions nothing, travel profiles are not named.
CONFIGURED = (
    '{"customers": {"required_columns": ["CUSTOMER_ID"]}, "terminals": {"required_columns": ["TERMINAL_ID", "CAPACITY", "CITY"]}, '
    '"transactions": {}}'
)


@query(
    "header_validation_configured",
    """
SELECT file_key, missing_columns, CASE WHEN entity IS NULL THEN 'unknown type' WHEN NOT is_csv THEN 'wrong extension'
            WHEN missing_columns IS NULL THEN 'no required columns known' WHEN missing_columns <> '' THEN 'missing columns' END AS reason
FROM (SELECT * REPLACE (CASE entity
        WHEN 'customers' THEN CASE WHEN list_contains(string_split(header, ','), 'CUSTOMER_ID') THEN '' ELSE 'CUSTOMER_ID' END
        WHEN 'terminals' THEN concat_ws(',', 'CAPACITY', CASE WHEN NOT list_contains(string_split(header, ','), 'CITY') THEN 'CITY' END,
             CASE WHEN NOT list_contains(string_split(header, ','), 'TERMINAL_ID') THEN 'TERMINAL_ID' END)
        WHEN 'transactions' THEN '' END AS missing_columns) FROM {judged})""",
)
def _(fx):
    """Headers judged by the required columns of a file."""
    path = f"{workspace(fx.spark, 'required')}/required"
    fx.spark.createDataFrame([(CONFIGURED,)], "value STRING").coalesce(1).write.text(path)
    required = ingest.read_required(fx.spark, path)
    return ingest.judge(fx["landing_files"], required).select("file_key", "missing_columns", "reason")


@query("quarantine_split", "SELECT coalesce(reason, 'valid') AS verdict, file_key, batch_id FROM {reasoned}")
def _(fx):
    files = fx["landing_files"]
    valid = ingest.accepted(files).select(F.lit("valid").alias("verdict"), "file_key", "batch_id")
    return valid.unionByName(ingest.rejected(files).select(F.col("reason").alias("verdict"), "file_key", "batch_id"))


@query("entity_filter", "SELECT file_key, batch_id, entity FROM {reasoned} WHERE reason IS NULL AND entity = 'transactions'")
def _(fx):
    return ingest.of_entity(ingest.accepted(fx["landing_files"]), "transactions").select("file_key", "batch_id", "entity")


@query(
    "infer_entity",
    """
SELECT file_key, CASE WHEN header LIKE 'HOME_CITY,CUSTOMER_ID%' THEN 'customers' WHEN header LIKE 'TERMINAL_ID,%' THEN 'terminals'
       WHEN header LIKE 'TRANSACTION_ID,%' THEN 'transactions' WHEN header LIKE 'CUSTOMER_ID,TRAVEL%' THEN 'travel_profiles' END AS inferred
FROM {landing_files}""",
)
def _(fx):
    return ingest.infer_from_header(fx["landing_files"]).select("file_key", "inferred")


@query("unprocessed_files", f"SELECT * FROM {{landing_files}} WHERE NOT (rows_n > 0 AND landed_at < {stamp('2000-01-01 00:00:00')})")
def _(fx):
    """Files not yet in the ledger, which holds the non-empty files landed before the year 2000."""
    files = fx["landing_files"]
    ledger = files.filter((F.col("rows_n") > 0) & (F.col("landed_at") < F.lit("2000-01-01 00:00:00").cast("timestamp_ntz")))
    return ingest.unprocessed(files, ledger).select(*files.columns)


@query(
    "archive_target_paths",
    """
SELECT file_key, CASE WHEN reason IS NULL THEN 'valid/' ELSE 'invalid/' END || file_key AS archive_path,
       's3://raw-data/' || file_key AS uri,
       CASE WHEN reason IS NULL THEN 'temp/parquet/' || batch_id || '/' || entity END AS staging_path FROM {reasoned}""",
)
def _(fx):
    return ingest.target_paths(fx["landing_files"], RAW_BUCKET)


@query(
    "batch_file_names",
    "SELECT file_key, folder || '_' || strftime(landed_at, '%Y%m%d_%H%M%S') || '_batch_' || "
    "CASE WHEN batch_num < 1000 THEN lpad(CAST(batch_num AS VARCHAR), 3, '0') ELSE CAST(batch_num AS VARCHAR) END || '.csv' "
    "AS file_name FROM {landing_files}",
)
def _(fx):
    return ingest.file_names(fx["landing_files"])


@query(
    "batch_numbering",
    "SELECT TRANSACTION_ID, n AS row_number, CAST((n - 1) // 5000 + 1 AS BIGINT) AS batch_num FROM "
    "(SELECT TRANSACTION_ID, row_number() OVER (ORDER BY TX_DATETIME, TRANSACTION_ID) AS n FROM {tx})",
)
def _(fx):
    tx = fx["tx"].select("TRANSACTION_ID", "TX_DATETIME")
    return ingest.number_batches(tx, ["TX_DATETIME", "TRANSACTION_ID"]).drop("TX_DATETIME")


@query(
    "csv_entity_scan",
    "SELECT * EXCLUDE (end_date, is_current) REPLACE (HOME_CITY || ' \"a\", b' || chr(10) || 'c' AS HOME_CITY) FROM {customers_v1} "
    "UNION ALL SELECT * FROM {customers_v2}",
)
def _(fx):
    """Two CSV deliveries with different column orders, one with quotes, commas and line breaks in its cities, read in one scan
    and converted."""
    root = workspace(fx.spark, "landing")
    first = fx["customers_v1"].drop("end_date", "is_current").withColumn("HOME_CITY", F.concat("HOME_CITY", F.lit(' "a", b\nc')))
    second = fx["customers_v2"].select(*reversed(fx["customers_v2"].columns))
    csv_files.write(first, f"{root}/customers/a", rows_per_file=5000)
    csv_files.write(second, f"{root}/customers/b", rows_per_file=5000)
    rows = csv_files.scan(fx.spark, f"{root}/customers", "customers")
    return prepare(rows, "customers", BATCH, AS_OF).select(*first.columns)


@query(
    "csv_headers",
    "SELECT 'a' AS delivery, count(*) AS n_rows, 'CUSTOMER_ID,TRAVEL_REGIONS' AS header FROM {travel_profiles} "
    "UNION ALL SELECT 'b', count(*), 'TERMINAL_ID,CITY,REGION' FROM {terminals_v2}",
)
def _(fx):
    """Header line of written files, found by reading only their first block, with the rows behind it."""
    root = workspace(fx.spark, "headers")
    csv_files.write(fx["travel_profiles"].select("CUSTOMER_ID", "TRAVEL_REGIONS"), f"{root}/a", rows_per_file=5000)
    csv_files.write(fx["terminals_v2"].select("TERMINAL_ID", "CITY", "REGION"), f"{root}/b", rows_per_file=5000)
    rows = (
        fx.spark.read.option("recursiveFileLookup", True).option("pathGlobFilter", "*.csv").option("header", True)
        .schema("a STRING").csv(root).groupBy(F.col("_metadata.file_path").alias("file_path")).agg(F.count("*").alias("n"))
    )
    found = csv_files.headers(fx.spark, root).join(rows, "file_path")
    delivery = F.regexp_extract("file_path", "/([ab])/[^/]+$", 1)
    return found.groupBy(delivery.alias("delivery"), "header").agg(F.sum("n").alias("n_rows"))


@query("staging_roundtrip", "SELECT * FROM {merged_t}")
def _(fx):
    from txlake.workload.deliveries import merged

    root = workspace(fx.spark, "staging")
    return staging.read_one(fx.spark, staging.write_one(merged(fx, "terminals"), root, BATCH, "terminals"))


@query(
    "staging_multi_roundtrip",
    "SELECT 'customers' AS entity, count(*) AS n_rows, CAST(sum(CUSTOMER_ID) AS BIGINT) AS key_sum FROM {inc_c} "
    "UNION ALL SELECT 'terminals', count(*), CAST(sum(TERMINAL_ID) AS BIGINT) FROM {inc_t} "
    "UNION ALL SELECT 'travel_profiles', count(*), CAST(sum(CUSTOMER_ID) AS BIGINT) FROM {travel_profiles}",
)
def _(fx):
    """Several entities staged at once; the empty one is left out."""
    profiles = fx["travel_profiles"]
    frames = {
        "customers": prepare(fx["customers_v2"], "customers", BATCH, AS_OF),
        "terminals": prepare(fx["terminals_v2"], "terminals", BATCH, AS_OF),
        "travel_profiles": prepare(profiles, "travel_profiles", BATCH, AS_OF),
        "transactions": prepare(fx["tx"], "transactions", BATCH, AS_OF).filter("TX_AMOUNT < 0 AND TX_AMOUNT > 0"),
    }
    paths = staging.write_many(frames, workspace(fx.spark, "staging"), BATCH)
    keys = {"customers": "CUSTOMER_ID", "terminals": "TERMINAL_ID", "travel_profiles": "CUSTOMER_ID"}
    read = staging.read_many(fx.spark, paths)
    return consolidate([
        df.agg(F.count("*").alias("n_rows"), F.sum(keys.get(k, "CUSTOMER_ID")).alias("key_sum")).select(
            F.lit(k).alias("entity"), "n_rows", "key_sum"
        )
        for k, df in read.items()
    ])


@query(
    "consolidate_entity",
    f"SELECT *, 'batch-1' AS BATCH_ID, {stamp(LOADED)} AS created_at FROM {{customers_v1}} UNION ALL "
    f"SELECT *, NULL, NULL, 'batch-2', {stamp(AS_OF)} FROM {{customers_v2}}",
)
def _(fx):
    """Two deliveries of an entity as one table; columns one of them lacks are null there."""
    from txlake.operators.prepare import add_lineage

    return consolidate([
        add_lineage(fx["customers_v1"], FIRST_BATCH, LOADED), add_lineage(fx["customers_v2"], BATCH, AS_OF)
    ])
