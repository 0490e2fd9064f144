"""Loading one batch from the landing folder into the tables."""

from __future__ import annotations

import logging
from urllib.parse import urlsplit

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from txlake.functions.keys import decode_key, entity_of_key
from txlake.operators import facts, ingest, quality
from txlake.operators.prepare import FAULT, REJECT, conform
from txlake.plans.session import configure, shared_folder
from txlake.registry import ENRICHMENT_COLUMNS, ENTITIES, TRANSACTIONS, Entity
from txlake.sources import csv_files, ledger, manifest, staging, tables
from txlake.sources.id_index import IdIndex

log = logging.getLogger(__name__)

REPORT_SCHEMA = (
    "entity STRING, records BIGINT, status STRING, reason STRING, n_rows BIGINT, n_rejected BIGINT, n_keys BIGINT, n_columns BIGINT, "
    "missing MAP<STRING, BIGINT>, filled MAP<STRING, BIGINT>, batch_id STRING, run INT"
)


def file_key(landing: str) -> Column:
    """The key of a file that is being read: its whole path below the landing folder."""
    path, root = decode_key(F.col(csv_files.PATH)), f"{urlsplit(landing).path.rstrip('/')}/"
    return F.substring(path, F.locate(root, path) + len(root), F.length(path))


def judged_files(listed: DataFrame, found: DataFrame, required: ingest.Required | None = None) -> DataFrame:
    """Listed files with entity, header and reason to reject; `found` has what is known of the files that were read."""
    judged = ingest.judge(listed.join(found.withColumnRenamed("file_path", "file_key"), "file_key", "left"), required)
    expected = F.col("entity").isNotNull() & F.col("is_csv")
    missing = F.when(expected & F.col("header").isNull(), F.lit(ledger.NOT_FOUND))
    return judged.withColumn("reason", F.coalesce(missing, "reason", "file_fault"))


def transaction_ids(spark: SparkSession, lake: str) -> IdIndex:
    return IdIndex(spark, f"{lake}/{TRANSACTIONS.table}_ids", "TRANSACTION_ID")


def counts(staged: DataFrame, e: Entity) -> DataFrame:
    """Quality counts of an entity's converted rows, one row from one pass: rows, rejected rows, keys of a dimension, columns, and of the
    rows that are loaded the nulls per required column and, of transactions, the filled values per enrichment column."""
    kept = F.col(REJECT).isNull()
    key = quality.KEY_COUNTED.get(e.name)
    looked_at = ENRICHMENT_COLUMNS if e is TRANSACTIONS else ()

    def by_column(columns: list[str], test) -> Column:
        pairs = [x for c in columns for x in (F.lit(c), F.count_if(kept & test(F.col(c))))]
        return F.create_map(*pairs) if pairs else F.create_map().cast("map<string,bigint>")

    return staged.agg(
        F.count_if(kept).alias("n_rows"), F.count_if(~kept).alias("n_rejected"),
        (F.countDistinct(F.when(kept, F.col(key))) if key else F.lit(None).cast("bigint")).alias("n_keys"),
        F.lit(len(e.columns)).cast("bigint").alias("n_columns"),
        by_column(list(e.required_columns), Column.isNull).alias("missing"), by_column(list(looked_at), Column.isNotNull).alias("filled"),
    )


def load_entity(
    spark: SparkSession, lines: DataFrame, cut: DataFrame, lake: str, e: Entity, files: DataFrame, batch_id: str, load_id: str, at: str
) -> tuple[tuple[str, int, str], dict]:
    """Convert, stage and write the rows of one entity's files; its status and its quality counts."""
    named = files.select(F.explode(ingest.header_names(F.col("header"))).alias("n")).distinct()
    present = {r["n"] for r in named.filter(F.col("n").isin(e.columns)).collect()}
    mine = lines.filter(F.col("part") == e.name).drop("part")
    known = files.select(F.col("file_key").alias("file_path"), "header", "header_line", "file_fault")
    raw = csv_files.fields(csv_files.records(mine, cut), known, e).select(*[c for c in e.columns if c in present], FAULT)
    staged = staging.read_one(spark, staging.write_one(conform(raw, e, batch_id, at), lake, load_id, e.name))
    seen = counts(staged, e).first().asDict()

    rejected = staged.filter(F.col(REJECT).isNotNull())
    writer = rejected.withColumn("load_id", F.lit(load_id)).write.mode("overwrite")
    writer.option("partitionOverwriteMode", "dynamic").partitionBy("load_id").parquet(f"{lake}/quarantine/{e.table}")

    rows = staged.filter(F.col(REJECT).isNull()).drop(REJECT)
    if e is not TRANSACTIONS:
        return tables.upsert(rows, e.name, lake, load_id, at, [c for c in e.compared if c in present]), seen
    # An id is stored once, whatever time it comes with.
    claimed = transaction_ids(spark, lake).claim(rows, batch_id)
    fresh = facts.dedup(rows).join(claimed, "TRANSACTION_ID", "left_semi").select(*e.columns)
    return tables.upsert(fresh, e.name, lake, load_id, at), seen


def report(spark: SparkSession, lake: str, batch_id: str | None = None) -> DataFrame:
    """What the runs of a batch, or of all, say of each entity: status, the reason of a failure, quality counts."""
    path = f"{lake}/reports"
    spark.createDataFrame([], REPORT_SCHEMA).write.mode("ignore").partitionBy("batch_id", "run").parquet(path)
    rows = spark.read.schema(REPORT_SCHEMA).parquet(path)
    return rows if batch_id is None else rows.filter(F.col("batch_id") == batch_id)


def load_batch(
    spark: SparkSession, landing: str, lake: str, batch_id: str, at: str, required: ingest.Required | None = None
) -> DataFrame:
    """Load what the manifests list for a batch; returns one status row per entity.

    An entity is loaded when the ledger lacks one of its files, and then from all of its files in the
    batch: its rows replace those of an earlier run. The text of these files is read once, for all entities together. An entity that fails,
    for whatever reason, does not stop the others and is taken up again by the next run; `report` tells the reason and the quality
    counts. The ledger is written last. `required` (`ingest.read_required`) replaces the columns that a header must carry. File names of the batch go through the driver, where Spark's file index keeps them too.
    """
    configure(spark)
    shared_folder(spark)
    done = ledger.read(spark, lake).filter(F.col("batch_id") == batch_id)
    run = ledger.next_run(spark, lake, batch_id)
    load_id = batch_id if run == 0 else f"{batch_id}.{run}"
    manifests = manifest.read(spark, f"{landing}/metadata", one_per_file=True)
    listed = ingest.route(manifest.listed_files(manifests, batch_id).select("file_key").distinct()).checkpoint()
    open_files = ingest.unprocessed(listed, done)
    entities = {r["entity"] for r in open_files.filter("entity IS NOT NULL").select("entity").distinct().collect()}
    taken = listed.filter(F.col("entity").isin(sorted(entities)) | F.col("entity").isNull())
    keys = [r["file_key"] for r in taken.filter("entity IS NOT NULL AND is_csv").select("file_key").collect()]
    folder = staging.stage_path(lake, load_id, "lines")
    key = file_key(landing)
    lines = csv_files.stage_lines(spark, landing, folder, keys, key, entity_of_key(key))
    cut = csv_files.ranges(lines).checkpoint()
    judged = judged_files(taken.select("file_key"), csv_files.files_of(lines, cut), required).checkpoint()
    accepted = judged.filter(F.col("reason").isNull())
    waiting = {r["entity"] for r in ingest.unprocessed(accepted, done).select("entity").distinct().collect()}
    statuses, told = [], []
    for e in ENTITIES.values():
        if e.name not in waiting:
            continue
        reason, seen = None, {}
        try:
            status, seen = load_entity(spark, lines, cut, lake, e, ingest.of_entity(accepted, e.name), batch_id, load_id, at)
        except Exception as error:
            # Whatever it is, the other entities are loaded, and the report says why this one was not.
            log.exception("load of %s failed", e.name)
            status, reason = (e.name, 0, "failed"), f"{type(error).__name__}: {error}"[:1000]
        statuses.append(status)
        told.append({"entity": status[0], "records": status[1], "status": status[2], "reason": reason, **seen, "batch_id": batch_id, "run": run})
    result = tables.status_frame(spark, statuses)
    report(spark, lake)
    ledger.replace(spark.createDataFrame(told, REPORT_SCHEMA), f"{lake}/reports")
    ledger.record(ingest.unprocessed(ledger.finished(judged, result), done), lake, batch_id, run)
    return result
