"""Ledger of the files each batch has dealt with. It replaces moving files to an archive."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

SCHEMA = "file_key STRING, entity STRING, status STRING, reason STRING, batch_id STRING, run INT"


# A listed file that is not there yet; it stays open.
NOT_FOUND = "not found"


def _path(lake: str) -> str:
    return f"{lake}/ledger"


def read(spark: SparkSession, lake: str) -> DataFrame:
    """All entries; creates the empty ledger where there is none."""
    spark.createDataFrame([], SCHEMA).write.mode("ignore").partitionBy("batch_id", "run").parquet(_path(lake))
    return spark.read.schema(SCHEMA).parquet(_path(lake))


def next_run(spark: SparkSession, lake: str, batch_id: str) -> int:
    """Number of runs of a batch that were finished."""
    done = read(spark, lake).filter(F.col("batch_id") == batch_id)
    return done.agg(F.coalesce(F.max("run") + 1, F.lit(0))).first()[0]


def finished(judged: DataFrame, statuses: DataFrame) -> DataFrame:
    """Entries for judged files: rejected ones with their reason, loaded ones of the entities that were loaded.

    Files of an entity whose load failed and files that were not found get no entry, so the next run of the batch takes
    them up again.
    """
    judged = judged.filter(~F.col("reason").eqNullSafe(F.lit(NOT_FOUND)))
    loaded = statuses.filter("status <> 'failed'").select("entity", F.lit(True).alias("done"))
    known = judged.join(loaded, "entity", "left").filter(F.col("reason").isNotNull() | F.col("done"))
    status = F.when(F.col("reason").isNotNull(), F.lit("rejected")).otherwise(F.lit("loaded"))
    return known.select("file_key", "entity", status.alias("status"), "reason")


def record(entries: DataFrame, lake: str, batch_id: str, run: int) -> None:
    """Write the entries of one run; written again they replace themselves."""
    replace(entries.withColumns({"batch_id": F.lit(batch_id), "run": F.lit(run)}), _path(lake))


def replace(rows: DataFrame, path: str) -> None:
    """Write rows in place of those of the same batch and run."""
    writer = rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    writer.partitionBy("batch_id", "run").parquet(path)
