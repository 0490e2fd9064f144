"""Batch manifests: JSON objects that list the files of a batch."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from txlake.functions.keys import key_of_uri

# Field names and types of the manifest.
MANIFEST_SCHEMA = (
    "batch_id STRING, generated_at STRING, files ARRAY<STRUCT<type: STRING, local_path: STRING, s3_path: STRING, "
    "rows: BIGINT, batch_id: STRING, batch_num: BIGINT>>"
)
FILES_PER_DOCUMENT = 1000


def build(files: DataFrame, generated_at: str, files_per_document: int = FILES_PER_DOCUMENT) -> DataFrame:
    """Manifest documents of every batch.

    A batch is cut into as many documents as its file count asks for, so that a large batch is never
    gathered into one row; together the documents list all its files.
    """
    sizes = files.groupBy("batch_id").agg(F.ceil(F.count("*") / F.lit(files_per_document)).alias("n_documents"))
    entry = F.struct(
        F.col("folder").alias("type"),
        F.concat(F.lit("data/"), F.col("file_key")).alias("local_path"),
        "s3_path",
        F.col("rows_n").alias("rows"),
        "batch_id",
        "batch_num",
    )
    part = F.pmod(F.xxhash64("file_key"), F.col("n_documents"))
    return (
        files.join(sizes, "batch_id")
        .groupBy("batch_id", part.alias("document_num"))
        .agg(F.collect_list(entry).alias("files"))
        .select(
            "batch_id",
            "document_num",
            F.to_json(F.struct("batch_id", F.lit(generated_at).alias("generated_at"), "files")).alias("document"),
        )
    )


def write(manifests: DataFrame, path: str) -> str:
    """One document per file."""
    manifests.select("document").write.mode("overwrite").option("maxRecordsPerFile", 1).text(path)
    return path


def read(spark: SparkSession, path: str, one_per_file: bool = False) -> DataFrame:
    """Documents under a path: one per line, or one (of any layout) per file. Broken ones come out empty."""
    reader = spark.read.schema(MANIFEST_SCHEMA).option("ignoreMissingFiles", True)
    return reader.option("multiLine", one_per_file).json(path)


def listed_files(manifests: DataFrame, batch_id: str | None = None) -> DataFrame:
    """One row per listed file with its object key; optionally of one batch. A broken manifest lists nothing."""
    chosen = manifests if batch_id is None else manifests.filter(F.col("batch_id") == batch_id)
    rows = chosen.select(F.col("batch_id").alias("manifest_batch"), F.inline("files"))
    return rows.select(
        F.col("manifest_batch").alias("batch_id"),
        F.col("type").alias("folder"),
        "s3_path",
        key_of_uri(F.col("s3_path")).alias("file_key"),
        F.col("rows").alias("rows_n"),
        "batch_num",
    )
