"""Routing and validation of landed files, and the ledger of those already loaded."""

from __future__ import annotations

import json
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from txlake.functions.keys import archive_path, batch_file_name, entity_of_key, is_csv_key, object_uri, staging_path
from txlake.operators.prepare import inferred_entity
from txlake.plans.numbering import number_rows
from txlake.registry import ENTITIES, ROWS_PER_BATCH_FILE


def route(files: DataFrame) -> DataFrame:
    """Entity of each file key, and the extension test in its strict and its tolerant form."""
    key = F.col("file_key")
    return files.withColumns({
        "entity": entity_of_key(key),
        "is_csv": is_csv_key(key),
        "is_csv_any_case": is_csv_key(key, ignore_case=True),
    })


def clean_header(header: Column) -> Column:
    """Header line without byte-order mark, quotes and the blanks around names."""
    inner = F.regexp_replace(header, '[\\s"]*,[\\s"]*', ",")
    cleaned = F.regexp_replace(inner, '^[\\s\\uFEFF"]+|[\\s"]+$', "")
    return F.when(header.rlike('[\\s\\uFEFF"]'), cleaned).otherwise(header)


def header_names(header: Column) -> Column:
    return F.split(clean_header(header), ",")


Required = Mapping[str, Sequence[str]]


def read_required(spark: SparkSession, path: str) -> dict[str, list[str]]:
    """Required columns per entity from a JSON file, `{"customers": {"required_columns": ["CUSTOMER_ID", ...]}, ...}`.

    An entity without the list requires nothing. A file that cannot be read so is an error, since taking it for empty would
    let every header pass or none.
    """
    text = spark.read.text(path, wholetext=True).first()
    try:
        found = {name: list(told.get("required_columns") or []) for name, told in json.loads(text[0] if text else "").items()}
    except (ValueError, AttributeError, TypeError) as error:
        raise ValueError(f"{path} does not map entities to required columns: {error}") from error
    unusable = [name for name, columns in found.items() if not all(isinstance(c, str) for c in columns)]
    if unusable:
        raise ValueError(f"{path} has required columns that are no text: {', '.join(unusable)}")
    return found


def required_of(entity: Column, required: Required | None = None) -> Column:
    """Required columns of the entity named in a column, by default the registry's; null for an unknown one."""
    of = {e.name: e.required_columns for e in ENTITIES.values()} if required is None else required
    known = [x for name, columns in of.items() for x in (F.lit(name), F.array(*[F.lit(c) for c in sorted(columns)]).cast("array<string>"))]
    return F.element_at(F.create_map(*known).cast("map<string,array<string>>"), entity)


def missing_columns(entity: Column, header: Column, required: Required | None = None) -> Column:
    """Comma list, sorted, of required columns a header lacks; null for an unknown entity.

    A file without a readable header lacks everything. Both inputs are named once, because a filter on
    the result repeats their computation as often as they are named.
    """
    names = header_names(F.coalesce(header, F.lit("")))
    return F.array_join(F.array_except(required_of(entity, required), names), ",")


def validate_headers(files: DataFrame, required: Required | None = None) -> DataFrame:
    """Required columns a file lacks, and whether it is valid: known entity, csv, nothing missing.

    `required`, as `read_required` gives it, takes the place of the registry's columns; an entity it does not name is never valid.
    """
    checked = route(files).withColumn("missing_columns", missing_columns(F.col("entity"), F.col("header"), required))
    return checked.withColumn(
        "is_valid", F.col("is_csv_any_case") & F.coalesce(F.col("missing_columns") == "", F.lit(False))
    )


def judge(files: DataFrame, required: Required | None = None) -> DataFrame:
    """Reason to quarantine a file, null for a file to load."""
    reason = (
        F.when(F.col("entity").isNull(), F.lit("unknown type"))
        .when(~F.col("is_csv"), F.lit("wrong extension"))
        .when(F.col("missing_columns").isNull(), F.lit("no required columns known"))
        .when(F.col("missing_columns") != "", F.lit("missing columns"))
    )
    return validate_headers(files, required).withColumn("reason", reason)


def accepted(files: DataFrame) -> DataFrame:
    return judge(files).filter(F.col("reason").isNull())


def rejected(files: DataFrame) -> DataFrame:
    return judge(files).filter(F.col("reason").isNotNull())


def of_entity(files: DataFrame, name: str) -> DataFrame:
    return files.filter(F.col("entity") == name)


def infer_from_header(files: DataFrame) -> DataFrame:
    """Entity recognised by the columns of the header line instead of the path."""
    named = files.withColumn("__names", header_names(F.col("header")))
    return named.withColumn("inferred", inferred_entity(F.col("__names"))).drop("__names")


def unprocessed(files: DataFrame, ledger: DataFrame) -> DataFrame:
    """Files not in the ledger of loaded ones."""
    return files.join(ledger.select("file_key").distinct(), "file_key", "left_anti")


def batch_stats(files: DataFrame) -> DataFrame:
    """Files and rows per batch and entity folder."""
    return files.groupBy("batch_id", "folder").agg(F.count("*").alias("n_files"), F.sum("rows_n").alias("n_rows"))


def target_paths(files: DataFrame, bucket: str) -> DataFrame:
    """Where a judged file is archived, its address, and where its rows are staged."""
    ok = F.col("reason").isNull()
    return judge(files).select(
        "file_key",
        archive_path(F.col("file_key"), ok).alias("archive_path"),
        object_uri(F.lit(bucket), F.col("file_key")).alias("uri"),
        F.when(ok, staging_path(F.col("batch_id"), F.col("entity"))).alias("staging_path"),
    )


def file_names(files: DataFrame) -> DataFrame:
    return files.select(
        "file_key", batch_file_name(F.col("folder"), F.col("landed_at"), F.col("batch_num")).alias("file_name")
    )


def number_batches(df: DataFrame, order: list[str], rows_per_file: int = ROWS_PER_BATCH_FILE) -> DataFrame:
    """Consecutive row number, and the number (from 1) of the batch file a row belongs to."""
    numbered = number_rows(df, order)
    return numbered.withColumn(
        "batch_num", (F.floor((F.col("row_number") - 1) / F.lit(rows_per_file)) + 1).cast("bigint")
    )
