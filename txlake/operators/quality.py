"""Counts that describe a batch."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from txlake.registry import ENRICHMENT_COLUMNS, Entity, entity

KEY_COUNTED = {"customers": "CUSTOMER_ID", "terminals": "TERMINAL_ID", "travel_profiles": "CUSTOMER_ID"}


def union_all(frames: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)


def entity_profile(batch: dict[str, DataFrame]) -> DataFrame:
    """Rows, distinct keys (dimensions only) and column count per entity; empty entities are left out."""
    parts = []
    for name, df in batch.items():
        key = KEY_COUNTED.get(name)
        distinct = F.countDistinct(key) if key else F.lit(None).cast("bigint")
        parts.append(
            df.agg(F.count("*").alias("n_rows"), distinct.alias("n_keys")).select(
                F.lit(name).alias("entity"), "n_rows", "n_keys", F.lit(len(df.columns)).cast("bigint").alias("n_columns")
            )
        )
    return union_all(parts).filter("n_rows > 0")


def total_records(batch: dict[str, DataFrame]) -> DataFrame:
    return entity_profile(batch).agg(
        F.sum("n_rows").alias("total_records"), F.count("*").alias("n_entities")
    )


def null_counts(df: DataFrame, columns: list[str]) -> DataFrame:
    """Null count per column, one row each, from one pass."""
    counted = df.agg(F.count("*").alias("n_rows"), *[F.count_if(F.col(c).isNull()).alias(c) for c in columns])
    return counted.unpivot("n_rows", columns, "column_name", "n_nulls")


def required_null_counts(df: DataFrame, kind: str | Entity) -> DataFrame:
    return null_counts(df, entity(kind).required_columns)


def enrichment_presence(df: DataFrame, columns: tuple[str, ...] = ENRICHMENT_COLUMNS) -> DataFrame:
    """Per expected column: is it there, and in how many rows is it filled."""
    filled = [F.count(c) if c in df.columns else F.lit(0) for c in columns]
    row = df.agg(F.count("*").alias("n_rows"), *[f.cast("bigint").alias(c) for f, c in zip(filled, columns)])
    present = F.col("column_name").isin(*[c for c in columns if c in df.columns])
    return row.unpivot("n_rows", list(columns), "column_name", "n_filled").withColumn("is_present", present)


def upsert_summary(results: DataFrame) -> DataFrame:
    """Total written and the entities that received rows, from the status rows of a batch."""
    return results.agg(
        F.sum("records").alias("total_records"),
        F.array_join(F.sort_array(F.collect_set(F.when(F.col("records") > 0, F.col("entity")))), ",").alias("entities"),
    )
