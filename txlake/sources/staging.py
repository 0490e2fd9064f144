"""Parquet staging area: one folder per batch and entity."""

from __future__ import annotations

import logging
from urllib.parse import quote

from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession

log = logging.getLogger(__name__)


def stage_path(root: str, batch_id: str, kind: str) -> str:
    return f"{root}/temp/parquet/{quote(batch_id, safe='')}/{kind}"


def write_one(df: DataFrame, root: str, batch_id: str, kind: str) -> str:
    """Stage an entity, replacing an earlier run of the batch."""
    path = stage_path(root, batch_id, kind)
    df.write.mode("overwrite").parquet(path)
    return path


def read_one(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def write_many(frames: dict[str, DataFrame], root: str, batch_id: str) -> dict[str, str]:
    """Stage the non-empty entities; one that fails does not stop the others."""
    paths = {}
    for kind, df in frames.items():
        try:
            if df.isEmpty():
                log.warning("nothing to stage for %s", kind)
                continue
            paths[kind] = write_one(df, root, batch_id, kind)
        except PySparkException:
            log.exception("staging of %s failed", kind)
    return paths


def read_many(spark: SparkSession, paths: dict[str, str]) -> dict[str, DataFrame]:
    """Staged entities that can be read."""
    frames = {}
    for kind, path in paths.items():
        try:
            frames[kind] = read_one(spark, path)
        except PySparkException:
            log.exception("staged %s cannot be read", kind)
    return frames
