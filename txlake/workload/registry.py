"""Named queries over a data folder, each with the DuckDB statement it must equal."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from txlake.fixtures import Frames, with_views
from txlake.workload.oracle_frames import ORACLE_FRAMES

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Register a function of the frames; `sql` may name frames in braces."""

    def register(build: Callable[[Frames], DataFrame]):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return build(Frames(spark, sf_dir))

        run.__name__ = name
        run.__doc__ = build.__doc__
        QUERIES[name] = run
        if sql:
            ORACLES[name] = with_views(sql.strip(), ORACLE_FRAMES)
        return build

    return register
