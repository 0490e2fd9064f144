"""Prepared deliveries and dimensions the queries start from."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from txlake.fixtures import Frames
from txlake.operators import enrich, scd2
from txlake.operators.prepare import prepare
from txlake.registry import ENTITIES
from txlake.workload.oracle_frames import AS_OF, LOADED, START

BATCH, FIRST_BATCH = "batch-2", "batch-1"


def stored(fx: Frames, kind: str) -> DataFrame:
    """Dimension as loaded by the first batch."""
    return prepare(fx[f"{kind}_v1"], kind, FIRST_BATCH, LOADED)


def delivered(fx: Frames, kind: str) -> DataFrame:
    """Second delivery, prepared."""
    return prepare(fx[f"{kind}_v2"], kind, BATCH, AS_OF)


def source_columns(fx: Frames, kind: str) -> list[str]:
    """Compared columns that were delivered; those filled in by the preparation do not count as changes."""
    return [c for c in ENTITIES[kind].compared if c in fx[f"{kind}_v2"].columns]


def delta(fx: Frames, kind: str) -> DataFrame:
    return scd2.delta(delivered(fx, kind), stored(fx, kind), kind, AS_OF, source_columns(fx, kind))


def merged(fx: Frames, kind: str) -> DataFrame:
    return scd2.merge(delivered(fx, kind), stored(fx, kind), kind, AS_OF, source_columns(fx, kind))


def middle(fx: Frames) -> DataFrame:
    return enrich.centroids(fx["geo"], "region", "x", "y")


def enriched(fx: Frames, tx: DataFrame | None = None, **options) -> DataFrame:
    rows = fx["tx"] if tx is None else tx
    return enrich.enrich(
        rows, fx["customers_v1"], fx["terminals_v1"], fx["travel_profiles"], middle(fx), START, **options
    )


def travel_km(fx: Frames) -> DataFrame:
    return enrich.travel_distance(fx["customers_v1"], fx["travel_profiles"], middle(fx))


def shifted_tx(fx: Frames) -> DataFrame:
    """Transactions moved 50 days on, so that they lie on both sides of the second batch."""
    return fx["tx"].withColumn("TX_DATETIME", F.col("TX_DATETIME") + F.make_dt_interval(days=F.lit(50)))
