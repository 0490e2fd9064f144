"""Geographic and travel columns of transactions, from the dimensions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from txlake.functions.geo import haversine_km, in_list
from txlake.operators.prepare import time_literal
from txlake.operators.scd2 import one_per_key
from txlake.operators.skew import spread_join
from txlake.registry import TRANSACTIONS


def centroids(places: DataFrame, region: str, lon: str, lat: str) -> DataFrame:
    """Mean position of the places of each region: one row per region."""
    return places.groupBy(F.col(region).alias("region")).agg(F.avg(lon).alias("x"), F.avg(lat).alias("y"))


def with_centroid(df: DataFrame, region: str, middle: DataFrame, prefix: str) -> DataFrame:
    """Centroid of the region named in a column, as `<prefix>_x` and `<prefix>_y`."""
    side = middle.select(F.col("region").alias(region), F.col("x").alias(f"{prefix}_x"), F.col("y").alias(f"{prefix}_y"))
    return df.join(side, region, "left")


def centroid_distance(a: str, b: str) -> Column:
    return haversine_km(F.col(f"{a}_x"), F.col(f"{a}_y"), F.col(f"{b}_x"), F.col(f"{b}_y"))


def region_distances(pairs: DataFrame, middle: DataFrame, a: str, b: str) -> DataFrame:
    """Distance between the centroids of two region columns; equal regions are 0 km apart.

    Works on the pairs that occur, found by a map-side combined distinct, not on all combinations.
    """
    met = pairs.select(a, b).distinct()
    both = with_centroid(with_centroid(met, a, middle, "__a"), b, middle, "__b")
    return both.select(a, b, centroid_distance("__a", "__b").alias("AVG_REGION_DISTANCE_KM"))


def first_profile(profiles: DataFrame, order: list[str] | None = None) -> DataFrame:
    """One travel profile per customer: the latest loaded, then a total order."""
    lead = order or [c for c in ("created_at",) if c in profiles.columns]
    return one_per_key(profiles, ["CUSTOMER_ID"], lead)


def latest_regions(profiles: DataFrame) -> DataFrame:
    """Travel list of each customer's latest profile; profiles are appended with every batch."""
    loaded = [c for c in ("created_at",) if c in profiles.columns]
    return first_profile(profiles.select("CUSTOMER_ID", *loaded, "TRAVEL_REGIONS")).select("CUSTOMER_ID", "TRAVEL_REGIONS")


def one_each(dim: DataFrame, key: str, columns: list[str]) -> DataFrame:
    """One row per key of a dimension: the current one, the latest where several are marked current."""
    rows = dim.filter("is_current") if "is_current" in dim.columns else dim
    order = [c for c in ("version", "effective_date") if c in dim.columns]
    return one_per_key(rows.select(key, *order, *columns), [key], [*order, *columns]).select(key, *columns)


def customer_side(
    customers: DataFrame, profiles: DataFrame, middle: DataFrame, about: DataFrame | None = None
) -> DataFrame:
    """What a transaction needs to know about its customer, one row per customer."""
    home = one_each(customers, "CUSTOMER_ID", ["HOME_REGION", "x_customer_id", "y_customer_id"])
    side = home.join(latest_regions(profiles), "CUSTOMER_ID", "left")
    if about is not None:
        side = side.join(about, "CUSTOMER_ID", "left")
    return with_centroid(side, "HOME_REGION", middle, "__home")


def terminal_side(terminals: DataFrame, middle: DataFrame) -> DataFrame:
    place = one_each(terminals, "TERMINAL_ID", ["CITY", "REGION", "x_terminal_id", "y_terminal_id"])
    return with_centroid(place, "REGION", middle, "__term")


def time_offsets(start: str) -> dict[str, Column]:
    """Whole seconds and calendar days since the start of the window."""
    origin, at = time_literal(start), F.col("TX_DATETIME")
    return {
        "TX_TIME_SECONDS": F.timestamp_diff("SECOND", origin, at),
        "TX_TIME_DAYS": F.date_diff(F.to_date(at), F.to_date(origin)).cast("bigint"),
    }


def enrich(
    tx: DataFrame,
    customers: DataFrame,
    terminals: DataFrame,
    profiles: DataFrame,
    middle: DataFrame,
    start: str,
    about_customer: DataFrame | None = None,
    keep: tuple[str, ...] = (),
) -> DataFrame:
    """The thirteen transaction columns. Two joins touch the transactions, one per dimension.

    Region centroids and travel lists are attached to the dimensions first, which are smaller; the
    region distance is then plain arithmetic. Hot customers and terminals are split. Transactions without a partner keep nulls. More facts
    about customers, one row each, can come along in the same join; `keep` names columns of theirs or
    of the transactions to leave in the result.
    """
    of_customer = spread_join(tx, customer_side(customers, profiles, middle, about_customer), "CUSTOMER_ID")
    joined = spread_join(of_customer, terminal_side(terminals, middle), "TERMINAL_ID")
    out = joined.withColumns({
        **time_offsets(start),
        "DISTANCE_FROM_HOME_KM": haversine_km(
            F.col("x_customer_id"), F.col("y_customer_id"), F.col("x_terminal_id"), F.col("y_terminal_id")
        ),
        "TERMINAL_CITY": F.col("CITY"),
        "TERMINAL_REGION": F.col("REGION"),
        "AVG_REGION_DISTANCE_KM": centroid_distance("__home", "__term"),
        "IS_NEW_REGION": ~in_list(F.col("REGION"), F.col("TRAVEL_REGIONS")),
        "CUSTOMER_TRAVEL_REGIONS": F.col("TRAVEL_REGIONS"),
    })
    lineage = ("BATCH_ID", "created_at")
    return out.select(*[c for c in TRANSACTIONS.columns if c not in lineage], *keep)


def travel_regions(profiles: DataFrame) -> DataFrame:
    """One row per customer and listed region."""
    return profiles.select("CUSTOMER_ID", F.explode(F.split("TRAVEL_REGIONS", ",")).alias("region"))


def travel_distance(customers: DataFrame, profiles: DataFrame, middle: DataFrame) -> DataFrame:
    """Mean distance from the home region to the regions of the latest profile, two decimals."""
    homes = one_each(customers, "CUSTOMER_ID", ["HOME_REGION"])
    listed = travel_regions(latest_regions(profiles)).join(homes, "CUSTOMER_ID")
    both = with_centroid(with_centroid(listed, "HOME_REGION", middle, "__home"), "region", middle, "__goal")
    return both.groupBy("CUSTOMER_ID").agg(
        F.round(F.avg(centroid_distance("__home", "__goal")), 2).alias("AVG_TRAVEL_DISTANCE_KM")
    )


def build_profiles(tx_places: DataFrame) -> DataFrame:
    """Travel list per customer from the regions of the transactions, sorted and comma-joined.

    The distinct runs first and combines on the map side, so the list per customer is never longer than
    the number of regions.
    """
    visited = tx_places.select("CUSTOMER_ID", F.col("TERMINAL_REGION").alias("region")).dropna().distinct()
    return visited.groupBy("CUSTOMER_ID").agg(
        F.array_join(F.sort_array(F.collect_list("region")), ",").alias("TRAVEL_REGIONS")
    )


def behavior_profile(tx: DataFrame) -> DataFrame:
    """Spending profile per customer: mean, deviation and transactions per active day."""
    days = F.countDistinct(F.to_date("TX_DATETIME"))
    return tx.groupBy("CUSTOMER_ID").agg(
        F.avg("TX_AMOUNT").alias("mean_amount"),
        F.stddev_samp("TX_AMOUNT").alias("std_amount"),
        (F.count("*") / days).alias("mean_nb_tx_per_day"),
    )
