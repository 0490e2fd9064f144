"""Distances as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from txlake.registry import EARTH_RADIUS_KM


def haversine_km(lon_a: Column, lat_a: Column, lon_b: Column, lat_b: Column) -> Column:
    """Great-circle distance in kilometres, two decimals, inputs in degrees."""
    phi_a, phi_b = F.radians(lat_a), F.radians(lat_b)
    half_dphi = (phi_b - phi_a) / F.lit(2.0)
    half_dlam = (F.radians(lon_b) - F.radians(lon_a)) / F.lit(2.0)
    chord = F.pow(F.sin(half_dphi), F.lit(2.0)) + F.cos(phi_a) * F.cos(phi_b) * F.pow(F.sin(half_dlam), F.lit(2.0))
    # Rounding can push the chord a hair above 1 for opposite points.
    angle = F.lit(2.0) * F.atan2(F.sqrt(chord), F.sqrt(F.greatest(F.lit(1.0) - chord, F.lit(0.0))))
    return F.round(F.lit(EARTH_RADIUS_KM) * angle, 2)


def in_list(item: Column, comma_list: Column) -> Column:
    """True when `item` is one of the entries of a comma-joined text."""
    return F.array_contains(F.split(comma_list, ","), item)


def lower_clamp(value: Column, floor: float = 0.1) -> Column:
    return F.greatest(F.lit(floor), value)
