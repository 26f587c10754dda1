"""Numeric column expressions for scores and distances."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

EARTH_RADIUS_KM = 6371


def normalised(weights: Mapping[str, float]) -> dict[str, float]:
    """The same weights with sum 1."""
    total = sum(weights.values())
    return {name: weight / total for name, weight in weights.items()}


def rating_unit(rating: Column) -> Column:
    """A rating of 1 to 5 on the scale 0 to 1."""
    return (rating.cast("double") - 1) / 4


def log1p(count: Column) -> Column:
    return F.ln(count.cast("double") + 1)


def min_max(value: Column, low: Column, high: Column, *, guarded: bool) -> Column:
    """Position between the bounds; for equal bounds 0 if guarded, otherwise null."""
    share = F.try_divide(value - low, high - low)
    return F.when(low == high, F.lit(0.0)).otherwise(share) if guarded else share


def half_even(value: Column, digits: int = 2) -> Column:
    """Rounding with ties to the even neighbour, on the binary value as NumPy does it."""
    return F.rint(value * 10.0**digits) / 10.0**digits


def recency_weight(days: Column, decay: float = 0.001) -> Column:
    return F.exp(days * F.lit(-float(decay)))


def haversine_km(lat1: Column, lon1: Column, lat2: Column, lon2: Column) -> Column:
    """Great-circle distance in kilometres between points in degrees."""
    a, b = F.radians(lat1), F.radians(lat2)
    north = F.sin((b - a) / 2)
    east = F.sin((F.radians(lon2) - F.radians(lon1)) / 2)
    chord = north * north + F.cos(a) * F.cos(b) * east * east
    return F.asin(F.sqrt(F.least(chord, F.lit(1.0)))) * (2 * EARTH_RADIUS_KM)
