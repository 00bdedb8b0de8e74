"""Arithmetic expressions."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from panelforge.config import EPS


def wind_speed(u: Column, v: Column) -> Column:
    return F.sqrt(u * u + v * v)


def kelvin_to_celsius(t: Column) -> Column:
    return t - F.lit(273.15)


def ratio(a: Column, b: Column) -> Column:
    """a / (b + 1e-6); NULL where that divisor is 0."""
    return F.try_divide(a, b + F.lit(EPS))


def relative_error(forecast: Column, actual: Column) -> Column:
    return ratio(F.abs(forecast - actual), actual)


def error_percent(forecast: Column, actual: Column) -> Column:
    return ratio(F.abs(actual - forecast), forecast) * F.lit(100.0)


def at_least(value: Column, floor: float) -> Column:
    """max(value, floor); NULL stays NULL."""
    return F.when(value.isNotNull(), F.greatest(value, F.lit(float(floor))))


def clip(value: Column, low: float, high: float) -> Column:
    """Clamp to [low, high]; NULL stays NULL."""
    return F.when(
        value.isNotNull(), F.least(F.greatest(value, F.lit(float(low))), F.lit(float(high)))
    )


def band(value: Column, limits: list[tuple[float, str]], otherwise: str) -> Column:
    """The label of the first limit the value lies below."""
    first, *rest = limits
    start = F.when(value < F.lit(first[0]), F.lit(first[1]))
    return reduce(
        lambda acc, lim: acc.when(value < F.lit(lim[0]), F.lit(lim[1])), rest, start
    ).otherwise(F.when(value.isNotNull(), F.lit(otherwise)))


def great_circle_km(lat1: Column, lon1: Column, lat2: Column, lon2: Column) -> Column:
    """Haversine distance."""
    half_lat = F.radians(lat2 - lat1) / F.lit(2.0)
    half_lon = F.radians(lon2 - lon1) / F.lit(2.0)
    h = F.pow(F.sin(half_lat), F.lit(2.0)) + F.cos(F.radians(lat1)) * F.cos(
        F.radians(lat2)
    ) * F.pow(F.sin(half_lon), F.lit(2.0))
    return F.lit(2.0 * 6371.0) * F.asin(F.sqrt(F.least(h, F.lit(1.0))))
