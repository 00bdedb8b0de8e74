"""Rule-based scores as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from panelforge.functions.numbers import at_least, band, clip

# fixed values: band limits and labels
STRESS_LEVELS = ([(33.0, "NORMAL"), (66.0, "MODERATE")], "HIGH RISK")
TARGET_LEVELS = ([(33.0, "LOW"), (66.0, "MEDIUM")], "HIGH")
RISK_CATEGORIES = ([(25.0, "NORMAL"), (50.0, "MODERATE")], "HIGH RISK")
ERROR_BANDS = ([(5.0, "OK"), (10.0, "WARNING")], "CRITICAL")


def reserve_margin(load: Column, trailing_mean: Column) -> Column:
    return F.try_divide(trailing_mean - load, trailing_mean)


def margin_points(margin: Column) -> Column:
    """Calm at |margin| >= 0.2; a NULL margin counts as the worst case."""
    size = F.abs(margin)
    return F.when(size >= 0.2, 0.0).when(size >= 0.1, 12.5).otherwise(25.0)


def error_points(rel_error: Column) -> Column:
    """A NULL error counts as the worst case."""
    return F.when(rel_error <= 0.03, 0.0).when(rel_error <= 0.1, 12.5).otherwise(25.0)


def flow_flags(net: Column, low: Column, high: Column) -> tuple[Column, Column]:
    return (net < low).cast("int"), (net > high).cast("int")


def stress_level(score: Column) -> Column:
    return band(score, *STRESS_LEVELS)


def target_level(score: Column) -> Column:
    return band(score, *TARGET_LEVELS)


def risk_category(score: Column) -> Column:
    return band(score, *RISK_CATEGORIES)


def serving_components(
    load: Column, forecast: Column, net: Column, low: Column, high: Column
) -> dict[str, Column]:
    """The points shown when serving; their limits differ from the training rules."""
    margin = (forecast - load) / at_least(load, 1)
    error = F.abs(forecast - load) / at_least(forecast, 1) * 100.0
    return {
        "pts_margin": F.when(margin < -0.15, 25.0).when(margin < -0.05, 12.5).otherwise(0.0),
        "pts_error": F.when(error > 10, 25.0).when(error > 5, 12.5).otherwise(0.0),
        "pts_exports": F.when(net < low, 25.0).otherwise(0.0),
        "pts_imports": F.when(net > high, 25.0).otherwise(0.0),
    }


def net_import_estimate(override: Column, last_hour: Column, last_day: Column) -> Column:
    return F.coalesce(override, (last_hour + last_day) / 2.0)


def fallback_score(
    base: Column,
    load: Column,
    default_load: Column,
    forecast: Column,
    net: Column,
    temperature: Column,
) -> Column:
    """Score without a model, clamped to 0..100."""
    error = F.abs(forecast - load) / at_least(forecast, 1) * 100.0
    raw = (
        base
        + F.lit(20.0) * (F.try_divide(load, default_load) - 1.0)
        + F.lit(0.5) * error
        + F.lit(2.0) * F.abs(net) / 1000.0
        + F.lit(0.5) * at_least(F.abs(temperature - 15.0) - 10.0, 0)
    )
    return clip(raw, 0, 100)


def forecast_error_percent(load: Column, forecast: Column) -> Column:
    return (load - forecast) / at_least(forecast, 1) * 100.0


def forecast_error_band(error_percent: Column) -> Column:
    return band(F.abs(error_percent), *ERROR_BANDS)


def flow_direction(net: Column) -> Column:
    return (
        F.when(net > 0, "Importing").when(net < 0, "Exporting").when(net == 0, "Balanced")
    )
