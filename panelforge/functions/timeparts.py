"""Calendar expressions on a timestamp column."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

MORNING_PEAK = (7, 8, 9)        # fixed values
EVENING_PEAK = (18, 19, 20, 21)  # fixed values


def hour_start(ts: Column) -> Column:
    return F.date_trunc("hour", ts)


def date_text(ts: Column) -> Column:
    return F.date_format(ts, "yyyy-MM-dd")


def month_text(ts: Column) -> Column:
    return F.date_format(ts, "yyyy-MM")


def weekday(ts: Column) -> Column:
    """Monday is 0."""
    return F.weekday(ts)


def time_parts(ts: Column) -> dict[str, Column]:
    day = weekday(ts)
    return {
        "hour": F.hour(ts),
        "month": F.month(ts),
        "day_of_week": day,
        "is_weekend": (day >= 5).cast("int"),
    }


def cyclical(value: Column, period: int) -> tuple[Column, Column]:
    angle = value * F.lit(2.0) * F.pi() / F.lit(float(period))
    return F.sin(angle), F.cos(angle)


def cyclical_parts(ts: Column) -> dict[str, Column]:
    out = {}
    for name, part, period in (
        ("hour", F.hour(ts), 24),
        ("month", F.month(ts), 12),
        ("day_of_week", weekday(ts), 7),
    ):
        out[f"{name}_sin"], out[f"{name}_cos"] = cyclical(part, period)
    return out


def peak_flags(hour: Column) -> dict[str, Column]:
    morning = hour.isin(*MORNING_PEAK).cast("int")
    evening = hour.isin(*EVENING_PEAK).cast("int")
    return {
        "is_morning_peak": morning,
        "is_evening_peak": evening,
        "is_peak_hour": morning.bitwiseOR(evening),
    }


def clock_label(hour: Column) -> Column:
    return F.format_string("%02d:00", F.pmod(hour, F.lit(24)).cast("int"))


def epoch_seconds_to_time(seconds: Column) -> Column:
    return F.timestamp_seconds(seconds)


def local_time(ts: Column, zone: str = "Europe/Berlin") -> Column:
    return F.from_utc_timestamp(ts, zone)
