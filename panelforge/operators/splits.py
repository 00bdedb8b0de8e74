"""Splitting by time and choosing time windows."""

from __future__ import annotations

from datetime import date, timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from panelforge.config import Splits


def split_label(time: str, splits: Splits = Splits()) -> Column:
    """'train', 'validation' or 'test'; NULL for a row without a time.

    A bare end date means midnight, so of the end day only 00:00 belongs to the
    earlier part. ``inclusive_day`` keeps that whole day."""

    def upto(end: str) -> Column:
        stamp = F.col(time).cast("timestamp")
        if splits.inclusive_day:
            return stamp < F.lit(end).cast("timestamp") + F.expr("INTERVAL 1 DAY")
        return stamp <= F.lit(end).cast("timestamp")

    return (
        F.when(F.col(time).isNull(), None)
        .when(upto(splits.train_end), "train")
        .when(upto(splits.val_end), "validation")
        .otherwise("test")
    )


def with_split(df: DataFrame, time: str = "index", splits: Splits = Splits()) -> DataFrame:
    return df.withColumn("split", split_label(time, splits))


def split_by_date(df: DataFrame, time: str = "index", splits: Splits = Splits()):
    """Three disjoint frames. Each is a plain filter, so it reaches the scan."""
    label = split_label(time, splits)
    return tuple(df.filter(label == part) for part in ("train", "validation", "test"))


def resolve_window(
    from_date: str | None = None,
    to_date: str | None = None,
    days_back: str | int | None = None,
    today: date | None = None,
    default: tuple[str, str] | None = None,
) -> tuple[date, date]:
    """First day and the day after the last one.

    Explicit dates win; then the last ``days_back`` days, today included (at
    least 1, also for unreadable text); then the default; then today."""
    now = today or date.today()
    first, last = (date.fromisoformat(d) for d in (default or (now.isoformat(),) * 2))
    if from_date or to_date:
        first = date.fromisoformat(from_date) if from_date else first
        last = date.fromisoformat(to_date) if to_date else last
    elif days_back not in (None, ""):
        try:
            days = max(1, int(days_back))
        except ValueError:
            days = 1
        first, last = now - timedelta(days=days - 1), now
    if last < first:
        raise ValueError(f"window ends on {last}, before it starts on {first}")
    return first, last + timedelta(days=1)


def in_window(df: DataFrame, time: str, first: date, after_last: date) -> DataFrame:
    """Half-open filter; comparable with file statistics and partitions."""
    return df.filter(
        (F.col(time) >= F.lit(first.isoformat()).cast("timestamp"))
        & (F.col(time) < F.lit(after_last.isoformat()).cast("timestamp"))
    )


def date_spine(bounds: DataFrame, first: str, last: str, name: str = "day") -> DataFrame:
    """All days from ``first`` to ``last``, both included, per row of ``bounds``.
    A row whose end lies before its start is an error."""
    end_first = F.to_date(F.col(last)) < F.to_date(F.col(first))
    days = F.sequence(F.to_date(first), F.to_date(last), F.expr("INTERVAL 1 DAY"))
    checked = F.when(
        end_first, F.raise_error(F.lit("end date before start date")).cast("array<date>")
    ).otherwise(days)
    return bounds.select(
        *[c for c in bounds.columns if c not in (first, last)], F.explode(checked).alias(name)
    )
