"""Resampling and grouped means.

All of these are partial-then-final hash aggregates: the map side collapses
each key and period first, so a key that holds a third of the rows still sends
one row per task and period into the shuffle.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelforge.operators.columns import numeric_columns


def resample_mean(
    df: DataFrame,
    keys: Sequence[str],
    time: str = "index",
    unit: str = "hour",
    values: Sequence[str] | None = None,
) -> DataFrame:
    """Mean of every numeric column per key and period; names are kept."""
    names = list(values or numeric_columns(df, exclude=[*keys, time]))
    return df.groupBy(*keys, F.date_trunc(unit, F.col(time)).alias(time)).agg(
        *[F.avg(F.col(f"`{c}`")).alias(c) for c in names]
    )


def group_mean(df: DataFrame, keys: Sequence[str], values: dict[str, str]) -> DataFrame:
    """Mean per key; ``values`` maps source column to result name."""
    return df.groupBy(*keys).agg(*[F.avg(c).alias(name) for c, name in values.items()])
