"""Gridded messages as rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelforge.functions.numbers import kelvin_to_celsius, wind_speed

# fixed values: variable code in a message -> column
VARIABLES = {"10u": "u10", "10v": "v10", "2t": "t2m", "ssrd": "ssrd"}


def flatten_grid(
    messages: DataFrame,
    cells: DataFrame,
    time: str = "timestamp",
    variable: str = "short_name",
    values: str = "values",
    width: int | None = None,
) -> DataFrame:
    """One row per time and grid cell, one column per variable.

    ``messages`` holds one array per time and variable, ``cells`` gives
    (pos, lat, lon). The few messages of a time are brought together as arrays
    and exploded once, so the shuffle carries messages, not cells. A variable
    without a message at some time is NULL there."""
    together = messages.groupBy(time).agg(
        *[
            F.max_by(values, F.when(F.col(variable) == code, F.lit(1))).alias(name)
            for code, name in VARIABLES.items()
        ]
    )
    size = F.greatest(*[F.coalesce(F.size(name), F.lit(0)) for name in VARIABLES.values()])
    slots = F.sequence(F.lit(0), size - 1)
    rows = together.filter(size > 0).select(
        time,
        *VARIABLES.values(),
        F.explode(slots).alias("pos"),
    ).select(
        time,
        "pos",
        *[F.get(name, F.col("pos")).alias(name) for name in VARIABLES.values()],
    )
    return with_derived_weather(rows.join(cells, "pos", "left"))


def with_derived_weather(df: DataFrame) -> DataFrame:
    return df.withColumns(
        {
            "wind_speed": wind_speed(F.col("u10"), F.col("v10")),
            "temperature_c": kelvin_to_celsius(F.col("t2m")),
        }
    )
