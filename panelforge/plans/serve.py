"""Plans behind the live view."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from panelforge.functions.timeparts import clock_label
from panelforge.operators.latest import last_n_per_key


def history_and_forecast(
    scores: DataFrame, ahead: DataFrame, score: str, key: str = "country", time: str = "index",
    history: int = 24,
) -> DataFrame:
    """(key, hour, kind, value, label): hours up to 0 are history, later ones
    forecasts. Hours count from the latest row of the key."""
    last = last_n_per_key(scores, [key], [time], history)
    back = F.row_number().over(Window.partitionBy(key).orderBy(F.col(time).desc()))   # at most 24 rows
    now = scores.groupBy(key).agg(F.hour(F.max(time)).alias("_now"))
    past = last.select(
        key, (F.lit(1) - back).alias("hour"), F.lit("history").alias("kind"), F.col(score).alias("value")
    )
    future = ahead.select(
        key, F.col("step").alias("hour"), F.lit("forecast").alias("kind"),
        F.col("forecast").alias("value"),
    )
    return (
        past.unionByName(future)
        .join(now, key)
        .withColumn("label", clock_label(F.col("_now") + F.col("hour")))
        .drop("_now")
    )
