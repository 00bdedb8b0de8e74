"""Model features of an hourly panel."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelforge.config import FEATURE_GROUPS, MODEL_FEATURES, RISK_THRESHOLD, ROLLING_ROWS
from panelforge.functions.numbers import error_percent, ratio
from panelforge.functions.timeparts import cyclical_parts, peak_flags, time_parts
from panelforge.operators.blocks import row_frames
from panelforge.operators.columns import (
    dense_columns,
    existing_columns,
    feature_candidates,
    one_hot,
)
from panelforge.operators.joins import with_group_stats, with_panel_stats

LAGS = (1, 24)   # fixed values: rows back


def with_calendar(df: DataFrame, time: str = "index") -> DataFrame:
    ts = F.col(time)
    return df.withColumns({**time_parts(ts), **cyclical_parts(ts), **peak_flags(F.hour(ts))})


def with_history(
    df: DataFrame, keys=("country",), order=("index",), imports: bool = True,
    span: str | None = None,
) -> DataFrame:
    """Lags, changes and rolling statistics: one sort serves them all."""
    load = "Actual_Load"

    def columns(w):
        window = w.rowsBetween(-(ROLLING_ROWS - 1), 0)
        out = {f"load_lag_{n}h": F.lag(load, n).over(w) for n in LAGS}
        out["load_rolling_mean_24h"] = F.avg(load).over(window)
        out["load_rolling_std_24h"] = F.stddev_samp(load).over(window)
        out["temp_lag_1h"] = F.lag("mean_temperature_c", 1).over(w)
        if imports:
            out["imports_lag_1h"] = F.lag("net_imports", 1).over(w)
            out["imports_rolling_mean_24h"] = F.avg("net_imports").over(
                w.rowsBetween(-ROLLING_ROWS, -1)
            )
        return out

    framed = row_frames(df, keys, order, columns, before=ROLLING_ROWS, span=span)
    return framed.withColumns(
        {f"load_change_{n}h": F.col(load) - F.col(f"load_lag_{n}h") for n in LAGS}
    )


def with_interactions(df: DataFrame) -> DataFrame:
    load, forecast = F.col("Actual_Load"), F.col("Forecasted_Load")
    temp = F.col("mean_temperature_c")
    cold = (temp < 0).cast("int")
    return df.withColumns(
        {
            "load_forecast_diff": load - forecast,
            "load_forecast_ratio": ratio(load, forecast),
            "load_forecast_error_pct": error_percent(forecast, load),
            "load_per_temp": F.try_divide(load, temp + 20.0),
            "temp_load_product": temp * load / 10000.0,
            "is_very_cold": cold,
            "temp_extreme": cold,
            "wind_power_index": F.pow(F.col("mean_wind_speed"), F.lit(3.0)) / 100.0,
        }
    )


def with_seasonal_means(df: DataFrame, keys=("country",), panel: bool = True) -> DataFrame:
    """Means per key and hour, and per key and weekday, over the whole frame;
    and how far each row lies from them. ``panel=False`` is for raw readings."""
    load = F.avg("Actual_Load")
    put = with_panel_stats if panel else with_group_stats
    out = put(df, [*keys, "hour"], {"hourly_avg_load": load})
    out = put(out, [*keys, "day_of_week"], {"daily_avg_load": load})
    return out.withColumns(
        {
            f"load_deviation_from_{p}_avg": F.col("Actual_Load") - F.col(f"{p}_avg_load")
            for p in ("hourly", "daily")
        }
    )


def clean_features(
    df: DataFrame, keys=("country",), order=("index",), imports: bool = True,
    span: str | None = None,
) -> DataFrame:
    """All features without target leakage. ``imports=False`` leaves out those
    made of past imports. On a panel (no ``span``) the windows by key come first;
    those by key and hour or weekday then use the same shuffle."""
    history = with_history(with_interactions(df), keys, order, imports, span)
    return with_seasonal_means(with_calendar(history, order[0]), keys, panel=span is None)


def final_features(df: DataFrame, wanted: Sequence[str] = MODEL_FEATURES) -> list[str]:
    """The wanted features that exist, then generation columns that are not too
    sparse. Counts NULLs once."""
    generation = [c for c in feature_candidates(df) if "Actual_Aggregated" in c]
    return existing_columns(df, [*wanted, *dense_columns(df, generation)])


def model_matrix(
    df: DataFrame,
    features: Sequence[str],
    categories: Sequence[str],
    key: str = "country",
    keep: Sequence[str] = (),
) -> DataFrame:
    """Features with 0 for gaps, the key as 0/1 columns, and columns to keep.
    The same features and categories for all splits give the same columns."""
    chosen = [F.coalesce(F.col(c).cast("double"), F.lit(0.0)).alias(c) for c in features]
    rest = [c for c in keep if c not in (*features, key)]
    return one_hot(df.select(key, *rest, *chosen), key, categories)


def feature_groups(names: Sequence[str]) -> dict[str, int]:
    """Number of features per category; one feature may be in several."""
    return {
        group: sum(
            any(p in n.lower() for p in loose) or any(p in n for p in exact) for n in names
        )
        for group, (loose, exact) in FEATURE_GROUPS.items()
    }


def with_label(
    df: DataFrame, score: str = "grid_stress_score", threshold: float = RISK_THRESHOLD
) -> DataFrame:
    return df.withColumn("label", (F.col(score) >= threshold).cast("int"))


def with_class_weights(df: DataFrame, label: str = "label", positive: float | None = None):
    """Balanced weights n / (2 * n_class), or a fixed weight for class 1."""
    if positive is not None:
        weight = F.when(F.col(label) == 1, float(positive)).otherwise(1.0)
        return df.withColumn("weight", weight)
    sizes = df.filter(F.col(label).isNotNull()).groupBy(label).agg(F.count(F.lit(1)).alias("_n"))
    total = sizes.agg(F.sum("_n")).scalar()
    weights = sizes.select(label, (total / (F.lit(2.0) * F.col("_n"))).alias("weight"))
    return df.join(weights, label, "left")
