"""The rule-based stress score of a panel."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from panelforge.config import TRAILING_ROWS
from panelforge.functions import scoring as S
from panelforge.functions.numbers import relative_error
from panelforge.operators.blocks import row_frames
from panelforge.operators.joins import join_on_keys
from panelforge.operators.percentiles import exact_percentiles, percentile_disc


def with_reserve_margin(
    df: DataFrame,
    keys: Sequence[str] = ("country",),
    order: Sequence[str] = ("index",),
    load: str = "Actual_Load",
    rows: int = TRAILING_ROWS,
    span: str | None = None,
) -> DataFrame:
    """Margin of the load against its mean over this row and ``rows`` before."""

    def columns(window):
        return {"load_trailing_avg": F.avg(load).over(window.rowsBetween(-rows, 0))}

    framed = row_frames(df, keys, order, columns, before=rows, span=span)
    margin = S.reserve_margin(F.col(load), F.col("load_trailing_avg"))
    return framed.withColumn("reserve_margin_ml", margin)


def with_load_errors(
    df: DataFrame, load: str = "Actual_Load", forecast: str = "Forecasted_Load"
) -> DataFrame:
    return df.withColumns(
        {
            "forecast_load_error": F.col(forecast) - F.col(load),
            "load_rel_error": relative_error(F.col(forecast), F.col(load)),
        }
    )


def with_flow_limits(
    df: DataFrame,
    keys: Sequence[str] = ("country",),
    net: str = "net_imports",
    low: float = 0.10,
    high: float = 0.90,
    one_row_per_period: bool = True,
) -> DataFrame:
    """Per-key percentiles of the flow on every row.

    A panel has one row per key and period, so a window over the key is bounded
    and shares the shuffle of the trailing window; joining aggregates back would
    run the whole plan below twice. ``one_row_per_period=False`` is for raw
    tables, whose keys may hold any number of rows."""
    keys = list(keys)
    if one_row_per_period:
        key = Window.partitionBy(*keys)
        return df.withColumns(
            {
                "P10_net": percentile_disc(net, low).over(key),
                "P90_net": percentile_disc(net, high).over(key),
            }
        )
    limits = exact_percentiles(df, keys, net, {"P10_net": low, "P90_net": high})
    return join_on_keys(df, limits, keys)


def score_columns() -> dict[str, Column]:
    """Component and total points from margin, error and flow columns."""
    margin = S.margin_points(F.col("reserve_margin_ml"))
    error = S.error_points(F.col("load_rel_error"))
    exports, imports = S.flow_flags(F.col("net_imports"), F.col("P10_net"), F.col("P90_net"))
    return {
        "score_reserve_margin": margin,
        "score_load_error": error,
        "T7_high_exports": exports,
        "T8_high_imports": imports,
        "score_T7": exports * 25,
        "score_T8": imports * 25,
        "grid_stress_score": margin + error + exports * 25 + imports * 25,
    }


def score_panel(df: DataFrame, keys: Sequence[str] = ("country",), order=("index",)) -> DataFrame:
    """All score columns of a joined panel. An unknown flow makes the total NULL;
    an unknown margin or error counts as the worst case."""
    margins = with_reserve_margin(df, keys, order)
    return with_flow_limits(with_load_errors(margins), keys).withColumns(score_columns())
