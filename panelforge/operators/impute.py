"""Filling gaps, and choosing how by hiding known values.

Cells are hidden by a keyed hash, so every run and every engine hides the same
ones, and columns differ from one another.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from panelforge.config import FILL_METHODS, MASK_SHARE_PERCENT
from panelforge.operators.blocks import fill_frames
from panelforge.operators.joins import with_panel_stats
from panelforge.operators.percentiles import percentile_disc

METHODS = ("mean", "median", "ffill_bfill")


def cell_is_hidden(cell_key: Column, column: str, percent: int = MASK_SHARE_PERCENT) -> Column:
    """True for about ``percent`` of the cells of a column."""
    digest = F.substring(F.md5(F.concat(cell_key, F.lit(f"|{column}"))), 1, 8)
    return F.conv(digest, 16, 10).cast("long") % 100 < percent


def mask_cells(
    df: DataFrame, columns: Sequence[str], cell_key: Column, percent: int = MASK_SHARE_PERCENT
) -> DataFrame:
    """Per column c: c_original, c_was_masked (0/1) and c_mask with the hidden
    cells blanked. Only known cells are hidden."""
    new = {}
    for c in columns:
        hidden = cell_is_hidden(cell_key, c, percent) & F.col(c).isNotNull()
        new[f"{c}_original"] = F.col(c)
        new[f"{c}_was_masked"] = hidden.cast("int")
        new[f"{c}_mask"] = F.when(~hidden, F.col(c))
    return df.withColumns(new)


def _key_values(columns: Sequence[str]) -> dict[str, Column]:
    """Mean and median of each column, as aggregates."""
    out = {f"{c}__mean": F.avg(c) for c in columns}
    return out | {f"{c}__median": percentile_disc(c, 0.5) for c in columns}


def key_fill_values(df: DataFrame, keys: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """Mean and median per key for all columns, in one aggregate."""
    return df.groupBy(*keys).agg(*[c.alias(n) for n, c in _key_values(columns).items()])


def fill_all_ways(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], columns: dict[str, str]
) -> DataFrame:
    """Fill each column by mean, by median and by its neighbours in time.

    ``columns`` maps result prefix to source; the results are prefix_mean,
    prefix_median and prefix_ffill_bfill. For panels: all windows are by key, so
    one shuffle and one sort serve them."""
    sources = list(columns.values())
    near = fill_frames(
        df, keys, order, both={f"{p}_ffill_bfill": c for p, c in columns.items()}
    )
    joined = with_panel_stats(near, keys, _key_values(sources))
    filled = {}
    for prefix, c in columns.items():
        filled[f"{prefix}_mean"] = F.coalesce(F.col(c), F.col(f"{c}__mean"))
        filled[f"{prefix}_median"] = F.coalesce(F.col(c), F.col(f"{c}__median"))
    helpers = [f"{c}__{m}" for c in sources for m in ("mean", "median")]
    return joined.withColumns(filled).drop(*helpers)


def method_mae(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    columns: Sequence[str],
    cell_key: Column,
    percent: int = MASK_SHARE_PERCENT,
) -> DataFrame:
    """(keys, column, method, mae): how far each method lands from hidden cells.
    All columns and methods are measured in one aggregate."""
    masked = mask_cells(df, columns, cell_key, percent)
    tried = fill_all_ways(masked, keys, order, {c: f"{c}_mask" for c in columns})

    def miss(c: str, m: str) -> Column:
        gap = F.abs(F.col(f"{c}_{m}") - F.col(f"{c}_original"))
        return F.avg(F.when(F.col(f"{c}_was_masked") == 1, gap))

    pairs = [(c, m) for c in columns for m in METHODS]
    wide = tried.groupBy(*keys).agg(*[miss(c, m).alias(f"{c}|{m}") for c, m in pairs])
    lines = [
        F.struct(
            F.lit(c).alias("column"), F.lit(m).alias("method"), F.col(f"`{c}|{m}`").alias("mae")
        )
        for c, m in pairs
    ]
    return wide.select(*keys, F.inline(F.array(*lines))).filter(F.col("mae").isNotNull())


def best_method(maes: DataFrame, key: str) -> DataFrame:
    """The one (key, method) with the smallest error per column."""
    return (
        maes.groupBy("column")
        .agg(
            F.min_by(F.struct(key, "method", "mae"), F.struct("mae", key, "method")).alias("_best")
        )
        .select("column", "_best.*")
    )


def apply_best(
    df: DataFrame, key: str, order: Sequence[str], columns: Sequence[str], best: DataFrame
) -> DataFrame:
    """Fill by the chosen methods: mean and median for the winning key only,
    then neighbours in time for all keys, then 0."""
    choice = best.groupBy(key).agg(
        *[F.max(F.when(F.col("column") == c, F.col("method"))).alias(f"{c}__m") for c in columns]
    )
    known = with_panel_stats(df.join(choice, key, "left"), [key], _key_values(columns))
    started = known.withColumns(
        {
            c: F.coalesce(
                F.col(c),
                F.when(F.col(f"{c}__m") == "mean", F.col(f"{c}__mean")).when(
                    F.col(f"{c}__m") == "median", F.col(f"{c}__median")
                ),
            )
            for c in columns
        }
    )
    return _finish(started, [key], order, columns, columns, df.columns)


def _finish(started, keys, order, neighbours, columns, keep) -> DataFrame:
    """Fill the ``neighbours`` columns in time order, zero what is left in
    ``columns``, and return just the columns to ``keep``."""
    near = {f"{c}__near": c for c in neighbours}
    filled = fill_frames(started, keys, order, both=near) if near else started
    done = {c: F.coalesce(F.col(f"{c}__near"), F.lit(0.0)) for c in neighbours}
    done |= {c: F.coalesce(F.col(c), F.lit(0.0)) for c in columns if c not in done}
    return filled.withColumns(done).select(*keep)


def apply_by_map(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    columns: Sequence[str],
    methods: dict[str, str] = FILL_METHODS,
    stats_from: DataFrame | None = None,
) -> DataFrame:
    """Fill each column by its fixed method for all keys, then 0.

    Columns that are not there are skipped. ``stats_from`` takes means and
    medians from another frame, e.g. the training part."""
    by = {m: [c for c in columns if methods.get(c) == m] for m in METHODS}
    stats = {f"{c}__v": F.avg(c) for c in by["mean"]}
    stats |= {f"{c}__v": percentile_disc(c, 0.5) for c in by["median"]}
    if stats_from is None:
        known = with_panel_stats(df, keys, stats)
    else:
        other = stats_from.groupBy(*keys).agg(
            F.count(F.lit(1)).alias("_rows"), *[c.alias(n) for n, c in stats.items()]
        )
        known = df.join(other, list(keys), "left")
    started = known.withColumns(
        {c: F.coalesce(F.col(c), F.col(f"{c}__v")) for c in (*by["mean"], *by["median"])}
    )
    return _finish(started, keys, order, by["ffill_bfill"], columns, df.columns)


def keep_original(df: DataFrame, original: Sequence[str]) -> DataFrame:
    """Drop helper columns."""
    return df.select(*original)
