"""The KPSS test of level stationarity, per key, from sums that Spark aggregates.

The statistic compares the squares of the running sum of deviations from the mean with
the long-run variance: autocovariances of the deviations under Bartlett weights. Both are
sums over rows. A running sum is the sum before a block plus the one within it, so each
block gives a few sums, and these are put together in order; no task holds a key.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from panelforge.operators.blocks import BLOCK, ROW, SIDE, block_parts, row_frames
from panelforge.operators.joins import join_on_keys
from panelforge.session import reliable_checkpoint

KPSS_LIMIT = 0.463   # 5 % value of the test around a level


def bartlett_lags(n: Column) -> Column:
    """How many autocovariances count, by the number of rows."""
    return F.floor(4 * F.pow(n / 100.0, F.lit(0.25))).cast("int")


def kpss(
    series: DataFrame, keys: Sequence[str], order: Sequence[str], value: str, lags: int | None = None, span: str | int = "auto"
) -> DataFrame:
    """keys, n, lags, kpss. ``order`` puts a key's rows in a line, time first; NULL values
    are left out. The statistic is NULL for a constant series. ``lags`` None follows the
    number of rows: it grows with its fourth root, and so do the columns of the sums."""
    keys, order = list(keys), list(order)
    known = series.where(F.col(value).isNotNull()).select(*keys, *order, F.col(value).cast("double").alias("_v"))
    count = F.count(F.lit(1))
    sizes = known.groupBy(*keys).agg(F.avg("_v").alias("_mean"), count.alias("_n"))
    sizes = reliable_checkpoint(sizes.withColumn("_lags", bartlett_lags(F.col("_n")) if lags is None else F.lit(lags)), "sizes")
    most = sizes.agg(F.max("_lags")).first()[0] or 0
    rows = join_on_keys(known, sizes.select(*keys, "_mean"), keys).select(*keys, *order, (F.col("_v") - F.col("_mean")).alias("_e"))
    window = Window.partitionBy(*keys, BLOCK).orderBy(SIDE, *order, ROW)
    own = F.when(F.col(SIDE) == 0, F.col("_e"))
    before = [F.lag("_e", k).over(window) if k else F.col("_e") for k in range(most + 1)]
    walked = block_parts(rows, keys, order, before=most, span=span).select(
        "*", F.sum(own).over(window.rowsBetween(Window.unboundedPreceding, 0)).alias("_run"),
        *[c.alias(f"_l{k}") for k, c in enumerate(before)],
    ).where(F.col(SIDE) == 0)
    blocks = walked.groupBy(*keys, BLOCK).agg(
        count.alias("_m"), F.sum("_e").alias("_sum"), F.sum("_run").alias("_runs"), F.sum(F.col("_run") * F.col("_run")).alias("_squares"),
        *[F.sum(F.col("_e") * F.col(f"_l{k}")).alias(f"_g{k}") for k in range(most + 1)],
    )
    # One row a block.
    earlier = Window.partitionBy(*keys).orderBy(BLOCK).rowsBetween(Window.unboundedPreceding, -1)
    p = F.coalesce(F.sum("_sum").over(earlier), F.lit(0.0))
    square = F.col("_m") * p * p + 2 * p * F.col("_runs") + F.col("_squares")
    sums = blocks.withColumn("_s", square).groupBy(*keys).agg(
        F.sum("_s").alias("_s"), *[F.coalesce(F.sum(f"_g{k}"), F.lit(0.0)).alias(f"_g{k}") for k in range(most + 1)]
    )
    found = join_on_keys(sums, sizes, keys, "inner")
    weighted = [
        F.when(F.col("_lags") >= k, 2 * (1 - k / (F.col("_lags") + 1)) * F.col(f"_g{k}")).otherwise(0.0) for k in range(1, most + 1)
    ]
    long_run = reduce(lambda a, b: a + b, weighted, F.col("_g0")) / F.col("_n")
    return found.select(
        *keys, F.col("_n").alias("n"), F.col("_lags").alias("lags"), F.try_divide(F.col("_s"), F.col("_n") * F.col("_n") * long_run).alias("kpss")
    )


def differenced(series: DataFrame, keys: Sequence[str], order: Sequence[str], value: str, times: int, span: str | int = "auto") -> DataFrame:
    """keys, order, value: differences of neighbours, taken ``times`` times (up to 2)."""
    known = series.where(F.col(value).isNotNull()).select(*keys, *order, value)
    if not times:
        return known
    lag = [F.col(value), "_b1", "_b2"]
    rows = row_frames(
        known, keys, order, lambda w: {f"_b{k}": F.lag(value, k).over(w) for k in range(1, times + 1)}, before=times, span=span
    )
    step = lag[0] - F.col("_b1") if times == 1 else lag[0] - 2 * F.col("_b1") + F.col("_b2")
    return rows.where(F.col(f"_b{times}").isNotNull()).select(*keys, *order, step.alias(value))


def kpss_order(series: DataFrame, keys: Sequence[str], order: Sequence[str], value: str, span: str | int = "auto") -> DataFrame:
    """keys, d: how often to take differences until the test no longer rejects a level,
    twice at most. A constant series needs none."""
    tests = [
        kpss(differenced(series, keys, order, value, d, span), keys, order, value, span=span).select(*keys, F.col("kpss").alias(f"_k{d}"))
        for d in range(2)
    ]
    both = join_on_keys(*tests, keys)
    calm = [F.coalesce(F.col(f"_k{d}"), F.lit(0.0)) < KPSS_LIMIT for d in range(2)]
    return both.select(*keys, F.when(calm[0], 0).when(calm[1], 1).otherwise(2).alias("d"))
