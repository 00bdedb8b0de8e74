"""Profiles of a panel: counts, distributions, correlations."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from panelforge.functions.scoring import risk_category
from panelforge.operators.percentiles import exact_percentiles


def share_of_total(df: DataFrame, value: str, name: str = "pct") -> DataFrame:
    """value / sum(value) * 100. The total is a scalar subquery, so no task has
    to see all rows."""
    total = df.agg(F.sum(value)).scalar()
    return df.withColumn(name, F.try_divide(F.col(value) * 100.0, total))


def value_counts(df: DataFrame, column: str) -> DataFrame:
    """(column, n, pct, category) per distinct score."""
    counts = df.groupBy(column).agg(F.count(F.lit(1)).alias("n"))
    return share_of_total(counts, "n").withColumn("category", risk_category(F.col(column)))


def key_distribution(df: DataFrame, key: str, score: str) -> DataFrame:
    counts = df.groupBy(key).agg(F.count(F.lit(1)).alias("n"), F.avg(score).alias("avg_score"))
    return share_of_total(counts, "n")


def describe(df: DataFrame, column: str) -> DataFrame:
    """One row: mean, median, sample deviation, min, max."""
    plain = df.agg(
        F.avg(column).alias("mean"),
        F.stddev_samp(column).alias("std"),
        F.min(column).alias("min"),
        F.max(column).alias("max"),
    )
    median = exact_percentiles(df, [], column, {"median": 0.5}, interpolate=True)
    return plain.withColumn("median", median.scalar())


def temporal_coverage(df: DataFrame, keys: Sequence[str], time: str = "index") -> DataFrame:
    stamp = F.col(time).cast("timestamp")
    return df.groupBy(*keys).agg(
        F.min(stamp).alias("first_time"),
        F.max(stamp).alias("last_time"),
        F.floor(
            (F.unix_micros(F.max(stamp)) - F.unix_micros(F.min(stamp))) / F.lit(86_400_000_000)
        ).alias("days"),
    )


def key_stats(df: DataFrame, key: str, columns: Sequence[str]) -> DataFrame:
    return df.groupBy(key).agg(*[F.avg(c).alias(c) for c in columns])


def _corr(a: str, b: str) -> Column:
    """Pearson correlation over rows where both are known; NULL when undefined,
    e.g. for a constant column, where the built-in one stops with an error."""
    x, y = F.col(a).cast("double"), F.col(b).cast("double")
    spread = F.sqrt(F.regr_sxx(y, x)) * F.sqrt(F.regr_syy(y, x))
    return F.try_divide(F.regr_sxy(y, x), spread)


def target_correlation(
    df: DataFrame, features: Sequence[str], target: str, min_known: int = 100
) -> DataFrame:
    """(feature, correlation, abs_correlation) for features with more than
    ``min_known`` values. All come from one aggregate; undefined ones drop out."""
    row = df.agg(
        *[
            F.when(F.count(c) > min_known, _corr(c, target)).alias(c)
            for c in features
        ]
    )
    long = row.unpivot([], list(features), "feature", "correlation")
    return long.filter(F.col("correlation").isNotNull()).withColumn(
        "abs_correlation", F.abs("correlation")
    )


def correlation_matrix(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(feature_a, feature_b, correlation) for every ordered pair of columns.
    Each pair uses the rows where both are known; one pass over the data."""
    names = list(columns)
    pairs = [(a, b) for i, a in enumerate(names) for b in names[i:]]
    row = df.agg(*[_corr(a, b).alias(f"c{i}") for i, (a, b) in enumerate(pairs)])

    def cell(a, b, i):
        return F.struct(
            F.lit(a).alias("feature_a"), F.lit(b).alias("feature_b"),
            F.col(f"c{i}").alias("correlation"),
        )

    cells = [cell(a, b, i) for i, (a, b) in enumerate(pairs)]
    cells += [cell(b, a, i) for i, (a, b) in enumerate(pairs) if a != b]
    return row.select(F.inline(F.array(*cells)))


def histogram(df: DataFrame, column: str, low: float, high: float, bins: int) -> DataFrame:
    """(bin, n) over equal bins of [low, high]; the last bin is closed."""
    number = F.width_bucket(
        F.col(column).cast("double"), F.lit(float(low)), F.lit(float(high)), F.lit(bins)
    )
    closed = F.when(F.col(column) == high, F.lit(bins)).otherwise(number).cast("int")
    return (
        df.filter(F.col(column).between(low, high))
        .groupBy(closed.alias("bin"))
        .agg(F.count(F.lit(1)).alias("n"))
    )


def top_k(df: DataFrame, k: int, *order: Column) -> DataFrame:
    """Each task keeps k rows, then k of these are kept."""
    return df.orderBy(*order).limit(k)


def ranked(df: DataFrame, k: int, value: str, tie: str, name: str = "rank") -> DataFrame:
    """The k largest rows with their place, 1 for the largest."""
    from pyspark.sql import Window

    best = top_k(df, k, F.col(value).desc_nulls_last(), F.col(tie))
    place = F.row_number().over(Window.orderBy(F.col(value).desc_nulls_last(), F.col(tie)))
    return best.withColumn(name, place)   # at most k rows


def best_row(df: DataFrame, value: str, tie: str, smallest: bool = False) -> DataFrame:
    """The row with the largest (or smallest) value; equal ones by ``tie``."""
    order = F.col(value).asc_nulls_last() if smallest else F.col(value).desc_nulls_last()
    return top_k(df, 1, order, F.col(tie))


def coverage_rollup(df: DataFrame, outer: str, inner: str, score: str) -> DataFrame:
    return df.rollup(outer, inner).agg(
        F.count(F.lit(1)).alias("n"), F.avg(score).alias("avg_score")
    )
