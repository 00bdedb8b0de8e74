"""The first, last and latest rows of each key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def last_n_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[str], n: int) -> DataFrame:
    """The n latest rows of each key. Every task first cuts its own rows to n
    per key, so a large key does not travel as a whole."""
    place = F.row_number().over(
        Window.partitionBy(*keys).orderBy(*[F.col(c).desc_nulls_last() for c in order])
    )
    return df.withColumn("_place", place).filter(F.col("_place") <= n).drop("_place")


def first_n_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[str], n: int) -> DataFrame:
    place = F.row_number().over(
        Window.partitionBy(*keys).orderBy(*[F.col(c).asc_nulls_last() for c in order])
    )
    return df.withColumn("_place", place).filter(F.col("_place") <= n).drop("_place")


def latest_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """One row per key: partial maxima in each task, then one small shuffle."""
    rest = [c for c in df.columns if c not in set(keys)]
    return (
        df.groupBy(*keys)
        .agg(F.max_by(F.struct(*rest), F.struct(*order)).alias("_row"))
        .select(*keys, "_row.*")
    )


def head_of_key(df: DataFrame, key: str, value, order: Sequence[str], n: int) -> DataFrame:
    """The first n rows of one key."""
    return df.filter(F.col(key) == value).orderBy(*order).limit(n)
