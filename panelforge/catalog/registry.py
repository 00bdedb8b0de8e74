"""Queries and their SQL counterparts, collected by name."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def _edge(df: DataFrame) -> DataFrame:
    """Results carry times without a zone, as the input files do."""
    return df.select(
        *[
            F.col(f"`{f.name}`").cast("timestamp_ntz").alias(f.name)
            if isinstance(f.dataType, T.TimestampType)
            else F.col(f"`{f.name}`")
            for f in df.schema
        ]
    )


def query(name: str, sql: str | None = None):
    def register(fn):
        if name in QUERIES:
            raise ValueError(f"query {name} registered twice")

        def run(spark: SparkSession, sf: str) -> DataFrame:
            spark.conf.set("spark.sql.session.timeZone", "UTC")
            return _edge(fn(spark, sf))

        run.__name__ = name
        run.__doc__ = fn.__doc__
        QUERIES[name] = run
        if sql is not None:
            SQL[name] = sql
        return fn

    return register


def r6(column, places: int = 6):
    """Rounded for comparison across engines; adding 0 turns -0 into 0."""
    c = F.col(column) if isinstance(column, str) else column
    return F.round(c, places) + F.lit(0.0)


def rounded(df: DataFrame, *columns: str, places: int = 6) -> DataFrame:
    return df.withColumns({c: r6(c, places) for c in columns})


def money(df: DataFrame, *columns: str) -> DataFrame:
    """Large amounts: two places, since sums of means differ in the last bits."""
    return rounded(df, *columns, places=2)
