"""Directed flows between entities."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def sums_by_end(
    flows: DataFrame, end: str, time: str = "index", value: str = "Value", name: str = "total",
    key: str = "country",
) -> DataFrame:
    """Sum of the flow by one end of the edge."""
    return flows.groupBy(F.col(end).alias(key), time).agg(F.sum(value).alias(name))


def _both_ends(source: str, target: str, value: str, key: str) -> Column:
    """Each edge as two rows: what the target takes in and what the source gives."""
    return F.inline(
        F.array(
            F.struct(
                F.col(target).alias(key), F.col(value).alias("_in"),
                F.lit(None).cast("double").alias("_out"),
            ),
            F.struct(
                F.col(source).alias(key), F.lit(None).cast("double").alias("_in"),
                F.col(value).alias("_out"),
            ),
        )
    )


def in_out_sums(
    flows: DataFrame,
    source: str = "from_country",
    target: str = "to_country",
    time: str = "index",
    value: str = "Value",
    key: str = "country",
) -> DataFrame:
    """(key, time, imports, exports); a missing side counts as 0.

    One aggregate over both ends gives the result of summing by each end and
    full-outer joining the two sums, with one shuffle instead of three."""
    return (
        flows.select(time, _both_ends(source, target, value, key))
        .groupBy(key, time)
        .agg(
            F.coalesce(F.sum("_in"), F.lit(0.0)).alias("imports"),
            F.coalesce(F.sum("_out"), F.lit(0.0)).alias("exports"),
        )
    )


def net_flow(flows: DataFrame, **names) -> DataFrame:
    """(key, time, net_imports) with net = imports - exports."""
    sums = in_out_sums(flows, **names)
    return sums.select(
        names.get("key", "country"),
        names.get("time", "index"),
        (F.col("imports") - F.col("exports")).alias("net_imports"),
    )


def full_outer_zero(left: DataFrame, right: DataFrame, on: Sequence[str]) -> DataFrame:
    """Full outer join whose numeric gaps become 0; the keys are coalesced."""
    return left.join(right, list(on), "full_outer").fillna(0)


def both_directions(pairs: DataFrame, a: str = "from_country", b: str = "to_country") -> DataFrame:
    """Undirected pairs without self-links, once each, then both directions."""
    low, high = F.least(a, b), F.greatest(a, b)
    return (
        pairs.filter(F.col(a) != F.col(b))
        .select(low.alias("_a"), high.alias("_b"))
        .distinct()
        .select(
            F.inline(
                F.array(
                    F.struct(F.col("_a").alias(a), F.col("_b").alias(b)),
                    F.struct(F.col("_b").alias(a), F.col("_a").alias(b)),
                )
            )
        )
    )
