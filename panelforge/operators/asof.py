"""As-of join: for each row of one series the row of another that is nearest in time.

Both series are laid on one time line per key, and what was seen last (or comes next) is
carried along it in blocks of counted rows. So a key may hold any share of either table:
no task gets a whole key, and no row meets more than the two that it lies between.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from panelforge.operators.blocks import fill_frames

BEFORE, AFTER, NEAREST = "before", "after", "nearest"


def asof_join(
    left: DataFrame, right: DataFrame, keys: Sequence[str], time: str, side: str = BEFORE, tolerance: str | None = None,
    ties: Sequence[str] = (), prefix: str = "right_", how: str = "left", span: str | int = "auto",
) -> DataFrame:
    """``left`` with the columns of one row of ``right``, named with ``prefix``, ``time``
    among them. ``keys`` and ``time`` are columns of both.

    ``side`` says which row of the same key it is: ``before``, the last up to the row's
    time; ``after``, the first from then on; ``nearest``, the nearer of both, the earlier
    where they are as near. Of several at that time it is the last by ``ties`` (before),
    or the first (after). With ``tolerance``, such as "6 hours", rows further away don't
    count. Rows of ``left`` without such a row get NULLs, or go with ``how="inner"``.

    NULL keys meet NULL keys; rows without a time match nothing. Repeated rows each get
    their match."""
    if side not in (BEFORE, AFTER, NEAREST) or how not in ("left", "inner"):
        raise ValueError(f"no such join: {side}, {how}")
    rest = [c for c in right.columns if c not in keys]
    kinds = dict(right.dtypes)
    hit = F.struct(*[F.col(f"`{c}`") for c in rest])
    no_hit = F.lit(None).cast(f"struct<{','.join(f'`{c}`:{kinds[c]}' for c in rest)}>")
    no_tie = [F.lit(None).cast(kinds[c]).alias(f"_tie_{i}") for i, c in enumerate(ties)]
    own = left.select(*keys, F.col(time).alias("_time"), F.struct("*").alias("_left"), no_hit.alias("_hit"), *no_tie)
    other = right.where(F.col(time).isNotNull()).select(
        *keys, F.col(time).alias("_time"), F.lit(None).cast(own.schema["_left"].dataType).alias("_left"), hit.alias("_hit"),
        *[F.col(f"`{c}`").alias(f"_tie_{i}") for i, c in enumerate(ties)],
    )
    # Rows of one time: those to be found come first, but last where they follow the row.
    line = own.unionByName(other).withColumn("_late", F.col("_left").isNotNull() if side != AFTER else F.col("_left").isNull())
    order = ["_time", "_late", *(f"_tie_{i}" for i in range(len(ties)))]
    ahead = {"_last": "_hit"} if side != AFTER else {}
    back = {"_next": "_hit"} if side != BEFORE else {}
    filled = fill_frames(line, keys, order, forward=ahead, backward=back, span=span).where(F.col("_left").isNotNull())
    found = _within(F.col("_last" if side != AFTER else "_next"), time, tolerance)
    if side == NEAREST:
        later = _within(F.col("_next"), time, tolerance)
        nearer = _apart(later, time) < _apart(found, time)
        found = F.when(found.isNull() | nearer, later).otherwise(found)
    joined = filled.withColumn("_found", F.when(F.col("_time").isNotNull(), found))
    if how == "inner":
        joined = joined.where(F.col("_found").isNotNull())
    return joined.select("_left.*", *[F.col(f"_found.`{c}`").alias(f"{prefix}{c}") for c in rest])


def _apart(hit: Column, time: str) -> Column:
    micros = lambda c: F.unix_micros(c.cast("timestamp"))
    return F.abs(micros(F.col("_time")) - micros(hit[time]))


def _within(hit: Column, time: str, tolerance: str | None) -> Column:
    if tolerance is None:
        return hit
    return F.when(_apart(hit, time) <= F.unix_micros(F.timestamp_seconds(F.lit(0)) + F.expr(f"INTERVAL {tolerance}")), hit)
