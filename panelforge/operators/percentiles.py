"""Percentiles per key.

``key_percentiles`` uses the built-in aggregate, whose buffer holds the distinct
values of a key: right for panels, where a key has one row per period.

``exact_percentiles`` bounds every buffer: a fixed-size sketch brackets the
wanted rank, only the values inside the bracket are counted, and the bracket is
narrowed until the values to order are few.
The sketch errs by at most 1/accuracy of the rows, so a bracket of two such
steps on both sides always holds the rank and the result is exact.
"""

from __future__ import annotations

from collections.abc import Sequence
from decimal import Decimal

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from panelforge.operators.joins import join_on_keys
from panelforge.session import reliable_checkpoint


def _name(text: str) -> str:
    return f"`{text}`"


def percentile_disc(column: str, p: float) -> Column:
    return F.expr(f"percentile_disc({p}) WITHIN GROUP (ORDER BY {_name(column)})")


def percentile_cont(column: str, p: float) -> Column:
    return F.expr(f"percentile_cont({p}) WITHIN GROUP (ORDER BY {_name(column)})")


def key_percentiles(
    df: DataFrame, keys: Sequence[str], wanted: dict[str, tuple[str, float]]
) -> DataFrame:
    """``wanted`` maps a result name to (column, p)."""
    return df.groupBy(*keys).agg(
        *[percentile_disc(c, p).alias(name) for name, (c, p) in wanted.items()]
    )


def approx_percentiles(
    df: DataFrame, keys: Sequence[str], wanted: dict[str, tuple[str, float]], accuracy: int = 1000
) -> DataFrame:
    """One grouped sketch for all keys and columns."""
    return df.groupBy(*keys).agg(
        *[F.percentile_approx(c, p, accuracy).alias(name) for name, (c, p) in wanted.items()]
    )


RANKED = 100_000   # distinct values of a bracket that one task puts in order
BINS = 1024


def _narrowed(counted: DataFrame, keys: list[str]) -> DataFrame:
    """Brackets cut down until each has few distinct values: values are counted in equal
    steps between the bracket's ends, and only the steps that hold the wanted ranks
    stay. What lies below them becomes part of the counted row with a NULL value."""
    names = [*keys, "_i"]
    counted = reliable_checkpoint(counted, "brackets")
    before = None
    while True:
        most = counted.groupBy(*names).agg(F.count("_v").alias("n")).agg(F.max("n")).first()[0]
        if most is None or most <= RANKED or most == before:
            return counted
        before = most
        ends = counted.groupBy(*names).agg(F.min("_v").alias("_lo"), F.max("_v").alias("_hi"))
        step = F.floor((F.col("_v") - F.col("_lo")) / (F.col("_hi") - F.col("_lo")) * BINS)
        binned = join_on_keys(counted, ends, names).withColumn(
            "_bin", F.when(F.col("_v").isNotNull(), F.least(F.coalesce(step, F.lit(0)), F.lit(BINS - 1))).otherwise(-1)
        )
        upto = Window.partitionBy(*names).orderBy("_bin")
        bins = binned.groupBy(*names, "_r1", "_r2", "_bin").agg(F.sum("_c").alias("_c")).withColumn("_cum", F.sum("_c").over(upto))
        first, last = (F.min(F.when(F.col("_cum") >= F.col(r), F.col("_bin"))) for r in ("_r1", "_r2"))
        held = bins.groupBy(*names).agg(first.alias("_from"), last.alias("_to"))
        counted = (
            join_on_keys(binned, held, names).filter(F.col("_bin") <= F.col("_to"))
            .groupBy(*names, "_r1", "_r2", "_w", F.when(F.col("_bin") >= F.col("_from"), F.col("_v")).alias("_v"))
            .agg(F.sum("_c").alias("_c"))
        )
        counted = reliable_checkpoint(counted, "brackets")


def exact_percentiles(
    df: DataFrame,
    keys: Sequence[str],
    column: str,
    wanted: dict[str, float],
    interpolate: bool = False,
    accuracy: int = 10_000,
) -> DataFrame:
    """Exact percentiles of one column per key (or of the table, without keys).

    ``wanted`` maps a result name to p. The value is the smallest one whose
    cumulative share reaches p, or, with ``interpolate``, the linear
    interpolation between the two ranks around p * (n - 1)."""
    keys = list(keys)
    value = F.col(_name(column)).cast("double")
    rows = df.select(*keys, value.alias("_v")).filter(F.col("_v").isNotNull())
    step = 2.0 / accuracy

    def bracket(p: float) -> list[float]:
        return [max(0.0, p - step), min(1.0, p + step)]

    ps = list(wanted.values())
    sketch = rows.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("_n"),
        *[
            F.percentile_approx("_v", bracket(p), accuracy).alias(f"_b{i}")
            for i, p in enumerate(ps)
        ],
    )

    def target(i: int, p: float) -> Column:
        # up to ``accuracy`` values a key needs no bracket
        wide = F.col("_n") > accuracy
        low = F.when(wide & F.lit(p - step > 0), F.col(f"_b{i}")[0]).otherwise(float("-inf"))
        high = F.when(wide & F.lit(p + step < 1), F.col(f"_b{i}")[1]).otherwise(float("inf"))
        share = F.lit(Decimal(str(p)))
        n = F.col("_n").cast("decimal(20,0)")
        if interpolate:
            place = share * (n - 1)
            first = F.floor(place) + 1
            second = F.ceil(place) + 1
            weight = (place - F.floor(place)).cast("double")
        else:
            first = second = F.greatest(F.ceil(share * n), F.lit(1))
            weight = F.lit(0.0)
        return F.struct(
            F.lit(i).alias("_i"), low.alias("_low"), high.alias("_high"),
            first.cast("long").alias("_r1"), second.cast("long").alias("_r2"),
            weight.alias("_w"),
        )

    targets = sketch.select(
        *keys, F.array(*[target(i, p) for i, p in enumerate(ps)]).alias("_t")
    )
    if keys:
        near = join_on_keys(rows, targets, keys, "inner")
    else:
        near = rows.withColumn("_t", targets.scalar())
    # per target, values below the bracket collapse into one counted row (NULL
    # value); values above it are not needed
    counted = (
        near.select(
            *keys,
            "_v",
            F.inline(F.filter("_t", lambda t: F.col("_v") <= t["_high"])),
        )
        .groupBy(
            *keys, "_i", "_r1", "_r2", "_w",
            F.when(F.col("_v") >= F.col("_low"), F.col("_v")).alias("_v"),
        )
        .agg(F.count(F.lit(1)).alias("_c"))
    )
    upto = Window.partitionBy(*keys, "_i").orderBy(F.col("_v").asc_nulls_first())
    ranked = _narrowed(counted, keys).withColumn("_cum", F.sum("_c").over(upto))
    chosen = ranked.groupBy(*keys, "_i").agg(
        F.min(F.when(F.col("_cum") >= F.col("_r1"), F.col("_v"))).alias("_v1"),
        F.min(F.when(F.col("_cum") >= F.col("_r2"), F.col("_v"))).alias("_v2"),
        F.first("_w").alias("_w"),
    )
    result = F.col("_v1") + (F.col("_v2") - F.col("_v1")) * F.col("_w")
    return chosen.groupBy(*keys).agg(
        *[
            F.max(F.when(F.col("_i") == i, result)).alias(name)
            for i, name in enumerate(wanted)
        ]
    )
