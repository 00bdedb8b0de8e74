"""Statistics kept as sketches, so that history isn't read again.

A sketch has a fixed size however many rows went into it, and sketches merge. Quantiles
come from KLL sketches of each key and day in a table beside the data; how far splits
overlap comes from theta sketches of their keys.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelforge.sources.tables import replace_partitions, stored

KLL_SIZE = 200        # of a sketch; ranks err by KLL_ERROR of the rows, 99 times of 100
KLL_ERROR = 0.0133
THETA_BITS = 12       # 2**12 kept hashes: an estimate errs by 1/sqrt(2**12) a deviation


def refresh_quantiles(
    df: DataFrame, path: str, keys: Sequence[str], day: str, value: str, again: Sequence[str] = (), size: int = KLL_SIZE
) -> DataFrame:
    """Sketches of ``value`` per key for each ``day`` (a text column) that the table at
    ``path`` doesn't hold, and for the days of ``again``; returns the whole table.

    The days that are there are known from the folder names, and are left out of the
    scan: of a source partitioned by ``day`` only the new ones are read. NULL values
    don't count; a day whose values are all NULL gets a row without a sketch, so it isn't
    read again."""
    spark = df.sparkSession
    # One text a day.
    held = [r[0] for r in spark.read.parquet(path).select(day).distinct().collect()] if stored(spark, path) else []
    done = sorted({str(d) for d in held} - set(again))
    new = df.where(~F.col(day).isin(done)) if done else df
    sketch = F.when(F.count(value) > 0, F.kll_sketch_agg_double(F.col(value).cast("double"), size))
    made = new.groupBy(*keys, day).agg(sketch.alias("sketch"), F.count(value).alias("n"))
    replace_partitions(made, path, [day])
    return spark.read.schema(made.schema).parquet(path)


def sketched_quantiles(sketches: DataFrame, keys: Sequence[str], wanted: dict[str, float]) -> DataFrame:
    """keys, n and a value for each wanted share of the rows, by the merged sketches. The
    value's true rank is within about ``KLL_ERROR`` of the rows."""
    merged = sketches.where(F.col("sketch").isNotNull()).groupBy(*keys).agg(
        F.kll_merge_agg_double("sketch").alias("_all"), F.sum("n").alias("n")
    )
    return merged.select(
        *keys, "n", *[F.kll_sketch_get_quantile_double("_all", F.lit(float(p))).alias(name) for name, p in wanted.items()]
    )


def overlap(df: DataFrame, split: str, members: Sequence[str], bits: int = THETA_BITS) -> DataFrame:
    """For each pair of splits about how many distinct ``members`` both hold, how many the
    first holds alone, and how many it holds at all: left, right, both, left_only, left_all.

    One aggregate makes a sketch for each split, and only sketches are compared. Splits are
    few; members may be any number. Up to 2**bits members the counts are exact."""
    sketches = df.groupBy(split).agg(F.theta_sketch_agg(F.xxhash64(*members), bits).alias("_s"))
    # A line a split: they fit in one row, and pairs of them are made there.
    every = sketches.agg(F.collect_list(F.struct(F.col(split).alias("name"), "_s")).alias("_every"))
    pairs = every.select(F.explode("_every").alias("l"), "_every").select("l", F.explode("_every").alias("r")).where("NOT l.name <=> r.name")
    count = F.theta_sketch_estimate
    return pairs.select(
        F.col("l.name").alias("left"), F.col("r.name").alias("right"), count(F.theta_intersection("l._s", "r._s")).alias("both"),
        count(F.theta_difference("l._s", "r._s")).alias("left_only"), count("l._s").alias("left_all"),
    )
