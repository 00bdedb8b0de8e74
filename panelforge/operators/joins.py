"""Joins on entity and time.

No join here forces a broadcast: with adaptive execution Spark broadcasts a side
once its measured size is below ``spark.sql.autoBroadcastJoinThreshold``, and
otherwise sorts and merges, splitting skewed partitions.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from panelforge.functions.numbers import great_circle_km
from panelforge.session import reliable_checkpoint


def align(frames: Sequence[DataFrame], keys: Sequence[str] = ("index", "country")) -> DataFrame:
    """Inner-join frames that hold one row per key. Frames that come out of an
    aggregate on the same keys are already partitioned by them."""
    return reduce(lambda a, b: a.join(b, list(keys)), frames)


def join_on_keys(df: DataFrame, other: DataFrame, keys: Sequence[str], how: str = "left") -> DataFrame:
    """Join by keys, a NULL key meeting a NULL key, as in a window by these keys."""
    mine = {k: f"_key_{i}" for i, k in enumerate(keys)}
    met = reduce(lambda a, b: a & b, [F.col(f"`{k}`").eqNullSafe(F.col(m)) for k, m in mine.items()])
    return df.join(other.withColumnsRenamed(mine), met, how).drop(*mine.values())


def lookup(
    df: DataFrame, dim: DataFrame, on: Sequence[str], defaults: dict[str, object] | None = None
) -> DataFrame:
    """Left join to a dimension; missing attributes take a default value."""
    joined = df.join(dim, list(on), "left")
    if not defaults:
        return joined
    return joined.withColumns({c: F.coalesce(F.col(c), F.lit(v)) for c, v in defaults.items()})


def with_group_stats(df: DataFrame, keys: Sequence[str], stats: dict[str, Column]) -> DataFrame:
    """Put per-key aggregates on every row of a raw table: aggregate first, then
    join the few result rows back, so no task holds a whole key. ``df`` is read
    twice."""
    return join_on_keys(df, df.groupBy(*keys).agg(*[c.alias(n) for n, c in stats.items()]), keys)


def with_panel_stats(df: DataFrame, keys: Sequence[str], stats: dict[str, Column]) -> DataFrame:
    """The same for a panel, where a key holds at most one row per period: a
    window, which runs the plan below once and needs no further shuffle when the
    rows are already partitioned by some of the keys."""
    window = Window.partitionBy(*keys)
    return df.withColumns({n: c.over(window) for n, c in stats.items()})


def nearest_in_time(
    df: DataFrame, keys: Sequence[str], time: str, instant: Column, ties: Sequence[str] = ()
) -> DataFrame:
    """Per key the row closest in time; of two equally close ones the earlier, of rows
    of one time the first by ``ties``. Rows without a time don't count."""
    stamp = F.col(time).cast("timestamp")
    distance = F.abs(F.unix_micros(stamp) - F.unix_micros(instant.cast("timestamp")))
    rest = [c for c in df.columns if c not in set(keys)]
    return (
        df.filter(F.col(time).isNotNull())
        .groupBy(*keys)
        .agg(F.min_by(F.struct(*rest), F.struct(distance, stamp, *ties)).alias("_row"))
        .select(*keys, "_row.*")
    )


SPLIT = 4   # parts of a cell's edge from one level to the next


def _on_sphere(lat: str, lon: str) -> dict[str, Column]:
    """The point on the unit sphere. Nothing wraps there and poles are no exception."""
    a, b = F.radians(lat), F.radians(lon)
    return {"_x": F.cos(a) * F.cos(b), "_y": F.cos(a) * F.sin(b), "_z": F.sin(a)}


def _cell(axis: str, level: int) -> Column:
    return F.floor((F.col(axis) + 1.0) / (2.0 / SPLIT**level)).cast("long")


def _square(a: Column, b: Column) -> Column:
    return (a - b) * (a - b)


def nearest_place(points: DataFrame, places: DataFrame, levels: int = 7) -> DataFrame:
    """The nearest place for each distinct (lat, lon); ties go to the smaller id.

    ``places`` has (place_id, lat, lon, code). Cells around the unit sphere are split
    level by level. A point goes down only into occupied cells that may hold its nearest
    place: whose border is no further than the best place known so far, where each cell
    names one of its places. So each point meets a few cells at each level, and at the
    end the places of a few small cells, however many places there are. Points or places
    without coordinates match nothing."""
    coords = points.select("lat", "lon").distinct()
    known = coords.dropna().withColumns(_on_sphere("lat", "lon"))
    homes = places.dropna(subset=["lat", "lon"]).groupBy("lat", "lon").agg(
        F.min(F.struct("place_id", "code")).alias("_place")
    ).withColumns(_on_sphere("lat", "lon"))
    homes = homes.withColumns({f"{a}{k}": _cell(a, k) for a in ("_x", "_y", "_z") for k in range(levels + 1)})
    homes = reliable_checkpoint(homes, "places")
    axes = ("_x", "_y", "_z")
    near = known.withColumns({f"_c{a}": F.lit(0).cast("long") for a in axes})
    for level in range(1, levels + 1):
        size = 2.0 / SPLIT**level
        cells = homes.groupBy(
            *[F.col(f"{a}{level - 1}").alias(f"_c{a}") for a in axes], *[F.col(f"{a}{level}").alias(f"_n{a}") for a in axes]
        ).agg(F.min(F.struct("_x", "_y", "_z")).alias("_one"))
        border = reduce(
            lambda p, q: p + q,
            [
                _square(F.col(a), F.least(F.greatest(F.col(a), F.col(f"_n{a}") * size - 1.0), (F.col(f"_n{a}") + 1) * size - 1.0))
                for a in axes
            ],
        )
        reach = reduce(lambda p, q: p + q, [_square(F.col(a), F.col(f"_one.{a}")) for a in axes])
        met = near.join(cells, [f"_c{a}" for a in axes]).select(
            "lat", "lon", *axes, *[F.col(f"_n{a}").alias(f"_c{a}") for a in axes],
            F.sqrt(border).alias("_border"), F.sqrt(reach).alias("_reach"),
        )
        # A point meets few cells, so its rows are few.
        best = F.min("_reach").over(Window.partitionBy("lat", "lon"))
        near = met.withColumn("_best", best).filter(F.col("_border") <= F.col("_best") + 1e-9).drop("_border", "_reach", "_best")
        near = reliable_checkpoint(near, "cells") if level % 3 == 0 else near
    ends = homes.select(
        "_place", F.col("lat").alias("_plat"), F.col("lon").alias("_plon"), *[F.col(f"{a}{levels}").alias(f"_c{a}") for a in axes]
    )
    km = great_circle_km(F.col("lat"), F.col("lon"), F.col("_plat"), F.col("_plon"))
    found = (
        near.join(ends, [f"_c{a}" for a in axes])
        .groupBy("lat", "lon")
        .agg(F.min(F.struct(km.alias("km"), "_place")).alias("_best"))
        .select("lat", "lon", F.col("_best._place.place_id").alias("place_id"), F.col("_best._place.code").alias("code"), "_best.km")
    )
    return coords.join(found, ["lat", "lon"], "left")
