"""A table laid out so that filters on any of several columns skip most of it.

Sorting by (key, time) helps filters on the key alone. Here each column's values are
ranked by boundaries from a sample, and the bits of the ranks are interleaved: rows near
each other in all columns lie near each other in the files. Parquet's minima and maxima
then rule out row groups for a filter on any of them.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

RANK_BITS = 10       # 1024 ranks a column
SAMPLED = 40_000     # rows that boundaries come from, about


def _rank(column: Column, boundaries: list) -> Column:
    """How many boundaries lie below a value, by halving; NULL counts as below all."""
    n = len(boundaries)
    if not n:
        return F.lit(0)
    bounds, steps = F.array(*[F.lit(b) for b in boundaries]), [1 << i for i in reversed(range(n.bit_length()))]

    def step(at, s):
        onward = (at + s <= n) & (F.get(bounds, F.least(at + s, F.lit(n)) - 1) < column)
        return F.when(onward, at + s).otherwise(at)

    return F.when(column.isNull(), 0).otherwise(F.aggregate(F.lit(steps), F.lit(0), step))


def boundaries(df: DataFrame, columns: Sequence[str], bits: int = RANK_BITS, sampled: int = SAMPLED) -> dict[str, list]:
    """For each column up to 2**bits - 1 values that part the rows evenly, from rows drawn
    by the hash of these columns. Many rows of one value share a rank."""
    rows = df.select(*columns).groupBy(*columns).agg(F.count(F.lit(1)).alias("_n"))
    total = rows.agg(F.sum("_n")).first()[0] or 0
    # A combination of values is drawn in proportion to its rows.
    chance = F.pmod(F.xxhash64(*columns), F.lit(1 << 30)) / float(1 << 30)
    each = max(total / sampled, 1.0)
    drawn = rows.where(chance < F.col("_n") / each).select(*columns, F.greatest(F.col("_n") / each, F.lit(1.0)).alias("_w")).collect()
    out = {}
    for c in columns:
        weighed = sorted((r[c], r["_w"]) for r in drawn if r[c] is not None)
        whole, seen, cuts = sum(w for _, w in weighed), 0.0, []
        for value, w in weighed:
            seen += w
            if seen >= whole * (len(cuts) + 1) / (1 << bits) and len(cuts) < (1 << bits) - 1 and (not cuts or cuts[-1] < value):
                cuts.append(value)
        out[c] = cuts
    return out


def interleaved(columns: Sequence[str], bounds: dict[str, list], bits: int = RANK_BITS) -> Column:
    """A row's place on the space-filling curve through the ranks of its columns."""
    place, m = F.lit(0).cast("long"), len(columns)
    for i, c in enumerate(columns):
        rank = _rank(F.col(c), bounds[c])
        # The steps of a column's rank differ; ranks are stretched to the same range.
        high = F.floor(rank * ((1 << bits) - 1) / max(len(bounds[c]), 1)).cast("long")
        for b in range(bits):
            bit = F.shiftright(high, b).bitwiseAND(F.lit(1).cast("long"))
            place = place.bitwiseOR(F.shiftleft(bit, b * m + m - 1 - i))
    return place


def write_clustered(
    df: DataFrame, path: str, columns: Sequence[str], files: int, group_bytes: int | None = None, bits: int = RANK_BITS
) -> None:
    """Write ``df`` in ``files`` files along the curve through ``columns``. Rows of one
    place are dealt further by all columns, so that no file gets a hot place whole.
    ``group_bytes`` is the size of Parquet's row groups, which are what is skipped."""
    bounds = boundaries(df, columns, bits)
    place, rest = "_place", F.xxhash64(*[F.col(f"`{c}`") for c in df.columns])
    rows = df.withColumn(place, interleaved(columns, bounds, bits)).withColumn("_rest", rest)
    writer = rows.repartitionByRange(files, place, "_rest").sortWithinPartitions(place, *columns).drop(place, "_rest").write.mode("overwrite")
    if group_bytes:
        writer = writer.option("parquet.block.size", group_bytes)
    writer.parquet(path)
