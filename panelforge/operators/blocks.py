"""Ordered windows that do not need a whole key in one task.

``Window.partitionBy(key)`` sends all rows of a key to one task. That is fine
for a resampled panel, where a key has at most one row per period, and not for
raw readings, where one key may hold a third of the table. Here a key's series
is cut into blocks of counted rows (or of equal time), and each block gets the few
extra rows it needs from its neighbours:

* frames of N rows: copies of the N rows before (or after) the block;
* fill forward or backward: one row with the last (or next) known values.

The window is then partitioned by (key, block) and the extra rows are dropped.
Results equal those of the whole-key window.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from panelforge.session import reliable_checkpoint

BLOCK = "_block"
BLOCK_ROWS = 250_000
ROW = "_row_no"  # tells rows apart that are equal in all order columns
SIDE = "_side"   # -1 lies before the block, 0 is an own row, 1 lies after it

_UNITS = {"minute": 60, "hour": 3600, "day": 86400}


def span_seconds(span: str) -> int:
    """'6 hours' -> 21600."""
    number, unit = span.split()
    return int(number) * _UNITS[unit.rstrip("s")]


def block_of(time: str, span: str) -> Column:
    """Block number; rows without a time come first, as in a sorted window."""
    width = span_seconds(span) * 1_000_000
    number = F.floor(F.unix_micros(F.col(time).cast("timestamp")) / F.lit(width))
    return F.coalesce(number, F.lit(-(2**62)))


def counted_blocks(df: DataFrame, keys: Sequence[str], order: Sequence[str], rows: int) -> tuple[DataFrame, bool]:
    """``df`` with a block for each row, of about ``rows`` rows and below twice that, and
    whether no key has more than one.

    Rows are counted per key and minute; each key's minutes are dealt to blocks in
    order. A minute with more than ``rows`` rows, or that many rows without a time, is
    cut further by all of ``order``, at places that a sample gives. Rows that are equal in
    all of these go by ``ROW``, a number of their own. The input is read once."""
    own = F.xxhash64(F.monotonically_increasing_id())
    base = reliable_checkpoint(df.withColumns({"_slot": block_of(order[0], "1 minute"), ROW: own}), "readings")
    names, order = [*keys, "_slot"], [*order, ROW]
    counts = reliable_checkpoint(base.groupBy(*names).agg(F.count(F.lit(1)).alias("_n")), "minutes")
    of_key, of_slot = counts.groupBy(*keys).agg(F.sum("_n").alias("_of_key"), F.max("_n").alias("_of_slot")).agg(F.max("_of_key"), F.max("_of_slot")).first()
    block = lambda part, sub: F.struct(part.cast("bigint").alias("part"), sub.cast("int").alias("sub"))
    if (of_key or 0) <= rows:
        return base.withColumn(BLOCK, block(F.lit(0), F.lit(0))).drop("_slot"), True
    through = F.sum("_n").over(Window.partitionBy(*keys).orderBy("_slot").rowsBetween(Window.unboundedPreceding, 0))
    slots = counts.withColumn("_part", F.floor((through - F.col("_n")) / rows))
    if of_slot <= rows:
        joined = base.alias("t").join(slots.alias("c"), _same_key("t", "c", names)).select("t.*", "c._part")
        return joined.withColumn(BLOCK, block(F.col("_part"), F.lit(0))).drop("_slot", "_part"), False
    crowded = slots.filter(F.col("_n") > rows).select(*names)
    every = min(rows, 64)   # sampled rows for each cut
    drawn = F.pmod(F.xxhash64(*order), F.lit(1 << 20)) < int((1 << 20) * every / rows)
    cuts = (
        base.alias("t").join(crowded.alias("c"), _same_key("t", "c", names), "left_semi").filter(drawn)
        .groupBy(*names).agg(F.array_sort(F.collect_list(F.struct(*order))).alias("_drawn"))
        .select(*names, F.filter("_drawn", lambda _, i: i % every == every - 1).alias("_cuts"))
    )
    placed = slots.alias("t").join(cuts.alias("c"), _same_key("t", "c", names), "left").select("t.*", "c._cuts")
    joined = base.alias("t").join(placed.alias("c"), _same_key("t", "c", names), "left").select("t.*", "c._part", "c._cuts")
    own = F.struct(*order)

    def halve(at: Column, step: Column) -> Column:
        onward = (at + step <= F.size("_cuts")) & (F.get("_cuts", at + step - 1) < own)
        return F.when(onward, at + step).otherwise(at)

    steps = F.lit([1 << i for i in range(24, -1, -1)])
    sub = F.when(F.col("_cuts").isNull(), F.lit(0)).otherwise(F.aggregate(steps, F.lit(0), halve))
    return joined.withColumn(BLOCK, block(F.col("_part"), sub)).drop("_slot", "_part", "_cuts"), False


def _in_blocks(df: DataFrame, keys: Sequence[str], order: Sequence[str], span: str | int) -> tuple[DataFrame, list[str], bool]:
    """The rows with their blocks, what orders them, and whether keys are whole."""
    if span == "auto" or isinstance(span, int):
        base, whole = counted_blocks(df, keys, order, BLOCK_ROWS if span == "auto" else span)
    else:
        base, whole = df.withColumns({BLOCK: block_of(order[0], span), ROW: F.lit(0).cast("bigint")}), False
    return base.withColumn(SIDE, F.lit(0)), [*order, ROW], whole


def _same_key(left: str, right: str, keys: Sequence[str]) -> Column:
    cond = F.lit(True)
    for k in keys:
        cond = cond & F.col(f"{left}.{k}").eqNullSafe(F.col(f"{right}.{k}"))
    return cond


def _edge_rows(base: DataFrame, keys, order, reach: int, before: bool) -> DataFrame:
    """Copies of the ``reach`` rows next to each block, taken from as many
    neighbouring blocks as that needs."""
    walk = Window.partitionBy(*keys).orderBy(
        F.col(BLOCK).asc() if before else F.col(BLOCK).desc()
    )
    near = Window.partitionBy(*keys, BLOCK).orderBy(
        *[F.col(c).desc() if before else F.col(c).asc_nulls_first() for c in order]
    )
    sizes = base.groupBy(*keys, BLOCK).agg(F.count(F.lit(1)).alias("_n"))
    running = sizes.withColumn(
        "_through", F.sum("_n").over(walk.rowsBetween(Window.unboundedPreceding, 0))
    ).withColumn(
        "_sources",
        F.collect_list(F.struct(F.col(BLOCK).alias("_from"), F.col("_through").alias("_end")))
        .over(walk.rowsBetween(-reach, -1)),
    )
    # _gap: rows that lie between the end of the source block and the target block
    pairs = running.select(
        *keys,
        F.col(BLOCK).alias("_to"),
        (F.col("_through") - F.col("_n")).alias("_start"),
        F.inline("_sources"),
    ).select(*keys, "_from", "_to", (F.col("_start") - F.col("_end")).alias("_gap")).filter(
        F.col("_gap") < reach
    )
    tails = base.withColumn("_rank", F.row_number().over(near)).filter(F.col("_rank") <= reach)
    return (
        tails.alias("t")
        .join(
            pairs.alias("p"),
            _same_key("t", "p", keys) & (F.col(f"t.{BLOCK}") == F.col("p._from")),
        )
        .filter(F.col("_gap") + F.col("_rank") <= reach)
        .select(
            *[F.col(f"t.`{c}`") for c in base.columns if c not in (BLOCK, SIDE)],
            F.col("p._to").alias(BLOCK),
            F.lit(-1 if before else 1).alias(SIDE),
        )
    )


def block_parts(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], before: int = 0, after: int = 0, span: str | int = "auto"
) -> DataFrame:
    """``df`` in blocks: ``BLOCK`` orders those of a key, ``SIDE`` is 0 for a block's own
    rows, ``ROW`` is the last of what orders them. With them come copies of the ``before``
    rows that precede the block (side -1) and of the ``after`` rows that follow it (side 1)."""
    base, order, whole = _in_blocks(df, keys, order, span)
    parts = base
    if before and not whole:
        parts = parts.unionByName(_edge_rows(base, keys, order, before, before=True))
    if after and not whole:
        parts = parts.unionByName(_edge_rows(base, keys, order, after, before=False))
    return parts


def row_frames(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    columns: Callable[[WindowSpec], dict[str, Column]],
    before: int = 0,
    after: int = 0,
    span: str | int | None = None,
) -> DataFrame:
    """Add window columns that look at most ``before`` rows back and ``after``
    rows ahead. ``columns`` gets the ordered window and names its results.

    Without ``span`` the window covers whole keys: for panels, which hold one
    row per key and period. With ``span`` it works in blocks: for raw readings. A
    number, or "auto", means blocks of about so many rows, however they lie in time;
    a text like "6 hours" means blocks of that time, for evenly spread rows.
    ``order[0]`` is the time column."""
    if span is None:
        return df.withColumns(columns(Window.partitionBy(*keys).orderBy(*order)))
    parts = block_parts(df, keys, order, before, after, span)
    window = Window.partitionBy(*keys, BLOCK).orderBy(SIDE, *order, ROW)
    return parts.withColumns(columns(window)).filter(F.col(SIDE) == 0).drop(BLOCK, SIDE, ROW)


def _order_value(order: Sequence[str]) -> Column:
    return F.col(order[0]) if len(order) == 1 else F.struct(*order)


def _carry_rows(base: DataFrame, keys, order, names, before: bool) -> DataFrame:
    """One row per block with the last known values before it (or the next ones
    after it). Only one small row per block is ever ordered within a key."""
    pick = F.max_by if before else F.min_by
    known = base.groupBy(*keys, BLOCK).agg(
        *[
            pick(c, F.when(F.col(c).isNotNull(), _order_value(order))).alias(c)
            for c in names
        ]
    )
    walk = Window.partitionBy(*keys).orderBy(BLOCK)
    frame = (
        walk.rowsBetween(Window.unboundedPreceding, -1)
        if before
        else walk.rowsBetween(1, Window.unboundedFollowing)
    )
    take = F.last if before else F.first
    return known.select(
        *keys,
        BLOCK,
        F.lit(-1 if before else 1).alias(SIDE),
        *[take(c, ignorenulls=True).over(frame).alias(c) for c in names],
    )


def fill_frames(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    forward: dict[str, str] | None = None,
    backward: dict[str, str] | None = None,
    both: dict[str, str] | None = None,
    span: str | int | None = None,
) -> DataFrame:
    """Add filled columns; each mapping is {result: source column}.

    ``forward`` takes the last known value up to the row, ``backward`` the next
    one from the row on, ``both`` the first of these two that exists. ``span`` is
    as for ``row_frames``."""
    forward, backward, both = forward or {}, backward or {}, both or {}
    ahead = {**forward, **both}
    back = {**backward, **both}
    if span is None:
        parts, window, extra = df, Window.partitionBy(*keys).orderBy(*order), ()
    else:
        base, order, whole = _in_blocks(df, keys, order, span)
        parts, extra = base, (BLOCK, SIDE, ROW)
        for mapping, side in ((ahead, True), (back, False)):
            names = list(dict.fromkeys(mapping.values()))
            if names and not whole:
                parts = parts.unionByName(
                    _carry_rows(base, keys, order, names, side), allowMissingColumns=True
                )
        window = Window.partitionBy(*keys, BLOCK).orderBy(SIDE, *order)
    past = window.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    future = window.rowsBetween(Window.currentRow, Window.unboundedFollowing)

    def last(c):
        return F.last(c, ignorenulls=True).over(past)

    def first(c):
        return F.first(c, ignorenulls=True).over(future)

    filled = parts.select(
        "*",
        *[last(c).alias(name) for name, c in forward.items()],
        *[first(c).alias(name) for name, c in backward.items()],
        *[F.coalesce(last(c), first(c)).alias(name) for name, c in both.items()],
    )
    return filled.filter(F.col(SIDE) == 0).drop(*extra) if extra else filled
