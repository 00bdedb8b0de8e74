"""What several operators share: lists of bytes as maps, links to components."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from panelforge.session import reliable_checkpoint

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def register(fn):
        QUERIES[name] = fn
        if sql is not None:
            SQL[name] = sql
        return fn

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def rarely(batches: Iterator[pa.RecordBatch], rows: int = 256) -> Iterator[pa.RecordBatch]:
    """Batches cut to a few rows, so that what is made of one stays small."""
    for batch in batches:
        for i in range(0, batch.num_rows, rows):
            yield batch.slice(i, rows)


def longs(values: np.ndarray) -> pa.Array:
    return pa.array(values.view(np.int64) if values.dtype == np.uint64 else values.astype(np.int64))


def long_lists(values: np.ndarray, ends: np.ndarray) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), longs(values))


def key_bits(df: DataFrame, key: str, bits: int = 22) -> bytes:
    """A bit for each hash of ``key``; see ``bits_of``."""
    return bits_of(df.select(F.pmod(F.xxhash64(F.col(key)), F.lit(1 << bits)).alias("at")), bits)


def bits_of(numbers: DataFrame, bits: int) -> bytes:
    """A bit for each of the ``at`` that occur: 2**bits bits whatever the input, made on
    the executors. Asking it lets some other keys pass, and never misses one."""
    at = F.col("at")
    # Fixed by the function: a bucket holds 32768 bits, positions count from 0.
    rows = (
        numbers.groupBy(F.expr("at div 32768").alias("bucket"))
        .agg(F.bitmap_construct_agg(F.pmod(at, F.lit(32768))).alias("bits"))
        .collect()
    )
    out = np.zeros((1 << bits) // 8, np.uint8)
    for r in rows:
        out[r["bucket"] * 4096 : (r["bucket"] + 1) * 4096] = np.frombuffer(r["bits"], np.uint8)
    return out.tobytes()


def in_bits(bits: bytes, at: np.ndarray) -> np.ndarray:
    """Which of the bit numbers ``at`` are set."""
    table = np.frombuffer(bits, np.uint8)
    return (table[at >> 3] >> (at & 7).astype(np.uint8)) & 1 == 1


def components(links: DataFrame, left: str = "a", right: str = "b") -> DataFrame:
    """``node``, ``root``: the smallest node that each linked node can reach.

    Every round joins each node's neighbours to the smallest among them, first the
    larger neighbours, then the smaller ones; rounds grow with the logarithm of the
    longest path. Every step is a grouped minimum and an equi-join, so a node with
    very many links is split like any skewed key. The first half of a round tells
    whether all links lead to a smallest node already; then no other is made."""
    a, b = F.col(left), F.col(right)
    edges = reliable_checkpoint(
        links.where(a != b).select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).distinct(), "links"
    )
    while True:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        # Links to larger neighbours, and those to smaller ones but the smallest.
        moved = reliable_checkpoint(both.join(low, "u").where("v > u or v <> m"), "moved")
        if moved.where("v < u or m < u").isEmpty():
            break
        far = moved.where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        near = far.groupBy("u").agg(F.min("v").alias("m"))
        joined = far.join(near, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v")
        edges = reliable_checkpoint(joined.unionByName(near.withColumnRenamed("m", "v")).distinct(), "links")
    roots = edges.select(F.col("u").alias("node"), F.col("v").alias("root"))
    return roots.unionByName(roots.select(F.col("root").alias("node"), "root").distinct())


def labelled_sample(labels: DataFrame, label: str, rows: int, where=None, id_col: str = "doc_id") -> DataFrame:
    """``id``, ``label``: about 0.95 * ``rows`` of the labelled ids, and never more than
    ``rows`` but for a chance below 1e-9 (for 10,000 rows and more). An id counts once,
    with its largest label; ids and labels that are NULL don't count."""
    known = labels.select(F.col(id_col).cast("long").alias("id"), F.col(label).cast("int").alias("label")).dropna()
    known = known.groupBy("id").agg(F.max("label").alias("label"))
    if where is not None:
        known = known.where(where)
    size = known.count()
    if size <= rows:
        return known
    return known.where(F.pmod(F.xxhash64("id"), F.lit(1 << 30)) < int((1 << 30) * 0.95 * rows / size))


def one_text_each(rows: DataFrame, chosen: DataFrame) -> DataFrame:
    """``id``, ``label``, ``text``: one of the texts that ``rows`` (id, text) holds for each
    chosen id (id, label), so that an id counts once however many rows it has. ``chosen``
    is a bounded sample; copies fall together in each task before they are sent."""
    return (
        rows.select("id", "text").join(F.broadcast(chosen), "id").groupBy("id", "label")
        .agg(F.min_by("text", F.xxhash64("text")).alias("text"))
    )


def crc_remainder(id_col: str, parts: int):
    """crc32 of the id as text, modulo ``parts``; a NULL id counts as empty text."""
    return F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit("")).cast("binary")) % parts


def free_name(df: DataFrame, name: str) -> str:
    """``name``, longer if the table has such a column."""
    while name.lower() in (c.lower() for c in df.columns):
        name += "_"
    return name


def numbered(df: DataFrame, order: Sequence[str], name: str = "place") -> DataFrame:
    """``df``, written and read again, with each row's place from 0 in the order of the
    columns ``order`` (NULLs first). Rows are dealt by ranges, so where ``order`` tells all
    rows apart no task gets more than its range. Only a count a task is summed up."""
    at, n, first, part = (free_name(df, x) for x in ("_at", "_n", "_first", "_part"))
    ordered = df.repartitionByRange(*order).sortWithinPartitions(*order).withColumn(at, F.monotonically_increasing_id())
    # The task's number lies above bit 33, the row's place in the task below.
    ordered = reliable_checkpoint(ordered.withColumn(part, F.shiftright(at, 33)), "ordered")
    before = W.orderBy(part).rowsBetween(W.unboundedPreceding, -1)
    sizes = ordered.groupBy(part).agg(F.count("*").alias(n))
    starts = sizes.select(part, F.coalesce(F.sum(n).over(before), F.lit(0)).alias(first))
    place = F.col(first) + F.col(at).bitwiseAND(F.lit((1 << 33) - 1))
    return ordered.join(starts, part).withColumn(name, place).drop(at, part, first)
