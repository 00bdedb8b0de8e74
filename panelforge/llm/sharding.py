"""Shards of near equal bytes by sampled splitters, in DataFrame operations only.

Rows are ordered by a hash of their text, so that equal texts lie together. A sample,
drawn in proportion to size, gives boundaries that cut this order in ranges of about
equal bytes. Ranges that turn out overfull, as one text that a third of the rows share,
are subdivided by the rows' own hash. Ranges go to shards in their order.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from panelforge.llm.common import query, table
from panelforge.session import reliable_checkpoint

RANGES = 64           # ranges for each shard, before any is subdivided
SAMPLED = 32          # sampled rows for each range
UNIT_ROWS = 100_000   # rows of a subdivided range, about


def _boundaries(rows: DataFrame, total: int, ranges: int) -> list[int]:
    """Hashes that cut the rows in ranges of about equal bytes. The driver gets about
    ``ranges * SAMPLED`` rows: each with a chance that is its size's share of that
    number, so that every drawn row stands for as many bytes as any other, or its own."""
    each = total / (ranges * SAMPLED)
    chance = F.pmod(F.xxhash64("order", "row", F.lit(7)), F.lit(1 << 30)) / F.lit(float(1 << 30))
    drawn = rows.where(chance < F.col("size") / F.lit(each)).select("order", F.greatest(F.col("size").cast("double"), F.lit(each)).alias("w")).collect()
    drawn.sort(key=lambda r: r["order"])
    whole, seen, out = sum(r["w"] for r in drawn), 0.0, []
    for r in drawn:
        seen += r["w"]
        if seen >= whole * (len(out) + 1) / ranges and len(out) < ranges - 1:
            out.append(r["order"])
            while seen >= whole * (len(out) + 1) / ranges and len(out) < ranges - 1:
                out.append(r["order"])
    return out


def _range_of(order, boundaries: list[int]):
    """How many boundaries are below ``order``: a binary search in a constant array."""
    n = len(boundaries)
    if not n:
        return F.lit(0)
    steps = [1 << i for i in reversed(range(n.bit_length()))]
    bounds = F.lit(boundaries)

    def step(at, s):
        return F.when((at + s <= n) & (F.get(bounds, F.least(at + s, F.lit(n)) - 1) < order), at + s).otherwise(at)

    return F.aggregate(F.lit(steps), F.lit(0), step)


def shard(docs: DataFrame, shards: int = 16, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row for each row: doc_id, size, text_crc32, law ('bytes'), shard, slot,
    grown_shard (NULL), bucket (the range within the order), part (of a subdivided one).

    ``size`` is the text's UTF-8 bytes plus 1 (NULL text: 1), ``slot`` counts from 0
    within a shard without gaps. The shards' sizes differ by a range or two, a few
    hundredths, but for texts larger than that; a text is never cut.

    * NULL texts count as empty for size and checksum.
    * Equal texts lie side by side; only a text that fills more than a range is spread.
    * Repeated rows each have their slot; NULL ids come first among equal texts.
    * An empty table gives no rows. Other columns aren't read."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = docs.select(
        F.col(id_col).cast("long").alias("doc_id"), (F.octet_length(text) + 1).cast("long").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"), F.xxhash64(text).alias("order"), F.monotonically_increasing_id().alias("row"),
    )
    rows = reliable_checkpoint(rows, "rows")
    count, total = rows.agg(F.count("*"), F.sum("size")).first()
    ranges = shards * RANGES
    rows = rows.withColumn("bucket", _range_of(F.col("order"), _boundaries(rows, total, ranges) if count else []))
    most = F.lit((total or 1) / ranges)
    sizes = rows.groupBy("bucket").agg(F.sum("size").alias("b"), F.count("*").alias("n"))
    parts = sizes.select("bucket", F.greatest(F.ceil(F.col("b") / most), F.ceil(F.col("n") / UNIT_ROWS)).cast("int").alias("parts"))
    # Half of a mean range more than the mean doesn't make a range overfull.
    parts = parts.join(sizes, "bucket").select("bucket", F.when((F.col("b") > most * 1.5) | (F.col("n") > UNIT_ROWS), F.col("parts")).otherwise(1).alias("parts"))
    rows = rows.join(parts, "bucket").withColumn("part", F.pmod(F.xxhash64("doc_id", "row"), F.col("parts")).cast("int"))
    rows = reliable_checkpoint(rows.drop("parts"), "rows")
    units = rows.groupBy("bucket", "part").agg(F.sum("size").alias("b"), F.count("*").alias("n"))
    # One row for each range: far fewer than rows, so one task may order them.
    before = W.orderBy("bucket", "part").rowsBetween(W.unboundedPreceding, -1)
    middle = F.coalesce(F.sum("b").over(before), F.lit(0)) + F.col("b") / 2
    units = units.withColumn("shard", F.least(F.floor(middle * shards / F.lit(total or 1)), F.lit(shards - 1)).cast("int"))
    inside = W.partitionBy("shard").orderBy("bucket", "part").rowsBetween(W.unboundedPreceding, -1)
    units = units.withColumn("first", F.coalesce(F.sum("n").over(inside), F.lit(0))).select("bucket", "part", "shard", "first")
    place = F.row_number().over(W.partitionBy("bucket", "part").orderBy("order", "doc_id", "row")) - 1
    return rows.withColumn("place", place).join(units, ["bucket", "part"]).select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", (F.col("first") + F.col("place")).cast("long").alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"), "bucket", "part",
    )


@query("op6_splitters")
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shard(table(spark, sf_dir, "documents"))
