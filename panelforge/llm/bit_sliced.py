"""Exact top-k by inner product over a bit-sliced index.

Vectors become whole numbers. Segments of some thousand vectors are indexed by bitmaps:
for each component the leading bits of its value in the segment, a bitmap for each bit.
For a query the slices of all components are added, each as often as the query's component
says: shifted by the signed binary digits of that number, inverted where a digit is
negative, and summed by full adders over whole bitmaps, which gives the slices of the sum.
From its most significant slice downward the k-th largest sum is found; the bits left out
of the index bound how much a score may differ from its sum, so the rows that may belong to
the top k are those down to a known sum below. They alone are resolved by exact products.

All queries meet all segments, in blocks; what a block of queries finds in a segment are k
rows a query at most, from which the best k are ranked.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from panelforge.llm.common import query, table
from panelforge.session import reliable_checkpoint

SEGMENT = 16_384     # vectors of a segment, about
QUERIES_EACH = 4096  # queries of a block at most
LEAST = 64           # queries of a block at least, where there are as many
BITS = 6             # leading bits of each component in the index
ODD, ONES = np.iinfo(np.int64).max, np.uint64(0xFFFFFFFFFFFFFFFF)


def whole_numbers(column, scale: int):
    """floor(scale * x) of each component, as longs."""
    return F.transform(column, lambda x: F.floor(x.cast("double") * F.lit(float(scale))))


def finite(column):
    """Neither NULL nor empty, and no component NULL or not a finite number."""
    return F.coalesce(
        F.forall(column, lambda e: e.isNotNull() & ~F.isnan(e) & (F.abs(e) < float("inf"))) & (F.size(column) > 0), F.lit(False)
    )


def to_bitmap(flags: np.ndarray) -> np.ndarray:
    """Bitmaps of the last axis as 64-bit words, filled up with zeros."""
    raw = np.packbits(flags, axis=-1, bitorder="little")
    short = -raw.shape[-1] % 8
    return np.ascontiguousarray(np.pad(raw, [(0, 0)] * (raw.ndim - 1) + [(0, short)])).view(np.uint64)


def rows_of(bitmap: np.ndarray) -> np.ndarray:
    return np.flatnonzero(np.unpackbits(bitmap.view(np.uint8), bitorder="little"))


def count(bitmap: np.ndarray) -> int:
    return int(np.bitwise_count(bitmap).sum())


def signed_digits(n: int) -> list[tuple[int, int]]:
    """(position, sign) of the non-adjacent binary form: as few digits as can be."""
    out, at, sign = [], 0, 1 if n >= 0 else -1
    n = abs(n)
    while n:
        if n & 1:
            d = 2 - (n & 3)
            out.append((at, sign * d))
            n -= d
        n >>= 1
        at += 1
    return out


def add_columns(columns: dict[int, list[np.ndarray]]) -> dict[int, np.ndarray]:
    """The slices of a sum. ``columns``: for each binary place the bitmaps to be added
    there. Three bitmaps of a place become one there and one at the next place."""
    out, at = {}, min(columns, default=0)
    while columns:
        left = columns.pop(at, [])
        carry = columns.setdefault(at + 1, [])
        while len(left) > 1:
            a, b = left.pop(), left.pop()
            if left:
                c = left.pop()
                u = a ^ b
                left.insert(0, u ^ c)
                carry.append((a & b) | (u & c))
            else:
                left.append(a ^ b)
                carry.append(a & b)
        if left:
            out[at] = left[0]
        if not carry:
            del columns[at + 1]
        at = at + 1 if at + 1 in columns else min(columns, default=at)
    return out


def kth_largest(slices: dict[int, np.ndarray], among: np.ndarray, k: int) -> int:
    """The k-th largest sum among at least k rows, from the top slice downward."""
    sure, open_, value, found = np.zeros_like(among), among, 0, 0
    for at in sorted(slices, reverse=True):
        hit = open_ & slices[at]
        n = count(hit)
        if found + n >= k:
            open_, value = hit, value | (1 << at)
        else:
            sure, open_, found = sure | hit, open_ & ~slices[at], found + n
    return value


def at_least(slices: dict[int, np.ndarray], among: np.ndarray, least: int) -> np.ndarray:
    """The rows whose sum is not below ``least``."""
    if least <= 0:
        return among
    top = max([*slices, least.bit_length() - 1])
    above, equal = np.zeros_like(among), among
    for at in range(top, -1, -1):
        bit = slices.get(at)
        if least >> at & 1:
            equal = equal & bit if bit is not None else np.zeros_like(among)
        elif bit is not None:
            above, equal = above | (equal & bit), equal & ~bit
    return above | equal


class Segment:
    """The index of some vectors, ``values`` (rows, dim) of whole numbers."""

    def __init__(self, values: np.ndarray, bits: int = BITS):
        self.values, self.rows = values, len(values)
        span = int(values.max(initial=0)) - int(values.min(initial=0))
        self.cut = max(0, span.bit_length() - bits)
        self.least = values.min(0)
        lead = (values - self.least) >> self.cut
        self.slices = [[to_bitmap((lead[:, d] >> b) & 1) for b in range(int(lead[:, d].max(initial=0)).bit_length())] for d in range(values.shape[1])]
        self.all = to_bitmap(np.ones(self.rows, bool))

    def sums(self, q: np.ndarray) -> tuple[dict[int, np.ndarray], int]:
        """The slices of sum(q * lead), raised by a constant so as to be no less than 0,
        and that constant."""
        columns: dict[int, list[np.ndarray]] = {}
        raised = 0
        for d, n in enumerate(q.tolist()):
            own = self.slices[d]
            for at, sign in signed_digits(n) if own else ():
                if sign < 0:   # -x = (all ones - x) - all ones
                    raised += ((1 << len(own)) - 1) << at
                for b, bitmap in enumerate(own):
                    columns.setdefault(at + b, []).append(bitmap if sign > 0 else bitmap ^ ONES)
        return add_columns(columns), raised

    def candidates(self, q: np.ndarray, k: int, own: int | None = None) -> np.ndarray:
        """Rows that may be among the k with the highest scores, ``own`` left out."""
        among = self.all.copy()
        if own is not None:
            among[own >> 6] &= ~(np.uint64(1) << np.uint64(own & 63))
        if self.rows - (own is not None) <= k:
            return rows_of(among)
        slices, _ = self.sums(q)
        # A score is constant + 2**cut * sum + sum(q * rest), 0 <= rest < 2**cut.
        width = int(np.abs(q).sum()) * ((1 << self.cut) - 1)
        least = kth_largest(slices, among, k) - -(-width >> self.cut)
        return rows_of(at_least(slices, among, least))

    def top(self, q: np.ndarray, ids: np.ndarray, k: int, own: int | None = None) -> tuple[np.ndarray, np.ndarray]:
        """Rows and scores of the k highest, equal scores by smaller id."""
        rows = self.candidates(q, k, own)
        scores = self.values[rows] @ q
        order = np.lexsort((ids[rows], -scores))[:k]
        return rows[order], scores[order]


def _matrix(column: pa.ListArray) -> np.ndarray:
    return column.flatten().to_numpy().reshape(len(column), -1)


def _search(left: pa.Table, right: pa.Table, k: int) -> pa.Table:
    """A block of queries against a segment."""
    out: dict[str, list] = {c: [np.zeros(0, np.int64)] for c in ("query", "row", "score", "vec_id")}
    if left.num_rows and right.num_rows:
        left, right = left.combine_chunks(), right.combine_chunks()
        rows, ids = right["row"].to_numpy(), right["id"].fill_null(ODD).to_numpy()
        segment = Segment(_matrix(right["vector"].chunk(0)))
        place = {r: i for i, r in enumerate(rows.tolist())}
        for number, q in zip(left["row"].to_pylist(), _matrix(left["vector"].chunk(0))):
            at, scores = segment.top(q, ids, k, place.get(number))
            for name, value in (("query", np.full(len(at), number)), ("row", rows[at]), ("score", scores), ("vec_id", ids[at])):
                out[name].append(value)
    made = {c: np.concatenate(v) for c, v in out.items()}
    return pa.table({c: pa.array(v, pa.int64(), mask=v == ODD if c == "vec_id" else None) for c, v in made.items()})


def top_k(vectors: DataFrame, queries, k: int = 10, scale: int = 1024, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """The ``k`` rows with the highest inner product for each row that the condition
    ``queries`` (a column over ``id``) holds for: query_id, rank (from 1), vec_id, score.

    Components x count as floor(scale * x). Rows of equal score rank by smaller id.

    * Vectors that are NULL, empty or hold NULL or non-finite numbers take no part; others
      meet those of their length. Scores must fit in a long.
    * Only the query's own row is left out: repeated rows are found, and each is a query
      with ranks of its own. A row without an id is no query; it is found, after others of
      its score.
    * With fewer than ``k`` other rows all are given; an empty table gives none.
    * Other columns aren't read."""
    rows = vectors.select(F.col(id_col).cast("long").alias("id"), F.col(vector_col).alias("given")).where(finite(F.col("given")))
    rows = rows.select("id", whole_numbers(F.col("given"), scale).alias("vector"), F.monotonically_increasing_id().alias("row"))
    rows = reliable_checkpoint(rows.withColumn("dim", F.size("vector")), "numbers")
    wanted = queries(F.col("id"))
    # One number a length.
    sizes = {r["dim"]: (r["n"], r["q"]) for r in rows.groupBy("dim").agg(F.count("*").alias("n"), F.count_if(wanted).alias("q")).collect()}
    segments = {d: max(1, math.ceil(n / SEGMENT)) for d, (n, _) in sizes.items()}
    blocks = {d: max(1, math.ceil(q / QUERIES_EACH), min(8, q // LEAST)) for d, (_, q) in sizes.items()}

    def dealt(n: dict[int, int], seed: int):
        """A part from 0 to what ``n`` says for the length."""
        counts = F.create_map(*(F.lit(x) for pair in n.items() for x in pair)) if n else F.create_map(F.lit(0), F.lit(1))
        return F.pmod(F.xxhash64("row", F.lit(seed)), counts[F.col("dim")]).cast("int"), counts[F.col("dim")] - 1

    segment, last_segment = dealt(segments, 1)
    block, last_block = dealt(blocks, 2)
    key = ["dim", "segment", "block"]
    left = rows.where(wanted).withColumn("block", block).withColumn("segment", F.explode(F.sequence(F.lit(0), last_segment)))
    right = rows.withColumn("segment", segment).withColumn("block", F.explode(F.sequence(F.lit(0), last_block)))

    def search(a: pa.Table, b: pa.Table) -> pa.Table:
        return _search(a, b, k)

    found = left.select(*key, "row", "vector").groupBy(*key).cogroup(right.select(*key, "row", "id", "vector").groupBy(*key)).applyInArrow(
        search, "query long, row long, score long, vec_id long"
    )
    # Ranks are cut to k in each task before rows are sent.
    rank = F.row_number().over(W.partitionBy("query").orderBy(F.desc("score"), F.asc_nulls_last("vec_id"), "row"))
    best = found.withColumn("rank", rank).where(F.col("rank") <= k)
    asked = rows.where(wanted).select(F.col("row").alias("query"), F.col("id").alias("query_id"))
    return best.join(asked, "query").select("query_id", "rank", "vec_id", "score")


ORACLE = """
WITH numbers AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(1024 * x::DOUBLE)::BIGINT) AS v FROM embeddings
  WHERE len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND len(embedding) > 0),
scored AS (
  SELECT q.vec_id AS query_id, c.vec_id, list_sum(list_transform(list_zip(q.v, c.v), lambda p: p[1] * p[2]))::BIGINT AS score
  FROM numbers q JOIN numbers c ON q.vec_id <> c.vec_id AND len(q.v) = len(c.v) WHERE q.vec_id % 100 = 0)
SELECT query_id, row_number() OVER best::INT AS rank, vec_id, score FROM scored
WINDOW best AS (PARTITION BY query_id ORDER BY score DESC, vec_id) QUALIFY row_number() OVER best <= 10"""


@query("op12_bit_sliced_top_k", ORACLE)
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    return top_k(table(spark, sf_dir, "embeddings"), lambda i: i % 100 == 0)
