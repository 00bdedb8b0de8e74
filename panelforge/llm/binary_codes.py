"""Near-duplicate vectors by iterative quantisation and multi-index tables.

Rotations of the principal axes are learned so that signs along them lose little; each
rotation starts from a fresh one, and its signs are a code of up to 64 bits. Tables
index parts of the codes; vectors meet where all bits of a part agree, and are then
compared by the cosine of the original vectors in double precision. How many bits a part
has follows the number of vectors, so that a place in a table holds about the same number
of them at any size; tables are added until pairs made at the cosine limit from the
vectors themselves meet as often as wanted. Vectors of each length have tables of their
own; few enough to be compared at once need none.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from panelforge.llm.common import components, query, table
from panelforge.session import reliable_checkpoint

SAMPLE = 20_000     # vectors that the rotation is learned from, about
ROUNDS = 30
PLACE = 200         # vectors that a place of a table holds, about
MISS = 0.002        # share of pairs just similar enough that may share no place
PAIRS = 8192        # made of either kind to measure that
MOST = 4096         # tables
BLOCK = 2048        # vectors that are compared at a time, with as many others


@dataclass
class Codes:
    """Signs along ``axes`` (dim, tables * width) after ``mean`` is taken off; every
    ``width`` of them are a table's bits."""

    mean: np.ndarray
    axes: np.ndarray
    width: int

    def places(self, x: np.ndarray) -> np.ndarray:
        """For each vector its place in each table."""
        out = [np.zeros((0, self.axes.shape[1] // self.width), np.int64)]
        for i in range(0, len(x), 1024):
            b = ((x[i : i + 1024] - self.mean) @ self.axes >= 0).reshape(len(x[i : i + 1024]), -1, self.width)
            out.append(b.astype(np.int64) @ (1 << np.arange(self.width)))
        return np.concatenate(out)


def learn_rotation(v: np.ndarray, rng: np.random.Generator) -> np.ndarray:
    """A rotation of ``v``, from a fresh one. Alternates between the signs of the rotated
    data and the rotation that comes nearest to them."""
    r, _ = np.linalg.qr(rng.normal(size=(v.shape[1], v.shape[1])))
    for _ in range(ROUNDS):
        signs = np.where(v @ r >= 0, 1.0, -1.0)
        a, _, b = np.linalg.svd(signs.T @ v)
        r = (a @ b).T
    return r


def pairs_at(x: np.ndarray, cosine: float, rng: np.random.Generator, pairs: int = PAIRS) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Unit vectors and partners at exactly ``cosine``, and the kind of each pair: the
    difference points anywhere (0), or as the vectors differ among each other (1)."""
    a = x[rng.integers(0, len(x), 2 * pairs)]
    kind = np.arange(2 * pairs) % 2
    u = np.where(kind[:, None] == 0, rng.normal(size=a.shape), x[rng.integers(0, len(x), 2 * pairs)] - x[rng.integers(0, len(x), 2 * pairs)])
    u = u - (u * a).sum(1, keepdims=True) * a
    size = np.sqrt((u * u).sum(1, keepdims=True))
    fit = size[:, 0] > 1e-9
    a, u, kind = a[fit], (u / np.where(size > 0, size, 1))[fit], kind[fit]
    return a, cosine * a + math.sqrt(1 - cosine**2) * u, kind


def learn_codes(x: np.ndarray, vectors: int, cosine: float, seed: int = 42) -> Codes:
    """Tables for ``vectors`` vectors like the sample ``x``, as many as it takes until at
    most ``MISS`` of either kind of made pairs share no place at the width in use. Pairs
    are made from the half of the sample that the rotations aren't learned from. Where
    learned rotations find no more pairs, fresh random axes of all dimensions follow."""
    rng = np.random.default_rng(seed)
    x, held = (x[::2], x[1::2]) if len(x) > 1 else (x, x)
    dim, mean = x.shape[1], x.mean(0)
    bits = min(64, dim)
    width = min(bits, max(8, math.ceil(math.log2(max(vectors, 1) / PLACE + 1))))
    _, _, axes = np.linalg.svd((x - mean).T @ (x - mean))
    axes = axes[:bits].T
    a, b, kind = pairs_at(held, cosine, rng)
    made, learned = [], True
    while len(made) < MOST:
        if learned:
            code = axes @ learn_rotation((x - mean) @ axes, rng)
        else:
            code = np.linalg.qr(rng.normal(size=(dim, bits)))[0]
        before, order = len(a), rng.permutation(bits)
        for i in range(0, bits - width + 1, width):
            made.append(code[:, order[i : i + width]])
            one = Codes(mean, made[-1], width)
            apart = (one.places(a) != one.places(b))[:, 0]
            a, b, kind = a[apart], b[apart], kind[apart]
            if max((kind == 0).sum(), (kind == 1).sum()) <= MISS * PAIRS:
                return Codes(mean, np.concatenate(made, 1), width)
        learned = learned and len(a) < 0.98 * before
    raise ValueError(f"{MOST} tables miss more than {MISS} of the pairs at cosine {cosine}")


def _units(column) -> np.ndarray:
    x = column.flatten().to_numpy(zero_copy_only=False).astype(float).reshape(len(column), -1)
    x = x / np.abs(x).max(1, keepdims=True)
    return x / np.sqrt((x * x).sum(1, keepdims=True))


def _places(batches, codes: dict[int, Codes]) -> Iterator[pa.RecordBatch]:
    """Vectors of a length without codes all have one place."""
    for batch in batches:
        dims = batch["dim"].to_numpy()
        for d in np.unique(dims).tolist():
            part = batch.filter(pa.array(dims == d))
            place = codes[d].places(_units(part["embedding"])) if d in codes else np.zeros((part.num_rows, 1), np.int64)
            yield pa.RecordBatch.from_arrays([part["node"], pa.array(place.tolist(), pa.list_(pa.int64()))], ["node", "places"])


def _compare(batches, cosine: float) -> Iterator[pa.RecordBatch]:
    """Links between two blocks of a place that no earlier table has: for each vector
    how many rows it links with, and the smallest node it hangs together with."""
    t = pa.Table.from_batches(list(batches))
    number, lo, hi = (t[c][0].as_py() for c in ("number", "lo", "hi"))
    block = t["block"].to_numpy()

    def side(which):
        part = t.filter(pa.array(block == which)).combine_chunks()
        chunk = lambda c: part[c].chunk(0) if part[c].num_chunks else pa.array([], part[c].type)
        if not part.num_rows:
            return None
        places = chunk("places").flatten().to_numpy().reshape(part.num_rows, -1)
        return part["node"].to_numpy(), part["copies"].to_numpy(), places, _units(chunk("embedding"))

    x = side(lo)
    y = x if lo == hi else side(hi)
    if x is None or y is None:
        return
    link = x[3] @ y[3].T >= cosine
    for k in range(number):
        link &= x[2][:, k, None] != y[2][None, :, k]
    if lo == hi:
        np.fill_diagonal(link, False)
    low_x, low_y = x[0].copy(), y[0].copy() if y is not x else None
    while True:
        ly = low_x if y is x else low_y
        new_x = np.minimum(low_x, np.where(link, ly[None, :], np.iinfo(np.int64).max).min(1))
        new_y = new_x if y is x else np.minimum(low_y, np.where(link, new_x[:, None], np.iinfo(np.int64).max).min(0))
        if (new_x == low_x).all() and (y is x or (new_y == low_y).all()):
            break
        low_x, low_y = new_x, new_y
    rows = [(x[0], link @ y[1], low_x)]
    if y is not x:
        rows.append((y[0], link.T @ x[1], low_y))
    for node, n, low in rows:
        has = n > 0
        yield pa.RecordBatch.from_arrays([pa.array(node[has]), pa.array(n[has].astype(np.int64)), pa.array(low[has])], ["node", "n", "low"])


def near_duplicates(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", cosine: float = 0.95, sample: int = SAMPLE) -> DataFrame:
    """One row for each row: vec_id, n_links (other rows with a cosine of at least
    ``cosine``), component_id (smallest vec_id reachable), kept (vec_id = component_id).

    * Vectors that are NULL, empty or zero, or hold NULL or non-finite numbers, link
      with nothing; others link with those of their length.
    * Equal vectors link with each other; they are compared with others once.
    * A NULL id takes part; it is never the smallest, and not kept.
    * Rotations are learned from about ``sample`` vectors of a length, chosen by their
      hash; every vector is indexed. Of pairs just at the limit about ``MISS`` are missed;
      found pairs are never below it.
    * Other columns aren't read."""
    v = F.col("embedding")
    rows = vectors.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vector_col).cast("array<double>").alias("embedding"))
    finite = F.forall(v, lambda e: e.isNotNull() & ~F.isnan(e) & (F.abs(e) < float("inf"))) & F.exists(v, lambda e: e != 0)
    rows = reliable_checkpoint(rows.withColumn("valid", F.coalesce(finite, F.lit(False))).withColumn("node", F.xxhash64("embedding")), "vectors")
    valid = F.col("valid")
    nodes = rows.where(valid).groupBy("node").agg(F.first("embedding").alias("embedding"), F.count("*").alias("copies"), F.min("vec_id").alias("least"))
    nodes = reliable_checkpoint(nodes.withColumn("dim", F.size(v)), "nodes")
    # Bounded by the number of lengths that many vectors have.
    many = nodes.groupBy("dim").agg(F.count("*").alias("n")).where(F.col("n") > BLOCK).collect()
    total = nodes.count()
    own = rows.select("vec_id", F.when(valid, F.col("node")).alias("node"))
    if not total:
        return own.select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"), F.col("vec_id").isNotNull().alias("kept"))
    codes = {}
    for r in many:
        like = F.pmod(F.xxhash64("node"), F.lit(1 << 30)) <= int((1 << 30) * min(1.0, sample / r["n"]))
        chosen = nodes.where((F.col("dim") == r["dim"]) & like).select("embedding").toArrow()
        if chosen.num_rows:
            codes[r["dim"]] = learn_codes(_units(chosen["embedding"].combine_chunks()), r["n"], cosine)

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return _places(batches, codes)

    indexed = reliable_checkpoint(
        nodes.select("node", "dim", "embedding").mapInArrow(place, "node long, places array<long>").join(nodes.select("node", "dim", "embedding", "copies"), "node"), "codes"
    )
    at = indexed.select("node", "dim", F.posexplode("places").alias("number", "place"))
    sizes = at.groupBy("dim", "number", "place").agg(F.count("*").alias("m")).where("m > 1").select("dim", "number", "place", F.ceil(F.col("m") / BLOCK).cast("int").alias("blocks"))
    dealt = (
        at.join(sizes, ["dim", "number", "place"]).withColumn("block", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int"))
        .withColumn("other", F.explode(F.expr("sequence(0, blocks - 1)")))
        .withColumn("lo", F.least("block", "other")).withColumn("hi", F.greatest("block", "other"))
        .select("node", "number", "place", "block", "lo", "hi").join(indexed, "node")
    )

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return _compare(batches, cosine)

    found = reliable_checkpoint(dealt.groupBy("dim", "number", "place", "lo", "hi").applyInArrow(compare, "node long, n long, low long"), "links")
    counts = found.groupBy("node").agg(F.sum("n").alias("n"))
    roots = components(found.select(F.col("node").alias("a"), F.col("low").alias("b")))
    one = nodes.select("node", "copies", "least").join(counts, "node", "left").join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    low = one.groupBy("root").agg(F.min("least").alias("component_id"))
    one = one.join(low, "root").select("node", (F.coalesce("n", F.lit(0)) + F.col("copies") - 1).alias("n_links"), "component_id")
    component = F.when(F.col("node").isNull(), F.col("vec_id")).otherwise(F.col("component_id"))
    return (
        own.join(one, "node", "left")
        .select("vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), component.alias("component_id"))
        .withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(False)))
    )


@query("op3_binary_codes")
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "embeddings"))
