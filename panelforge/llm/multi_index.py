"""Hard negatives by an inverted multi-index.

A vector is cut in two halves, each with a codebook of its own; the pair of the nearest
codewords is the vector's cell. A row of a cell scores at most the sum of two half bounds:
the anchor's half times the codeword plus the half's length times the codeword's radius,
the largest distance of a row from it. A heap walks through the pairs of both sorted lists
of half bounds, so that cells come in descending order of their bound.

The walk goes over all machines: a first stretch of cells for each anchor, until they hold
some thousand rows; then, with what was found there, all further cells whose bound is not
below the last place still open. Once no such cell is left the result is certified.
Positives are the first of the anchor's label. Negatives are searched for in a window for
each positive, in the same way.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from panelforge.llm.bit_sliced import ODD, finite, whole_numbers
from panelforge.llm.common import numbered, query, table
from panelforge.session import reliable_checkpoint

SAMPLE = 20_000      # vectors that codebooks are learned from, about
WORDS = 256          # codewords of a half at most
CELL = 512           # rows of a cell, about, while there are fewer codewords
ROUNDS = 15
FIRST = 2_048        # rows of the cells that are searched first
ROWS = 4_096         # rows of a cell that one task compares
ANCHORS = 1_024      # with as many anchors
NONE = np.iinfo(np.int64).min


def learn_words(x: np.ndarray, words: int, rng: np.random.Generator) -> np.ndarray:
    """Codewords of ``x`` by k-means; one that no vector is nearest to moves to the vector
    that is farthest from its own."""
    words = min(words, len(x))
    c = x[rng.choice(len(x), words, replace=False)]
    for _ in range(ROUNDS):
        code, far = nearest(x, c)
        n = np.bincount(code, minlength=words)
        total = np.zeros_like(c)
        np.add.at(total, code, x)
        c = total / np.maximum(n, 1)[:, None]
        empty = np.flatnonzero(n == 0)
        c[empty] = x[np.argsort(-far, kind="stable")[: len(empty)]]
    return c


def nearest(x: np.ndarray, words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The nearest codeword of each vector and its distance."""
    code = (((words**2).sum(1) - 2 * (x @ words.T))).argmin(1)
    return code, np.sqrt(((x - words[code]) ** 2).sum(1))


@dataclass
class Index:
    """Codebooks of both halves, the radius of each codeword, and rows of each cell."""

    words: tuple[np.ndarray, np.ndarray]
    radii: tuple[np.ndarray, np.ndarray]
    rows: np.ndarray

    def halves(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        return x[:, : x.shape[1] // 2], x[:, x.shape[1] // 2 :]

    def codes(self, x: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
        return [nearest(h, w) for h, w in zip(self.halves(x), self.words)]

    def bounds(self, q: np.ndarray) -> list[np.ndarray]:
        """For each half (anchors, codewords): no row with that codeword scores more."""
        out = []
        for h, w, r in zip(self.halves(q), self.words, self.radii):
            length = np.sqrt((h**2).sum(1, keepdims=True))
            # What rounding may take off is put on top.
            slack = 1e-9 * (length * (np.sqrt((w**2).sum(1)) + r) + 1)
            out.append(h @ w.T + length * r + slack)
        return out


def cells_in_order(u: np.ndarray, v: np.ndarray) -> Iterator[tuple[int, int, float]]:
    """Pairs (i, j) by descending u[i] + v[j]: the multi-sequence walk. A pair enters the
    heap once its neighbours before it in both lists are out."""
    a, b = np.argsort(-u, kind="stable"), np.argsort(-v, kind="stable")
    us, vs = u[a].tolist(), v[b].tolist()
    heap, out = [(-(us[0] + vs[0]), 0, 0)], np.zeros(len(us), int)
    while heap:
        low, i, j = heapq.heappop(heap)
        yield int(a[i]), int(b[j]), -low
        out[i] = j + 1
        if i + 1 < len(us) and out[i + 1] == j:
            heapq.heappush(heap, (-(us[i + 1] + vs[j]), i + 1, j))
        if j + 1 < len(vs) and (i == 0 or out[i - 1] > j + 1):
            heapq.heappush(heap, (-(us[i] + vs[j + 1]), i, j + 1))


def first_cells(u: np.ndarray, v: np.ndarray, rows: np.ndarray, wanted: int) -> tuple[list[int], float]:
    """Cells from the highest bound on until they hold ``wanted`` rows, and the bound of
    the last: all that is above it was searched."""
    found, seen, low = [], 0, math.inf
    for i, j, bound in cells_in_order(u, v):
        if seen >= wanted and bound < low:
            return found, low
        low = bound
        if rows[i, j]:
            found.append(i * rows.shape[1] + j)
            seen += rows[i, j]
    return found, -math.inf


def further_cells(u: np.ndarray, v: np.ndarray, rows: np.ndarray, done: float, least: float) -> list[int]:
    """Cells with a bound below ``done`` and not below ``least``."""
    found = []
    for i, j, bound in cells_in_order(u, v):
        if bound < least:
            break
        if bound < done and rows[i, j]:
            found.append(i * rows.shape[1] + j)
    return found


def _matrix(column) -> np.ndarray:
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1) if len(column) else np.zeros((0, 0))


def products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact inner products of whole numbers, in floating point where that is exact."""
    most = float(np.abs(a).max(initial=0)) * float(np.abs(b).max(initial=0)) * max(a.shape[1], 1)
    return (a.astype(float) @ b.T.astype(float)).astype(np.int64) if most < 2**53 else a @ b.T


def best_of(scores: np.ndarray, fits: np.ndarray, ids: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(line, column) of the k highest that fit in each line, equal ones by smaller id."""
    s = np.where(fits, scores, NONE)
    if s.shape[1] > k:
        limit = np.partition(s, s.shape[1] - k, axis=1)[:, s.shape[1] - k]
        line, at = np.nonzero((s >= limit[:, None]) & fits)
    else:
        line, at = np.nonzero(fits)
    order = np.lexsort((ids[at], -scores[line, at], line))
    line, at = line[order], at[order]
    first = np.searchsorted(line, np.arange(len(s)))
    keep = np.arange(len(line)) - first[line] < k
    return line[keep], at[keep]


def _compare(left: pa.Table, right: pa.Table, k: int, same: bool) -> pa.Table:
    """A stretch of anchors against a block of a cell. With ``same`` the rows of the
    anchor's label count, else those of others, in each of the anchor's windows."""
    out: dict[str, list] = {c: [np.zeros(0, np.int64)] for c in ("anchor", "slot", "row", "score", "id")}
    if left.num_rows and right.num_rows:
        anchor, row = left["row"].to_numpy(), right["row"].to_numpy()
        ids = right["id"].combine_chunks().fill_null(ODD).to_numpy()
        scores = products(_matrix(left["vector"]), _matrix(right["vector"]))
        equal = left["label"].to_numpy()[:, None] == right["label"].to_numpy()[None, :]
        windows = [(0, None, None)]
        if not same:
            low, high = _matrix(left["low"]), _matrix(left["high"])
            windows = [(i, low[:, i], high[:, i]) for i in range(low.shape[1])]
        for slot, low, high in windows:
            fits = equal & (anchor[:, None] != row[None, :]) if same else ~equal & (scores >= low[:, None]) & (scores <= high[:, None])
            line, at = best_of(scores, fits, ids, k)
            for name, value in (("anchor", anchor[line]), ("slot", np.full(len(line), slot)), ("row", row[at]), ("score", scores[line, at]), ("id", ids[at])):
                out[name].append(value)
    made = {c: np.concatenate(v) for c, v in out.items()}
    return pa.table({c: pa.array(v, pa.int64(), mask=v == ODD if c == "id" else None) for c, v in made.items()})


class Search:
    """The index of a table of rows (row, id, label, vector, dim), spread over its cells."""

    def __init__(self, rows: DataFrame, sample: int = SAMPLE, seed: int = 42):
        # One number a length.
        sizes = {r["dim"]: r["n"] for r in rows.groupBy("dim").agg(F.count("*").alias("n")).collect()}
        rng, books = np.random.default_rng(seed), {}
        for dim, n in sizes.items():
            like = F.pmod(F.xxhash64("row", F.lit(seed)), F.lit(1 << 30)) <= int((1 << 30) * min(1.0, sample / n))
            x = _matrix(rows.where((F.col("dim") == dim) & like).select("vector").toArrow()["vector"]).astype(float).reshape(-1, dim)
            x = x if len(x) else np.zeros((1, dim))
            words = min(WORDS, max(1, math.ceil(math.sqrt(n / CELL))))
            halves = x[:, : dim // 2], x[:, dim // 2 :]
            books[dim] = tuple(learn_words(h, words, rng) for h in halves)
        plain = {d: Index(w, (np.zeros(0), np.zeros(0)), np.zeros((0, 0))) for d, w in books.items()}

        def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                dims = batch["dim"].to_numpy()
                for d in np.unique(dims).tolist():
                    part = batch.filter(pa.array(dims == d))
                    (i, far1), (j, far2) = plain[d].codes(_matrix(part["vector"]).astype(float))
                    cell = i * len(plain[d].words[1]) + j
                    yield pa.RecordBatch.from_arrays([*part.columns, pa.array(cell, pa.int64()), pa.array(far1), pa.array(far2)], [*part.schema.names, "cell", "far1", "far2"])

        schema = "row long, id long, label int, vector array<long>, dim int, cell long, far1 double, far2 double"
        placed = reliable_checkpoint(rows.select("row", "id", "label", "vector", "dim").mapInArrow(place, schema), "cells")
        self.index = {}
        # At most WORDS * WORDS cells a length, however many rows.
        cells = placed.groupBy("dim", "cell").agg(F.count("*").alias("n"), F.max("far1").alias("r1"), F.max("far2").alias("r2")).toPandas()
        for d, (a, b) in books.items():
            n, r = np.zeros((len(a), len(b)), np.int64), (np.zeros(len(a)), np.zeros(len(b)))
            for x in cells[cells.dim == d].itertuples():
                i, j = divmod(x.cell, len(b))
                n[i, j], r[0][i], r[1][j] = x.n, max(r[0][i], x.r1), max(r[1][j], x.r2)
            self.index[d] = Index((a, b), r, n)
        blocks = {d: -(-x.rows.ravel() // ROWS) for d, x in self.index.items()}
        parts = [(int(d), c, int(m)) for d, n in blocks.items() for c, m in enumerate(n.tolist()) if m > 1]
        # Overfull cells are cut by row; there are no more of them than cells.
        spark = rows.sparkSession
        many = spark.createDataFrame(parts, "dim int, cell long, blocks int")
        placed = placed.drop("far1", "far2").join(F.broadcast(many), ["dim", "cell"], "left").fillna(1, ["blocks"])
        self.blocks, self.rows = blocks, placed.withColumn("block", F.pmod(F.xxhash64("row", F.lit(seed + 1)), F.col("blocks")).cast("int")).drop("blocks")

    def order(self, anchors: DataFrame) -> DataFrame:
        """``anchors`` with ``chunk``: stretches of anchors, cell by cell, so that those of
        a stretch visit much the same cells."""
        cells = anchors.join(self.rows.select("row", "cell"), "row")
        placed = numbered(cells, ["dim", "cell", "row"])
        return reliable_checkpoint(placed.withColumn("chunk", F.expr(f"place div {ANCHORS}")).drop("place", "cell"), "anchors")

    def _visit(self, anchors: DataFrame, names: list[str], schema: str) -> DataFrame:
        """A row for each anchor and block of a cell to visit. Anchors with ``done`` go on
        below that bound, down to ``least``; the others take their first cells."""
        index, blocks = self.index, self.blocks
        on = "done" in anchors.columns

        def visit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                dims = batch["dim"].to_numpy()
                for d in np.unique(dims).tolist():
                    part = batch.filter(pa.array(dims == d))
                    us, vs = index[d].bounds(_matrix(part["vector"]).astype(float))
                    for i, (u, v) in enumerate(zip(us, vs)):
                        if on:
                            done = part["done"][i].as_py()
                            found = further_cells(u, v, index[d].rows, done, part["least"][i].as_py())
                        else:
                            found, done = first_cells(u, v, index[d].rows, FIRST)
                        each = blocks[d][found] if found else np.zeros(0, np.int64)
                        cells = np.repeat(np.array(found, np.int64), each)
                        block = np.arange(len(cells)) - np.repeat(np.cumsum(each) - each, each)
                        same = part.take(pa.array(np.full(len(cells), i)))
                        yield pa.RecordBatch.from_arrays(
                            [*(same[c] for c in names), pa.array(cells), pa.array(block.astype(np.int32)), pa.array(np.full(len(cells), done))],
                            [*names, "cell", "block", "done"],
                        )

        return anchors.mapInArrow(visit, schema + ", cell long, block int, done double")

    def best(self, anchors: DataFrame, k: int, same: bool) -> DataFrame:
        """``anchor``, ``slot``, ``row``, ``score``, ``rank``: for each anchor (row, label,
        vector, dim, chunk; for negatives low and high, arrays of whole numbers) the k best
        rows of its label or, for each of its windows, of other labels."""
        windows = [] if same else ["low", "high"]
        names = ["row", "label", "vector", "dim", "chunk", *windows]
        schema = "row long, label int, vector array<long>, dim int, chunk long" + ("" if same else ", low array<long>, high array<long>")
        key = ["dim", "cell", "block", "chunk", *(["label"] if same else [])]

        def compare(a: pa.Table, b: pa.Table) -> pa.Table:
            return _compare(a, b, k, same)

        def search(asked: DataFrame) -> tuple[DataFrame, DataFrame]:
            pairs = reliable_checkpoint(self._visit(asked, names, schema), "visits")
            # A block goes only to the stretches of anchors that visit it.
            where = pairs.select(*(F.col(c).alias(c) for c in key)).distinct()
            rows = self.rows.join(where, [c for c in key if c != "chunk"])
            made = pairs.groupBy(*key).cogroup(rows.groupBy(*key)).applyInArrow(compare, "anchor long, slot long, row long, score long, id long")
            return made, pairs

        def ranked(found: DataFrame) -> DataFrame:
            # Ranks are cut to k in each task before rows are sent.
            rank = F.row_number().over(W.partitionBy("anchor", "slot").orderBy(F.desc("score"), F.asc_nulls_last("id"), "row"))
            return found.withColumn("rank", rank).where(F.col("rank") <= k)

        found, pairs = search(anchors.select(*names))
        first = reliable_checkpoint(ranked(found).drop("rank"), "first")
        done = pairs.groupBy("row").agg(F.min("done").alias("done"))
        last = first.groupBy("anchor", "slot").agg(F.min("score").alias("low_score"), F.count("*").alias("n"))
        # The lowest score that is still of use: the k-th found, or all that fits.
        full = F.map_from_entries(F.collect_list(F.when(F.col("n") >= k, F.struct("slot", F.col("low_score").cast("double")))))
        full = last.groupBy(F.col("anchor").alias("row")).agg(full.alias("full"))
        rest = anchors.join(done, "row").join(full, "row", "left")
        known = F.coalesce(F.col("full"), F.create_map().cast("map<bigint,double>"))
        if same:
            least = F.coalesce(F.try_element_at(known, F.lit(0).cast("long")), F.lit(-math.inf))
        else:
            every = F.transform("low", lambda x, i: F.when(x > F.get("high", i), F.lit(math.inf)).otherwise(F.coalesce(F.try_element_at(known, i.cast("long")), x.cast("double"))))
            least = F.array_min(every)
        rest = rest.withColumn("least", least).where(F.col("done") > F.col("least"))
        more, _ = search(rest.select(*names, "done", "least"))
        return reliable_checkpoint(ranked(more.unionByName(first)), "best")


def hard_negatives(
    vectors: DataFrame, anchors, scale: int = 256, positives: int = 5, negatives: int = 3, low_percent: int = 50, high_percent: int = 95,
    id_col: str = "vec_id", label_col: str = "label", vector_col: str = "embedding", sample: int = SAMPLE,
) -> DataFrame:
    """For each row that the condition ``anchors`` (a column over ``id``) holds for and each
    of its first ``positives`` other rows of the same label, the first ``negatives`` rows of
    other labels that score from ``low_percent`` to ``high_percent`` of the positive:
    anchor_id, positive_id, rank, negative_id, positive_score, negative_score.

    Scores are inner products of floor(scale * x), higher ones first, equal ones by
    smaller id. Every pair that belongs there is found, wherever it lies.

    * Rows with a NULL label, or a vector that is NULL, empty or holds NULL or non-finite
      numbers, take no part; others meet those of their length. Scores must fit in a long.
    * An anchor's own row alone is left out: repeated rows are found, and each is an anchor.
      A row without an id is no anchor; it is found, after others of its score.
    * Anchors without positives, and positives without negatives in their window, give no
      rows; neither does an empty table. Other columns aren't read.
    * Codebooks are learned from about ``sample`` vectors of a length; every row is indexed."""
    rows = vectors.select(F.col(id_col).cast("long").alias("id"), F.col(label_col).cast("int").alias("label"), F.col(vector_col).alias("given"))
    rows = rows.where(F.col("label").isNotNull() & finite(F.col("given")))
    rows = rows.select("id", "label", whole_numbers(F.col("given"), scale).alias("vector"), F.monotonically_increasing_id().alias("row"))
    rows = reliable_checkpoint(rows.withColumn("dim", F.size("vector")), "numbers")
    index = Search(rows, sample)
    asked = index.order(rows.where(anchors(F.col("id"))))
    near = index.best(asked, positives, True).select("anchor", F.col("rank").alias("place"), F.col("id").alias("positive_id"), F.col("score").alias("positive_score"))
    listed = near.groupBy(F.col("anchor").alias("row")).agg(F.sort_array(F.collect_list(F.struct("place", "positive_score"))).alias("own"))
    # One window a place; places that are not there have an empty one.
    # Neither has a negative score: half of it is more than all of it.
    def ends(percent: int, rest: int, none: int):
        score = "get(own, {0}).positive_score"
        one = f"CASE WHEN {score} >= 0 THEN ({score} * {percent} + {rest}) div 100 ELSE {none} END"
        return F.array(*(F.expr(one.format(i)).cast("long") for i in range(positives)))

    low, high = ends(low_percent, 99, 1), ends(high_percent, 0, 0)
    windows = asked.join(listed, "row").withColumn("low", low).withColumn("high", high).drop("own")
    far = index.best(reliable_checkpoint(windows, "windows"), negatives, False)
    far = far.select("anchor", (F.col("slot") + 1).cast("int").alias("place"), "rank", F.col("id").alias("negative_id"), F.col("score").alias("negative_score"))
    names = asked.select(F.col("row").alias("anchor"), F.col("id").alias("anchor_id"))
    return far.join(near, ["anchor", "place"]).join(names, "anchor").select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")


ORACLE = """
WITH numbers AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::BIGINT) AS v
  FROM embeddings
  WHERE label IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND len(embedding) > 0),
scored AS (
  SELECT a.vec_id AS anchor_id, a.label = c.label AS same, c.vec_id,
         list_sum(list_transform(list_zip(a.v, c.v), lambda p: p[1] * p[2]))::BIGINT AS score
  FROM numbers a JOIN numbers c ON a.vec_id <> c.vec_id AND len(a.v) = len(c.v) WHERE a.vec_id % 50 = 0),
positives AS (
  SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM scored WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5)
SELECT anchor_id, positive_id, row_number() OVER best::INT AS rank, vec_id AS negative_id, positive_score, score AS negative_score
FROM positives JOIN scored USING (anchor_id)
WHERE NOT same AND 50 * positive_score <= 100 * score AND 100 * score <= 95 * positive_score
WINDOW best AS (PARTITION BY anchor_id, positive_id ORDER BY score DESC, vec_id) QUALIFY row_number() OVER best <= 3"""


def shifted_label():
    """Every seventh id has the next of ten labels."""
    label = F.col("label").cast("int")
    return F.when(F.col("vec_id") % 7 == 0, (label + 1) % 10).otherwise(label)


@query("op13_inverted_multi_index", ORACLE)
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings").withColumn("label", shifted_label())
    return hard_negatives(vectors, lambda i: i % 50 == 0)
