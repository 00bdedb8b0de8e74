"""The exact Gaussian likelihood of ARMA models, per key, over blocks of rows.

The Kalman filter's gains don't depend on the data, and given the gains its state is an
affine map of the state before: a = A a0 + b. So a block of rows, whatever comes before
it, boils down to its map and to the sum of its squared errors as a quadratic form of the
state it starts from. Blocks are filtered on their own; their maps are then composed in
order, a few numbers a block, which gives the likelihood of the whole series.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from panelforge.ml.stationarity import differenced
from panelforge.operators.blocks import BLOCK, BLOCK_ROWS, counted_blocks
from panelforge.operators.joins import join_on_keys

SETTLED = 1e-15   # gains that change less than this stay as they are


@dataclass
class Filter:
    """The filter of an ARMA model with unit shock variance: gains and error variances,
    one a step until they settle."""

    ar: Sequence[float]
    ma: Sequence[float]
    gains: list = field(default_factory=list)
    settled: bool = False

    def __post_init__(self):
        r = max(len(self.ar), len(self.ma) + 1)
        self.size = r
        self.move = np.eye(r, k=1)
        self.move[: len(self.ar), 0] = self.ar
        shock = np.zeros(r)
        shock[: len(self.ma) + 1] = [1.0, *self.ma]
        self.noise = np.outer(shock, shock)
        self.stationary = not len(self.ar) or np.abs(np.linalg.eigvals(self.move)).max() < 1 - 1e-9
        if self.stationary:
            flat = np.linalg.solve(np.eye(r * r) - np.kron(self.move, self.move), self.noise.ravel())
            self.spread = flat.reshape(r, r)

    def gain(self, step: int) -> tuple[np.ndarray, float]:
        while step >= len(self.gains) and not self.settled:
            p, error = self.spread, float(self.spread[0, 0])
            k = self.move @ p[:, 0] / error
            self.gains.append((k, error))
            after = self.move @ p @ self.move.T + self.noise - np.outer(k, k) * error
            self.settled = bool(np.abs(after - p).max() <= SETTLED * (1 + np.abs(p).max()))
            self.spread = after
        return self.gains[min(step, len(self.gains) - 1)]


def block_map(z: np.ndarray, start: int, model: Filter) -> dict:
    """What the rows ``z``, the first of them at place ``start`` of its series, do to a
    state a0: the next state is a @ a0 + b; the squared errors, each by its variance, sum
    up to c - 2 h a0 + a0 g a0; ``logs`` sums the logs of the variances."""
    r, t = model.size, model.move
    a, b, h, g, c, logs = np.eye(r), np.zeros(r), np.zeros(r), np.zeros((r, r)), 0.0, 0.0
    live = True   # once the start is forgotten, a is 0
    for i, value in enumerate(z.tolist()):
        k, f = model.gain(start + i)
        error = value - b[0]
        if live:
            row = a[0].copy()
            h += row * (error / f)
            g += np.outer(row, row) / f
            a = t @ a - np.outer(k, row)
            live = np.abs(a).max() > 1e-200
            if not live:
                a[:] = 0
        c += error * error / f
        logs += np.log(f)
        b = t @ b + k * error
    return {"n": len(z), "a": a.ravel(), "b": b, "h": h, "g": g.ravel(), "c": c, "logs": logs}


def compose(maps: Sequence) -> tuple[int, float, float]:
    """Rows, squared errors and logs of all blocks of a key, from a state of 0."""
    state, n, errors, logs = None, 0, 0.0, 0.0
    for m in maps:
        b, h = np.array(m["b"]), np.array(m["h"])
        a, g = np.array(m["a"]).reshape(len(b), -1), np.array(m["g"]).reshape(len(b), -1)
        state = np.zeros(len(b)) if state is None else state
        errors += m["c"] - 2 * h @ state + state @ g @ state
        logs += m["logs"]
        n += m["n"]
        state = a @ state + b
    return n, errors, logs


def log_likelihood(
    series: DataFrame, models: DataFrame, keys: Sequence[str], time: str, value: str, rows_each: int = BLOCK_ROWS
) -> DataFrame:
    """keys, n, sigma2, log_likelihood, aic for each key of ``models`` (p, d, q, const, ar,
    ma, center, as ``fit_arima`` gives them) that ``series`` has rows of.

    The series is differenced d times; sigma2 is the variance at which the likelihood is
    highest. Models that aren't stationary, and series that fit without error, have NULLs.
    A block of ``rows_each`` rows is filtered at a time."""
    keys = list(keys)
    facts = models.select(*keys, F.struct("d", "const", "ar", "ma", "center").alias("_model"))
    known = join_on_keys(series.select(*keys, time, value), facts, keys, "inner")
    parts = []
    for d in range(3):
        own = known.where(F.col("_model.d") == d).withColumn("_y", F.col(value) - F.col("_model.center"))
        parts.append(differenced(own, keys, [time], "_y", d))
    z, _ = counted_blocks(parts[0].unionByName(parts[1]).unionByName(parts[2]), keys, [time], rows_each)
    earlier = Window.partitionBy(*keys).orderBy(BLOCK).rowsBetween(Window.unboundedPreceding, -1)
    blocks = z.groupBy(*keys, BLOCK).agg(F.count(F.lit(1)).alias("_m"))
    blocks = join_on_keys(blocks.withColumn("_start", F.coalesce(F.sum("_m").over(earlier), F.lit(0))), facts, keys, "inner")
    group = [*keys, "_part", "_sub"]
    cut = lambda df: df.withColumns({"_part": F.col(f"{BLOCK}.part"), "_sub": F.col(f"{BLOCK}.sub")}).drop(BLOCK)
    kinds = dict(series.dtypes)
    schema = ", ".join(f"`{k}` {kinds[k]}" for k in keys) + ", _part bigint, _sub int, n bigint, a array<double>, b array<double>, h array<double>, g array<double>, c double, logs double"

    def run(rows: pa.Table, block: pa.Table) -> pa.Table:
        model = block["_model"][0].as_py()
        made = Filter(model["ar"], model["ma"])
        out = {k: block[k] for k in keys} | {c: block[c] for c in ("_part", "_sub")}
        found = dict(n=0, a=[], b=[], h=[], g=[], c=0.0, logs=0.0)
        if made.stationary:
            y = rows.sort_by(time)["_y"].to_numpy()
            found = block_map(y - model["const"] / (1 - sum(model["ar"])), block["_start"][0].as_py(), made)
        lists = {c: pa.array([list(found[c])], pa.list_(pa.float64())) for c in ("a", "b", "h", "g")}
        sums = {c: pa.array([float(found[c])]) for c in ("c", "logs")}
        line = pa.table(out | {"n": pa.array([found["n"]], pa.int64())} | lists | sums)
        return line if made.stationary else line.slice(0, 0)

    facts_of = cut(blocks).select(*[F.col(c).alias(c) for c in (*group, "_start", "_model")])
    maps = cut(z).groupBy(*group).cogroup(facts_of.groupBy(*group)).applyInArrow(run, schema)
    listed = maps.groupBy(*keys).agg(F.sort_array(F.collect_list(F.struct("_part", "_sub", "n", "a", "b", "h", "g", "c", "logs"))).alias("_maps"))

    @F.pandas_udf("n bigint, sigma2 double, log_likelihood double")
    def whole(maps: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for batch in maps:
            lines = []
            for n, errors, logs in map(compose, batch):
                sigma2 = errors / n
                value = -0.5 * (n * (np.log(2 * np.pi * sigma2) + 1) + logs) if sigma2 > 0 else None
                lines.append((n, sigma2 if sigma2 > 0 else None, value))
            yield pd.DataFrame(lines, columns=["n", "sigma2", "log_likelihood"])

    found = listed.select(*keys, whole("_maps").alias("_f")).select(*keys, "_f.*")
    sizes = models.select(*keys, (2 * (F.col("p") + F.col("q") + 2)).alias("_penalty"))
    return join_on_keys(sizes, found, keys).select(
        *keys, "n", "sigma2", "log_likelihood", (F.col("_penalty") - 2 * F.col("log_likelihood")).alias("aic")
    )
