"""KPSS and the exact likelihood against plain versions, over many small blocks."""

from datetime import datetime, timedelta

import numpy as np
import pytest

from panelforge.ml import likelihood as L
from panelforge.ml import stationarity as S

START = datetime(2024, 1, 1)


def series(kind, n, seed=3):
    draw = np.random.default_rng(seed)
    e, y = draw.normal(size=n + 2), np.zeros(n + 2)
    for t in range(2, n + 2):
        y[t] = {"ar": 0.6 * y[t - 1] - 0.2 * y[t - 2] + e[t], "walk": y[t - 1] + e[t], "twice": 2 * y[t - 1] - y[t - 2] + e[t], "flat": 4.0}[kind]
    return y[2:]


def plain_kpss(y):
    n, e = len(y), y - y.mean()
    lags = int(4 * (n / 100) ** 0.25)
    long_run = (e @ e + 2 * sum((1 - k / (lags + 1)) * (e[k:] @ e[:-k]) for k in range(1, lags + 1))) / n
    return n, lags, (np.cumsum(e) ** 2).sum() / (n * n * long_run)


def frame(spark, kinds, n):
    rows = [(k, START + timedelta(hours=i), float(v)) for k in kinds for i, v in enumerate(series(k, n))]
    rows += [(kinds[0], None, None), ("none", START, None)]
    return spark.createDataFrame(rows, "k string, t timestamp, v double").repartition(4)


def test_kpss_in_blocks(spark):
    df = frame(spark, ["ar", "walk", "flat"], 500)
    got = {r.k: r for r in S.kpss(df, ["k"], ["t"], "v", span=40).collect()}
    assert set(got) == {"ar", "walk", "flat"} and got["flat"].kpss is None
    for k in ("ar", "walk"):
        n, lags, value = plain_kpss(series(k, 500))
        assert (got[k].n, got[k].lags) == (n, lags) and got[k].kpss == pytest.approx(value, rel=1e-9)


def test_order_of_differences(spark):
    df = frame(spark, ["ar", "walk", "twice", "flat"], 400)
    assert {r.k: r.d for r in S.kpss_order(df, ["k"], ["t"], "v").collect()} == {"ar": 0, "walk": 1, "twice": 2, "flat": 0}


def plain_likelihood(z, ar, ma):
    """The covariance of all rows at once."""
    r = max(len(ar), len(ma) + 1)
    psi = np.zeros(4000)
    for j in range(4000):
        psi[j] = (1.0 if j == 0 else (ma[j - 1] if j <= len(ma) else 0.0)) + sum(a * psi[j - i - 1] for i, a in enumerate(ar) if j > i)
    gamma = np.array([psi[: 4000 - k] @ psi[k:] for k in range(len(z))])
    cov = gamma[np.abs(np.subtract.outer(range(len(z)), range(len(z))))]
    low, u = np.zeros_like(cov), np.zeros(len(z))        # Cholesky, row by row
    for i in range(len(z)):
        for j in range(i):
            low[i, j] = (cov[i, j] - low[i, :j] @ low[j, :j]) / low[j, j]
        low[i, i] = np.sqrt(cov[i, i] - low[i, :i] @ low[i, :i])
        u[i] = (z[i] - low[i, :i] @ u[:i]) / low[i, i]
    logs, sigma2 = 2 * np.log(np.diag(low)).sum(), u @ u / len(z)
    return r, sigma2, -0.5 * (len(z) * (np.log(2 * np.pi * sigma2) + 1) + logs)


MODELS = {"ar": (2, 0, 0, 0.1, [0.6, -0.2], []), "walk": (0, 1, 1, 0.0, [], [0.3]), "twice": (1, 2, 2, 0.05, [0.2], [0.1, -0.4])}


def test_likelihood_equals_the_plain_one(spark):
    df = frame(spark, list(MODELS), 250)
    center = {k: float(series(k, 250).mean()) for k in MODELS}
    rows = [(k, p, d, q, c, ar, ma, center[k]) for k, (p, d, q, c, ar, ma) in MODELS.items()]
    rows += [("off", 1, 0, 0, 0.0, [1.0], [], 0.0), ("none", 1, 0, 0, 0.0, [0.5], [], 0.0)]
    schema = "k string, p int, d int, q int, const double, ar array<double>, ma array<double>, center double"
    models = spark.createDataFrame(rows, schema)
    more = spark.createDataFrame([("off", START, 1.0), ("off", START + timedelta(hours=1), 2.0)], df.schema)
    got = {r.k: r for r in L.log_likelihood(df.unionByName(more), models, ["k"], "t", "v", rows_each=30).collect()}
    assert set(got) == set(MODELS) | {"off", "none"} and got["off"].log_likelihood is None and got["none"].n is None
    for k, (p, d, q, c, ar, ma) in MODELS.items():
        z = np.diff(series(k, 250) - center[k], d) - c / (1 - sum(ar))
        _, sigma2, want = plain_likelihood(z, ar, ma)
        assert got[k].n == len(z) and got[k].sigma2 == pytest.approx(sigma2, rel=1e-8)
        assert got[k].log_likelihood == pytest.approx(want, rel=1e-8)
        assert got[k].aic == pytest.approx(2 * (p + q + 2) - 2 * want, rel=1e-8)


def test_maps_compose():
    draw = np.random.default_rng(0)
    z, model = draw.normal(size=300), L.Filter([0.5, 0.2], [0.4])
    whole = L.compose([L.block_map(z, 0, model)])
    parts = [L.block_map(z[i : i + 37], i, L.Filter([0.5, 0.2], [0.4])) for i in range(0, 300, 37)]
    assert L.compose(parts) == pytest.approx(whole, rel=1e-10)
