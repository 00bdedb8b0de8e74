"""ARIMA from sums against plain least squares, and models end to end."""

from datetime import datetime, timedelta

import numpy as np
import pytest

from panelforge.ml import forecasting as A
from panelforge.ml import models as ML


def _series(kind, n=400, seed=1):
    draw = np.random.default_rng(seed)
    e, y = draw.normal(size=n), np.zeros(n)
    for t in range(1, n):
        if kind == "ar":
            y[t] = 0.7 * y[t - 1] + e[t]
        elif kind == "walk":
            y[t] = y[t - 1] + e[t]
        else:
            y[t] = e[t] + 0.6 * e[t - 1]
    return y + 50


@pytest.fixture(scope="module")
def series(spark):
    start = datetime(2024, 1, 1)
    rows = [
        (k, start + timedelta(hours=i), float(v))
        for k in ("ar", "walk", "ma") for i, v in enumerate(_series(k))
    ]
    rows += [("short", start + timedelta(hours=i), 1.0) for i in range(20)]
    return spark.createDataFrame(rows, "k string, t timestamp, v double")


@pytest.fixture(scope="module")
def fitted(series):
    known = A.prepare_series(series, ["k"], "t", "v")
    return A.fit_arima(known, ["k"], "t", "v").cache()


def test_orders_and_coefficients(fitted):
    got = {r["k"]: r for r in fitted.collect()}
    assert set(got) == {"ar", "walk", "ma"}            # too few rows: no model
    assert got["ar"]["d"] == 0 and got["walk"]["d"] == 1 and got["ma"]["d"] == 0
    assert got["ar"]["p"] >= 1 and got["ar"]["ar"][0] == pytest.approx(0.7, abs=0.25)
    assert got["ma"]["p"] + got["ma"]["q"] >= 1


def test_long_autoregression_is_least_squares(fitted):
    row = {r["k"]: r for r in fitted.collect()}["ar"]
    y = _series("ar")
    y = y - y.mean()
    first = A.REACH + A.MAX_D
    x = np.column_stack(
        [np.ones(len(y) - first)] + [y[first - k : len(y) - k] for k in range(1, A.LONG + 1)]
    )
    want = np.linalg.lstsq(x, y[first:], rcond=None)[0]
    assert row["long_ar"] == pytest.approx(want.tolist(), abs=1e-8)


def test_blocks_give_the_same_fit(series, fitted):
    known = A.prepare_series(series, ["k"], "t", "v")
    cut = {r["k"]: r for r in A.fit_arima(known, ["k"], "t", "v", span="12 hours").collect()}
    for r in fitted.collect():
        assert cut[r["k"]]["aic"] == pytest.approx(r["aic"], rel=1e-9)
        assert (cut[r["k"]]["p"], cut[r["k"]]["q"]) == (r["p"], r["q"])


def test_forecast_steps_and_limits(fitted):
    rows = A.forecast(fitted, ["k"], 6, 0, 49.9).collect()
    assert len(rows) == 18 and all(0 <= r["forecast"] <= 49.9 for r in rows)
    far = {r["step"]: r["forecast"] for r in A.forecast(fitted, ["k"], 200).collect() if r["k"] == "ar"}
    assert far[200] == pytest.approx(_series("ar").mean(), abs=1.0)   # back to the mean


def test_validation_drops_keys_without_model_or_values(spark, fitted):
    later = datetime(2025, 1, 1)
    rows = [(k, later + timedelta(hours=i), 50.0) for k in ("ar", "short") for i in range(5)]
    actual = spark.createDataFrame(rows, "k string, t timestamp, v double")
    got = A.validate(fitted, actual, ["k"], "t", "v").collect()
    assert [(r["k"], r["n"]) for r in got] == [("ar", 5)]


def test_models_report_failures_and_rank(spark):
    draw = np.random.default_rng(2)
    rows = [(k, float(a), float(2 * a + (k == "x"))) for a in draw.normal(size=200) for k in ("x", "y")]
    df = spark.createDataFrame(rows, "country string, a double, y double")
    from pyspark.ml import Pipeline

    ready = Pipeline(stages=ML.feature_stages(["a"])).fit(df).transform(df)
    models = {**ML.linear_models("y", 400), "broken": ML.linear_models("absent", 1)["Ridge"]}
    table, fitted = ML.leaderboard(ready, ready, models, "y")
    got = {r["model"]: r for r in table.collect()}
    assert got["Linear Regression"]["r2"] == pytest.approx(1.0, abs=1e-6)
    assert got["broken"]["error"] and "broken" not in fitted
    assert ML.feature_names(ready)[0] == "a"


def test_sampled_grid_is_stable():
    space = {"a": [1, 2, 3], "b": [4, 5]}
    assert ML.sampled_grid(space, 5) == ML.sampled_grid(space, 5)
