"""ARIMA per key, fitted from sums that Spark aggregates.

The usual way hands each key's whole series to one task. Here the series stays
distributed: lagged values become columns, their cross products are summed per
key, and only these sums (a small matrix per key) reach a vectorised helper that
solves for the coefficients. The fit follows Hannan and Rissanen (1982): a long
autoregression gives the residuals, then the values are regressed on their own
lags and on lagged residuals, for each (p, q); the lowest AIC wins. A
Dickey-Fuller regression, or the KPSS test, decides between levels, differences and
their differences.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from panelforge.config import MIN_OBSERVATIONS
from panelforge.ml.stationarity import kpss_order
from panelforge.operators.blocks import row_frames
from panelforge.operators.evaluate import regression_metrics
from panelforge.session import reliable_checkpoint

LONG = 8          # lags of the long autoregression
MAX_P = 5
MAX_Q = 5
MAX_D = 2
REACH = LONG + MAX_Q          # lags of z that the second regression needs
DF_LIMIT = -2.86              # 5 % value of the Dickey-Fuller test with a constant
WIDTH1 = LONG + 2             # 1, z1..z8, z
WIDTH2 = MAX_P + MAX_Q + 2    # 1, z1..z5, e1..e5, z

MODEL = T.StructType(
    [
        T.StructField("p", T.IntegerType()),
        T.StructField("q", T.IntegerType()),
        T.StructField("const", T.DoubleType()),
        T.StructField("ar", T.ArrayType(T.DoubleType())),
        T.StructField("ma", T.ArrayType(T.DoubleType())),
        T.StructField("sigma2", T.DoubleType()),
        T.StructField("aic", T.DoubleType()),
    ]
)


def prepare_series(
    df: DataFrame, keys: Sequence[str], time: str, value: str, min_rows: int = MIN_OBSERVATIONS
) -> DataFrame:
    """(keys, time, value, n_obs) for keys with enough known values."""
    known = df.filter(F.col(value).isNotNull()).select(*keys, time, value)
    sizes = known.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_obs"))
    return known.join(sizes.filter(F.col("n_obs") >= min_rows), list(keys))


def _products(names: Sequence[str], where=None) -> list:
    """Sums of all pairwise products, upper triangle by rows."""
    pairs = [F.col(a) * F.col(b) for i, a in enumerate(names) for b in names[i:]]
    return [F.sum(p if where is None else F.when(where, p)) for p in pairs]


def _matrix(flat, width: int) -> np.ndarray:
    out = np.zeros((width, width))
    out[np.triu_indices(width)] = flat
    return out + np.triu(out, 1).T


def _solve(gram: np.ndarray, use: list[int]) -> tuple[np.ndarray, float]:
    """Least squares of the last column on the columns ``use``, from sums."""
    x, y = gram[np.ix_(use, use)], gram[use, -1]
    beta = np.linalg.lstsq(x, y, rcond=None)[0]
    rest = float(gram[-1, -1] - 2 * beta @ y + beta @ x @ beta)
    return beta, max(rest, 0.0)


@F.pandas_udf(T.ArrayType(T.DoubleType()))
def _long_autoregression(sums: Iterator[pd.Series]) -> Iterator[pd.Series]:
    for batch in sums:
        yield pd.Series(
            [_solve(_matrix(s, WIDTH1), list(range(WIDTH1 - 1)))[0].tolist() for s in batch]
        )


def _choose(flat) -> dict:
    gram, best = _matrix(flat, WIDTH2), None
    n = gram[0, 0]
    for p in range(MAX_P + 1):
        for q in range(MAX_Q + 1):
            use = [0, *range(1, 1 + p), *range(1 + MAX_P, 1 + MAX_P + q)]
            beta, rest = _solve(gram, use)
            sigma2 = rest / max(n, 1.0)
            aic = n * np.log(max(sigma2, 1e-12)) + 2 * (len(use) + 1)
            if best is None or aic < best["aic"] - 1e-9:
                best = {
                    "p": p, "q": q, "const": float(beta[0]),
                    "ar": beta[1 : 1 + p].tolist(), "ma": beta[1 + p :].tolist(),
                    "sigma2": sigma2, "aic": float(aic),
                }
    return best


@F.pandas_udf(MODEL)
def _choose_model(sums: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
    for batch in sums:
        yield pd.DataFrame([_choose(s) for s in batch], columns=MODEL.names)


def _lagged(df: DataFrame, keys, order, value: str, span: str | None) -> DataFrame:
    """y0, y1, ... are the value and its lags, measured from the key's mean."""
    mean = df.groupBy(*keys).agg(F.avg(value).alias("center"))
    rows = df.join(mean, list(keys)).withColumn("y0", F.col(value) - F.col("center"))
    lags = REACH + MAX_D
    return row_frames(
        rows, keys, order,
        lambda w: {f"y{k}": F.lag("y0", k).over(w) for k in range(1, lags + 1)},
        before=lags, span=span,
    )


def _statistic(n, slope, sxx, syy):
    """The Dickey-Fuller statistic from the sums of a regression."""
    rest = F.greatest(syy - slope * slope * sxx, F.lit(0.0))
    return F.try_divide(slope, F.sqrt(F.try_divide(rest, (n - 2) * sxx)))


def _difference_order(lagged: DataFrame, keys) -> DataFrame:
    """d per key: how often to take differences until the Dickey-Fuller statistic
    rejects a unit root, ``MAX_D`` times at most."""
    y = [F.col(f"y{k}") for k in range(3)]
    cases = ((y[0] - y[1], y[1]), (y[0] - 2 * y[1] + y[2], y[1] - y[2]))
    sums = lagged.groupBy(*keys).agg(
        *[
            s(*pair).cast("double").alias(f"{n}{i}")
            for i, pair in enumerate(cases)
            for n, s in (("n", F.regr_count), ("slope", F.regr_slope), ("sxx", F.regr_sxx), ("syy", F.regr_syy))
        ]
    )
    found = [_statistic(*[F.col(f"{n}{i}") for n in ("n", "slope", "sxx", "syy")]) < DF_LIMIT for i in range(MAX_D)]
    return sums.select(*keys, F.when(found[0], 0).when(found[1], 1).otherwise(2).alias("d"))


def fit_arima(
    series: DataFrame, keys: Sequence[str], time: str, value: str, span: str | None = None, test: str = "dickey_fuller"
) -> DataFrame:
    """One row per key: p, d, q, const, ar, ma, sigma2, aic, and what a forecast
    needs: the long autoregression, the mean and the last values. ``test`` decides on d:
    "dickey_fuller" looks for proof of a level, "kpss" for proof against one.

    The lagged rows are written once; three aggregates then read them."""
    keys = list(keys)
    lagged = reliable_checkpoint(_lagged(series, keys, [time], value, span), "lagged")
    if test not in ("dickey_fuller", "kpss"):
        raise ValueError(f"no such test: {test}")
    order = _difference_order(lagged, keys) if test == "dickey_fuller" else kpss_order(series, keys, [time], value)
    rows = lagged.join(order, keys)
    z = {
        f"z{k}": F.when(F.col("d") == 0, F.col(f"y{k}"))
        .when(F.col("d") == 1, F.col(f"y{k}") - F.col(f"y{k + 1}"))
        .otherwise(F.col(f"y{k}") - 2 * F.col(f"y{k + 1}") + F.col(f"y{k + 2}"))
        for k in range(REACH + 1)
    }
    rows = rows.withColumns(z).withColumn("one", F.lit(1.0))
    has_lags = F.col(f"y{REACH + MAX_D}").isNotNull()
    whole = rows.filter(has_lags)
    first = rows.groupBy(*keys).agg(
        F.array(
            *_products(["one", *[f"z{k}" for k in range(1, LONG + 1)], "z0"], has_lags)
        ).alias("_s"),
        F.max_by(F.array(*[f"y{k}" for k in range(REACH + MAX_D + 1)]), time).alias("last_values"),
        F.max(time).alias("last_time"),
        F.max("center").alias("center"),
        F.max("d").alias("d"),
    ).filter(F.col("_s")[0].isNotNull()).select(
        *keys, "last_values", "last_time", "center", "d",
        _long_autoregression("_s").alias("long_ar"),
    )

    def residual(back: int):
        fitted = F.col("long_ar")[0]
        for k in range(1, LONG + 1):
            fitted = fitted + F.col("long_ar")[k] * F.col(f"z{back + k}")
        return F.col(f"z{back}") - fitted

    shocks = {f"e{j}": residual(j) for j in range(1, MAX_Q + 1)}
    second = whole.join(first.select(*keys, "long_ar"), keys).withColumns(shocks)
    names = ["one", *[f"z{k}" for k in range(1, MAX_P + 1)], *shocks, "z0"]
    chosen = second.groupBy(*keys).agg(
        F.array(*_products(names)).alias("_s"), F.count(F.lit(1)).alias("rows_used")
    ).select(*keys, "rows_used", _choose_model("_s").alias("m"))
    return (
        chosen.join(first, keys)
        .select(
            *keys, "m.p", "d", "m.q", "m.const", "m.ar", "m.ma", "m.sigma2", "m.aic",
            "rows_used", "long_ar", "center", "last_values", "last_time",
        )
    )


def _project(row, steps: int, low: float, high: float) -> list[float]:
    y = np.array(row.last_values, dtype=float)        # newest first
    z = y
    for _ in range(row.d):
        z = z[:-1] - z[1:]
    long_ar = np.array(row.long_ar)
    shocks = [
        z[j] - long_ar[0] - long_ar[1:] @ z[j + 1 : j + 1 + LONG] for j in range(MAX_Q)
    ]
    values, level, slope, out = list(z[:MAX_P]), y[0], y[0] - y[1], []
    for _ in range(steps):
        ahead = row.const + sum(a * v for a, v in zip(row.ar, values))
        ahead += sum(b * e for b, e in zip(row.ma, shocks))
        values = [ahead, *values[: MAX_P - 1]]
        shocks = [0.0, *shocks[: MAX_Q - 1]]
        slope = slope + ahead if row.d == 2 else ahead
        level = level + slope if row.d else ahead
        out.append(float(min(max(level + row.center, low), high)))
    return out


def forecast(
    models: DataFrame, keys: Sequence[str], steps: int | str = 6, low: float = 0.0,
    high: float = 100.0,
) -> DataFrame:
    """(keys, step, forecast): the next values of each key, clamped to a range.
    ``steps`` is a number or the name of a column with one."""
    @F.pandas_udf(T.ArrayType(T.DoubleType()))
    def project(frames: Iterator[pd.DataFrame]) -> Iterator[pd.Series]:
        for pdf in frames:
            yield pd.Series([_project(r, int(r.steps), low, high) for r in pdf.itertuples()])

    count = F.col(steps) if isinstance(steps, str) else F.lit(steps)
    need = F.struct("d", "const", "ar", "ma", "long_ar", "center", "last_values", count.alias("steps"))
    path = models.select(*keys, project(need).alias("_path"))
    return path.select(*keys, F.posexplode("_path").alias("_i", "forecast")).select(
        *keys, (F.col("_i") + 1).alias("step"), "forecast"
    )


def validate(
    models: DataFrame, actual: DataFrame, keys: Sequence[str], time: str, value: str
) -> DataFrame:
    """MAE and RMSE per key over as many steps as the key has actual values. Keys
    without a model or without actual values drop out."""
    from pyspark.sql import Window

    keys = list(keys)
    known = actual.filter(F.col(value).isNotNull())
    place = F.row_number().over(Window.partitionBy(*keys).orderBy(time))   # panel: a row per period
    numbered = known.select(*keys, F.col(value).alias("_actual"), place.alias("step"))
    sizes = known.groupBy(*keys).agg(F.count(F.lit(1)).cast("int").alias("_steps"))
    ahead = forecast(models.join(sizes, keys), keys, "_steps", float("-inf"), float("inf"))
    joined = numbered.join(ahead, [*keys, "step"])
    return regression_metrics(joined, "_actual", "forecast", keys).select(*keys, "n", "mae", "rmse")


def fit_ar1(
    series: DataFrame, keys: Sequence[str], order: Sequence[str], value: str, span: str | None = None
) -> DataFrame:
    """First-order autoregression per key: slope and intercept on the last value."""
    rows = row_frames(
        series, keys, order, lambda w: {"_before": F.lag(value, 1).over(w)}, before=1, span=span
    )
    return rows.groupBy(*keys).agg(
        F.regr_slope(value, "_before").alias("slope"),
        F.regr_intercept(value, "_before").alias("intercept"),
        F.regr_count(value, "_before").alias("n"),
    )
