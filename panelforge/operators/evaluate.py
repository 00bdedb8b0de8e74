"""Measuring predictions against actual values."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from panelforge.config import RISK_THRESHOLD, SCORE_BINS, THRESHOLDS
from panelforge.operators.percentiles import exact_percentiles


def _hits(truth: Column, guess: Column) -> dict[str, Column]:
    """The four cells of a two-class table as counts."""
    return {
        "tn": F.count_if(~truth & ~guess),
        "fp": F.count_if(~truth & guess),
        "fn": F.count_if(truth & ~guess),
        "tp": F.count_if(truth & guess),
    }


def _rates(tn: Column, fp: Column, fn: Column, tp: Column) -> dict[str, Column]:
    """Ratios with an empty divisor count as 0."""

    def safe(a: Column, b: Column) -> Column:
        return F.coalesce(F.try_divide(a.cast("double"), b.cast("double")), F.lit(0.0))

    precision, recall = safe(tp, tp + fp), safe(tp, tp + fn)
    return {
        "accuracy": safe(tn + tp, tn + fp + fn + tp),
        "precision": precision,
        "recall": recall,
        "f1": safe(2 * tp, 2 * tp + fp + fn),
    }


def _cells(names=("tn", "fp", "fn", "tp"), suffix: str = ""):
    return [F.col(f"{n}{suffix}") for n in names]


def confusion_matrix(
    df: DataFrame, actual: str, predicted: str, threshold: float = RISK_THRESHOLD
) -> DataFrame:
    """(actual, predicted, n, pct, row_share) for the four cells."""
    row = df.agg(
        *[c.alias(n) for n, c in _hits(F.col(actual) >= threshold, F.col(predicted) >= threshold).items()]
    )
    tn, fp, fn, tp = _cells()
    total = tn + fp + fn + tp

    def cell(a: int, p: int, n: Column, of: Column) -> Column:
        return F.struct(
            F.lit(a).alias("actual"), F.lit(p).alias("predicted"), n.alias("n"),
            F.try_divide(n * 100.0, total).alias("pct"),
            F.try_divide(n.cast("double"), of).alias("row_share"),
        )

    return row.select(
        F.inline(
            F.array(
                cell(0, 0, tn, tn + fp), cell(0, 1, fp, tn + fp),
                cell(1, 0, fn, fn + tp), cell(1, 1, tp, fn + tp),
            )
        )
    )


def classification_metrics(
    df: DataFrame, actual: str, predicted: str, threshold: float = RISK_THRESHOLD,
    keys: Sequence[str] = (),
) -> DataFrame:
    """Accuracy, precision, recall, F1 and reliability; one row per key."""
    truth, guess = F.col(actual) >= threshold, F.col(predicted) >= threshold
    counts = df.groupBy(*keys).agg(*[c.alias(n) for n, c in _hits(truth, guess).items()])
    rates = _rates(*_cells())
    return counts.select(
        *keys, "tn", "fp", "fn", "tp",
        *[c.alias(n) for n, c in rates.items()],
        rates["accuracy"].alias("reliability"),
    )


def regression_metrics(
    df: DataFrame, actual: str, predicted: str, keys: Sequence[str] = ()
) -> DataFrame:
    """MAE, RMSE and R2 per key, in one pass over the rows.

    The spread of the actual values is their population variance times the
    count, which Spark merges without loss across tasks."""
    miss = F.col(actual) - F.col(predicted)
    both = df.filter(F.col(actual).isNotNull() & F.col(predicted).isNotNull())
    sums = both.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("n"),
        F.avg(F.abs(miss)).alias("mae"),
        F.avg(miss * miss).alias("_mse"),
        F.var_pop(actual).alias("_var"),
    )
    return sums.select(
        *keys, "n", "mae", F.sqrt("_mse").alias("rmse"),
        (F.lit(1.0) - F.try_divide(F.col("_mse"), F.col("_var"))).alias("r2"),
    )


def overfit_gap(metrics: DataFrame, part: str = "split") -> DataFrame:
    """Train R2 minus test R2, with its verdict."""
    gap = F.col("train_r2") - F.col("test_r2")
    return metrics.agg(
        F.max(F.when(F.col(part) == "train", F.col("r2"))).alias("train_r2"),
        F.max(F.when(F.col(part) == "test", F.col("r2"))).alias("test_r2"),
    ).select(
        "train_r2", "test_r2", gap.alias("gap"),
        F.when(gap < 0.05, "excellent").when(gap < 0.10, "good").otherwise("overfit").alias("verdict"),
    )


def score_bin(
    value: Column, edges: Sequence[float] = SCORE_BINS, include_lowest: bool = False
) -> Column:
    """1-based bin number, bins open to the left; NULL outside."""
    start = value >= edges[0] if include_lowest else value > edges[0]
    out = F.when(~start, None)
    for i, edge in enumerate(edges[1:], 1):
        out = out.when(value <= edge, i)
    return out


def error_by_bin(
    df: DataFrame, actual: str, predicted: str, edges: Sequence[float] = SCORE_BINS,
    include_lowest: bool = False,
) -> DataFrame:
    """Box-plot numbers of |error| per bin of the actual value."""
    errors = df.select(
        score_bin(F.col(actual), edges, include_lowest).alias("bin"),
        F.abs(F.col(actual) - F.col(predicted)).alias("abs_error"),
    ).filter(F.col("bin").isNotNull())
    plain = errors.groupBy("bin").agg(
        F.count("abs_error").alias("n"),
        F.min("abs_error").alias("low"),
        F.max("abs_error").alias("high"),
        F.avg("abs_error").alias("mean"),
    )
    boxes = exact_percentiles(
        errors, ["bin"], "abs_error", {"q1": 0.25, "median": 0.5, "q3": 0.75}, interpolate=True
    )
    return plain.join(boxes, "bin")


def with_residual(df: DataFrame, actual: str, predicted: str, name: str = "residual") -> DataFrame:
    return df.withColumn(name, F.col(actual) - F.col(predicted))


def residual_stats(df: DataFrame, actual: str, predicted: str, keys: Sequence[str] = ()) -> DataFrame:
    miss = F.col(actual) - F.col(predicted)
    return df.groupBy(*keys).agg(
        F.count(miss).alias("n"), F.avg(miss).alias("mean"), F.stddev_samp(miss).alias("std")
    )


def _sweep(df: DataFrame, cases: Sequence[tuple[str, Column, Column]]) -> DataFrame:
    """Metrics for several (label, truth, guess) cases from one aggregate: the
    rows are read once and not multiplied by the number of cases."""
    aggs = [
        c.alias(f"{n}_{i}")
        for i, (_, truth, guess) in enumerate(cases)
        for n, c in _hits(truth, guess).items()
    ]
    row = df.agg(*aggs)
    lines = []
    for i, (label, _, _) in enumerate(cases):
        cells = _cells(suffix=f"_{i}")
        rates = _rates(*cells)
        lines.append(
            F.struct(
                F.lit(label).alias("label"),
                *[c.alias(n) for n, c in rates.items()],
                cells[2].alias("missed"),
            )
        )
    return row.select(F.inline(F.array(*lines)))


def threshold_sweep(
    df: DataFrame, actual: str, predicted: str, thresholds: Sequence[float] = THRESHOLDS,
    fixed_truth: float | None = None,
) -> DataFrame:
    """Metrics per threshold. The threshold moves truth and guess together,
    unless ``fixed_truth`` pins the truth."""
    cases = [
        (
            str(t),
            F.col(actual) >= (t if fixed_truth is None else fixed_truth),
            F.col(predicted) >= t,
        )
        for t in thresholds
    ]
    return _sweep(df, cases).select(
        F.col("label").cast("int").alias("threshold"),
        "accuracy", "precision", "recall", "f1", "missed",
    )


def compare_approaches(
    df: DataFrame, actual: str, approaches: dict[str, Column], threshold: float = RISK_THRESHOLD
) -> DataFrame:
    """Metrics of several yes/no guesses against one truth."""
    truth = F.col(actual) >= threshold
    return _sweep(df, [(name, truth, guess) for name, guess in approaches.items()]).select(
        F.col("label").alias("approach"), "accuracy", "precision", "recall", "f1"
    )
