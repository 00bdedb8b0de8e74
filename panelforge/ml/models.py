"""Training, comparing and applying models with Spark ML."""

from __future__ import annotations

import random
import time
from collections.abc import Sequence
from multiprocessing.pool import ThreadPool

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import (
    DecisionTreeClassifier,
    GBTClassifier,
    LogisticRegression,
    RandomForestClassifier,
)
from pyspark.ml.evaluation import RegressionEvaluator
from pyspark.ml.feature import OneHotEncoder, StringIndexer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import (
    DecisionTreeRegressor,
    LinearRegression,
    RandomForestRegressor,
)
from pyspark.ml.tuning import CrossValidator
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from panelforge.ml.boosting import BoostedTrees
from panelforge.operators.evaluate import classification_metrics, regression_metrics
from panelforge.operators.profile import share_of_total
from panelforge.session import reliable_checkpoint

SEED = 42


def feature_stages(numeric: Sequence[str], key: str = "country") -> list:
    """The key as a sparse 0/1 vector, then all features as one vector. A key
    that training did not see sets no flag."""
    return [
        StringIndexer(inputCol=key, outputCol="_key", handleInvalid="keep"),
        OneHotEncoder(inputCol="_key", outputCol="_flags", dropLast=True),
        VectorAssembler(inputCols=[*numeric, "_flags"], outputCol="features"),
    ]


def _rounds(base: int, share: float) -> int:
    return max(2, round(base * share))


def linear_models(label: str, rows: int) -> dict:
    """Plain, ridge and lasso regression. Spark divides the loss by the number of
    rows, so the ridge penalty of 1.0 becomes 1 / rows."""
    plain = {"labelCol": label, "standardization": False}
    return {
        "Linear Regression": LinearRegression(regParam=0.0, **plain),
        "Ridge": LinearRegression(regParam=1.0 / max(rows, 1), elasticNetParam=0.0, **plain),
        "Lasso": LinearRegression(regParam=0.1, elasticNetParam=1.0, maxIter=5000, **plain),
    }


def tree_regressors(label: str) -> dict:
    return {
        "Decision Tree": DecisionTreeRegressor(
            labelCol=label, maxDepth=25, minInstancesPerNode=5, seed=SEED),
        "Decision Tree (shallow)": DecisionTreeRegressor(
            labelCol=label, maxDepth=15, minInstancesPerNode=10, seed=SEED),
    }


def forest_regressors(label: str) -> dict:
    def forest(trees, depth, least):
        return RandomForestRegressor(
            labelCol=label, numTrees=trees, maxDepth=depth,
            minInstancesPerNode=least, seed=SEED)

    return {
        "Random Forest (default)": forest(100, 20, 2),
        "Random Forest (deep)": forest(150, 30, 1),
        "Random Forest (wide)": forest(200, 15, 5),
    }


def boosted_regressors(label: str) -> dict:
    def boosted(rounds, depth, step, columns="all", least=1):
        return BoostedTrees(
            labelCol=label, maxIter=rounds, maxDepth=depth, stepSize=step,
            subsamplingRate=0.8, featureSubsetStrategy=columns, minInstancesPerNode=least, seed=SEED)

    return {
        "Gradient Boosting": boosted(100, 7, 0.1),
        "Gradient Boosting (aggressive)": boosted(200, 5, 0.05),
        "Boosted, column sample": boosted(100, 7, 0.1, "0.8"),
        "Boosted, column sample (deep)": boosted(150, 10, 0.05, "0.8"),
        "Boosted, column sample (large leaves)": boosted(100, 7, 0.1, "0.8", 20),
    }


def searched_trees(label: str) -> BoostedTrees:
    """The boosted trees that a search varies: their rounds are not searched."""
    return BoostedTrees(
        labelCol=label, maxIter=200, maxDepth=10, stepSize=0.05, subsamplingRate=0.8,
        featureSubsetStrategy="0.8", seed=SEED)


def regressors(label: str, rows: int) -> dict:
    """All regressors."""
    return {
        **linear_models(label, rows), **tree_regressors(label),
        **forest_regressors(label), **boosted_regressors(label),
    }


def logistic_models(label: str, weight: str = "weight") -> dict:
    return {
        "Logistic Regression": LogisticRegression(labelCol=label, maxIter=1000),
        "Logistic Regression (balanced)": LogisticRegression(
            labelCol=label, weightCol=weight, maxIter=1000),
    }


def classifiers(label: str, share: float = 1.0, weight: str = "weight", fixed: str = "weight_3"):
    """All classifiers; the balanced ones weigh rows by ``weight``. ``share`` scales the
    boosting rounds."""
    def tree(**kw):
        return DecisionTreeClassifier(labelCol=label, maxDepth=15, seed=SEED, **kw)

    def forest(**kw):
        return RandomForestClassifier(
            labelCol=label, numTrees=100, maxDepth=20, seed=SEED, **kw)

    def boosted(**kw):
        return GBTClassifier(
            labelCol=label, maxIter=_rounds(100, share), maxDepth=7, stepSize=0.1, seed=SEED, **kw)

    return {
        **logistic_models(label, weight),
        "Decision Tree Classifier": tree(),
        "Decision Tree (balanced)": tree(weightCol=weight),
        "Random Forest Classifier": forest(),
        "Random Forest (balanced)": forest(weightCol=weight),
        "Gradient Boosting Classifier": boosted(),
        "Gradient Boosting (positive weight)": boosted(weightCol=fixed),
    }


def leaderboard(
    train: DataFrame, valid: DataFrame, models: dict, label: str, classify: bool = False
) -> tuple[DataFrame, dict]:
    """Fit each model and measure it on the validation part. A model that fails
    is listed with its error. Returns the table and the fitted models."""
    lines, fitted = [], {}
    for name, estimator in models.items():
        begin = time.time()
        try:
            model = estimator.fit(train)
            took = time.time() - begin
            out = model.transform(valid)
            found = (
                classification_metrics(out, label, "prediction", 0.5)
                if classify
                else regression_metrics(out, label, "prediction")
            ).first()
            fitted[name] = model
            a, b, c, d = (
                (found["accuracy"], found["precision"], found["recall"], found["f1"])
                if classify
                else (found["mae"], found["rmse"], found["r2"], found["r2"])
            )
            lines.append((name, took, a, b, c, d, None))
        except Exception as error:   # one bad model must not end the comparison
            lines.append((name, None, None, None, None, None, str(error)))
    names = ("accuracy", "precision", "recall", "f1") if classify else ("mae", "rmse", "r2", "score")
    fields = ", ".join(f"{n} double" for n in names)
    table = train.sparkSession.createDataFrame(
        lines, f"model string, seconds double, {fields}, error string"
    )
    return table, fitted


def sampled_grid(params: dict, n: int, seed: int = SEED) -> list[dict]:
    """n random parameter combinations."""
    draw = random.Random(seed)
    return [{p: draw.choice(values) for p, values in params.items()} for _ in range(n)]


def hyper_search(
    train: DataFrame, estimator, params: dict, label: str, n: int = 20, folds: int = 5,
    parallelism: int = 4,
):
    """Random search with cross-validation by mean squared error. Returns the
    best model and a table of all tried combinations."""
    grid = sampled_grid(params, n)
    errors = estimator.cross_validated(train, grid, folds, SEED) if isinstance(estimator, BoostedTrees) else None
    if errors is not None:
        best = estimator.fit(train, grid[errors.index(min(errors))])
    else:
        judge = RegressionEvaluator(labelCol=label, metricName="mse")
        search = CrossValidator(
            estimator=estimator, estimatorParamMaps=grid, evaluator=judge, numFolds=folds,
            parallelism=parallelism, seed=SEED,
        ).fit(train)
        best, errors = search.bestModel, search.avgMetrics
    lines = [
        (", ".join(f"{p.name}={v}" for p, v in combo.items()), float(mse))
        for combo, mse in zip(grid, errors)
    ]
    table = train.sparkSession.createDataFrame(lines, "parameters string, mse double")
    return best, table


def _part(rows: DataFrame, share: float, seed: int) -> DataFrame:
    """The rows whose hash lies in the first ``share``: larger shares hold smaller ones."""
    if share >= 1.0:
        return rows
    at = F.pmod(F.xxhash64(F.lit(seed), *[c for c in rows.columns if c != "features"]), F.lit(1 << 30))
    return rows.where(at < int(share * (1 << 30)))


def halving_search(
    train: DataFrame, estimator, params: dict, label: str, n: int = 20, folds: int = 5, rungs: int = 3, keep: int = 3,
    rounds: str = "maxIter", least: int = 1, parallelism: int = 4, seed: int = SEED,
):
    """Random search by successive halving, cross-validated by mean squared error.

    All ``n`` draws begin with a few rounds on a part of the rows; on each of the ``rungs``
    the best 1/``keep`` of them go on with ``keep`` times the rounds and rows, and the last
    rung has all of both. Rows are dealt to folds and parts by their hash, so a draw is
    measured on the same folds throughout, and the part of a rung holds that of the one
    before. Returns the best model, fitted on all rows, and a table: rung, draw, fold,
    parameters, rounds, share, mse, stays."""
    grid, judge = sampled_grid(params, n, seed), RegressionEvaluator(labelCol=label, metricName="mse")
    full = estimator.getOrDefault(rounds)
    of_fold = F.pmod(F.xxhash64(F.lit(seed + 1), *[c for c in train.columns if c != "features"]), F.lit(folds))
    dealt = reliable_checkpoint(train.withColumn("_fold", of_fold), "folds")
    alive, lines = list(range(n)), []
    with ThreadPool(parallelism) as pool:
        for rung in range(rungs):
            share = float(keep) ** (rung + 1 - rungs)
            turns = max(least, round(full * share))
            part = _part(dealt, share, seed)
            setting = {estimator.getParam(rounds): turns}

            def measure(job):
                draw, fold = job
                own = part.where(F.col("_fold") != fold).drop("_fold")
                held = part.where(F.col("_fold") == fold).drop("_fold")
                model = estimator.fit(own, {**grid[draw], **setting})
                return draw, fold, float(judge.evaluate(model.transform(held)))

            found = pool.map(measure, [(d, f) for d in alive for f in range(folds)])
            mean = {d: sum(m for x, _, m in found if x == d) / folds for d in alive}
            best = sorted(alive, key=lambda d: (mean[d], d))
            stays = set(best[: max(1, -(-len(best) // keep))])
            lines += [
                (rung, d, f, ", ".join(f"{p.name}={v}" for p, v in grid[d].items()), turns, share, m, d in stays) for d, f, m in found
            ]
            alive = sorted(stays)
    winner = best[0]
    table = train.sparkSession.createDataFrame(
        lines, "rung int, draw int, fold int, parameters string, rounds int, share double, mse double, stays boolean"
    )
    return estimator.fit(train, grid[winner]), table


def boosted_search_space(estimator) -> dict:
    """Parameters of boosted trees to search, with their values."""
    return {
        estimator.maxDepth: [5, 7, 10],
        estimator.stepSize: [0.01, 0.05, 0.1],
        estimator.minInstancesPerNode: [10, 30, 100],
        estimator.subsamplingRate: [0.6, 0.8, 1.0],
        estimator.featureSubsetStrategy: ["0.6", "0.8", "all"],
    }


def with_probability(scored: DataFrame, name: str = "stress_probability") -> DataFrame:
    """Probability of class 1, in percent."""
    return scored.withColumn(name, vector_to_array("probability")[1] * 100.0)


def feature_names(df: DataFrame, column: str = "features") -> list[str]:
    """Names of the vector's slots, from the metadata the assembler wrote."""
    groups = df.schema[column].metadata["ml_attr"]["attrs"].values()
    return [a["name"] for a in sorted((a for g in groups for a in g), key=lambda a: a["idx"])]


def feature_importance(spark: SparkSession, model, names: Sequence[str]) -> DataFrame:
    """(feature, importance, pct, rank), one row per feature."""
    values = model.featureImportances.toArray()
    table = spark.createDataFrame(
        [(n, float(v)) for n, v in zip(names, values)], "feature string, importance double"
    )
    place = Window.orderBy(F.col("importance").desc(), "feature")   # one row per feature
    return share_of_total(table, "importance").withColumn("rank", F.row_number().over(place))


def save_bundle(model: PipelineModel, features: Sequence[str], path: str, spark: SparkSession) -> None:
    """The pipeline and its feature list, side by side."""
    model.write().overwrite().save(f"{path}/model")
    spark.createDataFrame(list(enumerate(features)), "place int, feature string").write.mode(
        "overwrite"
    ).parquet(f"{path}/features")


def load_bundle(path: str, spark: SparkSession) -> tuple[PipelineModel, list[str]]:
    rows = spark.read.parquet(f"{path}/features").orderBy("place").collect()   # one row per feature
    return PipelineModel.load(f"{path}/model"), [r["feature"] for r in rows]


def fit_pipeline(train: DataFrame, numeric: Sequence[str], estimator, key: str = "country"):
    return Pipeline(stages=[*feature_stages(numeric, key), estimator]).fit(train)
