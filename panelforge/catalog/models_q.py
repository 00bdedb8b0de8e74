"""Queries: models and forecasts."""

from __future__ import annotations

from pyspark.ml.regression import GBTRegressor
from pyspark.sql import functions as F

from panelforge.catalog.profile_q import scored
from panelforge.catalog.registry import query, rounded
from panelforge.catalog.sqltext import with_fragments as sql
from panelforge.ml import forecasting as A
from panelforge.ml import models as ML
from panelforge.ml.likelihood import log_likelihood
from panelforge.ml.stationarity import kpss
from panelforge.functions.scoring import fallback_score, stress_level
from panelforge.operators import evaluate as E
from panelforge.operators import features as FE
from panelforge.operators import joins as J
from panelforge.operators import latest as L
from panelforge.operators import scenarios as X
from panelforge.operators.profile import best_row
from panelforge.operators.scores import score_panel
from panelforge.operators.splits import Splits, split_by_date
from panelforge.session import reliable_checkpoint, scratch_dir
from panelforge.sources import benchdata as B

SPLITS = Splits("1999-12-31", "2000-12-31")
ROUNDS = 0.1   # share of the classifiers' boosting rounds, see README
SCORE = "grid_stress_score"


def matrix(spark, sf):
    """Train and validation parts with features, label and weights, written once
    since every model reads them many times."""
    rows = FE.with_label(FE.clean_features(score_panel(B.panel(spark, sf))))
    rows = reliable_checkpoint(rows, "features")
    names = FE.final_features(rows)
    table = FE.model_matrix(rows, names, [], keep=["index", SCORE, "label"])
    train, valid, test = split_by_date(table, splits=SPLITS)
    train = FE.with_class_weights(train).withColumn(
        "weight_3", F.when(F.col("label") == 1, 3.0).otherwise(1.0)
    )
    from pyspark.ml import Pipeline

    stages = Pipeline(stages=ML.feature_stages(names)).fit(train)
    return stages.transform(train), stages.transform(valid), stages.transform(test), names


def _board(spark, sf, models, label, classify=False):
    train, valid, _, _ = matrix(spark, sf)
    made = models(train) if callable(models) else models
    table, _ = ML.leaderboard(train, valid, made, label, classify)
    return table.drop("seconds")


@query("fit_linear")
def fit_linear(spark, sf):
    """Linear, ridge and lasso regression."""
    return _board(spark, sf, lambda t: ML.linear_models(SCORE, t.count()), SCORE)


@query("fit_tree")
def fit_tree(spark, sf):
    return _board(spark, sf, ML.tree_regressors(SCORE), SCORE)


@query("fit_forest")
def fit_forest(spark, sf):
    return _board(spark, sf, ML.forest_regressors(SCORE), SCORE)


@query("fit_gbt")
def fit_gbt(spark, sf):
    return _board(spark, sf, ML.boosted_regressors(SCORE), SCORE)


@query("fit_logistic")
def fit_logistic(spark, sf):
    return _board(spark, sf, ML.logistic_models("label"), "label", classify=True)


@query("model_leaderboard")
def model_leaderboard(spark, sf):
    """All classifiers, with the best by F1 marked."""
    table = _board(spark, sf, ML.classifiers("label", ROUNDS), "label", classify=True)
    top = best_row(table, "f1", "model").select("model", F.lit(True).alias("best"))
    return table.join(top, "model", "left").fillna(False, subset=["best"])


@query("hyper_search")
def hyper_search(spark, sf):
    """Random search over boosted trees; fewer draws and folds than the default."""
    train, _, _, _ = matrix(spark, sf)
    model = GBTRegressor(labelCol=SCORE, maxIter=3, seed=ML.SEED)
    _, table = ML.hyper_search(train, model, ML.boosted_search_space(model), SCORE, n=3, folds=2)
    return table


@query("halving_search")
def halving_search(spark, sf):
    """All twenty draws and five folds, by successive halving; a few rounds in the end."""
    train, _, _, _ = matrix(spark, sf)
    model = GBTRegressor(labelCol=SCORE, maxIter=3, seed=ML.SEED)
    _, table = ML.halving_search(train, model, ML.boosted_search_space(model), SCORE, rungs=2)
    return table


@query("score_probability")
def score_probability(spark, sf):
    train, _, test, _ = matrix(spark, sf)
    model = ML.logistic_models("label")["Logistic Regression"].fit(train)
    return ML.with_probability(model.transform(test)).select(
        "country", "index", "stress_probability", "prediction"
    )


@query("feature_importance")
def feature_importance(spark, sf):
    train, _, _, _ = matrix(spark, sf)
    model = ML.forest_regressors(SCORE)["Random Forest (wide)"].fit(train)
    return ML.feature_importance(spark, model, ML.feature_names(train))


@query("save_model_bundle")
def save_model_bundle(spark, sf):
    """Save a pipeline and its features, load them again and predict."""
    rows = reliable_checkpoint(FE.clean_features(score_panel(B.panel(spark, sf))), "features")
    names = FE.final_features(rows)
    table = FE.model_matrix(rows, names, [], keep=["index", SCORE])
    train, _, test = split_by_date(table, splits=SPLITS)
    path = scratch_dir(spark, "model")
    ML.save_bundle(ML.fit_pipeline(train, names, ML.tree_regressors(SCORE)["Decision Tree (shallow)"]),
                   names, path, spark)
    model, features = ML.load_bundle(path, spark)
    assert features == names
    return model.transform(test).select("country", "index", "prediction")


def _tuned(spark, sf, model, **search):
    """Train and validation parts, and the best searched model's prediction on all three."""
    train, valid, test, _ = matrix(spark, sf)
    best, _ = ML.hyper_search(train, model, ML.boosted_search_space(model), SCORE, **search)
    parts = {"train": train, "validation": valid, "test": test}
    names = ["country", "index", SCORE, "label", "prediction"]
    rows = [best.transform(df).select(*names, F.lit(part).alias("split")) for part, df in parts.items()]
    return train, valid, reliable_checkpoint(rows[0].unionByName(rows[1]).unionByName(rows[2]), "tuned")


@query("tuned_model_splits")
def tuned_model_splits(spark, sf):
    """MAE, RMSE and R2 of the searched model on each part, and its overfit gap; fewer
    draws, folds and rounds than the default."""
    _, _, rows = _tuned(spark, sf, GBTRegressor(labelCol=SCORE, maxIter=3, seed=ML.SEED), n=3, folds=2)
    metrics = E.regression_metrics(rows, SCORE, "prediction", ["split"])
    return metrics.withColumns({c: F.lit(v) for c, v in E.overfit_gap(metrics).first().asDict().items() if c not in metrics.columns})


@query("tuned_model_thresholds")
def tuned_model_thresholds(spark, sf):
    """The searched model as a warning at several thresholds, beside a classifier: all draws,
    folds and rounds."""
    train, valid, rows = _tuned(spark, sf, ML.searched_trees(SCORE))
    held = rows.filter("split = 'validation'").drop("split")
    sweep = E.threshold_sweep(held, SCORE, "prediction")
    told = ML.logistic_models("label")["Logistic Regression"].fit(train).transform(valid)
    both = J.join_on_keys(held, told.select("country", "index", F.col("prediction").alias("class")), ["country", "index"])
    approaches = E.compare_approaches(both, SCORE, {"regression_50": F.col("prediction") >= 50, "classifier": F.col("class") == 1})
    return sweep.select(F.concat(F.lit("threshold "), F.col("threshold").cast("string")).alias("approach"), "accuracy", "precision", "recall", "f1").unionByName(
        approaches.select("approach", "accuracy", "precision", "recall", "f1")
    )


@query("model_scenarios")
def model_scenarios(spark, sf):
    """Presets for every country through a saved and loaded model: the latest row of
    each country, with the preset's values in place of its own, or the rule-based score
    where a feature is missing."""
    rows = reliable_checkpoint(FE.with_label(FE.clean_features(score_panel(B.panel(spark, sf)))), "features")
    names = FE.final_features(rows)
    train, _, _ = split_by_date(FE.model_matrix(rows, names, [], keep=["index", "label"]), splits=SPLITS)
    path = scratch_dir(spark, "model")
    ML.save_bundle(ML.fit_pipeline(train, names, ML.logistic_models("label")["Logistic Regression"]), names, path, spark)
    model, features = ML.load_bundle(path, spark)
    usual = rows.groupBy("country").agg(F.avg(SCORE).alias("avg_stress"), F.avg("Actual_Load").alias("avg_load"))
    latest = L.latest_per_key(rows, ["country"], ["index"]).drop("label")
    grid = X.resolve_features(
        X.per_scenario(J.join_on_keys(latest, usual, ["country"])),
        overrides={
            "Actual_Load": F.col("Actual_Load") * F.col("load_multiplier"), "mean_temperature_c": F.col("temperature").cast("double"),
            "mean_wind_speed": F.col("wind").cast("double"), "mean_ssrd": F.col("solar").cast("double"),
        },
        defaults={}, features=["Actual_Load", "mean_temperature_c", "mean_wind_speed", "mean_ssrd"],
    )
    rule = fallback_score(F.col("avg_stress"), F.col("Actual_Load"), F.col("avg_load"), F.col("Forecasted_Load"), F.col("net_imports"), F.col("temperature"))
    scored = X.model_scores(FE.with_interactions(grid), model, features, rule)
    return scored.select("country", "scenario", "score", "scored_by", stress_level(F.col("score")).alias("level"))


# ---- forecasts -------------------------------------------------------------------
@query(
    "ts_prepare",
    sql("""SELECT country, "index", Actual_Load, n_obs FROM (
             SELECT *, count(*) OVER (PARTITION BY country) AS n_obs FROM hourly) WHERE n_obs >= 30"""),
)
def ts_prepare(spark, sf):
    return A.prepare_series(B.hourly(spark, sf), ["country"], "index", "Actual_Load")


@query(
    "ar1_sql",
    sql(
        """SELECT country, round(regr_slope(v, before), 6) AS slope, round(regr_intercept(v, before), 4) AS intercept,
                  regr_count(v, before)::BIGINT AS n FROM lagged GROUP BY 1""",
        {"lagged": """SELECT country, Actual_Load AS v,
                             lag(Actual_Load) OVER (PARTITION BY country ORDER BY "index", event_id) AS before
                      FROM readings"""},
    ),
)
def ar1_sql(spark, sf):
    rows = A.fit_ar1(
        B.readings(spark, sf).drop("user_id"), ["country"], ["index", "event_id"], "Actual_Load", "auto"
    )
    return rounded(rounded(rows, "slope"), "intercept", places=4)


def _models(spark, sf, rows=None):
    rows = scored(spark, sf) if rows is None else rows
    series = reliable_checkpoint(A.prepare_series(rows, ["country"], "index", SCORE), "series")
    return A.fit_arima(series, ["country"], "index", SCORE)


@query("arima_fit")
def arima_fit(spark, sf):
    """One model per country for the monthly score."""
    return _models(spark, sf).select("country", "p", "d", "q", "sigma2", "aic", "rows_used")


@query("arima_params")
def arima_params(spark, sf):
    """Fitted orders and coefficients, stored as a table."""
    path = scratch_dir(spark, "arima")
    _models(spark, sf).write.parquet(path)
    return spark.read.parquet(path).select("country", "p", "d", "q", "const", "ar", "ma")


_KPSS = """SELECT country, n, lags, round(s / (n * n * long_run), 6) + 0.0 AS kpss FROM (
    SELECT country, n, lags, (g0 + coalesce(g, 0)) / n AS long_run, s FROM totals LEFT JOIN near USING (country))"""


@query(
    "kpss_statistic",
    sql(
        _KPSS,
        {
            "deviations": """SELECT country, "index", Actual_Load - avg(Actual_Load) OVER (PARTITION BY country) AS e,
                                    row_number() OVER (PARTITION BY country ORDER BY "index") AS t,
                                    count(*) OVER (PARTITION BY country) AS n FROM hourly""",
            "runs": """SELECT *, sum(e) OVER (PARTITION BY country ORDER BY t) AS run,
                              floor(4 * pow(n / 100.0, 0.25))::INT AS lags FROM deviations""",
            "totals": """SELECT country, any_value(n) AS n, any_value(lags) AS lags, sum(e * e) AS g0, sum(run * run) AS s
                         FROM runs GROUP BY 1""",
            "near": """SELECT a.country, sum(2 * (1 - (b.t - a.t) / (a.lags + 1.0)) * a.e * b.e) AS g
                       FROM runs a JOIN runs b ON a.country = b.country AND b.t > a.t AND b.t <= a.t + a.lags GROUP BY 1""",
        },
    ),
)
def kpss_statistic(spark, sf):
    """The stationarity test of the hourly load, in blocks of counted rows."""
    return rounded(kpss(B.hourly(spark, sf), ["country"], ["index"], "Actual_Load"), "kpss")


@query("arima_likelihood")
def arima_likelihood(spark, sf):
    """Exact likelihoods of the models of the monthly score, differenced by the KPSS test."""
    rows = scored(spark, sf)
    series = reliable_checkpoint(A.prepare_series(rows, ["country"], "index", SCORE), "series")
    models = reliable_checkpoint(A.fit_arima(series, ["country"], "index", SCORE, test="kpss"), "models")
    found = log_likelihood(series, models, ["country"], "index", SCORE)
    return found.join(models.select("country", "p", "d", "q"), "country")


@query("arima_fit_raw")
def arima_fit_raw(spark, sf):
    """The same on raw readings, whose keys are fitted in time blocks."""
    rows = B.readings(spark, sf).select("country", "index", "Actual_Load")
    series = A.prepare_series(rows, ["country"], "index", "Actual_Load")
    models = A.fit_arima(reliable_checkpoint(series, "series"), ["country"], "index", "Actual_Load", "auto")
    return models.select("country", "p", "d", "q", "sigma2", "aic", "rows_used")


@query("forecast_6h")
def forecast_6h(spark, sf):
    """The next six scores per country; NULL for countries without a model."""
    ahead = A.forecast(_models(spark, sf), ["country"], 6)
    keys = B.load(spark, sf).select("country").distinct()
    slots = keys.select("country", F.explode(F.sequence(F.lit(1), F.lit(6))).alias("step"))
    return slots.join(ahead, ["country", "step"], "left")


@query("forecast_validation")
def forecast_validation(spark, sf):
    rows = reliable_checkpoint(scored(spark, sf).select("country", "index", SCORE), "scored")
    train, valid, _ = split_by_date(rows, splits=SPLITS)
    return A.validate(_models(spark, sf, train), valid, ["country"], "index", SCORE)


@query("stress_history_24_6")
def stress_history_24_6(spark, sf):
    """The last 24 scores and the next 6 per country, with hour labels."""
    from panelforge.plans.serve import history_and_forecast

    rows = reliable_checkpoint(scored(spark, sf).select("country", "index", SCORE), "scored")
    ahead = A.forecast(_models(spark, sf, rows), ["country"], 6)
    return history_and_forecast(rows, ahead, SCORE)
