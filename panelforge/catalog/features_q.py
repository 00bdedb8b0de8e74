"""Queries: model features and labels."""

from __future__ import annotations

from pyspark.sql import functions as F

from panelforge.catalog.registry import query, rounded
from panelforge.catalog.sqltext import HOURLY
from panelforge.catalog.sqltext import with_fragments as sql
from panelforge.config import MODEL_FEATURES
from panelforge.operators import features as FE
from panelforge.operators.scores import score_panel
from panelforge.operators.splits import Splits, with_split
from panelforge.session import reliable_checkpoint
from panelforge.sources import benchdata as B

SPLITS = Splits("1999-12-31", "2000-12-31")
SPLIT_SQL = """CASE WHEN "index" <= TIMESTAMP '1999-12-31' THEN 'train'
                    WHEN "index" <= TIMESTAMP '2000-12-31' THEN 'validation' ELSE 'test' END"""
NATIONS = [f"NATION_{i}" for i in range(25)]


def _cyc(part, period, name):
    return ", ".join(f"{fn}(2 * pi() * ({part}) / {period}) AS {name}_{fn}" for fn in ("sin", "cos"))


FEATURES = {
    "calendar": f"""SELECT *, hour("index")::INT AS hour, month("index")::INT AS month,
            (isodow("index") - 1)::INT AS day_of_week, (isodow("index") >= 6)::INT AS is_weekend,
            {_cyc('hour("index")', 24, 'hour')}, {_cyc('month("index")', 12, 'month')},
            {_cyc('isodow("index") - 1', 7, 'day_of_week')},
            (hour("index") IN (7, 8, 9))::INT AS is_morning_peak,
            (hour("index") IN (18, 19, 20, 21))::INT AS is_evening_peak,
            (hour("index") IN (7, 8, 9, 18, 19, 20, 21))::INT AS is_peak_hour
        FROM panel""",
    "feats": """SELECT *, lag(Actual_Load, 1) OVER w AS load_lag_1h, lag(Actual_Load, 24) OVER w AS load_lag_24h,
            Actual_Load - lag(Actual_Load, 1) OVER w AS load_change_1h,
            Actual_Load - lag(Actual_Load, 24) OVER w AS load_change_24h,
            avg(Actual_Load) OVER (PARTITION BY country ORDER BY "index" ROWS BETWEEN 23 PRECEDING AND CURRENT ROW)
              AS load_rolling_mean_24h,
            stddev_samp(Actual_Load) OVER (PARTITION BY country ORDER BY "index"
              ROWS BETWEEN 23 PRECEDING AND CURRENT ROW) AS load_rolling_std_24h,
            lag(mean_temperature_c, 1) OVER w AS temp_lag_1h, lag(net_imports, 1) OVER w AS imports_lag_1h,
            avg(net_imports) OVER (PARTITION BY country ORDER BY "index" ROWS BETWEEN 24 PRECEDING AND 1 PRECEDING)
              AS imports_rolling_mean_24h,
            Actual_Load - Forecasted_Load AS load_forecast_diff,
            Actual_Load / nullif(Forecasted_Load + 1e-6, 0) AS load_forecast_ratio,
            abs(Actual_Load - Forecasted_Load) / nullif(Forecasted_Load + 1e-6, 0) * 100 AS load_forecast_error_pct,
            Actual_Load / nullif(mean_temperature_c + 20.0, 0) AS load_per_temp,
            mean_temperature_c * Actual_Load / 10000.0 AS temp_load_product,
            (mean_temperature_c < 0)::INT AS is_very_cold, (mean_temperature_c < 0)::INT AS temp_extreme,
            mean_wind_speed ** 3 / 100.0 AS wind_power_index,
            Actual_Load - avg(Actual_Load) OVER (PARTITION BY country, hour) AS load_deviation_from_hourly_avg,
            Actual_Load - avg(Actual_Load) OVER (PARTITION BY country, day_of_week) AS load_deviation_from_daily_avg
        FROM calendar WINDOW w AS (PARTITION BY country ORDER BY "index")""",
}
INTS = {"is_very_cold", "temp_extreme", "is_weekend", "is_morning_peak", "is_evening_peak", "is_peak_hour"}
EXACT = {"Actual_Load", "Forecasted_Load", "load_lag_1h", "load_lag_24h", "load_change_1h",
         "load_change_24h", "load_forecast_diff", "imports_lag_1h"}


def _shown(c, zero=False):
    e = f"coalesce({c}, 0)" if zero else c
    if c in INTS or c in EXACT:
        return f"{e}::DOUBLE AS {c}" if zero else f"{e} AS {c}"
    return f"round({e}, {_places(c)}) + 0.0 AS {c}"


def _places(c):
    return 3 if c in ("load_rolling_std_24h",) else 6 if c != "temp_load_product" else 8


def _round_all(df, names):
    for places in (3, 6, 8):
        cols = [c for c in names if c not in INTS | EXACT and _places(c) == places]
        df = rounded(df, *cols, places=places)
    return df


def features(spark, sf, **kw):
    return FE.clean_features(B.panel(spark, sf), **kw)


@query(
    "clean_features",
    sql(f"""SELECT country, "index", {', '.join(_shown(c) for c in MODEL_FEATURES)} FROM feats""", FEATURES),
)
def clean_features(spark, sf):
    """Every model feature of the panel."""
    return _round_all(features(spark, sf).select("country", "index", *MODEL_FEATURES), MODEL_FEATURES)


@query(
    "clean_features_by_hour",
    sql(f"""SELECT country, "index", {', '.join(_shown(c) for c in MODEL_FEATURES)} FROM feats""", {**HOURLY, **FEATURES}),
)
def clean_features_by_hour(spark, sf):
    """The same for the hourly panel of the event stream: hours, peaks and lags of a day vary."""
    rows = FE.clean_features(B.hour_panel(spark, sf))
    return _round_all(rows.select("country", "index", *MODEL_FEATURES), MODEL_FEATURES)


NO_IMPORTS = [c for c in MODEL_FEATURES if not c.startswith("imports_")]


@query(
    "clean_features_no_imports",
    sql(f"""SELECT country, "index", {', '.join(_shown(c) for c in NO_IMPORTS)} FROM feats""", FEATURES),
)
def clean_features_no_imports(spark, sf):
    rows = features(spark, sf, imports=False)
    assert "imports_lag_1h" not in rows.columns
    return _round_all(rows.select("country", "index", *NO_IMPORTS), NO_IMPORTS)


GENERATION = ["Nuclear__Actual_Aggregated", "Solar__Actual_Aggregated"]


@query(
    "model_matrix",
    sql(
        f"""SELECT "index", {', '.join(_shown(c, zero=True) for c in MODEL_FEATURES)},
                   {', '.join(f'coalesce({c}, 0)::DOUBLE AS {c}' for c in GENERATION)},
                   {', '.join(f"(country = '{k}')::INT AS country_{k}" for k in NATIONS)}
            FROM feats""",
        FEATURES,
    ),
)
def model_matrix(spark, sf):
    """Wanted features, generation columns that are dense enough, 0 for gaps and
    the country as 0/1 columns."""
    rows = reliable_checkpoint(features(spark, sf), "features")   # read twice below
    names = FE.final_features(rows)
    matrix = FE.model_matrix(rows, names, NATIONS, keep=["index"]).drop("country")
    return _round_all(matrix, [c for c in names if c not in GENERATION])


@query(
    "feature_groups",
    sql(
        "SELECT feature_group, n_features, (SELECT count(*) FROM panel) AS row_count FROM ("
        + " UNION ALL ".join(
            f"""SELECT '{g}' AS feature_group, count(*) FILTER (WHERE {rule}) AS n_features
                FROM feature_names"""
            for g, rule in (
                ("load", "lower(n) LIKE '%load%'"),
                ("weather", "regexp_matches(lower(n), 'temp|wind|solar|ssrd')"),
                ("temporal", "regexp_matches(n, 'hour_|month_|day_of_week|weekend|peak')"),
                ("import", "lower(n) LIKE '%import%'"),
                ("country", "contains(n, 'country_')"),
                ("generation", "contains(n, 'Actual_Aggregated')"),
            )
        ) + ")",
        {
            "feature_names": "SELECT * FROM (VALUES " + ", ".join(
                f"('{c}')" for c in (*MODEL_FEATURES, *GENERATION, *[f"country_{k}" for k in NATIONS])
            ) + ") t(n)"
        },
    ),
)
def feature_groups(spark, sf):
    """Features per category, beside the rows of the matrix they describe."""
    rows = reliable_checkpoint(features(spark, sf), "features")
    names = [c for c in FE.model_matrix(rows, FE.final_features(rows), NATIONS).columns if c != "country"]
    lines = [
        F.struct(F.lit(g).alias("feature_group"), F.lit(n).cast("long").alias("n_features"))
        for g, n in FE.feature_groups(names).items()
    ]
    return rows.agg(F.count(F.lit(1)).alias("row_count")).select("row_count", F.inline(F.array(*lines)))


LABELED = {"labeled": f"""SELECT *, (grid_stress_score >= 50)::INT AS label, {SPLIT_SQL} AS split FROM scored"""}


def labeled(spark, sf):
    rows = FE.with_label(score_panel(B.panel(spark, sf, with_supply=False)))
    return with_split(rows, splits=SPLITS)


@query(
    "binary_label",
    sql("""SELECT split, label, count(*) AS n FROM labeled GROUP BY 1, 2""", LABELED),
)
def binary_label(spark, sf):
    return labeled(spark, sf).groupBy("split", "label").agg(F.count(F.lit(1)).alias("n"))


@query(
    "class_weights",
    sql("""SELECT country, "index", label, round((SELECT count(*) FROM labeled)
                  / (2.0 * count(*) OVER (PARTITION BY label)), 6) AS weight FROM labeled""", LABELED),
)
def class_weights(spark, sf):
    known = labeled(spark, sf).select("country", "index", "label")
    rows = FE.with_class_weights(reliable_checkpoint(known, "labels")).select("country", "index", "label", "weight")
    return rounded(rows, "weight")


@query(
    "class_weights_fixed",
    sql("""SELECT country, "index", CASE WHEN label = 1 THEN 3.0 ELSE 1.0 END::DOUBLE AS weight FROM labeled""",
        LABELED),
)
def class_weights_fixed(spark, sf):
    return FE.with_class_weights(labeled(spark, sf), positive=3.0).select("country", "index", "weight")
