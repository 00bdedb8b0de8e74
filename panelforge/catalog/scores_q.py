"""Queries: the stress score and its parts."""

from pyspark.sql import functions as F

from panelforge.catalog.registry import money, query, rounded
from panelforge.catalog.sqltext import HOURLY
from panelforge.catalog.sqltext import with_fragments as sql
from panelforge.functions import scoring as S
from panelforge.operators import scenarios as X
from panelforge.operators.blocks import row_frames
from panelforge.operators.resample import group_mean
from panelforge.operators.scores import (
    score_panel,
    with_flow_limits,
    with_load_errors,
    with_reserve_margin,
)
from panelforge.session import reliable_checkpoint
from panelforge.sources import benchdata as B


_SCORE = """SELECT country, "index", round(Actual_Load, 2) AS Actual_Load,
                  round(reserve_margin_ml, 6) + 0.0 AS reserve_margin_ml,
                  round(load_rel_error, 6) + 0.0 AS load_rel_error,
                  round(net_imports, 2) + 0.0 AS net_imports,
                  score_reserve_margin, score_load_error, score_T7, score_T8, grid_stress_score
           FROM scored"""


@query("stress_score", sql(_SCORE))
def stress_score(spark, sf):
    """The flagship: resample, join, window, percentile and rule scoring."""
    return _scores(B.panel(spark, sf, with_supply=False))


@query("stress_score_by_hour", sql(_SCORE, HOURLY))
def stress_score_by_hour(spark, sf):
    """The same by hour, from the event stream."""
    return _scores(B.hour_panel(spark, sf, with_supply=False))


def _scores(panel):
    scored = score_panel(panel)
    scored = rounded(scored, "reserve_margin_ml", "load_rel_error")
    return money(scored, "Actual_Load", "net_imports").select(
        "country", "index", "Actual_Load", "reserve_margin_ml", "load_rel_error", "net_imports",
        "score_reserve_margin", "score_load_error", "score_T7", "score_T8", "grid_stress_score",
    )


def _panel(spark, sf):
    return B.panel(spark, sf, with_supply=False)


@query(
    "reserve_margin",
    sql("""SELECT country, "index", round(reserve_margin_ml, 6) + 0.0 AS reserve_margin_ml FROM indicators"""),
)
def reserve_margin(spark, sf):
    rows = with_reserve_margin(_panel(spark, sf)).select("country", "index", "reserve_margin_ml")
    return rounded(rows, "reserve_margin_ml")


@query(
    "load_rel_error",
    sql("""SELECT country, "index", forecast_load_error, round(load_rel_error, 6) + 0.0 AS load_rel_error
           FROM indicators"""),
)
def load_rel_error(spark, sf):
    rows = with_load_errors(_panel(spark, sf))
    return rounded(rows.select("country", "index", "forecast_load_error", "load_rel_error"), "load_rel_error")


def _scored(*names):
    return sql(f"""SELECT country, "index", {', '.join(names)} FROM scored""")


@query("score_reserve_margin", _scored("score_reserve_margin"))
def score_reserve_margin(spark, sf):
    rows = with_reserve_margin(_panel(spark, sf))
    return rows.select(
        "country", "index", S.margin_points(F.col("reserve_margin_ml")).alias("score_reserve_margin")
    )


@query("score_load_error", _scored("score_load_error"))
def score_load_error(spark, sf):
    rows = with_load_errors(_panel(spark, sf))
    return rows.select(
        "country", "index", S.error_points(F.col("load_rel_error")).alias("score_load_error")
    )


@query(
    "flow_flags",
    _scored("P10_net", "P90_net", "T7_high_exports", "T8_high_imports", "score_T7", "score_T8"),
)
def flow_flags(spark, sf):
    rows = with_flow_limits(_panel(spark, sf))
    high_exports, high_imports = S.flow_flags(*[F.col(c) for c in ("net_imports", "P10_net", "P90_net")])
    return rows.select(
        "country", "index", "P10_net", "P90_net",
        high_exports.alias("T7_high_exports"), high_imports.alias("T8_high_imports"),
        (high_exports * 25).alias("score_T7"), (high_imports * 25).alias("score_T8"),
    )


@query(
    "flow_flags_raw",
    sql(
        """SELECT from_country AS country, "index", Value, (Value < p10)::INT AS low, (Value > p90)::INT AS high
           FROM flow_readings JOIN (SELECT from_country, quantile_disc(Value, 0.1) AS p10,
             quantile_disc(Value, 0.9) AS p90 FROM flow_readings GROUP BY 1) USING (from_country)"""
    ),
)
def flow_flags_raw(spark, sf):
    """Limits of raw flows: keys of any size, exact all the same."""
    rows = B.flow_readings(spark, sf).select(F.col("from_country").alias("country"), "index", "Value")
    rows = with_flow_limits(reliable_checkpoint(rows, "flows"), net="Value", one_row_per_period=False)
    low, high = S.flow_flags(*[F.col(c) for c in ("Value", "P10_net", "P90_net")])
    return rows.select("country", "index", "Value", low.alias("low"), high.alias("high"))


LEVEL = """CASE WHEN {0} < 33 THEN 'NORMAL' WHEN {0} < 66 THEN 'MODERATE'
                WHEN {0} IS NOT NULL THEN 'HIGH RISK' END"""


@query("stress_level", _scored("grid_stress_score", LEVEL.format("grid_stress_score") + " AS level"))
def stress_level(spark, sf):
    score = F.col("grid_stress_score")
    return score_panel(_panel(spark, sf)).select(
        "country", "index", score, S.stress_level(score).alias("level")
    )


@query(
    "risk_category",
    _scored("""CASE WHEN grid_stress_score < 25 THEN 'NORMAL' WHEN grid_stress_score < 50 THEN 'MODERATE'
               ELSE 'HIGH RISK' END AS category"""),
)
def risk_category(spark, sf):
    return score_panel(_panel(spark, sf)).select(
        "country", "index", S.risk_category(F.col("grid_stress_score")).alias("category")
    )


def _parts_sql(load="Actual_Load", fc="Forecasted_Load", source="indicators"):
    margin = f"(({fc} - {load}) / greatest({load}, 1))"
    error = f"(abs({fc} - {load}) / greatest({fc}, 1) * 100.0::DOUBLE)"
    return f"""SELECT *, CASE WHEN {margin} < -0.15 THEN 25.0 WHEN {margin} < -0.05 THEN 12.5 ELSE 0.0 END::DOUBLE
                           AS pts_margin,
                      CASE WHEN {error} > 10 THEN 25.0 WHEN {error} > 5 THEN 12.5 ELSE 0.0 END::DOUBLE AS pts_error,
                      CASE WHEN net_imports < P10_net THEN 25.0 ELSE 0.0 END::DOUBLE AS pts_exports,
                      CASE WHEN net_imports > P90_net THEN 25.0 ELSE 0.0 END::DOUBLE AS pts_imports
               FROM {source}"""


def _active_sql(source):
    return f"""SELECT *, (pts_margin > 0)::INT + (pts_error > 0)::INT + (pts_exports > 0)::INT
                         + (pts_imports > 0)::INT AS active_targets,
                      pts_margin + pts_error + pts_exports + pts_imports AS points FROM {source}"""


PARTS = {"parts": _parts_sql(), "active": _active_sql("parts")}
PART_NAMES = ["pts_margin", "pts_error", "pts_exports", "pts_imports"]


@query("component_breakdown", sql(f"""SELECT country, "index", {', '.join(PART_NAMES)} FROM parts""", PARTS))
def component_breakdown(spark, sf):
    rows = X.with_components(with_flow_limits(_panel(spark, sf)))
    return rows.select("country", "index", *PART_NAMES)


@query("active_targets", sql("""SELECT country, "index", active_targets, points FROM active""", PARTS))
def active_targets(spark, sf):
    rows = X.with_components(with_flow_limits(_panel(spark, sf)))
    return rows.select("country", "index", "active_targets", "points")


PAST = """SELECT *, lag(net_imports, 1) OVER w AS imports_lag_1h,
                 avg(net_imports) OVER (PARTITION BY country ORDER BY "index"
                   ROWS BETWEEN 24 PRECEDING AND 1 PRECEDING) AS imports_rolling_mean_24h
          FROM core_panel WINDOW w AS (PARTITION BY country ORDER BY "index")"""


def _with_past(spark, sf):
    def columns(w):
        return {
            "imports_lag_1h": F.lag("net_imports", 1).over(w),
            "imports_rolling_mean_24h": F.avg("net_imports").over(w.rowsBetween(-24, -1)),
        }

    return row_frames(_panel(spark, sf), ["country"], ["index"], columns, before=24)


@query(
    "net_import_estimate",
    sql("""SELECT country, "index", round(coalesce(CASE WHEN net_imports > 0 THEN net_imports END,
                  (imports_lag_1h + imports_rolling_mean_24h) / 2.0), 6) + 0.0 AS estimate FROM past""",
        {"past": PAST}),
)
def net_import_estimate(spark, sf):
    """Imports stand in for what a user enters; other rows use their past."""
    entered = F.when(F.col("net_imports") > 0, F.col("net_imports"))
    value = S.net_import_estimate(entered, F.col("imports_lag_1h"), F.col("imports_rolling_mean_24h"))
    return rounded(_with_past(spark, sf).select("country", "index", value.alias("estimate")), "estimate")


FALLBACK = """least(greatest({base} + 20.0 * ({load} / nullif({usual}, 0) - 1.0)
                + 0.5 * (abs({fc} - {load}) / greatest({fc}, 1) * 100.0)
                + 2.0 * abs({net}) / 1000.0 + 0.5 * greatest(abs({temp} - 15.0) - 10.0, 0), 0), 100)"""
MEANS = {"means": """SELECT country, avg(Actual_Load) AS usual FROM load GROUP BY 1"""}


@query(
    "fallback_score",
    sql(
        f"""SELECT country, "index", round({FALLBACK.format(base='25.0', load='Actual_Load', usual='usual',
                fc='Forecasted_Load', net='(net_imports / 1e6)', temp='mean_temperature_c')}, 6) AS score
            FROM core_panel JOIN means USING (country) JOIN weather USING (country, "index")""",
        MEANS,
    ),
)
def fallback_score(spark, sf):
    rows = B.panel(spark, sf).drop("Marine__Actual_Aggregated")
    usual = group_mean(B.load(spark, sf), ["country"], {"Actual_Load": "usual"})
    score = S.fallback_score(
        F.lit(25.0), F.col("Actual_Load"), F.col("usual"), F.col("Forecasted_Load"),
        F.col("net_imports") / 1e6, F.col("mean_temperature_c"),
    )
    rows = rows.join(usual, "country").select("country", "index", score.alias("score"))
    return rounded(rows, "score")


@query(
    "forecast_error_band",
    sql(
        """SELECT country, "index", round(e, 6) + 0.0 AS error_pct,
                  CASE WHEN abs(e) < 5 THEN 'OK' WHEN abs(e) < 10 THEN 'WARNING' ELSE 'CRITICAL' END AS band
           FROM errors""",
        {"errors": """SELECT country, "index", (Actual_Load - Forecasted_Load)
                             / greatest(Forecasted_Load, 1) * 100.0::DOUBLE AS e FROM core_panel"""},
    ),
)
def forecast_error_band(spark, sf):
    error = S.forecast_error_percent(F.col("Actual_Load"), F.col("Forecasted_Load"))
    rows = _panel(spark, sf).select(
        "country", "index", error.alias("error_pct"), S.forecast_error_band(error).alias("band")
    )
    return rounded(rows, "error_pct")


# ---- scenarios -------------------------------------------------------------------
PRESETS = {
    "presets": """SELECT * FROM (VALUES ('normal', 15.0, 5.0, 500.0, 1.0), ('heat_wave', 38.0, 2.0, 900.0, 1.3),
        ('cold_snap', -15.0, 3.0, 100.0, 1.4), ('wind_drought', 15.0, 0.5, 300.0, 1.0),
        ('import_crisis', 10.0, 5.0, 400.0, 1.1), ('forecast_error', 15.0, 5.0, 500.0, 1.2),
        ('peak_hour', 20.0, 4.0, 600.0, 1.25), ('blackout', 38.0, 1.0, 50.0, 2.0))
        t(scenario, temperature, wind, solar, load_multiplier)""",
    "country_stats": """SELECT country, avg(Actual_Load) AS avg_load, avg(net_imports) AS net_imports,
                               avg(grid_stress_score) AS avg_stress, max(P10_net) AS P10_net,
                               max(P90_net) AS P90_net
                        FROM scored GROUP BY 1""",
}


def country_stats(spark, sf):
    """Averages per country of the scored panel."""
    return score_panel(_panel(spark, sf)).groupBy("country").agg(
        F.avg("Actual_Load").alias("avg_load"), F.avg("net_imports").alias("net_imports"),
        F.avg("grid_stress_score").alias("avg_stress"), F.max("P10_net").alias("P10_net"),
        F.max("P90_net").alias("P90_net"),
    )


@query(
    "scenario_presets",
    sql("""SELECT country, scenario, temperature::DOUBLE AS temperature, wind::DOUBLE AS wind,
                  solar::DOUBLE AS solar, round(usual * load_multiplier::DOUBLE, 6) AS load
           FROM means, presets""", {**PRESETS, **MEANS}),
)
def scenario_presets(spark, sf):
    """The presets applied to the usual load of each country."""
    usual = group_mean(B.load(spark, sf), ["country"], {"Actual_Load": "usual"})
    grid = X.per_scenario(usual).withColumn("load", F.col("usual") * F.col("load_multiplier"))
    return rounded(grid.drop("usual", "load_multiplier"), "load")


@query(
    "scenario_cross",
    sql("""SELECT country, "index", scenario, round(Actual_Load * load_multiplier::DOUBLE, 6) AS load,
                  temperature::DOUBLE AS temperature
           FROM load, presets""", PRESETS),
)
def scenario_cross(spark, sf):
    """Every scenario for every row of the panel, without a join."""
    grid = X.per_scenario(B.load(spark, sf))
    load = (F.col("Actual_Load") * F.col("load_multiplier")).alias("load")
    return rounded(grid.select("country", "index", "scenario", load, "temperature"), "load")


GRID = {
    **PRESETS,
    "reference": """SELECT max(avg_load) AS ref FROM country_stats""",
    "grid": """SELECT country, scenario, temperature::DOUBLE AS temperature, net_imports, avg_load,
                      avg_stress, P10_net, P90_net,
                      ref * (avg_load / ref) * load_multiplier::DOUBLE AS load, ref * (avg_load / ref) AS fc
               FROM country_stats, presets, reference""",
    "grid_parts": _parts_sql("load", "fc", "grid"),
    "grid_active": _active_sql("grid_parts"),
    "grid_scored": f"""SELECT *, {FALLBACK.format(base='avg_stress', load='load', usual='avg_load', fc='fc',
                         net='net_imports', temp='temperature')} AS score FROM grid_active""",
}


def _scenario_scores(spark, sf):
    stats = reliable_checkpoint(country_stats(spark, sf), "stats")   # one row per country
    return X.scenario_scores(stats, stats.agg(F.max("avg_load")).scalar())


@query(
    "scenario_scores",
    sql(f"""SELECT country, scenario, round(load, 6) AS load, active_targets, points,
                   round(score, 4) AS score, {LEVEL.format('score')} AS level FROM grid_scored""", GRID),
)
def scenario_scores(spark, sf):
    rows = _scenario_scores(spark, sf)
    rows = rows.select("country", "scenario", "load", "active_targets", "points", "score", "level")
    return rounded(rounded(rows, "load"), "score", places=4)


@query(
    "baseline_delta",
    sql("""SELECT country, scenario, round(score - avg_stress, 4) + 0.0 AS score_delta,
                  round((load / avg_load - 1.0) * 100.0, 4) + 0.0 AS load_delta_pct,
                  CASE WHEN net_imports > 0 THEN 'Importing' WHEN net_imports < 0 THEN 'Exporting'
                       WHEN net_imports = 0 THEN 'Balanced' END AS direction FROM grid_scored""", GRID),
)
def baseline_delta(spark, sf):
    rows = X.baseline_delta(_scenario_scores(spark, sf))
    return rounded(
        rows.select("country", "scenario", "score_delta", "load_delta_pct", "direction"),
        "score_delta", "load_delta_pct", places=4,
    )


@query(
    "eu_map_table",
    sql(
        """SELECT name AS country, iso_3, coalesce(score, 28.5)::DOUBLE AS score,
                  printf('%s: %.1f pts', name, coalesce(score, 28.5)) AS label
           FROM facts LEFT JOIN latest ON country = name""",
        {"latest": """SELECT country, arg_max(grid_stress_score, "index") AS score FROM scored GROUP BY 1""",
         "facts": """SELECT n_name AS name, upper(substr(r_name, 1, 3)) AS iso_3 FROM nation JOIN region ON n_regionkey = r_regionkey
                     UNION ALL SELECT upper(r_name), upper(substr(r_name, 1, 3)) FROM region"""},
    ),
)
def eu_map_table(spark, sf):
    """The latest score per country, or its average where there is none: whole regions
    stand among the countries and have no score."""
    regions = B.table(spark, sf, "region").withColumnRenamed("r_regionkey", "n_regionkey")
    code = F.upper(F.substring("r_name", 1, 3)).alias("iso_3")
    facts = B.table(spark, sf, "nation").join(regions, "n_regionkey").select(F.col("n_name").alias("country"), code)
    facts = facts.unionByName(regions.select(F.upper("r_name").alias("country"), code))
    facts = facts.withColumns({"name": F.col("country"), "avg_stress": F.lit(28.5)})
    latest = score_panel(_panel(spark, sf)).groupBy("country").agg(
        F.max_by("grid_stress_score", "index").alias("score")
    )
    return X.map_table(facts, latest)


@query(
    "override_chain",
    sql(
        """SELECT country, scenario, (Actual_Load * load_multiplier::DOUBLE) AS Actual_Load,
                  Forecasted_Load, temperature::DOUBLE AS mean_temperature_c,
                  coalesce(CASE WHEN scenario = 'import_crisis' THEN 6000.0 END, imports_lag_1h,
                           0.0)::DOUBLE AS imports_lag_1h, 500.0::DOUBLE AS mean_ssrd,
                  (country = 'NATION_1')::INT AS country_NATION_1, (country = 'NATION_2')::INT AS country_NATION_2
           FROM first_rows, presets""",
        {
            **PRESETS,
            "past": PAST,
            "first_rows": """SELECT country, arg_min(Actual_Load, "index") AS Actual_Load,
                  arg_min(Forecasted_Load, "index") AS Forecasted_Load,
                  CAST(NULL AS DOUBLE) AS imports_lag_1h FROM past GROUP BY 1""",
        },
    ),
)
def override_chain(spark, sf):
    """Scenario value, else the key's first row, else a default; then the flags."""
    from panelforge.operators.columns import one_hot
    from panelforge.operators.latest import first_n_per_key

    first = first_n_per_key(_with_past(spark, sf), ["country"], ["index"], 1)
    rows = X.resolve_features(
        X.per_scenario(first),
        overrides={
            "Actual_Load": F.col("Actual_Load") * F.col("load_multiplier"),
            "mean_temperature_c": F.col("temperature"),
            "imports_lag_1h": F.when(F.col("scenario") == "import_crisis", 6000.0),
        },
        defaults={"imports_lag_1h": F.lit(0.0), "mean_ssrd": F.lit(500.0)},
        features=["Actual_Load", "Forecasted_Load", "mean_temperature_c", "imports_lag_1h", "mean_ssrd"],
    )
    return one_hot(rows, "country", ["NATION_1", "NATION_2"]).select(
        "country", "scenario", "Actual_Load", "Forecasted_Load", "mean_temperature_c", "imports_lag_1h",
        "mean_ssrd", "country_NATION_1", "country_NATION_2",
    )


@query(
    "interactions",
    sql("""SELECT country, "index", round(Actual_Load / nullif(mean_temperature_c + 20.0, 0), 6) AS load_per_temp,
                  round(mean_temperature_c * Actual_Load / 10000.0, 8) + 0.0 AS temp_load_product,
                  round(mean_wind_speed ** 3 / 100.0, 6) AS wind_power_index
           FROM panel"""),
)
def interactions(spark, sf):
    from panelforge.operators.features import with_interactions

    rows = with_interactions(B.panel(spark, sf)).select(
        "country", "index", "load_per_temp", "temp_load_product", "wind_power_index"
    )
    return rounded(rounded(rows, "temp_load_product", places=8), "load_per_temp", "wind_power_index")
