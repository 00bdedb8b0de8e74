"""What-if grids and what a dashboard shows."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from panelforge.config import COUNTRY_FACTS, SCENARIO_PRESETS
from panelforge.functions import scoring as S
from panelforge.sources.tables import local_rows

PRESET_SCHEMA = (
    "scenario string, temperature double, wind double, solar double, load_multiplier double"
)


def presets(spark: SparkSession) -> DataFrame:
    return local_rows(spark, SCENARIO_PRESETS, PRESET_SCHEMA)


def country_facts(spark: SparkSession) -> DataFrame:
    return local_rows(
        spark, COUNTRY_FACTS, "country string, name string, iso_3 string, avg_load int, avg_stress double"
    )


def per_scenario(df: DataFrame, scenarios: Sequence[tuple] = SCENARIO_PRESETS) -> DataFrame:
    """Every row once per scenario. The few scenarios are literals beside the
    row, so nothing is joined or shuffled."""
    names = ("scenario", "temperature", "wind", "solar", "load_multiplier")
    lines = [F.struct(*[F.lit(v).alias(n) for n, v in zip(names, s)]) for s in scenarios]
    return df.select("*", F.inline(F.array(*lines)))


def resolve_features(
    df: DataFrame,
    overrides: dict[str, Column],
    defaults: dict[str, Column],
    features: Sequence[str],
) -> DataFrame:
    """Each feature is the override, else the row's value, else the default."""
    def value(c: str) -> Column:
        found = [overrides.get(c), F.col(c) if c in df.columns else None, defaults.get(c)]
        return F.coalesce(*[v for v in found if v is not None])

    return df.withColumns({c: value(c) for c in features})


def with_components(
    df: DataFrame, load="Actual_Load", forecast="Forecasted_Load", net="net_imports",
    low="P10_net", high="P90_net",
) -> DataFrame:
    """The four component points, how many are active and their sum."""
    parts = S.serving_components(*[F.col(c) for c in (load, forecast, net, low, high)])
    return with_active_targets(df.withColumns(parts), list(parts))


def with_active_targets(df: DataFrame, parts: Sequence[str]) -> DataFrame:
    active = sum((F.when(F.col(p) > 0, 1).otherwise(0) for p in parts), F.lit(0))
    points = sum((F.col(p) for p in parts), F.lit(0.0))
    return df.withColumns({"active_targets": active, "points": points})


def scenario_scores(stats: DataFrame, reference_load: Column) -> DataFrame:
    """Presets for every country. ``stats`` has one row per country: load,
    forecast, net imports, base score and flow limits. The load of each country
    scales with its share of the reference load, then with the preset."""
    grid = per_scenario(stats)
    share = F.try_divide(F.col("avg_load"), reference_load)
    grid = grid.withColumns(
        {
            "load": reference_load * share * F.col("load_multiplier"),
            "forecast": reference_load * share,
        }
    )
    grid = with_components(grid, "load", "forecast", "net_imports")
    score = S.fallback_score(
        F.col("avg_stress"), F.col("load"), F.col("avg_load"), F.col("forecast"),
        F.col("net_imports"), F.col("temperature"),
    )
    return grid.withColumn("score", score).withColumn("level", S.stress_level(F.col("score")))


def model_scores(grid: DataFrame, model, features: Sequence[str], fallback: Column) -> DataFrame:
    """``score`` of each row: the model's probability of stress in percent, or the
    ``fallback`` where a feature is missing, and ``scored_by``."""
    known = reduce(lambda a, b: a & b, [F.col(f"`{c}`").isNotNull() & ~F.isnan(F.col(f"`{c}`").cast("double")) for c in features])
    by_model = model.transform(grid.filter(known)).withColumn("score", vector_to_array("probability")[1] * 100.0)
    by_rule = grid.filter(~F.coalesce(known, F.lit(False))).withColumn("score", fallback)
    names = [*grid.columns, "score"]
    return by_model.select(*names, F.lit("model").alias("scored_by")).unionByName(
        by_rule.select(*names, F.lit("rule").alias("scored_by"))
    )


def baseline_delta(df: DataFrame, score="score", base="avg_stress", load="load", usual="avg_load"):
    return df.withColumns(
        {
            "score_delta": F.col(score) - F.col(base),
            "load_delta_pct": (F.try_divide(F.col(load), F.col(usual)) - 1.0) * 100.0,
            "direction": S.flow_direction(F.col("net_imports")),
        }
    )


def map_table(facts: DataFrame, scores: DataFrame) -> DataFrame:
    """(country, iso_3, score, label); a country without a score shows its average."""
    joined = facts.join(scores.select("country", "score"), "country", "left")
    shown = F.coalesce("score", "avg_stress")
    return joined.select(
        "country", "iso_3", shown.alias("score"),
        F.format_string("%s: %.1f pts", F.col("name"), shown).alias("label"),
    )
