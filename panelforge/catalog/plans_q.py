"""Queries: the whole batch and live preparation."""

from __future__ import annotations

import uuid

from panelforge.catalog.features_q import FEATURES, NATIONS
from panelforge.catalog.registry import query, rounded
from panelforge.catalog.sqltext import FRAGMENTS, HOURLY
from panelforge.catalog.sqltext import with_fragments as sql
from panelforge.operators.splits import Splits
from panelforge.plans import prepare as P
from panelforge.session import scratch_dir
from panelforge.sources import benchdata as B

SPLITS = Splits("1999-12-31", "2000-12-31")
SPLIT_SQL = """CASE WHEN "index" <= TIMESTAMP '1999-12-31' THEN 'train'
                    WHEN "index" <= TIMESTAMP '2000-12-31' THEN 'validation' ELSE 'test' END"""


def inputs(spark, sf):
    """Monthly inputs in whole cents, so that results match digit by digit. Series that
    come from the same readings come from one pass over them."""
    return P.Inputs(
        readings=[B.load_and_forecast(spark, sf)],
        flows=B.flow(spark, sf),
        panels=[B.supply(spark, sf)],
        unit="month",
    )


N, S, BIO = "Nuclear__Actual_Aggregated", "Solar__Actual_Aggregated", "Biomass__Actual_Consumption"


def _near(c):
    return f"""coalesce(
        last_value({c} IGNORE NULLS) OVER (PARTITION BY split, country ORDER BY "index"
          ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW),
        first_value({c} IGNORE NULLS) OVER (PARTITION BY split, country ORDER BY "index"
          ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING), 0)"""


def _prepared(split: str, more: dict | None = None) -> str:
    return sql(
        f"""SELECT split, country, "index", grid_stress_score, {_near(N)} AS {N}, {_near(S)} AS {S},
                   round(coalesce({BIO}, avg({BIO}) OVER (PARTITION BY split, country), 0), 6) AS {BIO}
            FROM labeled""",
        {**(more or {}), "labeled": f"""SELECT scored.*, {N}, {S}, {BIO}, {split} AS split FROM scored
                        JOIN generation USING (country, "index")
                        JOIN weather USING (country, "index")"""},
    )


@query("batch_preparation", _prepared(SPLIT_SQL))
def batch_preparation(spark, sf):
    """Resample, join, score, split and impute, with tables in between."""
    return _prepare(spark, inputs(spark, sf), SPLITS)


HOUR_SPLITS = Splits("2024-01-16", "2024-01-24")
HOUR_SPLIT_SQL = """CASE WHEN "index" <= TIMESTAMP '2024-01-16' THEN 'train'
                         WHEN "index" <= TIMESTAMP '2024-01-24' THEN 'validation' ELSE 'test' END"""


@query("batch_preparation_by_hour", _prepared(HOUR_SPLIT_SQL, HOURLY))
def batch_preparation_by_hour(spark, sf):
    """The same by hour, from the event stream."""
    by_hour = P.Inputs(readings=[B.hour_load(spark, sf)], flows=B.hour_flow(spark, sf), panels=[B.hour_supply(spark, sf)], unit="hour")
    return _prepare(spark, by_hour, HOUR_SPLITS)


def _prepare(spark, given, splits):
    name = f"batch_{uuid.uuid4().hex[:12]}"
    done = spark.table(P.run_batch(given, splits, name, scratch_dir(spark, name)))
    return rounded(done.select("split", "country", "index", "grid_stress_score", N, S, BIO), BIO)


@query(
    "live_preparation",
    sql(
        """SELECT country, "index", grid_stress_score, round(load_rolling_mean_24h, 6) AS load_rolling_mean_24h,
                  coalesce(imports_lag_1h, 0)::DOUBLE AS imports_lag_1h,
                  round(load_forecast_ratio, 6) AS load_forecast_ratio,
                  (country = 'NATION_1')::INT AS country_NATION_1, (country = 'NATION_24')::INT AS country_NATION_24
           FROM feats JOIN (SELECT country, "index", grid_stress_score FROM scored) USING (country, "index")""",
        {**FRAGMENTS, **FEATURES},
    ),
)
def live_preparation(spark, sf):
    """The hourly re-run: features and actual scores, read back and joined."""
    name = f"live_{uuid.uuid4().hex[:12]}"
    features, scores = P.run_live(inputs(spark, sf), name, scratch_dir(spark, name), NATIONS)
    rows = spark.table(scores).join(
        spark.table(features).select(
            "country", "index", "load_rolling_mean_24h", "imports_lag_1h", "load_forecast_ratio",
            "country_NATION_1", "country_NATION_24",
        ),
        B.KEYS,
    )
    return rounded(rows.select(
        "country", "index", "grid_stress_score", "load_rolling_mean_24h", "imports_lag_1h",
        "load_forecast_ratio", "country_NATION_1", "country_NATION_24",
    ), "load_rolling_mean_24h", "load_forecast_ratio")
