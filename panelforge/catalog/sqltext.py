"""SQL fragments: the same fixtures as ``sources.benchdata``, for the oracle."""

from __future__ import annotations

import re

FRAGMENTS = {
    "readings": """
        SELECT event_type AS country, ts AS "index", round(value * 100) AS Actual_Load,
               event_id, user_id
        FROM events""",
    "hourly": """
        SELECT country, date_trunc('hour', "index") AS "index", avg(Actual_Load) AS Actual_Load
        FROM readings GROUP BY 1, 2""",
    "sparse_readings": """
        SELECT user_id AS country, ts AS "index", event_id,
               CASE WHEN event_type = 'purchase' THEN round(value * 100) END AS value
        FROM events""",
    "load_readings": """
        SELECT n_name AS country, o_orderdate AS "index", round(o_totalprice * 100) AS Actual_Load,
               CASE WHEN o_orderpriority IN ('1-URGENT', '2-HIGH', '3-MEDIUM')
                    THEN round(o_totalprice * 100) END AS Forecasted_Load
        FROM orders JOIN customer ON o_custkey = c_custkey
        JOIN nation ON c_nationkey = n_nationkey""",
    "load": """
        SELECT country, date_trunc('month', "index") AS "index", round(avg(Actual_Load)) AS Actual_Load
        FROM load_readings GROUP BY 1, 2""",
    "forecast": """
        SELECT country, date_trunc('month', "index") AS "index",
               round(avg(Forecasted_Load)) AS Forecasted_Load
        FROM load_readings WHERE Forecasted_Load IS NOT NULL GROUP BY 1, 2""",
    "flow_readings": """
        SELECT a.n_name AS from_country, b.n_name AS to_country, l_shipdate AS "index",
               round(l_extendedprice * 100) AS Value
        FROM lineitem JOIN supplier ON l_suppkey = s_suppkey
        JOIN nation a ON s_nationkey = a.n_nationkey
        JOIN orders ON l_orderkey = o_orderkey
        JOIN customer ON o_custkey = c_custkey
        JOIN nation b ON c_nationkey = b.n_nationkey""",
    "flow": """
        SELECT from_country, to_country, date_trunc('month', "index") AS "index",
               round(avg(Value)) AS Value
        FROM flow_readings GROUP BY 1, 2, 3""",
    "imports": """
        SELECT to_country AS country, "index", sum(Value) AS imports FROM flow GROUP BY 1, 2""",
    "exports": """
        SELECT from_country AS country, "index", sum(Value) AS exports FROM flow GROUP BY 1, 2""",
    "in_out": """
        SELECT coalesce(i.country, e.country) AS country, coalesce(i."index", e."index") AS "index",
               coalesce(imports, 0) AS imports, coalesce(exports, 0) AS exports
        FROM imports i FULL OUTER JOIN exports e
          ON i.country = e.country AND i."index" = e."index" """,
    "net": """
        SELECT country, "index", imports - exports AS net_imports FROM in_out""",
    "supply_readings": """
        SELECT n_name AS country, l_shipdate AS "index", round(l_extendedprice * 100) AS price,
               l_quantity, round(l_discount * 100) AS discount, round(l_tax * 100) AS tax, p_size
        FROM lineitem JOIN supplier ON l_suppkey = s_suppkey
        JOIN nation ON s_nationkey = n_nationkey JOIN part ON l_partkey = p_partkey""",
    "generation": """
        SELECT country, date_trunc('month', "index") AS "index",
               round(avg(price) FILTER (WHERE p_size = 1)) AS Nuclear__Actual_Aggregated,
               round(avg(price) FILTER (WHERE p_size = 2)) AS Solar__Actual_Aggregated,
               round(avg(l_quantity) FILTER (WHERE p_size <= 10) * 100) / 100 AS Biomass__Actual_Consumption,
               CAST(NULL AS DOUBLE) AS Marine__Actual_Aggregated
        FROM supply_readings GROUP BY 1, 2""",
    "weather": """
        SELECT country, date_trunc('month', "index") AS "index",
               round(avg(price)) / 10000.0 AS mean_ssrd, avg(l_quantity) / 5.0 AS mean_wind_speed,
               avg(discount) * 4.0 - 18.0 AS mean_temperature_c
        FROM supply_readings GROUP BY 1, 2""",
    "renewables": """
        SELECT country, date_trunc('month', "index") AS "index",
               avg(tax) AS solar_forecast, avg(discount) AS wind_forecast
        FROM supply_readings GROUP BY 1, 2""",
    "panel": """
        SELECT * FROM load JOIN forecast USING (country, "index") JOIN net USING (country, "index")
        JOIN weather USING (country, "index") JOIN renewables USING (country, "index")
        JOIN generation USING (country, "index")""",
    "core_panel": """
        SELECT * FROM load JOIN forecast USING (country, "index") JOIN net USING (country, "index")""",
    "limits": """
        SELECT country, quantile_disc(net_imports, 0.1) AS P10_net,
               quantile_disc(net_imports, 0.9) AS P90_net
        FROM core_panel GROUP BY 1""",
    "margins": """
        SELECT *, avg(Actual_Load) OVER (PARTITION BY country ORDER BY "index"
                    ROWS BETWEEN 24 PRECEDING AND CURRENT ROW) AS load_trailing_avg
        FROM core_panel""",
    "indicators": """
        SELECT m.*, (load_trailing_avg - Actual_Load) / nullif(load_trailing_avg, 0)
                 AS reserve_margin_ml,
               Forecasted_Load - Actual_Load AS forecast_load_error,
               abs(Forecasted_Load - Actual_Load) / nullif(Actual_Load + 1e-6, 0) AS load_rel_error,
               P10_net, P90_net
        FROM margins m LEFT JOIN limits USING (country)""",
    "components": """
        SELECT *, CASE WHEN abs(reserve_margin_ml) >= 0.2 THEN 0.0
                       WHEN abs(reserve_margin_ml) >= 0.1 THEN 12.5 ELSE 25.0 END::DOUBLE
                 AS score_reserve_margin,
               CASE WHEN load_rel_error <= 0.03 THEN 0.0
                    WHEN load_rel_error <= 0.1 THEN 12.5 ELSE 25.0 END::DOUBLE AS score_load_error,
               (net_imports < P10_net)::INT AS T7_high_exports,
               (net_imports > P90_net)::INT AS T8_high_imports
        FROM indicators""",
    "scored": """
        SELECT *, T7_high_exports * 25 AS score_T7, T8_high_imports * 25 AS score_T8,
               score_reserve_margin + score_load_error + T7_high_exports * 25
                 + T8_high_imports * 25 AS grid_stress_score
        FROM components""",
    "points": """
        SELECT vec_id AS id, 45.0::DOUBLE + embedding[1]::DOUBLE * 20.0::DOUBLE AS lat,
               10.0::DOUBLE + embedding[2]::DOUBLE * 20.0::DOUBLE AS lon, label AS slot,
               embedding[3]::DOUBLE AS ssrd, embedding[4]::DOUBLE AS wind_speed,
               embedding[5]::DOUBLE AS temperature_c
        FROM embeddings""",
    "places": """
        SELECT * FROM (VALUES
          (1, 47.52, 14.55, 'AT'), (2, 50.5, 4.47, 'BE'), (3, 51.17, 10.45, 'DE'),
          (4, 40.46, -3.75, 'ES'), (5, 46.23, 2.21, 'FR'), (6, 45.1, 15.2, 'HR'),
          (7, 47.16, 19.5, 'HU'), (8, 41.87, 12.56, 'IT'), (9, 55.17, 23.88, 'LT'),
          (10, 52.13, 5.29, 'NL'), (11, 51.92, 19.14, 'PL'), (12, 39.4, -8.22, 'PT'),
          (13, 48.67, 19.69, 'SK')) t(place_id, plat, plon, code)""",
    "coords": "SELECT DISTINCT lat, lon FROM points",
    "distances": """
        SELECT lat, lon, place_id, code,
               2 * 6371.0 * asin(sqrt(least(1.0::DOUBLE, pow(sin(radians(plat - lat) / 2), 2)
                 + cos(radians(lat)) * cos(radians(plat)) * pow(sin(radians(plon - lon) / 2), 2))))
                 AS km
        FROM coords, places""",
    "coord_country": """
        SELECT lat, lon, arg_min(place_id, (km, place_id)) AS place_id,
               arg_min(code, (km, place_id)) AS code, min(km) AS km
        FROM distances GROUP BY 1, 2""",
    "messages": """
        SELECT TIMESTAMP '1970-01-01' + INTERVAL 1 HOUR * (vec_id // 4)::INT AS "timestamp",
               ['10u', '10v', '2t', 'ssrd'][(vec_id % 4 + 1)::INT] AS short_name,
               embedding::DOUBLE[] AS "values"
        FROM embeddings""",
}


# The panel by hour: its sources are the events, and what is made of them goes by hour.
HOURLY = {
    "load_readings": """
        SELECT event_type AS country, ts AS "index", round(value * 100) AS Actual_Load,
               CASE WHEN user_id % 2 = 1 THEN round(value * 100) END AS Forecasted_Load
        FROM events""",
    "flow_readings": """
        SELECT * FROM (SELECT event_type AS from_country, ts AS "index", round(value * 100) AS Value,
                              ['click', 'error', 'purchase', 'signup', 'view'][(user_id % 5 + 1)::INT] AS to_country
                       FROM events) WHERE from_country <> to_country""",
    "supply_readings": """
        SELECT event_type AS country, ts AS "index", round(value * 100) AS price, (user_id % 50)::DOUBLE AS l_quantity,
               (event_id % 11)::DOUBLE AS discount, (event_id % 9)::DOUBLE AS tax, (event_id % 50 + 1)::INT AS p_size
        FROM events""",
    **{
        name: FRAGMENTS[name].replace("'month'", "'hour'")
        for name in ("load", "forecast", "flow", "generation", "weather", "renewables")
    },
}


def with_fragments(body: str, extra: dict[str, str] | None = None) -> str:
    """Put the fragments that ``body`` names, and theirs, in front as CTEs."""
    pool = {**FRAGMENTS, **(extra or {})}
    needed: list[str] = []

    def visit(text: str) -> None:
        for name in pool:
            if name not in needed and re.search(rf"(?:FROM|JOIN|,)\s+{name}\b", text):
                visit(pool[name])
                if name not in needed:
                    needed.append(name)

    visit(body)
    if not needed:
        return body
    ctes = ",\n".join(f"{name} AS ({pool[name]})" for name in needed)
    return f"WITH {ctes}\n{body}"
