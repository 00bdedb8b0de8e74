"""Queries: joins and set operations."""

from __future__ import annotations

from pyspark.sql import functions as F

from panelforge.catalog.registry import money, query, rounded
from panelforge.catalog.sqltext import with_fragments as sql
from panelforge.operators import flows
from panelforge.operators import joins as J
from panelforge.operators import latest as L
from panelforge.operators import splits as S
from panelforge.operators.asof import asof_join
from panelforge.operators.columns import with_periods
from panelforge.operators.resample import group_mean, resample_mean
from panelforge.sources import benchdata as B
from panelforge.sources import tables as T

COORD_SQL = """SELECT id, p.lat, p.lon, slot, c.code AS country, c.place_id
               FROM points p LEFT JOIN coord_country c ON p.lat = c.lat AND p.lon = c.lon"""


def located(spark, sf):
    """Points with the code of their nearest place."""
    points = B.points(spark, sf)
    dim = J.nearest_place(points, B.places(spark))
    return points.join(dim.withColumnRenamed("code", "country"), ["lat", "lon"], "left")


@query("left_dim_join", sql(COORD_SQL))
def left_dim_join(spark, sf):
    return located(spark, sf).select("id", "lat", "lon", "slot", "country", "place_id")


NEAREST_SQL = """SELECT lat, lon, place_id, code, round(km, 4) AS km FROM coord_country"""


@query("nearest_reference", sql(NEAREST_SQL))
def nearest_reference(spark, sf):
    return rounded(J.nearest_place(B.points(spark, sf), B.places(spark)), "km", places=4)


@query("nearest_reference_by_cell", sql(NEAREST_SQL))
def nearest_reference_by_cell(spark, sf):
    """The same with larger cells at the end: the result doesn't hang on them."""
    return rounded(J.nearest_place(B.points(spark, sf), B.places(spark), levels=2), "km", places=4)


@query(
    "distinct_keys",
    sql("""SELECT DISTINCT lat, lon FROM points"""),
)
def distinct_keys(spark, sf):
    return B.points(spark, sf).select("lat", "lon").distinct()


@query(
    "geo_mean",
    sql(
        """SELECT country, slot, round(avg(ssrd), 6) + 0.0 AS mean_ssrd,
                  round(avg(wind_speed), 6) + 0.0 AS mean_wind_speed,
                  round(avg(temperature_c), 6) + 0.0 AS mean_temperature_c
           FROM placed GROUP BY 1, 2""",
        {
            "placed": """SELECT p.*, c.code AS country FROM points p
                         LEFT JOIN coord_country c ON p.lat = c.lat AND p.lon = c.lon"""
        },
    ),
)
def geo_mean(spark, sf):
    names = ("ssrd", "wind_speed", "temperature_c")
    means = group_mean(located(spark, sf), ["country", "slot"], {c: f"mean_{c}" for c in names})
    return rounded(means, *[f"mean_{c}" for c in names])


@query("full_outer_flow", sql("""SELECT country, "index", imports, exports FROM in_out"""))
def full_outer_flow(spark, sf):
    edges = B.flow(spark, sf)
    return flows.full_outer_zero(
        flows.sums_by_end(edges, "to_country", name="imports"),
        flows.sums_by_end(edges, "from_country", name="exports"),
        B.KEYS,
    )


@query(
    "in_out_sums",
    sql("""SELECT country, "index", imports, exports FROM in_out"""),
)
def in_out_sums(spark, sf):
    """Both sums from one pass over the flows."""
    return flows.in_out_sums(B.flow(spark, sf))


@query("net_flow", sql("""SELECT country, "index", net_imports FROM net"""))
def net_flow(spark, sf):
    return B.net(spark, sf)


@query(
    "inner_join_chain",
    sql("""SELECT country, "index", Actual_Load, Forecasted_Load, net_imports,
                  round(mean_ssrd, 6) AS mean_ssrd, round(mean_wind_speed, 6) AS mean_wind_speed,
                  round(mean_temperature_c, 6) + 0.0 AS mean_temperature_c,
                  round(solar_forecast, 6) AS solar_forecast, round(wind_forecast, 6) AS wind_forecast,
                  Nuclear__Actual_Aggregated, Biomass__Actual_Consumption
           FROM panel"""),
)
def inner_join_chain(spark, sf):
    """Load, net flow, supply series (generation, weather, renewables) and load
    forecast joined on time and key. Each is an aggregate by that key, so the
    joins add no shuffle."""
    wide = J.align(
        [B.load(spark, sf), B.supply(spark, sf), B.net(spark, sf), B.forecast(spark, sf)],
        ["index", "country"],
    ).drop("Solar__Actual_Aggregated", "Marine__Actual_Aggregated")
    return rounded(
        wide, "mean_ssrd", "mean_wind_speed", "mean_temperature_c", "solar_forecast", "wind_forecast"
    )


@query(
    "left_stats_join",
    sql("""SELECT country, "index", Actual_Load, round(m, 2) AS mean_load, top AS max_load
           FROM load LEFT JOIN (SELECT country, avg(Actual_Load) AS m, max(Actual_Load) AS top
                                FROM load GROUP BY 1) USING (country)"""),
)
def left_stats_join(spark, sf):
    stats = {"mean_load": F.avg("Actual_Load"), "max_load": F.max("Actual_Load")}
    return money(J.with_group_stats(B.load(spark, sf), ["country"], stats), "mean_load")


@query(
    "lookup_default",
    sql("""SELECT event_id, country, coalesce(label, 'unknown') AS label, coalesce(base, 25.0)::DOUBLE AS base
           FROM readings LEFT JOIN (VALUES ('click', 'Clicks', 29.5), ('view', 'Views', 28.6))
             t(country, label, base) USING (country)"""),
)
def lookup_default(spark, sf):
    dim = T.local_rows(
        spark, [("click", "Clicks", 29.5), ("view", "Views", 28.6)],
        "country string, label string, base double",
    )
    rows = B.readings(spark, sf).select("event_id", "country")
    return J.lookup(rows, dim, ["country"], {"label": "unknown", "base": 25.0})


INSTANT = "2024-01-15 12:00:00"


@query(
    "asof_nearest",
    sql(f"""SELECT country, "index", event_id, Actual_Load FROM (
              SELECT *, row_number() OVER (PARTITION BY country ORDER BY
                abs(epoch_us("index") - epoch_us(TIMESTAMP '{INSTANT}')), "index", event_id) AS r FROM readings)
            WHERE r = 1"""),
)
def asof_nearest(spark, sf):
    rows = B.readings(spark, sf).drop("user_id")
    return J.nearest_in_time(rows, ["country"], "index", F.lit(INSTANT), ["event_id"])


# Purchases are one series of each user, all other events are another.
_LATER = """SELECT user_id, max(event_id) AS right_event_id, ts AS right_ts, arg_max(round(value * 100), event_id) AS right_value
            FROM events WHERE event_type = 'purchase' GROUP BY user_id, ts"""
_FIRST = _LATER.replace("max(event_id) AS", "min(event_id) AS").replace("arg_max", "arg_min")
_OTHERS = "SELECT event_id, user_id, ts FROM events WHERE event_type <> 'purchase'"


def _two_series(spark, sf):
    events = B.table(spark, sf, "events").select("event_id", "user_id", B.utc("ts").alias("ts"), "event_type", B.cents("value").alias("value"))
    bought = F.col("event_type") == "purchase"
    return events.where(~bought).select("event_id", "user_id", "ts"), events.where(bought).drop("event_type")


def _asof(compare: str, side: str) -> str:
    return f"""SELECT l.*, r.right_event_id, r.right_ts, r.right_value
               FROM ({_OTHERS}) l ASOF LEFT JOIN ({side}) r ON l.user_id = r.user_id AND l.ts {compare} r.right_ts"""


@query("asof_join_before", _asof(">=", _LATER))
def asof_join_before(spark, sf):
    """For each event the user's last purchase up to then."""
    return asof_join(*_two_series(spark, sf), ["user_id"], "ts", "before", ties=["event_id"])


@query("asof_join_after", _asof("<=", _FIRST))
def asof_join_after(spark, sf):
    """For each event the user's next purchase."""
    return asof_join(*_two_series(spark, sf), ["user_id"], "ts", "after", ties=["event_id"])


@query(
    "asof_join_nearest",
    f"""WITH b AS ({_asof(">=", _LATER)}), a AS ({_asof("<=", _FIRST)}),
        pair AS (SELECT b.event_id, b.user_id, b.ts,
                        CASE WHEN b.ts - b.right_ts <= INTERVAL 12 HOUR THEN b.right_ts END AS back,
                        CASE WHEN a.right_ts - a.ts <= INTERVAL 12 HOUR THEN a.right_ts END AS ahead,
                        b.right_event_id AS b_id, a.right_event_id AS a_id, b.right_value AS b_value, a.right_value AS a_value
                 FROM b JOIN a USING (event_id)),
        chosen AS (SELECT *, CASE WHEN back IS NULL OR ahead - ts < ts - back THEN ahead ELSE back END AS right_ts,
                          coalesce(back IS NULL OR ahead - ts < ts - back, false) AS forward FROM pair)
        SELECT event_id, user_id, ts, CASE WHEN right_ts IS NULL THEN NULL WHEN forward THEN a_id ELSE b_id END AS right_event_id, right_ts,
               CASE WHEN right_ts IS NULL THEN NULL WHEN forward THEN a_value ELSE b_value END AS right_value
        FROM chosen WHERE right_ts IS NOT NULL""",
)
def asof_join_nearest(spark, sf):
    """For each event the user's nearest purchase, if there is one within 12 hours."""
    return asof_join(*_two_series(spark, sf), ["user_id"], "ts", "nearest", "12 hours", ["event_id"], how="inner")


def _nth(n, order):
    return sql(f"""SELECT country, "index", event_id, Actual_Load FROM (
                     SELECT *, row_number() OVER (PARTITION BY country ORDER BY {order}) AS r
                     FROM readings) WHERE r <= {n}""")


@query("first_row_per_key", _nth(1, '"index", event_id'))
def first_row_per_key(spark, sf):
    return L.first_n_per_key(B.readings(spark, sf).drop("user_id"), ["country"], ["index", "event_id"], 1)


@query("last_n_per_key", _nth(24, '"index" DESC, event_id DESC'))
def last_n_per_key(spark, sf):
    return L.last_n_per_key(B.readings(spark, sf).drop("user_id"), ["country"], ["index", "event_id"], 24)


@query("latest_per_key", _nth(1, '"index" DESC, event_id DESC'))
def latest_per_key(spark, sf):
    return L.latest_per_key(B.readings(spark, sf).drop("user_id"), ["country"], ["index", "event_id"])


@query(
    "head_per_key",
    sql("""SELECT country, "index", event_id, Actual_Load FROM readings WHERE country = 'click'
           ORDER BY "index", event_id LIMIT 336"""),
)
def head_per_key(spark, sf):
    """Two weeks of hours of one key: the report's own limit."""
    return L.head_of_key(
        B.readings(spark, sf).drop("user_id"), "country", "click", ["index", "event_id"], 336
    )


# ---- set operations --------------------------------------------------------------
@query(
    "union_by_name",
    sql("""SELECT country, "index", 'load' AS series, Actual_Load AS v FROM load
           UNION ALL SELECT country, "index", 'forecast', Forecasted_Load FROM forecast"""),
)
def union_by_name(spark, sf):
    a = B.load(spark, sf).select("country", "index", F.lit("load").alias("series"), F.col("Actual_Load").alias("v"))
    b = B.forecast(spark, sf).select(F.col("Forecasted_Load").alias("v"), F.lit("forecast").alias("series"), "index", "country")
    return a.unionByName(b)


@query(
    "union_all_sources",
    sql("""SELECT country, "index", Actual_Load, NULL::DOUBLE AS Value FROM load_readings
           UNION ALL SELECT country, "index", Actual_Load, NULL FROM readings
           UNION ALL SELECT from_country, "index", NULL, Value FROM flow_readings"""),
)
def union_all_sources(spark, sf):
    return T.union_sources(
        [
            B.load_readings(spark, sf).select("country", "index", "Actual_Load"),
            B.readings(spark, sf).select("country", "index", "Actual_Load"),
            B.flow_readings(spark, sf).select(F.col("from_country").alias("country"), "index", "Value"),
        ]
    )


@query("distinct_set", sql("""SELECT DISTINCT from_country, to_country FROM flow_readings"""))
def distinct_set(spark, sf):
    return B.flow_readings(spark, sf).select("from_country", "to_country").distinct()


@query(
    "split_disjoint",
    sql("""SELECT count(*) AS rows_all, count(*) FILTER (WHERE "index" IS NOT NULL) AS rows_in_parts,
                  0::BIGINT AS shared, 0::BIGINT AS missing FROM readings"""),
)
def split_disjoint(spark, sf):
    """The parts share no row and together hold every row with a time."""
    rows = B.readings(spark, sf).select("event_id", "index")
    parts = S.split_by_date(rows, splits=S.Splits("2024-01-18", "2024-01-25"))
    tagged = [p.withColumn("part", F.lit(i)) for i, p in enumerate(parts)]
    together = T.union_sources(tagged).groupBy("event_id").agg(F.count(F.lit(1)).alias("copies"))
    joined = rows.join(together, "event_id", "left")
    return joined.agg(
        F.count(F.lit(1)).alias("rows_all"),
        F.coalesce(F.sum("copies"), F.lit(0)).alias("rows_in_parts"),
        F.count_if(F.col("copies") > 1).alias("shared"),
        F.count_if(F.col("copies").isNull() & F.col("index").isNotNull()).alias("missing"),
    )


# ---- resampling ------------------------------------------------------------------
@query("hourly_mean", sql("""SELECT country, "index", round(Actual_Load, 6) AS Actual_Load FROM hourly"""))
def hourly_mean(spark, sf):
    return rounded(B.hourly(spark, sf), "Actual_Load")


@query(
    "edge_hourly_mean",
    sql("""SELECT from_country, to_country, date_trunc('month', "index") AS "index",
                  round(avg(Value), 4) AS Value FROM flow_readings GROUP BY 1, 2, 3"""),
)
def edge_hourly_mean(spark, sf):
    means = resample_mean(B.flow_readings(spark, sf), ["from_country", "to_country"], unit="month")
    return rounded(means, "Value", places=4)


@query(
    "edge_mean_by_hour",
    sql("""SELECT from_country, to_country, date_trunc('hour', "index") AS "index",
                  round(avg(Value), 4) AS Value FROM flow_readings GROUP BY 1, 2, 3"""),
)
def edge_mean_by_hour(spark, sf):
    means = resample_mean(B.flow_readings(spark, sf), ["from_country", "to_country"])
    return rounded(means, "Value", places=4)


@query(
    "net_flow_by_hour",
    sql("""SELECT country, "index", sum(signed) AS net_imports FROM (
             SELECT "index", unnest([{'country': to_country, 'signed': Value}, {'country': from_country, 'signed': -Value}], recursive := true)
             FROM (SELECT from_country, to_country, date_trunc('hour', "index") AS "index", round(avg(Value)) AS Value
                   FROM flow_readings GROUP BY 1, 2, 3))
           GROUP BY 1, 2"""),
)
def net_flow_by_hour(spark, sf):
    means = resample_mean(B.flow_readings(spark, sf), ["from_country", "to_country"])
    return flows.net_flow(means.withColumn("Value", F.round("Value")))


@query(
    "partition_counts",
    sql("""SELECT year("index")::INT AS year, month("index")::INT AS month, day("index")::INT AS day,
                  count(*) AS n FROM readings GROUP BY ALL"""),
)
def partition_counts(spark, sf):
    return T.scan_sql(
        spark,
        """SELECT year(index) AS year, month(index) AS month, day(index) AS day, count(*) AS n
           FROM {rows} GROUP BY ALL ORDER BY year, month, day""",
        rows=B.readings(spark, sf),
    )


@query(
    "current_period_counts",
    sql("""SELECT country, strftime("index", '%Y-%m-%d') AS date, count(*) AS n FROM readings GROUP BY 1, 2"""),
)
def current_period_counts(spark, sf):
    return with_periods(B.readings(spark, sf)).groupBy("country", "date").agg(F.count(F.lit(1)).alias("n"))
