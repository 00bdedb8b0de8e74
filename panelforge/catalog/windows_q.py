"""Queries: ordered and grouped windows.

Queries on raw readings work in time blocks, since a key may hold any number of
readings. Queries on panels window whole keys: one row per key and period.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from panelforge.catalog.registry import query, rounded
from panelforge.catalog.sqltext import with_fragments as sql
from panelforge.operators import blocks as K
from panelforge.operators.joins import with_group_stats
from panelforge.operators.percentiles import exact_percentiles
from panelforge.operators.profile import share_of_total
from panelforge.operators.scores import with_reserve_margin
from panelforge.sources import benchdata as B

SPAN = "auto"   # blocks of counted rows
ORDER = ["index", "event_id"]


def _raw(spark, sf):
    return B.readings(spark, sf).drop("user_id")


def _over(frame: str) -> str:
    return f"""OVER (PARTITION BY country ORDER BY "index", event_id {frame})"""


@query(
    "trailing_avg_25",
    sql("""SELECT country, "index", round(avg(Actual_Load) OVER (PARTITION BY country ORDER BY "index"
                  ROWS BETWEEN 24 PRECEDING AND CURRENT ROW), 6) AS load_trailing_avg FROM hourly"""),
)
def trailing_avg_25(spark, sf):
    """25 rows of the hourly panel, current one included; gaps are not counted."""
    rows = with_reserve_margin(B.hourly(spark, sf)).drop("Actual_Load", "reserve_margin_ml")
    return rounded(rows, "load_trailing_avg")


@query(
    "trailing_avg_25_raw",
    sql(f"""SELECT country, "index", event_id, round(avg(Actual_Load)
                   {_over('ROWS BETWEEN 24 PRECEDING AND CURRENT ROW')}, 6) AS load_trailing_avg
            FROM readings"""),
)
def trailing_avg_25_raw(spark, sf):
    rows = with_reserve_margin(_raw(spark, sf), order=ORDER, span=SPAN)
    return rounded(rows.drop("Actual_Load", "reserve_margin_ml"), "load_trailing_avg")


@query(
    "trailing_avg_24h_range",
    sql("""SELECT country, "index", round(avg(Actual_Load) OVER (PARTITION BY country ORDER BY "index"
                  RANGE BETWEEN INTERVAL 24 HOUR PRECEDING AND CURRENT ROW), 6) AS day_avg FROM hourly"""),
)
def trailing_avg_24h_range(spark, sf):
    """The same by time instead of rows."""
    from pyspark.sql import Window

    day = Window.partitionBy("country").orderBy(F.unix_seconds("index")).rangeBetween(-86400, 0)
    rows = B.hourly(spark, sf).select("country", "index", F.avg("Actual_Load").over(day).alias("day_avg"))
    return rounded(rows, "day_avg")


@query(
    "partition_avg",
    sql("""SELECT event_id, country, round(avg(Actual_Load) OVER (PARTITION BY country), 6) AS key_mean
           FROM readings"""),
)
def partition_avg(spark, sf):
    rows = with_group_stats(_raw(spark, sf), ["country"], {"key_mean": F.avg("Actual_Load")})
    return rounded(rows.select("event_id", "country", "key_mean"), "key_mean")


@query(
    "partition_percentile",
    sql("""SELECT event_id, country, p10, p50, p90 FROM readings JOIN (
             SELECT country, quantile_disc(Actual_Load, 0.1) AS p10, quantile_disc(Actual_Load, 0.5) AS p50,
                    quantile_disc(Actual_Load, 0.9) AS p90 FROM readings GROUP BY 1) USING (country)"""),
)
def partition_percentile(spark, sf):
    """Exact percentiles of raw readings, without one task holding a key."""
    rows = _raw(spark, sf).select("event_id", "country", "Actual_Load")
    limits = exact_percentiles(rows, ["country"], "Actual_Load", {"p10": 0.1, "p50": 0.5, "p90": 0.9})
    return rows.join(limits, "country", "left").drop("Actual_Load")


def _last(source: str = "value") -> str:
    return f"""last_value({source} IGNORE NULLS) {_over('ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW')}"""


def _next(source: str = "value") -> str:
    return f"""first_value({source} IGNORE NULLS) {_over('ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING')}"""


@query("ffill", sql(f"""SELECT country, "index", event_id, {_last()} AS filled FROM sparse_readings"""))
def ffill(spark, sf):
    rows = B.sparse_readings(spark, sf)
    return K.fill_frames(rows, ["country"], ORDER, forward={"filled": "value"}, span=SPAN).drop("value")


@query("bfill", sql(f"""SELECT country, "index", event_id, {_next()} AS filled FROM sparse_readings"""))
def bfill(spark, sf):
    rows = B.sparse_readings(spark, sf)
    return K.fill_frames(rows, ["country"], ORDER, backward={"filled": "value"}, span=SPAN).drop("value")


@query(
    "ffill_bfill",
    sql(f"""SELECT country, "index", event_id, coalesce({_last()}, {_next()}) AS filled FROM sparse_readings"""),
)
def ffill_bfill(spark, sf):
    rows = B.sparse_readings(spark, sf)
    return K.fill_frames(rows, ["country"], ORDER, both={"filled": "value"}, span=SPAN).drop("value")


def _framed(spark, sf, columns, before=0, after=0):
    return K.row_frames(
        _raw(spark, sf), ["country"], ORDER, columns, before=before, after=after, span=SPAN
    ).drop("Actual_Load")


LOAD = "Actual_Load"


@query(
    "lag_features",
    sql(f"""SELECT country, "index", event_id, lag(Actual_Load, 1) {_over('')} AS load_lag_1h,
                   lag(Actual_Load, 24) {_over('')} AS load_lag_24h FROM readings"""),
)
def lag_features(spark, sf):
    return _framed(
        spark, sf,
        lambda w: {"load_lag_1h": F.lag(LOAD, 1).over(w), "load_lag_24h": F.lag(LOAD, 24).over(w)},
        before=24,
    )


@query(
    "lead_features",
    sql(f"""SELECT country, "index", event_id, lead(Actual_Load, 24) {_over('')} AS load_lead_24h
            FROM readings"""),
)
def lead_features(spark, sf):
    return _framed(spark, sf, lambda w: {"load_lead_24h": F.lead(LOAD, 24).over(w)}, after=24)


@query(
    "diff_features",
    sql(f"""SELECT country, "index", event_id, Actual_Load - lag(Actual_Load, 1) {_over('')} AS load_change_1h,
                   Actual_Load - lag(Actual_Load, 24) {_over('')} AS load_change_24h FROM readings"""),
)
def diff_features(spark, sf):
    return _framed(
        spark, sf,
        lambda w: {
            "load_change_1h": F.col(LOAD) - F.lag(LOAD, 1).over(w),
            "load_change_24h": F.col(LOAD) - F.lag(LOAD, 24).over(w),
        },
        before=24,
    )


@query(
    "rolling_mean_24",
    sql(f"""SELECT country, "index", event_id, round(avg(Actual_Load)
                   {_over('ROWS BETWEEN 23 PRECEDING AND CURRENT ROW')}, 6) AS mean_24 FROM readings"""),
)
def rolling_mean_24(spark, sf):
    rows = _framed(spark, sf, lambda w: {"mean_24": F.avg(LOAD).over(w.rowsBetween(-23, 0))}, before=23)
    return rounded(rows, "mean_24")


@query(
    "rolling_std_24",
    sql(f"""SELECT country, "index", event_id, round(stddev_samp(Actual_Load)
                   {_over('ROWS BETWEEN 23 PRECEDING AND CURRENT ROW')}, 4) + 0.0 AS std_24 FROM readings"""),
)
def rolling_std_24(spark, sf):
    rows = _framed(
        spark, sf, lambda w: {"std_24": F.stddev_samp(LOAD).over(w.rowsBetween(-23, 0))}, before=23
    )
    return rounded(rows, "std_24", places=4)


@query(
    "lagged_rolling_mean",
    sql(f"""SELECT country, "index", event_id, round(avg(Actual_Load)
                   {_over('ROWS BETWEEN 24 PRECEDING AND 1 PRECEDING')}, 6) AS mean_before FROM readings"""),
)
def lagged_rolling_mean(spark, sf):
    rows = _framed(
        spark, sf, lambda w: {"mean_before": F.avg(LOAD).over(w.rowsBetween(-24, -1))}, before=24
    )
    return rounded(rows, "mean_before")


@query(
    "group_transform_mean",
    sql("""SELECT event_id, round(avg(Actual_Load) OVER (PARTITION BY country, hour("index")), 6) AS hourly_avg,
                  round(avg(Actual_Load) OVER (PARTITION BY country, isodow("index")), 6) AS daily_avg
           FROM readings"""),
)
def group_transform_mean(spark, sf):
    rows = _seasonal(spark, sf)
    return rounded(rows.select("event_id", "hourly_avg", "daily_avg"), "hourly_avg", "daily_avg")


def _seasonal(spark, sf):
    rows = _raw(spark, sf).withColumns({"hour": F.hour("index"), "day_of_week": F.weekday("index")})
    mean = F.avg(LOAD)
    rows = with_group_stats(rows, ["country", "hour"], {"hourly_avg": mean})
    return with_group_stats(rows, ["country", "day_of_week"], {"daily_avg": mean})


@query(
    "seasonal_deviation",
    sql("""SELECT event_id,
                  round(Actual_Load - avg(Actual_Load) OVER (PARTITION BY country, hour("index")), 6) + 0.0 AS from_hour,
                  round(Actual_Load - avg(Actual_Load) OVER (PARTITION BY country, isodow("index")), 6) + 0.0 AS from_day
           FROM readings"""),
)
def seasonal_deviation(spark, sf):
    rows = _seasonal(spark, sf).select(
        "event_id",
        (F.col(LOAD) - F.col("hourly_avg")).alias("from_hour"),
        (F.col(LOAD) - F.col("daily_avg")).alias("from_day"),
    )
    return rounded(rows, "from_hour", "from_day")


@query(
    "share_of_total",
    sql("""SELECT country, total, round(total * 100.0 / sum(total) OVER (), 6) AS pct
           FROM (SELECT country, sum(Actual_Load) AS total FROM readings GROUP BY 1)"""),
)
def share_of_total_query(spark, sf):
    sums = B.readings(spark, sf).groupBy("country").agg(F.sum(LOAD).alias("total"))
    return rounded(share_of_total(sums, "total"), "pct")
