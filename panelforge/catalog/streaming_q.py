"""Queries: the streaming jobs over the event files."""

from __future__ import annotations

from pyspark.sql import functions as F

from panelforge.catalog.registry import query, rounded
from panelforge.catalog.sqltext import with_fragments as sql
from panelforge.functions.timeparts import date_text
from panelforge.session import scratch_dir
from panelforge.sources import benchdata as B
from panelforge.streaming import jobs as J
from panelforge.streaming import live as V


def _events(spark, sf):
    schema = B.table(spark, sf, "events").schema
    return J.file_stream(spark, f"{sf}/events.parquet", schema)


def _readings(stream):
    return stream.select(
        F.col("event_type").alias("country"), B.utc("ts").alias("index"),
        B.cents("value").alias("Actual_Load"), "event_id",
    )


@query(
    "stream_hourly_mean",
    sql("""SELECT country, "index", round(Actual_Load, 6) AS Actual_Load FROM hourly"""),
)
def stream_hourly_mean(spark, sf):
    rows = _readings(_events(spark, sf)).drop("event_id")
    return rounded(J.hourly_mean(rows, "country", "index", "Actual_Load", scratch_dir(spark, "hours")), "Actual_Load")


@query("stream_dedupe", """SELECT event_id, event_type, ts, value FROM events""")
def stream_dedupe(spark, sf):
    """Every event is delivered twice."""
    rows = _events(spark, sf).select("event_id", "event_type", B.utc("ts").alias("ts"), "value")
    again = _events(spark, sf).select("event_id", "event_type", B.utc("ts").alias("ts"), "value")
    return J.deduplicated(rows.union(again), ["event_id"], "ts", scratch_dir(spark, "once"))


@query(
    "stream_partition_replace",
    sql("""SELECT strftime("index", '%Y-%m-%d') AS date, country, count(*) AS n, sum(Actual_Load) AS total
           FROM readings GROUP BY 1, 2"""),
)
def stream_partition_replace(spark, sf):
    """The job runs twice over the same input, the second time from the start; the
    table stays the same."""
    out = scratch_dir(spark, "days")
    for turn in range(2):
        rows = _readings(_events(spark, sf)).withColumn("date", date_text(F.col("index")))
        table = J.replace_days(rows, out, ["date"], ["event_id"], f"{out}/_checkpoint-{turn}")
    return table.groupBy("date", "country").agg(
        F.count(F.lit(1)).alias("n"), F.sum("Actual_Load").alias("total")
    )


@query(
    "stream_sliding_margin",
    sql(
        """SELECT country, window_end, round(avg(Actual_Load), 6) AS window_mean FROM spread GROUP BY 1, 2""",
        {"spread": """SELECT country, Actual_Load,
                             date_trunc('hour', "index") + INTERVAL 1 HOUR * h AS window_end
                      FROM readings, generate_series(1, 24) s(h)"""},
    ),
)
def stream_sliding_margin(spark, sf):
    rows = _readings(_events(spark, sf)).drop("event_id")
    means = J.sliding_mean(rows, "country", "index", "Actual_Load", scratch_dir(spark, "sliding"))
    return rounded(means, "window_mean")


@query(
    "stream_ffill_state",
    sql("""SELECT country, "index", event_id, last_value(value IGNORE NULLS) OVER (PARTITION BY country
             ORDER BY "index", event_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS filled
           FROM sparse_readings"""),
)
def stream_ffill_state(spark, sf):
    rows = _events(spark, sf).select(
        F.col("user_id").alias("country"), B.utc("ts").alias("index"), "event_id",
        F.when(F.col("event_type") == "purchase", B.cents("value")).alias("value"),
    )
    out = scratch_dir(spark, "filled")
    return J.fill_forward(rows, "country", ["index", "event_id"], "value", out).drop("value")


@query(
    "stream_late_data",
    """WITH hours AS (SELECT event_type AS country, date_trunc('hour', ts) AS "index", ts FROM events)
       SELECT country, "index", count(*) AS n,
              (SELECT count(*) FROM (SELECT DISTINCT country, "index" FROM hours WHERE ts < TIMESTAMP '2024-01-16')) AS late_groups_dropped
       FROM hours GROUP BY 1, 2
       HAVING "index" + INTERVAL 1 HOUR <= (SELECT max(ts) FROM events) - INTERVAL 1 HOUR""",
)
def stream_late_data(spark, sf):
    """All events arrive; then, in a second run, those of the first half of the month
    arrive again, too late: their groups are dropped and counted. That the second
    delivery is a part of the table is what is tested."""
    path, out = scratch_dir(spark, "arrivals"), scratch_dir(spark, "closed")
    events = B.table(spark, sf, "events")
    dropped = 0
    for rows in (events, events.filter(F.col("ts") < "2024-01-16")):
        rows.write.mode("append").parquet(path)
        stream = J.file_stream(spark, path, events.schema, files_per_batch=1_000_000)
        hours, now = J.closed_hours(_readings(stream), "country", "index", out)
        dropped += now
    return hours.withColumn("late_groups_dropped", F.lit(dropped).cast("long"))


# What the watermark has passed when the input is used up.
_PASSED = "(SELECT date_trunc('milliseconds', max(ts)) - INTERVAL 2 HOUR FROM events)"


@query(
    "stream_margin_join",
    f"""WITH a AS (SELECT event_type AS country, date_trunc('hour', ts) AS "index", avg(round(value * 100)) AS Actual_Load
                   FROM events WHERE user_id % 2 = 0 GROUP BY 1, 2),
             f AS (SELECT event_type AS country, date_trunc('hour', ts) AS "index", avg(round(value * 100)) AS Forecasted_Load
                   FROM events WHERE user_id % 2 = 1 GROUP BY 1, 2),
             passed AS (SELECT date_trunc('milliseconds', min(m)) - INTERVAL 2 HOUR AS at
                        FROM (SELECT max(ts) AS m FROM events GROUP BY user_id % 2)),
             hours AS (SELECT country, "index", Actual_Load, Forecasted_Load FROM a FULL JOIN f USING (country, "index"), passed
                       WHERE "index" + INTERVAL 1 HOUR <= passed.at),
             closed AS (SELECT *, avg(Actual_Load) OVER (PARTITION BY country ORDER BY "index" ROWS BETWEEN 24 PRECEDING AND CURRENT ROW) AS m
                          FROM hours WHERE Actual_Load IS NOT NULL)
        SELECT country, "index", round(Actual_Load, 6) AS Actual_Load, round(Forecasted_Load, 6) AS Forecasted_Load,
               round((m - Actual_Load) / nullif(m, 0), 6) + 0.0 AS reserve_margin_ml,
               round(abs(Forecasted_Load - Actual_Load) / nullif(Actual_Load + 1e-6, 0), 6) + 0.0 AS load_rel_error
        FROM closed""",
)
def stream_margin_join(spark, sf):
    """Two streams, of users with even and with odd ids, are load and forecast of each
    event type; they meet by hour, and the margin follows from the hours that are closed."""
    rows = _events(spark, sf).select(
        F.col("event_type").alias("country"), B.utc("ts").alias("index"), B.cents("value").alias("value"), "user_id"
    )
    again = _events(spark, sf).select(
        F.col("event_type").alias("country"), B.utc("ts").alias("index"), B.cents("value").alias("value"), "user_id"
    )
    load = rows.where("user_id % 2 = 0").select("country", "index", F.col("value").alias("Actual_Load"))
    ahead = again.where("user_id % 2 = 1").select("country", "index", F.col("value").alias("Forecasted_Load"))
    hours = V.joined_hours(load, ahead, "country", "index", "Actual_Load", "Forecasted_Load", scratch_dir(spark, "margin"))
    found = V.live_margin(hours, "country", "index", "Actual_Load", "Forecasted_Load")
    return rounded(
        found.select("country", "index", "Actual_Load", "Forecasted_Load", "reserve_margin_ml", "load_rel_error"),
        "Actual_Load", "Forecasted_Load", "reserve_margin_ml", "load_rel_error",
    )


@query(
    "stream_sliding_panes",
    sql(
        f"""SELECT country, window_end, round(avg(Actual_Load), 6) AS window_mean FROM spread
            WHERE window_end <= {_PASSED} GROUP BY 1, 2""",
        {"spread": """SELECT country, Actual_Load,
                             date_trunc('hour', "index") + INTERVAL 1 HOUR * h AS window_end
                      FROM readings, generate_series(1, 24) s(h)"""},
    ),
)
def stream_sliding_panes(spark, sf):
    """Windows of 24 hours by way of hourly panes, as far as they are closed."""
    rows = _readings(_events(spark, sf)).drop("event_id")
    return rounded(V.pane_mean(rows, "country", "index", "Actual_Load", scratch_dir(spark, "panes")), "window_mean")


@query(
    "stream_fill_store",
    sql(f"""SELECT country, "index", event_id, last_value(value IGNORE NULLS) OVER (PARTITION BY country
              ORDER BY "index", event_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS filled
            FROM sparse_readings WHERE "index" <= {_PASSED}"""),
)
def stream_fill_store(spark, sf):
    """The events arrive in three deliveries, each in a run of its own that goes on from
    the state of the one before; rows come out once the watermark has passed them."""
    path, out = scratch_dir(spark, "deliveries"), scratch_dir(spark, "store")
    events = B.table(spark, sf, "events")
    for part in ("ts < '2024-01-11'", "ts >= '2024-01-11' AND ts < '2024-01-21'", "ts >= '2024-01-21'"):
        events.where(part).write.mode("append").parquet(path)
        rows = J.file_stream(spark, path, events.schema, files_per_batch=1_000_000).select(
            F.col("user_id").alias("country"), B.utc("ts").alias("index"), "event_id",
            F.when(F.col("event_type") == "purchase", B.cents("value")).alias("value"),
        )
        filled = V.fill_live(rows, "country", "index", "event_id", "value", out)
    return filled.select("country", "index", "event_id", "filled")
