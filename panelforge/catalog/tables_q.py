"""Queries: scans, sources, sinks and table management."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from panelforge.catalog.registry import money, query, rounded
from panelforge.catalog.sqltext import with_fragments as sql
from panelforge.operators.columns import with_periods
from panelforge.operators.resample import group_mean
from panelforge.session import scratch_dir
from panelforge.sources import benchdata as B
from panelforge.sources import grid_source as grid_files
from panelforge.sources import grids
from panelforge.sources import tables as T
from panelforge.sources.changes import load_changed
from panelforge.sources.layout import write_clustered


def _fresh(spark, label):
    """A new table name and a new folder for it."""
    return f"{label}_{uuid.uuid4().hex[:12]}", scratch_dir(spark, label)


def _dated(spark, sf):
    return with_periods(B.load_readings(spark, sf).select("country", "index", "Actual_Load"))


DATED = """SELECT country, "index", Actual_Load, strftime("index", '%Y-%m-%d') AS date,
                  strftime("index", '%Y-%m') AS month FROM load_readings"""
LOADS = """SELECT country, count(*) AS n, sum(Actual_Load) AS total FROM load_readings GROUP BY 1"""
MONTHLY = """SELECT country, month, count(*) AS n, sum(Actual_Load) AS total
             FROM dated GROUP BY 1, 2"""


def _by_country(df):
    return df.groupBy("country").agg(
        F.count(F.lit(1)).alias("n"), F.sum("Actual_Load").alias("total")
    )


def _by_month(df):
    return df.groupBy("country", "month").agg(
        F.count(F.lit(1)).alias("n"), F.sum("Actual_Load").alias("total")
    )


@query("scan_table", """SELECT n_nationkey, n_name, n_regionkey FROM nation""")
def scan_table(spark, sf):
    return T.scan(spark, f"{sf}/nation.parquet")


@query(
    "scan_sql",
    """SELECT event_type, count(*) AS n, max(event_id) AS last_id FROM events GROUP BY event_type""",
)
def scan_sql(spark, sf):
    return T.scan_sql(
        spark,
        "SELECT event_type, count(*) AS n, max(event_id) AS last_id FROM {events} GROUP BY event_type",
        events=B.table(spark, sf, "events"),
    )


PRIORITIES = [("1-URGENT", 1, True), ("2-HIGH", 2, True), ("3-MEDIUM", 3, True),
              ("4-NOT SPECIFIED", 4, False), ("5-LOW", 5, False)]


@query(
    "local_rows",
    """SELECT rank, ahead, count(*) AS n FROM orders JOIN (VALUES ('1-URGENT', 1, true),
       ('2-HIGH', 2, true), ('3-MEDIUM', 3, true), ('4-NOT SPECIFIED', 4, false),
       ('5-LOW', 5, false)) t(o_orderpriority, rank, ahead) USING (o_orderpriority)
       GROUP BY 1, 2""",
)
def local_rows(spark, sf):
    """Literal rows with an explicit schema, used as a dimension of the orders."""
    dim = T.local_rows(spark, PRIORITIES, "o_orderpriority string, rank int, ahead boolean")
    orders = B.table(spark, sf, "orders")
    return orders.join(dim, "o_orderpriority").groupBy("rank", "ahead").agg(
        F.count(F.lit(1)).alias("n")
    )


STATS = """SELECT country, round(avg(Actual_Load), 2) AS Actual_Load,
                  round(avg(Forecasted_Load), 2) AS Forecasted_Load
           FROM load_readings GROUP BY 1"""


def _stats(spark, sf):
    return money(
        group_mean(
            B.load_readings(spark, sf), ["country"],
            {"Actual_Load": "Actual_Load", "Forecasted_Load": "Forecasted_Load"},
        ),
        "Actual_Load", "Forecasted_Load",
    )


@query("csv_write", sql(STATS))
def csv_write(spark, sf):
    """Per-key statistics to CSV; the check reads the files back as text."""
    path = scratch_dir(spark, "stats_csv")
    T.write_csv(_stats(spark, sf), path)
    back = spark.read.option("header", True).csv(path)
    return back.select(
        "country", *[F.col(c).cast("double").alias(c) for c in ("Actual_Load", "Forecasted_Load")]
    )


@query("csv_read", sql(STATS))
def csv_read(spark, sf):
    path = scratch_dir(spark, "stats_csv")
    T.write_csv(_stats(spark, sf), path)
    return T.read_csv(spark, path, "country string, Actual_Load double, Forecasted_Load double")


@query("table_overwrite", sql(LOADS))
def table_overwrite(spark, sf):
    name, path = _fresh(spark, "overwrite")
    rows = B.load_readings(spark, sf).select("country", "index", "Actual_Load")
    T.overwrite_table(rows.filter(F.col("Actual_Load") > 0), name, path)
    T.overwrite_table(rows, name, path)
    return _by_country(spark.table(name))


@query("overwrite_schema", sql(MONTHLY, {"dated": DATED}))
def overwrite_schema(spark, sf):
    """The second write brings other columns than the first."""
    name, path = _fresh(spark, "schema")
    T.overwrite_table(B.load_readings(spark, sf), name, path)
    T.overwrite_table(_dated(spark, sf).drop("date"), name, path)
    return _by_month(spark.table(name))


DAILY = {"days": """SELECT country, "index", Actual_Load, strftime("index", '%Y-%m-%d') AS date
                    FROM readings"""}
BY_DAY = """SELECT country, date, count(*) AS n, sum(Actual_Load) AS total
            FROM days GROUP BY 1, 2"""


def _days(spark, sf):
    return with_periods(B.readings(spark, sf).select("country", "index", "Actual_Load")).drop("month")


def _read_days(spark, path):
    """Folder names such as date=2024-01-05 come back as dates."""
    back = spark.read.parquet(path).withColumn("date", F.date_format("date", "yyyy-MM-dd"))
    return back.groupBy("country", "date").agg(
        F.count(F.lit(1)).alias("n"), F.sum("Actual_Load").alias("total")
    )


@query("partitioned_create", sql(BY_DAY, DAILY))
def partitioned_create(spark, sf):
    path = scratch_dir(spark, "partitioned")
    T.write_partitioned(_days(spark, sf), path, ["country", "date"])
    return _read_days(spark, path)


@query(
    "partition_replace",
    sql(
        """SELECT country, date, count(*) AS n,
                  sum(CASE WHEN date >= '2024-01-20' THEN 2 * Actual_Load ELSE Actual_Load END) AS total
           FROM days GROUP BY 1, 2""",
        DAILY,
    ),
)
def partition_replace(spark, sf):
    """Replace the later days, twice; the earlier ones stay as they are."""
    path = scratch_dir(spark, "replace")
    rows = _days(spark, sf)
    T.write_partitioned(rows, path, ["country", "date"])
    batch = rows.filter(F.col("date") >= "2024-01-20").withColumn(
        "Actual_Load", F.col("Actual_Load") * 2
    )
    T.replace_partitions(batch, path, ["country", "date"])
    T.replace_partitions(batch, path, ["country", "date"])
    return _read_days(spark, path)


@query(
    "schema_merge",
    sql("""SELECT country, "index", Actual_Load, NULL::DOUBLE AS Forecasted_Load FROM load
           UNION ALL SELECT country, "index", NULL, Forecasted_Load FROM forecast"""),
)
def schema_merge(spark, sf):
    path = scratch_dir(spark, "evolving")
    T.append(B.load(spark, sf), path)
    T.append(B.forecast(spark, sf), path)
    return T.read_evolving(spark, path).select("country", "index", "Actual_Load", "Forecasted_Load")


@query("full_reload", sql(LOADS))
def full_reload(spark, sf):
    name, path = _fresh(spark, "reload")
    rows = B.load_readings(spark, sf).select("country", "index", "Actual_Load")
    T.overwrite_table(rows, name, path)
    T.full_reload(rows, name, scratch_dir(spark, "reload"))
    return _by_country(spark.table(name))


@query("create_or_replace_branch", sql(BY_DAY, DAILY))
def create_or_replace_branch(spark, sf):
    """First batch creates the table, the second replaces its days."""
    path = scratch_dir(spark, "branch")
    rows = _days(spark, sf)
    parts = ["country", "date"]
    T.create_or_replace_partitions(rows.filter(F.col("date") <= "2024-01-20"), path, parts)
    T.create_or_replace_partitions(rows.filter(F.col("date") > "2024-01-10"), path, parts)
    return _read_days(spark, path)


@query(
    "partition_columns",
    sql("""SELECT n, place, column_name FROM (SELECT count(*) AS n FROM readings),
             (VALUES (0, 'country'), (1, 'date')) t(place, column_name)"""),
)
def partition_columns(spark, sf):
    """Partition columns of a table written from the data, with its row count."""
    name, path = _fresh(spark, "parts")
    T.overwrite_table(_days(spark, sf), name, path, ["country", "date"])
    found = F.array(*[F.lit(c) for c in T.partition_columns(spark, name)])
    return spark.table(name).agg(F.count(F.lit(1)).alias("n")).select(
        "n", F.posexplode(found).alias("place", "column_name")
    )


@query(
    "add_backfill_column",
    sql("""SELECT country, "index", Actual_Load, strftime("index", '%Y-%m-%d') AS date FROM load"""),
)
def add_backfill_column(spark, sf):
    rows = B.load(spark, sf)
    part = rows.withColumn("date", F.when(F.month("index") <= 6, F.date_format("index", "yyyy-MM-dd")))
    path = scratch_dir(spark, "backfill")
    T.backfill_date(T.backfill_date(part)).write.parquet(path)
    return spark.read.parquet(path)


@query("repartition_migration", sql(LOADS))
def repartition_migration(spark, sf):
    name, path = _fresh(spark, "migrate")
    T.overwrite_table(
        B.load_readings(spark, sf).select("country", "index", "Actual_Load"), name, path, ["country"]
    )
    T.unpartition_table(spark, name, scratch_dir(spark, "migrate"))
    assert T.partition_columns(spark, name) == []
    return _by_country(spark.table(name))


@query(
    "load_lineage",
    sql("""SELECT year("index")::INT AS year, month("index")::INT AS month,
                  day("index")::INT AS day,
                  'readings_all_' || strftime("index", '%Y%m%d') || '.bin' AS source_file,
                  'run-1' AS load_id, count(*) AS n
           FROM readings GROUP BY ALL"""),
)
def load_lineage(spark, sf):
    """Day parts come out of the file name."""
    file = F.concat(F.lit("readings_all_"), F.date_format("index", "yyyyMMdd"), F.lit(".bin"))
    stamped = T.with_lineage(B.readings(spark, sf), "run-1", file, file)
    return stamped.filter(F.col("load_ts").isNotNull()).groupBy(
        "year", "month", "day", "source_file", "load_id"
    ).agg(F.count(F.lit(1)).alias("n"))


@query(
    "table_profile",
    sql("""SELECT 'load' AS table_name, count(*) AS row_count, 3::BIGINT AS column_count FROM load
           UNION ALL SELECT 'forecast', count(*), 3 FROM forecast
           UNION ALL SELECT 'flow', count(*), 4 FROM flow
           UNION ALL SELECT 'generation', count(*), 6 FROM generation
           UNION ALL SELECT 'weather', count(*), 5 FROM weather"""),
)
def table_profile(spark, sf):
    return T.table_profile(
        {
            "load": B.load(spark, sf),
            "forecast": B.forecast(spark, sf),
            "flow": B.flow(spark, sf),
            "generation": B.generation(spark, sf),
            "weather": B.weather(spark, sf),
        }
    )


@query(
    "grid_flatten",
    sql(
        """SELECT "timestamp", pos, (50 - pos // 8)::DOUBLE AS lat, (5 + pos % 8)::DOUBLE AS lon,
                  u10, v10, t2m, ssrd, round(sqrt(u10 * u10 + v10 * v10), 6) + 0.0 AS wind_speed,
                  round(t2m - 273.15::DOUBLE, 6) + 0.0 AS temperature_c
           FROM cells""",
        {
            "exploded": """SELECT "timestamp", short_name, unnest("values") AS v,
                                  (generate_subscripts("values", 1) - 1)::INT AS pos FROM messages""",
            "cells": """SELECT "timestamp", pos,
                               max(v) FILTER (WHERE short_name = '10u') AS u10,
                               max(v) FILTER (WHERE short_name = '10v') AS v10,
                               max(v) FILTER (WHERE short_name = '2t') AS t2m,
                               max(v) FILTER (WHERE short_name = 'ssrd') AS ssrd
                        FROM exploded GROUP BY 1, 2""",
        },
    ),
)
def grid_flatten(spark, sf):
    cells = spark.range(64).select(
        F.col("id").cast("int").alias("pos"),
        F.expr("CAST(50 - id div 8 AS DOUBLE)").alias("lat"),
        F.expr("CAST(5 + id % 8 AS DOUBLE)").alias("lon"),
    )
    return rounded(
        grids.flatten_grid(B.grid_messages(spark, sf), cells), "wind_speed", "temperature_c"
    )


_CELLS = {
    "exploded": """SELECT "timestamp", short_name, unnest("values") AS v,
                          (generate_subscripts("values", 1) - 1)::INT AS pos FROM messages WHERE (epoch_us("timestamp") // 3600000000) % 2 = 0""",
    "cells": """SELECT "timestamp", pos, max(v) FILTER (WHERE short_name = '10u') AS u10, max(v) FILTER (WHERE short_name = '10v') AS v10,
                       max(v) FILTER (WHERE short_name = '2t') AS t2m, max(v) FILTER (WHERE short_name = 'ssrd') AS ssrd
                FROM exploded WHERE "timestamp" >= TIMESTAMP '1970-01-03' GROUP BY 1, 2""",
}


@query(
    "grid_source",
    sql(
        """SELECT "timestamp", pos, (50 - pos // 8)::DOUBLE AS lat, (5 + pos % 8)::DOUBLE AS lon,
                  u10, v10, t2m, ssrd, round(sqrt(u10 * u10 + v10 * v10), 6) + 0.0 AS wind_speed,
                  round(t2m - 273.15::DOUBLE, 6) + 0.0 AS temperature_c
           FROM cells""",
        _CELLS,
    ),
)
def grid_source(spark, sf):
    """Messages of every second hour, written as grid files and read by the data source
    from the third day on: earlier files aren't opened."""
    path = scratch_dir(spark, "grids")
    messages = B.grid_messages(spark, sf)
    grid_files.write_messages(messages.where(F.floor(F.unix_seconds("timestamp") / 3600) % 2 == 0), path)
    read = grid_files.read_messages(spark, path).where(F.col("timestamp") >= F.lit("1970-01-03").cast("timestamp"))
    read = read.withColumn("values", F.col("values").cast("array<double>"))
    cells = spark.range(64).select(
        F.col("id").cast("int").alias("pos"), F.expr("CAST(50 - id div 8 AS DOUBLE)").alias("lat"), F.expr("CAST(5 + id % 8 AS DOUBLE)").alias("lon")
    )
    return rounded(grids.flatten_grid(read, cells), "wind_speed", "temperature_c")


@query(
    "clustered_layout",
    """SELECT event_id, user_id, event_type, value FROM events
       WHERE user_id < 40 AND ts >= TIMESTAMP '2024-01-10' AND ts < TIMESTAMP '2024-01-12'""",
)
def clustered_layout(spark, sf):
    """Events laid out along a curve through user and time, then read by both."""
    path = scratch_dir(spark, "clustered")
    write_clustered(B.table(spark, sf, "events"), path, ["user_id", "ts"], files=8)
    rows = spark.read.parquet(path).where("user_id < 40 AND ts >= '2024-01-10' AND ts < '2024-01-12'")
    return rows.select("event_id", "user_id", "event_type", "value")


@query(
    "load_changed",
    sql(
        """SELECT month, count(*) AS n, sum(Actual_Load + CASE WHEN month LIKE '%-03' THEN 1 ELSE 0 END) AS total,
                  CASE WHEN month LIKE '%-03' THEN 'written' END AS change
           FROM dated WHERE month NOT LIKE '%-11' GROUP BY 1
           UNION ALL SELECT DISTINCT month, 0, NULL, 'removed' FROM dated WHERE month LIKE '%-11'""",
        {"dated": DATED},
    ),
)
def load_changed_query(spark, sf):
    """A table loaded twice: the second time the Marches differ, the Novembers are gone,
    and all other partitions hold the same rows in another order. Only the former are
    written or removed."""
    path, keys = scratch_dir(spark, "loads"), ["month"]
    rows = _dated(spark, sf).select("country", "month", "index", "Actual_Load")
    load_changed(rows, path, keys)
    march = F.col("month").endswith("-03")
    later = rows.where(~F.col("month").endswith("-11")).withColumn("Actual_Load", F.col("Actual_Load") + F.when(march, 1).otherwise(0))
    changes = load_changed(later.orderBy("Actual_Load"), path, keys)
    table = spark.read.schema(rows.schema).parquet(path).groupBy("month").agg(F.count(F.lit(1)).alias("n"), F.sum("Actual_Load").alias("total"))
    return table.join(changes, keys, "full").select(*keys, F.coalesce("n", F.lit(0)).alias("n"), "total", "change")


@query(
    "sample_rows",
    """SELECT event_id, event_type, value FROM events
       ORDER BY md5('42|' || event_id::VARCHAR) LIMIT 100""",
)
def sample_rows(spark, sf):
    """The sampling operator: 100 rows, the same on every run."""
    rows = B.table(spark, sf, "events").select("event_id", "event_type", "value")
    return T.hashed_sample(rows, "event_id", 100)
