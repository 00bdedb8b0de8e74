"""Queries: projections, filters and column choice."""

from __future__ import annotations

from datetime import date

from pyspark.sql import functions as F

from panelforge.catalog.registry import query, rounded
from panelforge.catalog.sqltext import with_fragments as sql
from panelforge.functions import names as N
from panelforge.functions import timeparts as TP
from panelforge.operators import columns as C
from panelforge.operators import flows
from panelforge.operators import splits as S
from panelforge.operators.scores import score_panel
from panelforge.sources import benchdata as B


@query("project", sql("""SELECT country, "index", Actual_Load FROM load_readings"""))
def project(spark, sf):
    return B.load_readings(spark, sf).select("country", "index", "Actual_Load")


@query("rename", sql("""SELECT country, "index" AS "timestamp", Actual_Load AS load FROM load"""))
def rename(spark, sf):
    return C.rename(B.load(spark, sf), {"index": "timestamp", "Actual_Load": "load"})


@query(
    "drop_columns",
    sql("""SELECT country, "index", Nuclear__Actual_Aggregated, Biomass__Actual_Consumption,
                  Marine__Actual_Aggregated FROM generation"""),
)
def drop_columns(spark, sf):
    """Legacy columns go; names that are not there are ignored."""
    old = B.generation(spark, sf).withColumnRenamed("Solar__Actual_Aggregated", "Solar")
    return C.drop_legacy(old)


KEPT = ("NATION_1", "NATION_3", "NATION_5", "NATION_7", "NATION_9", "NATION_11")
KEPT_SQL = ", ".join(f"'{k}'" for k in KEPT)


@query("filter_in", sql(f"""SELECT country, "index", Actual_Load FROM load_readings
                            WHERE country IN ({KEPT_SQL})"""))
def filter_in(spark, sf):
    rows = B.load_readings(spark, sf).select("country", "index", "Actual_Load")
    return rows.filter(F.col("country").isin(*KEPT))


@query("filter_not_in", sql(f"""SELECT country, "index", Actual_Load FROM load_readings
                                WHERE country NOT IN ({KEPT_SQL})"""))
def filter_not_in(spark, sf):
    rows = B.load_readings(spark, sf).select("country", "index", "Actual_Load")
    return rows.filter(~F.col("country").isin(*KEPT))


@query("numeric_columns", """SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, l_quantity,
       l_extendedprice, l_discount, l_tax FROM lineitem""")
def numeric_columns(spark, sf):
    items = B.table(spark, sf, "lineitem")
    return items.select(*C.numeric_columns(items))


@query(
    "suffix_columns",
    sql("""SELECT Nuclear__Actual_Aggregated, Solar__Actual_Aggregated, Biomass__Actual_Consumption,
                  Marine__Actual_Aggregated FROM generation"""),
)
def suffix_columns(spark, sf):
    rows = B.generation(spark, sf)
    return rows.select(*C.suffix_columns(rows))


@query(
    "leakage_check",
    sql("""SELECT 'forecast_load_error' AS column_name, count(forecast_load_error) AS known FROM scored
           UNION ALL SELECT 'load_rel_error', count(load_rel_error) FROM scored
           UNION ALL SELECT 'net_imports', count(net_imports) FROM scored
           UNION ALL SELECT 'reserve_margin_ml', count(reserve_margin_ml) FROM scored"""),
)
def leakage_check(spark, sf):
    """Columns that would leak the target, with their number of known values."""
    scored = score_panel(B.panel(spark, sf, with_supply=False))
    bad = C.leaking_columns(scored.columns)
    return scored.agg(*[F.count(c).alias(c) for c in bad]).unpivot(
        [], bad, "column_name", "known"
    )


SPARSE_SQL = """SELECT country, "index", Nuclear__Actual_Aggregated, Solar__Actual_Aggregated,
                       Biomass__Actual_Consumption FROM generation"""


@query("sparse_columns", sql(SPARSE_SQL))
def sparse_columns(spark, sf):
    """Columns with less than 80 % NULLs stay."""
    rows = B.generation(spark, sf)
    return rows.select("country", "index", *C.dense_columns(rows, C.suffix_columns(rows)))


@query("all_null_columns", sql(SPARSE_SQL))
def all_null_columns(spark, sf):
    rows = B.generation(spark, sf)
    return C.drop_all_null(rows, C.suffix_columns(rows))


@query("existing_columns", sql("""SELECT Actual_Load, "index" FROM load"""))
def existing_columns(spark, sf):
    rows = B.load(spark, sf)
    return rows.select(*C.existing_columns(rows, ["Actual_Load", "load_lag_1h", "index", "index"]))


@query(
    "sanitize_columns",
    """SELECT 'Order_status_' || o_orderstatus AS label, count(*) AS n_orders,
              sum(round(o_totalprice * 100)) AS _2nd_total__EUR_
       FROM orders GROUP BY o_orderstatus""",
)
def sanitize_columns(spark, sf):
    raw = B.table(spark, sf, "orders").groupBy("o_orderstatus").agg(
        F.count(F.lit(1)).alias(" n orders "), F.sum(B.cents("o_totalprice")).alias("2nd total (EUR)")
    )
    label = N.tidy_text(F.concat(F.lit(" Order status/"), F.col("o_orderstatus")))
    return N.clean_names(raw.withColumn("label", label).drop("o_orderstatus"))


@query(
    "flatten_header",
    """SELECT o_orderkey, o_totalprice AS "Order__Price", o_orderstatus AS "Order__State__Code"
       FROM orders""",
)
def flatten_header(spark, sf):
    """Nested headers become names joined by two underscores."""
    nested = B.table(spark, sf, "orders").select(
        "o_orderkey",
        F.struct(
            F.col("o_totalprice").alias("Price"),
            F.struct(F.col("o_orderstatus").alias("Code")).alias("State"),
        ).alias("Order"),
    )
    return N.flatten_structs(nested)


@query(
    "duplicate_columns",
    sql("""SELECT 'actual_load' AS column_name, 2::BIGINT AS occurrences,
                  (SELECT count(*) FROM load JOIN forecast USING (country, "index")) AS row_count"""),
)
def duplicate_columns(spark, sf):
    """Names that a join brought in twice, with the join's row count."""
    joined = B.load(spark, sf).join(
        B.forecast(spark, sf).withColumnRenamed("Forecasted_Load", "actual_load"), B.KEYS
    )
    lines = [
        F.struct(F.lit(c).alias("column_name"), F.lit(n).cast("long").alias("occurrences"))
        for c, n in C.duplicate_columns(joined)
    ]
    return joined.agg(F.count(F.lit(1)).alias("row_count")).select(
        "row_count", F.inline(F.array(*lines))
    )


@query("canonical_value", sql("""SELECT country, "index", Actual_Load AS Value FROM load_readings"""))
def canonical_value(spark, sf):
    return C.canonical_value(B.load_readings(spark, sf), ["country", "index"])


@query("detect_timestamp", """SELECT event_id, ts AS "index" FROM events""")
def detect_timestamp(spark, sf):
    """None of the usual names holds a readable time, so a later column wins."""
    rows = B.table(spark, sf, "events").select(
        "event_id",
        F.col("event_type").alias("time"),
        F.date_format("ts", "yyyy-MM-dd HH:mm:ss.SSSSSS").alias("seen_at"),
    )
    found = C.detect_timestamp(rows)
    return rows.select("event_id", F.try_to_timestamp(F.col(found)).alias("index"))


@query(
    "derive_periods",
    """SELECT o_orderkey, strftime(o_orderdate, '%Y-%m-%d') AS date,
              strftime(o_orderdate, '%Y-%m') AS month FROM orders""",
)
def derive_periods(spark, sf):
    return C.with_periods(B.table(spark, sf, "orders"), "o_orderdate").select(
        "o_orderkey", "date", "month"
    )


@query(
    "date_window",
    """SELECT event_id, ts, value FROM events
       WHERE ts >= TIMESTAMP '2024-01-05' AND ts < TIMESTAMP '2024-01-13'""",
)
def date_window(spark, sf):
    first, after = S.resolve_window("2024-01-05", "2024-01-12")
    return S.in_window(B.table(spark, sf, "events"), "ts", first, after).select(
        "event_id", "ts", "value"
    )


@query(
    "date_window_days_back",
    """SELECT event_id, ts, value FROM events
       WHERE ts >= TIMESTAMP '2024-01-24' AND ts < TIMESTAMP '2024-01-31'""",
)
def date_window_days_back(spark, sf):
    """The last seven days, seen from a given day."""
    first, after = S.resolve_window(days_back="7", today=date(2024, 1, 30))
    return S.in_window(B.table(spark, sf, "events"), "ts", first, after).select(
        "event_id", "ts", "value"
    )


@query(
    "date_spine",
    """SELECT event_type, unnest(generate_series(min(ts)::DATE, max(ts)::DATE, INTERVAL 1 DAY))::DATE
              AS day FROM events GROUP BY event_type""",
)
def date_spine(spark, sf):
    """All days between the first and the last reading of each key."""
    bounds = B.table(spark, sf, "events").groupBy("event_type").agg(
        F.min("ts").alias("first"), F.max("ts").alias("last")
    )
    return S.date_spine(bounds, "first", "last")


@query(
    "border_pairs",
    sql(
        """SELECT a AS from_country, b AS to_country FROM pairs
           UNION ALL SELECT b, a FROM pairs""",
        {
            "pairs": """SELECT DISTINCT least(from_country, to_country) AS a,
                               greatest(from_country, to_country) AS b
                        FROM flow_readings WHERE from_country <> to_country"""
        },
    ),
)
def border_pairs(spark, sf):
    return flows.both_directions(B.flow_readings(spark, sf))


@query(
    "split_by_date",
    sql("""SELECT country, "index", Actual_Load,
                  CASE WHEN "index" <= TIMESTAMP '2024-01-18' THEN 'train'
                       WHEN "index" <= TIMESTAMP '2024-01-25' THEN 'validation' ELSE 'test' END AS split
           FROM readings"""),
)
def split_by_date(spark, sf):
    parts = S.split_by_date(
        B.readings(spark, sf).select("country", "index", "Actual_Load"),
        splits=S.Splits("2024-01-18", "2024-01-25"),
    )
    train, val, test = (
        p.withColumn("split", F.lit(n)) for p, n in zip(parts, ("train", "validation", "test"))
    )
    return train.unionByName(val).unionByName(test)


@query(
    "threshold_filter",
    sql("""SELECT country, "index", grid_stress_score, (grid_stress_score >= 50)::INT AS high_risk,
                  (grid_stress_score >= 66)::INT AS warning
           FROM scored WHERE grid_stress_score >= 50"""),
)
def threshold_filter(spark, sf):
    score = F.col("grid_stress_score")
    return score_panel(B.panel(spark, sf, with_supply=False)).filter(score >= 50).select(
        "country", "index", "grid_stress_score",
        (score >= 50).cast("int").alias("high_risk"), (score >= 66).cast("int").alias("warning"),
    )


# ---- scalar functions ------------------------------------------------------------
@query(
    "time_parts",
    sql("""SELECT event_id, hour("index")::INT AS hour, month("index")::INT AS month,
                  (isodow("index") - 1)::INT AS day_of_week, (isodow("index") >= 6)::INT AS is_weekend
           FROM readings"""),
)
def time_parts(spark, sf):
    return B.readings(spark, sf).select(
        "event_id", *[c.alias(n) for n, c in TP.time_parts(F.col("index")).items()]
    )


@query(
    "cyclical",
    sql(
        "SELECT event_id, "
        + ", ".join(
            f"round({fn}(2 * pi() * ({part}) / {period}), 6) + 0.0 AS {name}_{fn}"
            for name, part, period in (
                ("hour", 'hour("index")', 24), ("month", 'month("index")', 12),
                ("day_of_week", 'isodow("index") - 1', 7),
            )
            for fn in ("sin", "cos")
        )
        + " FROM readings"
    ),
)
def cyclical(spark, sf):
    parts = TP.cyclical_parts(F.col("index"))
    return rounded(
        B.readings(spark, sf).select("event_id", *[c.alias(n) for n, c in parts.items()]), *parts
    )


PEAKS_SQL = """SELECT event_id, (hour("index") IN (7, 8, 9))::INT AS is_morning_peak,
                      (hour("index") IN (18, 19, 20, 21))::INT AS is_evening_peak,
                      (hour("index") IN (7, 8, 9, 18, 19, 20, 21))::INT AS is_peak_hour
               FROM readings"""


@query("peak_flags", sql(PEAKS_SQL))
def peak_flags(spark, sf):
    flags = TP.peak_flags(F.hour("index"))
    return B.readings(spark, sf).select("event_id", *[c.alias(n) for n, c in flags.items()])


@query(
    "bool_or_cast",
    sql("""SELECT event_id, ((Actual_Load > 1000)::INT | (hour("index") < 6)::INT)::INT AS flag
           FROM readings"""),
)
def bool_or_cast(spark, sf):
    high = (F.col("Actual_Load") > 1000).cast("int")
    night = (F.hour("index") < 6).cast("int")
    return B.readings(spark, sf).select("event_id", high.bitwiseOR(night).alias("flag"))


@query(
    "time_convert",
    sql("""SELECT event_id, date_trunc('hour', "index") AS hour_start,
                  strftime("index", '%Y-%m-%d %H:%M') AS text, epoch("index")::BIGINT AS seconds,
                  to_timestamp(epoch("index")::BIGINT) AT TIME ZONE 'UTC' AS back,
                  "index" + INTERVAL 1 HOUR AS berlin
           FROM (SELECT event_id, date_trunc('second', "index") AS "index" FROM readings)"""),
)
def time_convert(spark, sf):
    """Berlin is one hour ahead of UTC on all days of the readings."""
    rows = B.readings(spark, sf).select("event_id", F.date_trunc("second", "index").alias("index"))
    seconds = F.unix_seconds("index")
    return rows.select(
        "event_id",
        TP.hour_start(F.col("index")).alias("hour_start"),
        F.date_format("index", "yyyy-MM-dd HH:mm").alias("text"),
        seconds.alias("seconds"),
        TP.epoch_seconds_to_time(seconds).alias("back"),
        TP.local_time(F.col("index")).alias("berlin"),
    )


@query(
    "wind_vector",
    """SELECT vec_id, round(sqrt(embedding[1]::DOUBLE * embedding[1]::DOUBLE
              + embedding[2]::DOUBLE * embedding[2]::DOUBLE), 6) AS wind_speed FROM embeddings""",
)
def wind_vector(spark, sf):
    from panelforge.functions.numbers import wind_speed

    u, v = F.col("embedding")[0].cast("double"), F.col("embedding")[1].cast("double")
    rows = B.table(spark, sf, "embeddings").select("vec_id", wind_speed(u, v).alias("wind_speed"))
    return rounded(rows, "wind_speed")


@query(
    "kelvin_to_c",
    """SELECT event_id, round(value + 250 - 273.15, 6) + 0.0 AS celsius FROM events""",
)
def kelvin_to_c(spark, sf):
    from panelforge.functions.numbers import kelvin_to_celsius

    rows = B.table(spark, sf, "events").select(
        "event_id", kelvin_to_celsius(F.col("value") + 250).alias("celsius")
    )
    return rounded(rows, "celsius")


@query(
    "ratios",
    sql("""SELECT country, "index", Actual_Load - Forecasted_Load AS load_forecast_diff,
                  round(Actual_Load / nullif(Forecasted_Load + 1e-6, 0), 6) AS load_forecast_ratio,
                  round(abs(Actual_Load - Forecasted_Load) / nullif(Forecasted_Load + 1e-6, 0) * 100, 6)
                    AS load_forecast_error_pct
           FROM core_panel"""),
)
def ratios(spark, sf):
    from panelforge.functions.numbers import error_percent, ratio

    load, fc = F.col("Actual_Load"), F.col("Forecasted_Load")
    rows = B.panel(spark, sf, with_supply=False).select(
        "country", "index", (load - fc).alias("load_forecast_diff"),
        ratio(load, fc).alias("load_forecast_ratio"),
        error_percent(fc, load).alias("load_forecast_error_pct"),
    )
    return rounded(rows, "load_forecast_ratio", "load_forecast_error_pct")


@query(
    "flags",
    sql("""SELECT country, "index", (mean_temperature_c < 0)::INT AS is_very_cold FROM weather"""),
)
def flags(spark, sf):
    return B.weather(spark, sf).select(
        "country", "index", (F.col("mean_temperature_c") < 0).cast("int").alias("is_very_cold")
    )


@query(
    "null_fill",
    sql("""SELECT country, "index", coalesce(Nuclear__Actual_Aggregated, 0) AS Nuclear__Actual_Aggregated,
                  coalesce(Solar__Actual_Aggregated, 0) AS Solar__Actual_Aggregated,
                  Biomass__Actual_Consumption,
                  coalesce(Marine__Actual_Aggregated, 0) AS Marine__Actual_Aggregated
           FROM generation"""),
)
def null_fill(spark, sf):
    rows = B.generation(spark, sf)
    names = [c for c in C.suffix_columns(rows) if c.endswith("__Actual_Aggregated")]
    return rows.fillna(0, subset=names)


@query(
    "case_bands",
    sql("""SELECT country, "index", CASE WHEN grid_stress_score < 33 THEN 'LOW'
                  WHEN grid_stress_score < 66 THEN 'MEDIUM'
                  WHEN grid_stress_score IS NOT NULL THEN 'HIGH' END AS level FROM scored"""),
)
def case_bands(spark, sf):
    from panelforge.functions.scoring import target_level

    return score_panel(B.panel(spark, sf, with_supply=False)).select(
        "country", "index", target_level(F.col("grid_stress_score")).alias("level")
    )


@query(
    "clip",
    """SELECT event_id, least(greatest(value - 20, 0), 100) AS clipped, greatest(value, 1) AS floored
       FROM events""",
)
def clip(spark, sf):
    from panelforge.functions import numbers

    return B.table(spark, sf, "events").select(
        "event_id", numbers.clip(F.col("value") - 20, 0, 100).alias("clipped"),
        numbers.at_least(F.col("value"), 1).alias("floored"),
    )


@query("coalesce_keys", sql("""SELECT country, "index" FROM in_out"""))
def coalesce_keys(spark, sf):
    """Keys of either side of a full outer join."""
    edges = B.flow(spark, sf)
    a = flows.sums_by_end(edges, "to_country", name="imports").alias("a")
    b = flows.sums_by_end(edges, "from_country", name="exports").alias("b")
    on = (F.col("a.country") == F.col("b.country")) & (F.col("a.index") == F.col("b.index"))
    return a.join(b, on, "full_outer").select(
        F.coalesce("a.country", "b.country").alias("country"),
        F.coalesce("a.index", "b.index").alias("index"),
    )


@query(
    "unpivot",
    sql("""SELECT country, "index", 'Nuclear__Actual_Aggregated' AS series, Nuclear__Actual_Aggregated AS v
             FROM generation
           UNION ALL SELECT country, "index", 'Solar__Actual_Aggregated', Solar__Actual_Aggregated
             FROM generation
           UNION ALL SELECT country, "index", 'Biomass__Actual_Consumption', Biomass__Actual_Consumption
             FROM generation
           UNION ALL SELECT country, "index", 'Marine__Actual_Aggregated', Marine__Actual_Aggregated
             FROM generation"""),
)
def unpivot(spark, sf):
    rows = B.generation(spark, sf)
    return rows.unpivot(["country", "index"], C.suffix_columns(rows), "series", "v")


TYPES = ("click", "error", "purchase", "signup", "view")


@query(
    "one_hot",
    "SELECT event_id, "
    + ", ".join(f"(event_type = '{t}')::INT AS event_type_{t}" for t in (*TYPES, "refund"))
    + " FROM events",
)
def one_hot(spark, sf):
    rows = B.table(spark, sf, "events").select("event_id", "event_type")
    return C.one_hot(rows, "event_type", (*TYPES, "refund")).drop("event_type")


@query("one_hot_decode", """SELECT event_id, event_type AS label FROM events""")
def one_hot_decode(spark, sf):
    rows = B.table(spark, sf, "events").select("event_id", "event_type")
    flags = C.one_hot(rows, "event_type", TYPES).drop("event_type")
    return flags.select("event_id", C.one_hot_decode(TYPES, "event_type").alias("label"))


@query(
    "align_categories",
    "SELECT event_id, "
    + ", ".join(f"(event_type = '{t}')::INT AS event_type_{t}" for t in ("click", "refund", "view"))
    + " FROM events",
)
def align_categories(spark, sf):
    """Categories of the training data: unseen ones get 0, unknown ones no column."""
    rows = B.table(spark, sf, "events").select("event_id", "event_type")
    return C.one_hot(rows, "event_type", ("click", "refund", "view")).drop("event_type")


@query(
    "string_ops",
    """SELECT p_partkey, trim('  ' || p_name || ' ') AS trimmed, replace(p_name, ' ', '_') AS joined,
              regexp_replace(p_brand, '[^0-9A-Za-z_]+', '_', 'g') AS cleaned, lower(p_type) AS low,
              starts_with(p_type, 'ECO') AS starts, ends_with(p_name, 'ring') AS ends,
              contains(p_name, 'red') AS has_red,
              list_transform(string_split(p_name || ' , ' || p_type, ','), lambda x: trim(x)) AS parts,
              lpad(p_size::VARCHAR, 4, '0') AS padded
       FROM part""",
)
def string_ops(spark, sf):
    name, kind = F.col("p_name"), F.col("p_type")
    return B.table(spark, sf, "part").select(
        "p_partkey",
        F.trim(F.concat(F.lit("  "), name, F.lit(" "))).alias("trimmed"),
        F.replace(name, F.lit(" "), F.lit("_")).alias("joined"),
        F.regexp_replace("p_brand", "[^0-9A-Za-z_]+", "_").alias("cleaned"),
        F.lower(kind).alias("low"),
        F.startswith(kind, F.lit("ECO")).alias("starts"),
        F.endswith(name, F.lit("ring")).alias("ends"),
        F.contains(name, F.lit("red")).alias("has_red"),
        N.split_list(F.concat(name, F.lit(" , "), kind)).alias("parts"),
        F.lpad(F.col("p_size").cast("string"), 4, "0").alias("padded"),
    )


@query(
    "array_reshape",
    """SELECT vec_id, generate_subscripts(embedding, 1)::INT - 1 AS pos,
              unnest(embedding)::DOUBLE AS value,
              ((generate_subscripts(embedding, 1) - 1) // 8)::INT AS grid_row,
              ((generate_subscripts(embedding, 1) - 1) % 8)::INT AS grid_col
       FROM embeddings""",
)
def array_reshape(spark, sf):
    """8 x 8 grids, flattened with their row and column."""
    rows = B.table(spark, sf, "embeddings").select("vec_id", F.posexplode("embedding").alias("pos", "v"))
    return rows.select(
        "vec_id", "pos", F.col("v").cast("double").alias("value"),
        F.expr("CAST(pos div 8 AS INT)").alias("grid_row"), (F.col("pos") % 8).alias("grid_col"),
    )


@query(
    "hour_labels",
    sql(
        """SELECT country, now_hour, step::INT AS step,
                  lpad((((now_hour + step) % 24 + 24) % 24)::VARCHAR, 2, '0') || ':00' AS label
           FROM current_hours, generate_series(-23, 6) s(step)""",
        {"current_hours": """SELECT country, hour(max("index"))::INT AS now_hour FROM readings
                             GROUP BY 1"""},
    ),
)
def hour_labels(spark, sf):
    """Clock labels for the last 24 hours and the next 6 of each key."""
    now = B.readings(spark, sf).groupBy("country").agg(F.hour(F.max("index")).alias("now_hour"))
    steps = now.select("country", "now_hour", F.explode(F.sequence(F.lit(-23), F.lit(6))).alias("step"))
    return steps.withColumn("label", TP.clock_label(F.col("now_hour") + F.col("step")))
