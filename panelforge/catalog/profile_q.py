"""Queries: profiles, distributions and evaluation."""

from __future__ import annotations

from pyspark.sql import functions as F

from panelforge.catalog.registry import query, r6, rounded
from panelforge.catalog.sqltext import with_fragments as sql
from panelforge.functions.timeparts import date_text
from panelforge.operators import columns as C
from panelforge.operators import evaluate as E
from panelforge.operators import profile as P
from panelforge.operators import sketches as SK
from panelforge.operators.percentiles import approx_percentiles, percentile_disc
from panelforge.operators.scores import score_panel
from panelforge.operators.splits import Splits, with_split
from panelforge.session import reliable_checkpoint, scratch_dir
from panelforge.sources import benchdata as B

SPLITS = Splits("1999-12-31", "2000-12-31")
SPLIT_SQL = """CASE WHEN "index" <= TIMESTAMP '1999-12-31' THEN 'train'
                    WHEN "index" <= TIMESTAMP '2000-12-31' THEN 'validation' ELSE 'test' END"""
SHIFT_SQL = """(('0x' || substr(md5(country || '|' || strftime("index", '%Y-%m-%d')), 1, 8))::BIGINT % 41) - 20"""
PRED = {
    "pred": f"""SELECT *, grid_stress_score + {SHIFT_SQL} AS predicted, {SPLIT_SQL} AS split
                FROM scored"""
}


def scored(spark, sf):
    return score_panel(B.panel(spark, sf, with_supply=False))


def predicted(spark, sf):
    """A stand-in for a model: the score shifted by a hash of key and time."""
    digest = F.md5(F.concat_ws("|", "country", F.date_format("index", "yyyy-MM-dd")))
    shift = F.conv(F.substring(digest, 1, 8), 16, 10).cast("long") % 41 - 20
    rows = scored(spark, sf).withColumn("predicted", F.col("grid_stress_score") + shift)
    return with_split(rows, splits=SPLITS)


GEN = ("Nuclear__Actual_Aggregated", "Solar__Actual_Aggregated", "Biomass__Actual_Consumption",
       "Marine__Actual_Aggregated")


@query(
    "null_counts_long",
    sql(
        " UNION ALL ".join(
            f"""SELECT '{c}' AS column_name, count(*) - count({c}) AS null_count,
                       round((count(*) - count({c})) * 100.0 / count(*), 6) AS null_pct FROM generation"""
            for c in GEN
        )
    ),
)
def null_counts_long(spark, sf):
    return rounded(C.null_counts_long(B.generation(spark, sf), GEN), "null_pct")


@query(
    "null_counts_wide",
    sql("SELECT count(*) AS row_count, "
        + ", ".join(f"count(*) - count({c}) AS {c}" for c in GEN) + " FROM generation"),
)
def null_counts_wide(spark, sf):
    return C.null_counts(B.generation(spark, sf), GEN)


@query("global_max", sql("""SELECT round(max(reserve_margin_ml), 6) AS max_margin FROM indicators"""))
def global_max(spark, sf):
    return scored(spark, sf).agg(r6(F.max("reserve_margin_ml")).alias("max_margin"))


@query(
    "key_stats",
    sql(
        """SELECT country, round(avg(Actual_Load), 2) AS Actual_Load, round(avg(net_imports), 2) + 0.0 AS net_imports,
                  round(avg(mean_temperature_c), 6) + 0.0 AS mean_temperature_c,
                  round(avg(grid_stress_score), 6) AS grid_stress_score
           FROM scored JOIN weather USING (country, "index") GROUP BY 1"""
    ),
)
def key_stats(spark, sf):
    rows = score_panel(B.panel(spark, sf)).drop(*GEN)
    stats = P.key_stats(
        rows, "country", ["Actual_Load", "net_imports", "mean_temperature_c", "grid_stress_score"]
    )
    return rounded(
        rounded(stats, "Actual_Load", "net_imports", places=2), "mean_temperature_c", "grid_stress_score"
    )


@query(
    "key_mean_median",
    sql("SELECT country, " + ", ".join(
        f"round(avg({c}), 4) AS mean_{c}, quantile_disc({c}, 0.5) AS median_{c}" for c in GEN[:3]
    ) + " FROM generation GROUP BY 1"),
)
def key_mean_median(spark, sf):
    return B.generation(spark, sf).groupBy("country").agg(
        *[r6(F.avg(c), 4).alias(f"mean_{c}") for c in GEN[:3]],
        *[percentile_disc(c, 0.5).alias(f"median_{c}") for c in GEN[:3]],
    )


_SHARES = {"p10": 0.1, "p50": 0.5, "p90": 0.9}


@query("sketch_percentiles", sql("SELECT country, count(*) AS n, true AS p10, true AS p50, true AS p90 FROM readings GROUP BY 1"))
def sketch_percentiles(spark, sf):
    """Percentiles from sketches of each day, kept in a table: half of the month makes its
    sketches first, then the whole month adds its other days. Columns say whether the
    value's rank is within the bound by an exact count, twice the sketch's usual error."""
    rows = B.readings(spark, sf).select("country", "Actual_Load", date_text(F.col("index")).alias("date"))
    path = scratch_dir(spark, "sketches")
    SK.refresh_quantiles(rows.where("date < '2024-01-16'"), path, ["country"], "date", "Actual_Load")
    table = SK.refresh_quantiles(rows, path, ["country"], "date", "Actual_Load")
    found = SK.sketched_quantiles(table, ["country"], {f"_{k}": p for k, p in _SHARES.items()})
    beside = rows.join(found.drop("n"), "country").groupBy("country").agg(
        F.count(F.lit(1)).alias("n"),
        *[F.avg((F.col("Actual_Load") < F.col(f"_{k}")).cast("double")).alias(f"{k}_below") for k in _SHARES],
        *[F.avg((F.col("Actual_Load") <= F.col(f"_{k}")).cast("double")).alias(f"{k}_upto") for k in _SHARES],
    )
    slack = 2 * SK.KLL_ERROR
    return beside.select(
        "country", "n", *[((F.col(f"{k}_below") - slack <= p) & (F.col(f"{k}_upto") + slack >= p)).alias(k) for k, p in _SHARES.items()]
    )


@query(
    "split_overlap",
    """WITH m AS (SELECT DISTINCT user_id, event_type, CASE WHEN ts < TIMESTAMP '2024-01-16' THEN 'train'
                    WHEN ts < TIMESTAMP '2024-01-24' THEN 'validation' ELSE 'test' END AS split FROM events),
            s AS (SELECT DISTINCT split FROM m)
       SELECT a.split AS "left", b.split AS "right", true AS both, true AS left_only, true AS left_all
       FROM s a JOIN s b ON a.split <> b.split""",
)
def split_overlap(spark, sf):
    """How many pairs of user and event type two splits share, from a sketch of each split.
    Columns say whether the estimate is within a tenth of the split's exact count."""
    split = F.when(F.col("ts") < "2024-01-16", "train").when(F.col("ts") < "2024-01-24", "validation").otherwise("test")
    rows = B.table(spark, sf, "events").select("user_id", "event_type", split.alias("split"))
    found = SK.overlap(rows, "split", ["user_id", "event_type"])
    held = rows.distinct().groupBy("user_id", "event_type").agg(F.collect_set("split").alias("held"))
    pairs = held.select(F.explode("held").alias("left"), "held").select("left", F.explode(F.lit(["train", "validation", "test"])).alias("right"), "held")
    exact = pairs.where("left <> right").groupBy("left", "right").agg(
        F.count_if(F.array_contains("held", F.col("right"))).alias("e_both"), F.count(F.lit(1)).alias("e_all")
    )
    near = lambda a, b: F.abs(F.col(a) - b) <= F.col("e_all") * 0.1
    return found.join(exact, ["left", "right"]).select(
        "left", "right", near("both", F.col("e_both")).alias("both"), near("left_only", F.col("e_all") - F.col("e_both")).alias("left_only"),
        near("left_all", F.col("e_all")).alias("left_all"),
    )


@query("approx_quantile", sql("SELECT country, count(*) AS n, true AS near_half FROM readings GROUP BY 1"))
def approx_quantile(spark, sf):
    """Medians from a sketch of bounded size, not comparable digit by digit: whether each
    value's rank by an exact count is within the sketch's bound, a thousandth of the rows."""
    rows = B.readings(spark, sf).select("country", "Actual_Load")
    found = approx_percentiles(rows, ["country"], {"median": ("Actual_Load", 0.5)})
    below, upto = F.avg((F.col("Actual_Load") < F.col("median")).cast("double")), F.avg((F.col("Actual_Load") <= F.col("median")).cast("double"))
    slack = 1 / 1000 + 1 / F.count(F.lit(1))
    return rows.join(found, "country").groupBy("country").agg(
        F.count(F.lit(1)).alias("n"), ((below - slack <= 0.5) & (upto + slack >= 0.5)).alias("near_half")
    )


@query(
    "value_counts_pct",
    sql("""SELECT grid_stress_score, count(*) AS n, round(count(*) * 100.0 / sum(count(*)) OVER (), 6) AS pct,
                  CASE WHEN grid_stress_score < 25 THEN 'NORMAL' WHEN grid_stress_score < 50 THEN 'MODERATE'
                       ELSE 'HIGH RISK' END AS category
           FROM scored GROUP BY 1"""),
)
def value_counts_pct(spark, sf):
    return rounded(P.value_counts(scored(spark, sf), "grid_stress_score"), "pct")


@query(
    "describe_target",
    sql("""SELECT round(avg(grid_stress_score), 6) AS mean, round(stddev_samp(grid_stress_score), 6) AS std,
                  min(grid_stress_score) AS min, max(grid_stress_score) AS max,
                  round(quantile_cont(grid_stress_score, 0.5), 6) AS median FROM scored"""),
)
def describe_target(spark, sf):
    rows = reliable_checkpoint(scored(spark, sf).select("grid_stress_score"), "scored")   # read three times
    return rounded(P.describe(rows, "grid_stress_score"), "mean", "std", "median")


@query(
    "describe_readings",
    """SELECT round(avg(l_extendedprice), 4) AS mean, round(stddev_samp(l_extendedprice), 4) AS std,
              min(l_extendedprice) AS min, max(l_extendedprice) AS max,
              round(quantile_cont(l_extendedprice, 0.5), 4) AS median FROM lineitem""",
)
def describe_readings(spark, sf):
    """The same for a raw table: the median is exact without a global sort."""
    rows = P.describe(B.table(spark, sf, "lineitem"), "l_extendedprice")
    return rounded(rows, "mean", "std", "median", places=4)


@query(
    "temporal_coverage",
    sql(f"""SELECT {SPLIT_SQL} AS split, min("index") AS first_time, max("index") AS last_time,
                   datesub('day', min("index"), max("index")) AS days FROM load_readings GROUP BY 1"""),
)
def temporal_coverage(spark, sf):
    return P.temporal_coverage(with_split(B.load_readings(spark, sf), splits=SPLITS), ["split"])


@query(
    "key_distribution",
    sql("""SELECT country, count(*) AS n, round(avg(grid_stress_score), 6) AS avg_score,
                  round(count(*) * 100.0 / sum(count(*)) OVER (), 6) AS pct FROM scored GROUP BY 1"""),
)
def key_distribution(spark, sf):
    return rounded(P.key_distribution(scored(spark, sf), "country", "grid_stress_score"), "avg_score", "pct")


@query(
    "coverage_rollup",
    sql(f"""SELECT {SPLIT_SQL} AS split, country, count(*) AS n,
                   round(avg(grid_stress_score), 6) AS avg_score
            FROM scored GROUP BY ROLLUP (1, 2)"""),
)
def coverage_rollup(spark, sf):
    rows = with_split(scored(spark, sf), splits=SPLITS)
    return rounded(P.coverage_rollup(rows, "split", "country", "grid_stress_score"), "avg_score")


CORR = ("Actual_Load", "Forecasted_Load", "net_imports", "mean_ssrd", "mean_wind_speed",
        "mean_temperature_c", "solar_forecast", "wind_forecast", *GEN)
WIDE = {"wide": """SELECT * FROM scored JOIN weather USING (country, "index")
                   JOIN renewables USING (country, "index") JOIN generation USING (country, "index")"""}
CORR_SQL = "SELECT * FROM (" + " UNION ALL ".join(
    f"""SELECT '{c}' AS feature, round(corr(grid_stress_score, {c}), 6) + 0.0 AS correlation,
               round(abs(corr(grid_stress_score, {c})), 6) AS abs_correlation
        FROM wide HAVING count({c}) > 100""" for c in CORR
) + ") WHERE NOT isnan(correlation)"


def _correlations(spark, sf):
    return P.target_correlation(score_panel(B.panel(spark, sf)), CORR, "grid_stress_score")


@query("target_correlation", sql(CORR_SQL, WIDE))
def target_correlation(spark, sf):
    return rounded(_correlations(spark, sf), "correlation", "abs_correlation")


MATRIX = CORR[:6] + ("grid_stress_score",)


@query(
    "correlation_matrix",
    sql(
        " UNION ALL ".join(
            f"""SELECT '{a}' AS feature_a, '{b}' AS feature_b,
                       round(corr({a}, {b}), 6) + 0.0 AS correlation FROM wide"""
            for a in MATRIX for b in MATRIX
        ),
        WIDE,
    ),
)
def correlation_matrix(spark, sf):
    return rounded(P.correlation_matrix(score_panel(B.panel(spark, sf)), MATRIX), "correlation")


@query("top_k", sql(f"SELECT * FROM ({CORR_SQL}) ORDER BY abs_correlation DESC, feature LIMIT 5", WIDE))
def top_k(spark, sf):
    """The report of the five strongest correlations."""
    rows = rounded(_correlations(spark, sf), "correlation", "abs_correlation")
    return P.top_k(rows, 5, F.col("abs_correlation").desc(), F.col("feature"))


@query(
    "ranked_report",
    sql(f"""SELECT *, row_number() OVER (ORDER BY abs_correlation DESC, feature)::INT AS rank
            FROM ({CORR_SQL}) ORDER BY rank LIMIT 25""", WIDE),
)
def ranked_report(spark, sf):
    rows = rounded(_correlations(spark, sf), "correlation", "abs_correlation")
    return P.ranked(rows, 25, "abs_correlation", "feature")


@query(
    "arg_best",
    sql(f"SELECT * FROM ({CORR_SQL}) ORDER BY abs_correlation DESC, feature LIMIT 1", WIDE),
)
def arg_best(spark, sf):
    rows = rounded(_correlations(spark, sf), "correlation", "abs_correlation")
    return P.best_row(rows, "abs_correlation", "feature")


@query("global_sort", sql("""SELECT country, "index", Actual_Load FROM load"""))
def global_sort(spark, sf):
    return B.load(spark, sf).select("country", "index", "Actual_Load").orderBy("country", "index")


@query("limit_n", """SELECT event_id, value FROM events ORDER BY event_id LIMIT 5""")
def limit_n(spark, sf):
    """First rows for a look at a table: the limit is the feature."""
    return B.table(spark, sf, "events").select("event_id", "value").orderBy("event_id").limit(5)


# ---- evaluation ------------------------------------------------------------------
CELLS = """SELECT count(*) FILTER (WHERE NOT t AND NOT g) AS tn, count(*) FILTER (WHERE NOT t AND g) AS fp,
                  count(*) FILTER (WHERE t AND NOT g) AS fn, count(*) FILTER (WHERE t AND g) AS tp
           FROM (SELECT grid_stress_score >= 50 AS t, predicted >= 50 AS g FROM pred)"""


@query(
    "confusion_matrix",
    sql(
        """SELECT actual, predicted, n, round(n * 100.0 / sum(n) OVER (), 6) AS pct,
                  round(n / sum(n) OVER (PARTITION BY actual), 6) AS row_share
           FROM (SELECT 0 AS actual, 0 AS predicted, tn AS n FROM counts
                 UNION ALL SELECT 0, 1, fp FROM counts UNION ALL SELECT 1, 0, fn FROM counts
                 UNION ALL SELECT 1, 1, tp FROM counts)""",
        {**PRED, "counts": CELLS},
    ),
)
def confusion_matrix(spark, sf):
    rows = E.confusion_matrix(predicted(spark, sf), "grid_stress_score", "predicted")
    return rounded(rows, "pct", "row_share")


RATES = """round(coalesce((tn + tp) / nullif(tn + fp + fn + tp, 0), 0), 6) AS accuracy,
           round(coalesce(tp / nullif(tp + fp, 0), 0), 6) AS precision,
           round(coalesce(tp / nullif(tp + fn, 0), 0), 6) AS recall,
           round(coalesce(2 * tp / nullif(2 * tp + fp + fn, 0), 0), 6) AS f1"""
RATE_NAMES = ("accuracy", "precision", "recall", "f1")


@query(
    "classification_metrics",
    sql(f"""SELECT tn, fp, fn, tp, {RATES}, round((tn + tp) / (tn + fp + fn + tp), 6) AS reliability
            FROM counts""", {**PRED, "counts": CELLS}),
)
def classification_metrics(spark, sf):
    rows = E.classification_metrics(predicted(spark, sf), "grid_stress_score", "predicted")
    return rounded(rows, *RATE_NAMES, "reliability")


REG_SQL = """SELECT split, count(*) AS n, round(avg(abs(grid_stress_score - predicted)), 6) AS mae,
                    round(sqrt(avg((grid_stress_score - predicted) ** 2)), 6) AS rmse,
                    round(1 - avg((grid_stress_score - predicted) ** 2) / var_pop(grid_stress_score), 6) AS r2
             FROM pred GROUP BY 1"""


@query("regression_metrics", sql(REG_SQL, PRED))
def regression_metrics(spark, sf):
    rows = E.regression_metrics(predicted(spark, sf), "grid_stress_score", "predicted", ["split"])
    return rounded(rows, "mae", "rmse", "r2")


@query(
    "overfit_gap",
    sql(
        """SELECT round(a, 6) AS train_r2, round(b, 6) AS test_r2, round(a - b, 6) AS gap,
                  CASE WHEN a - b < 0.05 THEN 'excellent' WHEN a - b < 0.10 THEN 'good' ELSE 'overfit' END AS verdict
           FROM (SELECT max(r2) FILTER (WHERE split = 'train') AS a, max(r2) FILTER (WHERE split = 'test') AS b
                 FROM metrics)""",
        {
            **PRED,
            "metrics": """SELECT split, 1 - avg((grid_stress_score - predicted) ** 2)
                                 / var_pop(grid_stress_score) AS r2 FROM pred GROUP BY 1""",
        },
    ),
)
def overfit_gap(spark, sf):
    rows = E.regression_metrics(predicted(spark, sf), "grid_stress_score", "predicted", ["split"])
    return rounded(E.overfit_gap(rows), "train_r2", "test_r2", "gap")


@query(
    "error_by_bin",
    sql(
        """SELECT bin, count(e) AS n, min(e) AS low, max(e) AS high, round(avg(e), 6) AS mean,
                  round(quantile_cont(e, 0.25), 6) AS q1, round(quantile_cont(e, 0.5), 6) AS median,
                  round(quantile_cont(e, 0.75), 6) AS q3 FROM errors WHERE bin IS NOT NULL GROUP BY 1""",
        {
            **PRED,
            "errors": """SELECT abs(grid_stress_score - predicted) AS e,
                                CASE WHEN grid_stress_score <= 0 THEN NULL WHEN grid_stress_score <= 25 THEN 1
                                     WHEN grid_stress_score <= 50 THEN 2 WHEN grid_stress_score <= 75 THEN 3 END AS bin
                         FROM pred""",
        },
    ),
)
def error_by_bin(spark, sf):
    pairs = predicted(spark, sf).select("grid_stress_score", "predicted")
    rows = E.error_by_bin(reliable_checkpoint(pairs, "pairs"), "grid_stress_score", "predicted")
    return rounded(rows, "mean", "q1", "median", "q3")


@query(
    "histogram",
    sql("""SELECT CASE WHEN grid_stress_score = 75 THEN 30
                       ELSE floor(grid_stress_score / 2.5)::INT + 1 END AS bin, count(*) AS n
           FROM scored WHERE grid_stress_score BETWEEN 0 AND 75 GROUP BY 1"""),
)
def histogram(spark, sf):
    return P.histogram(scored(spark, sf), "grid_stress_score", 0, 75, 30)


@query(
    "residual_stats",
    sql("""SELECT split, count(*) AS n, round(avg(grid_stress_score - predicted), 6) + 0.0 AS mean,
                  round(stddev_samp(grid_stress_score - predicted), 6) AS std FROM pred GROUP BY 1""", PRED),
)
def residual_stats(spark, sf):
    rows = E.residual_stats(predicted(spark, sf), "grid_stress_score", "predicted", ["split"])
    return rounded(rows, "mean", "std")


def _sweep_sql(truth: str) -> dict[str, str]:
    return {
        **PRED,
        "sweep": f"""SELECT t AS threshold,
              count(*) FILTER (WHERE NOT {truth} AND predicted < t) AS tn,
              count(*) FILTER (WHERE NOT {truth} AND predicted >= t) AS fp,
              count(*) FILTER (WHERE {truth} AND predicted < t) AS fn,
              count(*) FILTER (WHERE {truth} AND predicted >= t) AS tp
            FROM pred, (VALUES (30), (35), (40), (45), (50), (55), (60)) v(t) GROUP BY 1""",
    }


SWEEP = f"SELECT threshold, {RATES}, fn AS missed FROM sweep"


@query("threshold_sweep", sql(SWEEP, _sweep_sql("(grid_stress_score >= t)")))
def threshold_sweep(spark, sf):
    return rounded(E.threshold_sweep(predicted(spark, sf), "grid_stress_score", "predicted"), *RATE_NAMES)


@query("threshold_sweep_fixed_truth", sql(SWEEP, _sweep_sql("(grid_stress_score >= 50)")))
def threshold_sweep_fixed_truth(spark, sf):
    rows = E.threshold_sweep(predicted(spark, sf), "grid_stress_score", "predicted", fixed_truth=50)
    return rounded(rows, *RATE_NAMES)


@query(
    "best_threshold",
    sql(f"""SELECT threshold, f1 FROM ({SWEEP}) ORDER BY f1 DESC, threshold LIMIT 1""",
        _sweep_sql("(grid_stress_score >= t)")),
)
def best_threshold(spark, sf):
    rows = rounded(E.threshold_sweep(predicted(spark, sf), "grid_stress_score", "predicted"), *RATE_NAMES)
    return P.best_row(rows, "f1", "threshold").select("threshold", "f1")


@query(
    "compare_approaches",
    sql(
        f"""SELECT approach, {RATES} FROM approaches""",
        {
            **PRED,
            "approaches": " UNION ALL ".join(
                f"""SELECT '{name}' AS approach, count(*) FILTER (WHERE grid_stress_score < 50 AND NOT {g}) AS tn,
                        count(*) FILTER (WHERE grid_stress_score < 50 AND {g}) AS fp,
                        count(*) FILTER (WHERE grid_stress_score >= 50 AND NOT {g}) AS fn,
                        count(*) FILTER (WHERE grid_stress_score >= 50 AND {g}) AS tp FROM pred"""
                for name, g in (
                    ("regression_50", "(predicted >= 50)"), ("regression_best", "(predicted >= 35)"),
                    ("classifier", "(load_rel_error > 0.1)"),
                )
            ),
        },
    ),
)
def compare_approaches(spark, sf):
    guess = F.col("predicted")
    rows = E.compare_approaches(
        predicted(spark, sf), "grid_stress_score",
        {
            "regression_50": guess >= 50, "regression_best": guess >= 35,
            "classifier": F.col("load_rel_error") > 0.1,
        },
    )
    return rounded(rows, *RATE_NAMES)
