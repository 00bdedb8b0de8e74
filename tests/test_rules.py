"""Rules of scoring, splitting, features and evaluation on small literals."""

from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import functions as F

from panelforge import config
from panelforge.functions import names as N
from panelforge.functions import numbers as NUM
from panelforge.functions import scoring as S
from panelforge.functions import timeparts as TP
from panelforge.operators import columns as C
from panelforge.operators import evaluate as E
from panelforge.operators import features as FE
from panelforge.operators import flows
from panelforge.operators import impute as M
from panelforge.operators import joins as J
from panelforge.operators import profile as P
from panelforge.operators import splits as SP
from panelforge.operators.resample import resample_mean
from panelforge.operators.scores import score_columns, score_panel, with_reserve_margin

T0 = datetime(2024, 1, 1)


def hours(n, skip=()):
    return [T0 + timedelta(hours=i) for i in range(n) if i not in skip]


def test_trailing_frame_counts_25_rows_not_hours(spark):
    rows = [("a", t, float(i)) for i, t in enumerate(hours(31, skip=(10,)))]
    df = spark.createDataFrame(rows, "country string, index timestamp, Actual_Load double")
    last = with_reserve_margin(df).orderBy(F.col("index").desc()).first()
    assert last["load_trailing_avg"] == sum(range(5, 30)) / 25


def test_constant_load_and_unknown_values_score_worst(spark):
    rows = [
        ("a", t, 5.0 if i else None, 5.0, float(i)) for i, t in enumerate(hours(5))
    ]
    df = spark.createDataFrame(
        rows, "country string, index timestamp, Actual_Load double, Forecasted_Load double, net_imports double"
    )
    out = score_panel(df).orderBy("index").collect()
    assert [r["score_reserve_margin"] for r in out] == [25.0] * 5
    assert out[0]["score_load_error"] == 25.0       # unknown load
    assert out[1]["score_load_error"] == 0.0


def test_unknown_flow_makes_the_total_null(spark):
    df = spark.sql(
        "SELECT 0.3D reserve_margin_ml, 0.01D load_rel_error, CAST(NULL AS DOUBLE) net_imports,"
        " 1D P10_net, 2D P90_net"
    ).withColumns(score_columns())
    assert df.first()["grid_stress_score"] is None


@pytest.mark.parametrize(
    "margin, error, net, total",
    [(0.2, 0.03, 5, 0.0), (-0.1, 0.03, 5, 12.5), (0.0999, 0.1, 5, 37.5), (0.0, 0.11, -1, 75.0),
     (0.0, 0.11, 11, 75.0), (0.5, 0.0, 0, 0.0), (0.5, 0.0, 10, 0.0)],
)
def test_points(spark, margin, error, net, total):
    df = spark.createDataFrame(
        [(margin, error, float(net), 0.0, 10.0)],
        "reserve_margin_ml double, load_rel_error double, net_imports double, P10_net double, P90_net double",
    ).withColumns(score_columns())
    assert df.first()["grid_stress_score"] == total


def test_levels(spark):
    df = spark.createDataFrame([(32.9,), (33.0,), (65.9,), (66.0,), (None,)], "s double")
    got = [tuple(r) for r in df.select(S.stress_level(F.col("s")), S.risk_category(F.col("s"))).collect()]
    assert got == [
        ("NORMAL", "MODERATE"), ("MODERATE", "MODERATE"), ("MODERATE", "HIGH RISK"),
        ("HIGH RISK", "HIGH RISK"), (None, None),
    ]


def test_split_end_means_midnight(spark):
    times = ["2024-12-31 00:00", "2024-12-31 01:00", "2025-07-31 00:00", "2025-07-31 01:00", None]
    df = spark.createDataFrame([(t,) for t in times], "index string").select(
        F.col("index").cast("timestamp").alias("index")
    )

    def labels(splits):
        return [r["split"] for r in SP.with_split(df, splits=splits).collect()]

    assert labels(SP.Splits()) == ["train", "validation", "validation", "test", None]
    assert labels(SP.Splits(inclusive_day=True)) == ["train", "train", "validation", "validation", None]
    assert [p.count() for p in SP.split_by_date(df)] == [1, 2, 1]


def test_window_resolution():
    today = date(2024, 3, 10)
    assert SP.resolve_window(days_back="3", today=today) == (date(2024, 3, 8), date(2024, 3, 11))
    assert SP.resolve_window(days_back="0", today=today)[0] == today
    assert SP.resolve_window(days_back="x", today=today)[0] == today
    assert SP.resolve_window("2024-01-01", "2024-01-02", "9") == (date(2024, 1, 1), date(2024, 1, 3))
    assert SP.resolve_window(default=("2023-01-01", "2023-02-01")) == (date(2023, 1, 1), date(2023, 2, 2))
    with pytest.raises(ValueError):
        SP.resolve_window("2024-01-02", "2024-01-01")


def test_date_spine_rejects_reversed_bounds(spark):
    df = spark.createDataFrame([("2024-01-05", "2024-01-01")], "a string, b string")
    with pytest.raises(Exception, match="end date before start date"):
        SP.date_spine(df, "a", "b").collect()


def test_weekday_and_peaks(spark):
    df = spark.createDataFrame([(datetime(2024, 1, 6, 19),)], "t timestamp")   # a Saturday
    parts = df.select(*[c.alias(n) for n, c in TP.time_parts(F.col("t")).items()]).first()
    assert (parts["day_of_week"], parts["is_weekend"], parts["hour"]) == (5, 1, 19)
    flags = df.select(*[c.alias(n) for n, c in TP.peak_flags(F.hour("t")).items()]).first()
    assert tuple(flags) == (0, 1, 1)


def test_divisor_of_zero_is_null(spark):
    df = spark.createDataFrame([(100.0, 90.0, -20.0, 3.0)],
                               "Actual_Load double, Forecasted_Load double, mean_temperature_c double, mean_wind_speed double")
    row = FE.with_interactions(df).first()
    assert row["load_per_temp"] is None
    assert row["is_very_cold"] == 1


def test_clip_keeps_null(spark):
    df = spark.createDataFrame([(-5.0,), (150.0,), (None,)], "v double")
    assert [r[0] for r in df.select(NUM.clip(F.col("v"), 0, 100)).collect()] == [0.0, 100.0, None]


def test_names():
    assert N.clean_name(" Actual Load (MW) ") == "Actual_Load__MW_"
    assert N.clean_name("10u") == "_10u"


def test_duplicate_and_missing_columns(spark):
    df = spark.createDataFrame([(1, 2.0, "x")], "a int, b double, c string")
    joined = df.select("a", F.col("b").alias("V"), F.col("b").alias("v"))
    assert C.duplicate_columns(joined) == [("v", 2)]
    assert C.existing_columns(df, ["b", "zzz", "a", "b"]) == ["b", "a"]
    assert C.numeric_columns(df) == ["a", "b"]
    assert C.canonical_value(df, ["a"]).columns == ["a", "Value"]
    assert C.leaking_columns(["x", "Stress_Lag_2", "net_imports_1"]) == ["Stress_Lag_2", "net_imports_1"]
    assert C.drop_legacy(df.withColumn("Solar", F.lit(1))).columns == ["a", "b", "c"]


def test_detect_timestamp(spark):
    df = spark.createDataFrame([("nope", "2024-01-01", 5)], "time string, when string, n int")
    assert C.detect_timestamp(df) == "when"
    assert C.detect_timestamp(df.withColumn("timestamp", F.lit("2024-02-02"))) == "timestamp"
    with pytest.raises(ValueError):
        C.detect_timestamp(df.select("time", "n"))


def test_sparse_and_empty_columns(spark):
    rows = [(None, float(i) if i < 2 else None, float(i)) for i in range(10)]
    df = spark.createDataFrame(rows, "none double, few double, full double")
    assert C.all_null_columns(df, df.columns) == ["none"]
    assert C.dense_columns(df, df.columns) == ["full"]      # 80 % missing is too sparse


def test_borders(spark):
    df = spark.createDataFrame([("A", "B"), ("B", "A"), ("A", "A")], "from_country string, to_country string")
    assert sorted(map(tuple, flows.both_directions(df).collect())) == [("A", "B"), ("B", "A")]


def test_borders_of_the_configuration(spark):
    df = spark.createDataFrame(list(config.BORDERS), "from_country string, to_country string")
    got = {tuple(r) for r in flows.both_directions(df).collect()}
    assert got == {p for a, b in config.BORDERS for p in ((a, b), (b, a))}
    assert {c for p in config.BORDERS for c in p} <= set(config.COUNTRIES)


def test_flow_ends(spark):
    df = spark.createDataFrame(
        [("A", "B", T0, 5.0), ("B", "A", T0, 2.0), ("A", "C", T0, 1.0)],
        "from_country string, to_country string, index timestamp, Value double",
    )
    one = {r["country"]: (r["imports"], r["exports"]) for r in flows.in_out_sums(df).collect()}
    assert one == {"A": (2.0, 6.0), "B": (5.0, 2.0), "C": (1.0, 0.0)}
    joined = flows.full_outer_zero(
        flows.sums_by_end(df, "to_country", name="imports"),
        flows.sums_by_end(df, "from_country", name="exports"), ["country", "index"],
    )
    assert {r["country"]: (r["imports"], r["exports"]) for r in joined.collect()} == one


def test_nearest_in_time_prefers_the_earlier(spark):
    rows = [("a", T0 + timedelta(hours=h), h) for h in (1, 3, 9)]
    df = spark.createDataFrame(rows, "k string, t timestamp, v int")
    assert J.nearest_in_time(df, ["k"], "t", F.lit("2024-01-01 02:00")).first()["v"] == 1


def test_nearest_in_time_skips_rows_without_a_time(spark):
    rows = [("a", T0 + timedelta(seconds=1), 1), ("a", None, 2), ("b", None, 3), ("a", T0 + timedelta(seconds=1), 0), (None, T0, 9)]
    df = spark.createDataFrame(rows, "k string, t timestamp, v int")
    got = {r["k"]: r["v"] for r in J.nearest_in_time(df, ["k"], "t", F.lit("2024-01-01 00:00"), ["v"]).collect()}
    assert got == {"a": 0, None: 9}


@pytest.mark.parametrize("levels", [1, 7])
def test_nearest_place_equals_brute_force(spark, levels):
    import math
    import random

    draw = random.Random(3)
    pts = [(draw.uniform(-90, 90), draw.uniform(-180, 180)) for _ in range(60)]
    pts += [(90.0, 0.0), (-90.0, 10.0), (0.0, 180.0), (5.0, -180.0), (1.0, 179.9)] + [(10.0, 179.0 + i / 100) for i in range(20)]
    places = [(i, draw.uniform(-80, 80), draw.uniform(-180, 180), f"P{i}") for i in range(60)]
    places += [(100, 1.0, -179.9, "E"), (101, 1.0, -179.9, "F"), (102, None, 5.0, "N")]
    df = spark.createDataFrame(pts + [(None, 1.0)], "lat double, lon double")
    dim = spark.createDataFrame(places, "place_id int, lat double, lon double, code string")
    got = {(r["lat"], r["lon"]): r["place_id"] for r in J.nearest_place(df, dim, levels).collect()}

    def far(a, b):
        p, q, d = math.radians(a[0]), math.radians(b[0]), math.radians(b[1] - a[1])
        return math.asin(math.sqrt(math.sin((q - p) / 2) ** 2 + math.cos(p) * math.cos(q) * math.sin(d / 2) ** 2))

    for p in pts:
        assert got[p] == min((far(p, s[1:3]), s[0]) for s in places if s[1] is not None)[1]
    assert got[(None, 1.0)] is None and len(got) == len(set(pts)) + 1


def test_resample_keeps_names(spark):
    rows = [("a", T0, 1.0, 4), ("a", T0 + timedelta(minutes=30), 3.0, 6), ("a", T0 + timedelta(hours=1), 7.0, 8)]
    df = spark.createDataFrame(rows, "country string, index timestamp, x double, y int")
    out = resample_mean(df, ["country"]).orderBy("index").collect()
    assert [tuple(r)[2:] for r in out] == [(2.0, 5.0), (7.0, 8.0)]


def test_masks_differ_by_column_and_hide_a_tenth(spark):
    df = spark.range(5000).select(F.col("id").cast("string").alias("k"), F.lit(1.0).alias("a"), F.lit(1.0).alias("b"))
    masked = M.mask_cells(df, ["a", "b"], F.col("k"))
    row = masked.agg(
        F.sum("a_was_masked").alias("a"), F.sum("b_was_masked").alias("b"),
        F.sum(F.expr("a_was_masked * b_was_masked")).alias("both"),
    ).first()
    assert 400 < row["a"] < 600 and 400 < row["b"] < 600 and row["both"] < 100
    assert masked.filter("(a_was_masked = 1) <> (a_mask IS NULL)").count() == 0


def _gaps(spark):
    rows = []
    for k in ("A", "B"):
        for i, t in enumerate(hours(6)):
            rows.append((k, t, float(i) if i % 2 else None, None if k == "A" else 2.0 * i))
    return spark.createDataFrame(rows, "country string, index timestamp, x double, y double")


def test_fills(spark):
    ways = M.fill_all_ways(_gaps(spark), ["country"], ["index"], {"x": "x"}).filter("country = 'A'").orderBy("index")
    rows = ways.collect()
    assert [r["x_mean"] for r in rows] == [3.0, 1.0, 3.0, 3.0, 3.0, 5.0]
    assert [r["x_median"] for r in rows] == [3.0, 1.0, 3.0, 3.0, 3.0, 5.0]
    assert [r["x_ffill_bfill"] for r in rows] == [1.0, 1.0, 1.0, 3.0, 3.0, 5.0]


def test_best_method_goes_to_one_key(spark):
    best = spark.createDataFrame(
        [("x", "A", "mean", 0.1), ("y", "B", "median", 0.2)], "column string, country string, method string, mae double"
    )
    out = M.apply_best(_gaps(spark), "country", ["index"], ["x", "y"], best).orderBy("country", "index").collect()
    assert [r["x"] for r in out[:6]] == [3.0, 1.0, 3.0, 3.0, 3.0, 5.0]      # mean for the winner
    assert [r["x"] for r in out[6:]] == [1.0, 1.0, 1.0, 3.0, 3.0, 5.0]      # neighbours for others
    assert [r["y"] for r in out[:6]] == [0.0] * 6                           # unknown everywhere


def test_best_method_picks_the_smallest_error(spark):
    maes = spark.createDataFrame(
        [("A", "x", "mean", 2.0), ("B", "x", "median", 1.0), ("A", "y", "mean", 3.0), ("A", "y", "median", 3.0)],
        "country string, column string, method string, mae double",
    )
    got = {r["column"]: (r["country"], r["method"]) for r in M.best_method(maes, "country").collect()}
    assert got == {"x": ("B", "median"), "y": ("A", "mean")}


def test_map_skips_absent_columns_and_uses_train_stats(spark):
    methods = {"x": "mean", "y": "ffill_bfill", "absent": "median"}
    df = _gaps(spark)
    out = M.apply_by_map(df, ["country"], ["index"], ["x", "y"], methods)
    assert out.columns == df.columns
    assert out.filter("x IS NULL OR y IS NULL").count() == 0
    train = df.withColumn("x", F.lit(100.0))
    other = M.apply_by_map(df, ["country"], ["index"], ["x", "y"], methods, stats_from=train)
    assert other.filter("x = 100").count() == 6


def test_method_map_is_complete():
    assert len(config.FILL_METHODS) == 37
    assert set(config.FILL_METHODS.values()) == {"mean", "median", "ffill_bfill"}
    assert len(config.COUNTRIES) == 27 and len(config.LEGACY_COLUMNS) == 19


def test_score_bins(spark):
    df = spark.createDataFrame([(v,) for v in (0.0, 0.5, 25.0, 25.1, 75.0, 80.0, None)], "v double")
    got = [r[0] for r in df.select(E.score_bin(F.col("v"))).collect()]
    assert got == [None, 1, 1, 2, 3, None, None]
    assert df.select(E.score_bin(F.col("v"), include_lowest=True)).first()[0] == 1


def test_empty_divisors_count_as_zero(spark):
    df = spark.createDataFrame([(10.0, 10.0), (20.0, 10.0)], "a double, p double")
    row = E.classification_metrics(df, "a", "p").first()
    assert (row["precision"], row["recall"], row["f1"], row["accuracy"]) == (0.0, 0.0, 0.0, 1.0)


def test_sweep_moves_or_pins_the_truth(spark):
    df = spark.createDataFrame([(55.0, 40.0), (35.0, 60.0)], "a double, p double")
    moved = {r["threshold"]: r["missed"] for r in E.threshold_sweep(df, "a", "p").collect()}
    pinned = {r["threshold"]: r["missed"] for r in E.threshold_sweep(df, "a", "p", fixed_truth=50).collect()}
    assert moved[30] == 0 and moved[55] == 1 and moved[60] == 0 and pinned[60] == 1


def test_regression_metrics_by_hand(spark):
    df = spark.createDataFrame([(1.0, 2.0), (3.0, 3.0), (5.0, 3.0)], "a double, p double")
    row = E.regression_metrics(df, "a", "p").first()
    assert row["mae"] == pytest.approx(1.0)
    assert row["rmse"] == pytest.approx((5 / 3) ** 0.5)
    assert row["r2"] == pytest.approx(1 - 5 / 8)


def test_correlations_skip_short_and_constant_columns(spark):
    rows = [(float(i), 2.0 * i, 1.0, float(i) if i < 50 else None) for i in range(200)]
    df = spark.createDataFrame(rows, "y double, twice double, flat double, short double")
    got = {r["feature"]: r["correlation"] for r in P.target_correlation(df, ["twice", "flat", "short"], "y").collect()}
    assert list(got) == ["twice"] and got["twice"] == pytest.approx(1.0)


def test_histogram_edges(spark):
    df = spark.createDataFrame([(0.0,), (2.5,), (75.0,), (76.0,)], "v double")
    assert sorted(map(tuple, P.histogram(df, "v", 0, 75, 30).collect())) == [(1, 1), (2, 1), (30, 1)]


def test_one_hot_round_trip_and_unseen(spark):
    df = spark.createDataFrame([("a",), ("z",), (None,)], "c string")
    flags = C.one_hot(df, "c", ["a", "b"])
    assert [tuple(r)[1:] for r in flags.collect()] == [(1, 0), (0, 0), (0, 0)]


def test_class_weights(spark):
    df = spark.createDataFrame([(1,), (0,), (0,), (0,)], "label int")
    got = {r["label"]: r["weight"] for r in FE.with_class_weights(df).collect()}
    assert got == {1: 2.0, 0: pytest.approx(4 / 6)}
