"""Layouts, changed partitions, sketches, grid files and the halving search."""

import os
import re
from datetime import datetime, timedelta

import pyarrow.parquet as pq
import pytest
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import LinearRegression
from pyspark.sql import functions as F

from panelforge.ml import models as ML
from panelforge.operators import sketches as SK
from panelforge.session import scratch_dir
from panelforge.sources import grid_source as G
from panelforge.sources.changes import load_changed
from panelforge.sources.layout import write_clustered

START = datetime(2024, 1, 1)


def local(path):
    return re.sub(r"^file:(//)?(?=/)", "", path)


def skipped(path, column, low, high):
    """The share of row groups that a filter rules out by their minima and maxima."""
    kept = total = 0
    for name in os.listdir(local(path)):
        if name.endswith(".parquet"):
            file = pq.ParquetFile(f"{local(path)}/{name}")
            at = file.schema_arrow.names.index(column)
            for g in range(file.metadata.num_row_groups):
                s = file.metadata.row_group(g).column(at).statistics
                total += 1
                kept += s.max is not None and not (s.max < low or s.min > high)
    return 1 - kept / total


def test_clustered_files_skip_row_groups_for_both_columns(spark):
    rows = spark.range(40_000).select(
        (F.xxhash64("id") % 500).alias("k"), F.timestamp_seconds(F.pmod(F.xxhash64("id", F.lit(1)), F.lit(10_000_000))).alias("t"), "id"
    ).withColumn("k", F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("k")))
    rows = rows.unionByName(spark.createDataFrame([(None, None, -1)], "k long, t timestamp, id long"))
    path = scratch_dir(spark, "curve")
    write_clustered(rows, path, ["k", "t"], files=64)
    assert spark.read.parquet(path).exceptAll(rows).count() == 0 and spark.read.parquet(path).count() == 40_001
    at = lambda s: datetime.fromtimestamp(s)
    stamp = spark.read.parquet(path).where("t IS NOT NULL").selectExpr("percentile_approx(unix_seconds(t), 0.5) AS m").first().m
    t = pq.ParquetFile(f"{local(path)}/{sorted(f for f in os.listdir(local(path)) if f.endswith('.parquet'))[0]}").schema_arrow.field("t").type
    moment = at(stamp).astimezone() if t.tz else at(stamp)
    assert skipped(path, "k", 100, 103) > 0.5 and skipped(path, "t", moment, moment) > 0.5


def files(path):
    found = {}
    for folder, _, names in os.walk(local(path)):
        for n in names:
            if n.endswith(".parquet"):
                found.setdefault(os.path.relpath(folder, local(path)), set()).add((n, os.stat(f"{folder}/{n}").st_mtime_ns))
    return found


def test_only_changed_partitions_are_written(spark):
    path = scratch_dir(spark, "changes")
    rows = [(k, f"d{i % 4}", i, float(i)) for i in range(200) for k in ("x", None)]
    df = lambda r: spark.createDataFrame(r, "k string, d string, i int, v double")
    told = lambda c: sorted(((r.k, r.d, r.change) for r in c.collect()), key=str)
    assert len(told(load_changed(df(rows), path, ["k", "d"]))) == 8
    before = files(path)
    assert told(load_changed(df(rows[::-1]), path, ["k", "d"])) == [] and files(path) == before
    later = [r for r in rows if r[:2] != ("x", "d3")]
    later = [(k, d, i, v if (k, d, i) != (None, "d1", 5) else None) for k, d, i, v in later] + [("y", "d0", 1, 1.0)]
    assert told(load_changed(df(later), path, ["k", "d"])) == sorted(
        [(None, "d1", "written"), ("y", "d0", "written"), ("x", "d3", "removed")], key=str
    )
    after = files(path)
    touched = {p for p in before | after if before.get(p) != after.get(p)}
    assert touched == {"k=__HIVE_DEFAULT_PARTITION__/d=d1", "k=y/d=d0", "k=x/d=d3"}
    assert spark.read.schema("k string, d string, i int, v double").parquet(path).select("k", "d", "i", "v").exceptAll(df(later)).count() == 0
    assert told(load_changed(df(later).withColumn("new", F.lit(1)), path, ["k", "d"])) != []


def test_sketches_read_only_new_days(spark):
    source, path = scratch_dir(spark, "days"), scratch_dir(spark, "sketches")
    rows = spark.range(30_000).select(
        F.when(F.col("id") % 3 == 0, "hot").otherwise("k").alias("k"), F.format_string("d%d", F.col("id") % 5).alias("day"), F.col("id").cast("double").alias("v")
    )
    rows.where("day < 'd4'").write.partitionBy("day").parquet(source)
    assert SK.refresh_quantiles(spark.read.parquet(source), path, ["k"], "day", "v").count() == 8
    before = files(path)
    rows.where("day = 'd4'").write.mode("append").partitionBy("day").parquet(source)
    new = spark.read.parquet(source)
    table = SK.refresh_quantiles(new, path, ["k"], "day", "v")
    after = files(path)
    assert {p for p in after if before.get(p) != after[p]} == {"day=d4"}
    done = [f"d{i}" for i in range(4)]
    plan = new.where(~F.col("day").isin(done)).select("k", "day", "v")
    assert {f.split("day=")[1].split("/")[0] for f in plan.inputFiles()} <= set("d0 d1 d2 d3 d4".split())
    for r in SK.sketched_quantiles(table, ["k"], {"p10": 0.1, "p50": 0.5}).collect():
        for name, p in (("p10", 0.1), ("p50", 0.5)):
            rank = rows.where((F.col("k") == r.k) & (F.col("v") <= r[name])).count() / r.n
            assert abs(rank - p) < 2 * SK.KLL_ERROR


def test_overlap_of_splits(spark):
    rows = spark.range(60_000).select("id", F.when(F.col("id") < 30_000, "a").otherwise("b").alias("s"))
    rows = rows.unionByName(spark.range(20_000, 30_000).select("id", F.lit("b").alias("s")))
    got = {(r.left, r.right): r for r in SK.overlap(rows, "s", ["id"]).collect()}
    assert set(got) == {("a", "b"), ("b", "a")}
    r = got["a", "b"]
    assert abs(r.both - 10_000) < 2_000 and abs(r.left_only - 20_000) < 3_000 and abs(r.left_all - 30_000) < 2_500
    few = SK.overlap(rows.where("id % 100 = 0"), "s", ["id"]).where("left = 'a'").first()
    assert (few.both, few.left_only, few.left_all) == (100, 200, 300)


def test_grid_files_that_a_filter_rules_out_are_not_opened(spark):
    path = scratch_dir(spark, "grid")
    rows = [(START + timedelta(hours=h), v, [float(h), None if v == "2t" else 0.5]) for h in range(6) for v in ("10u", "2t")]
    messages = spark.createDataFrame([*rows, (None, "10u", [1.0]), (START, None, [1.0])], "timestamp timestamp, short_name string, values array<float>")
    assert G.write_messages(messages, path) == 12
    read = G.read_messages(spark, path)
    assert sorted((r.timestamp, r.short_name, r.values[0]) for r in read.collect()) == [(t, v, a[0]) for t, v, a in rows]
    assert read.where("short_name = '2t'").first().values == [0.0] and read.rdd.getNumPartitions() == 12
    # A message that can't be opened, and is listed like the others.
    os.mkdir(f"{local(path)}/{int(START.timestamp()) + 5400}_10u.grid")
    late = read.where((F.col("timestamp") >= START + timedelta(hours=4)) & (F.col("short_name") == "10u"))
    assert sorted(r.values[0] for r in late.collect()) == [4.0, 5.0] and late.rdd.getNumPartitions() == 2
    with pytest.raises(Exception):
        G.read_messages(spark, path).collect()


def test_many_small_grid_files_share_tasks(spark):
    path = scratch_dir(spark, "grid")
    hours = [START + timedelta(hours=h) for h in range(300)]
    rows = [(t, "2t", [float(i)] * (i % 4)) for i, t in enumerate(hours)]
    assert G.write_messages(spark.createDataFrame(rows, "timestamp timestamp, short_name string, values array<float>"), path) == 300
    read = G.read_messages(spark, path)
    assert G.FEW <= read.rdd.getNumPartitions() <= 2 * G.FEW
    assert sorted((r.timestamp, r.short_name, r["values"]) for r in read.collect()) == rows
    large = [G.TASK_BYTES] * 3 + [0] * 3 * G.TASK_FILES
    runs = list(G._runs(large))
    assert [i for a, b in runs for i in range(a, b)] == list(range(len(large)))
    assert len(runs) < 200 and all(b - a == 1 for a, b in runs if a < 3) and list(G._runs([])) == []


def test_halving_finds_the_planted_draw(spark):
    rows = spark.range(600).select(
        F.rand(1).alias("a"), F.rand(2).alias("b")).withColumn("y", F.col("a") * 3 - F.col("b"))
    train = VectorAssembler(inputCols=["a", "b"], outputCol="features").transform(rows)
    model = LinearRegression(labelCol="y", maxIter=9)
    best, table = ML.halving_search(train, model, {model.regParam: [0.0, 5.0, 20.0, 80.0]}, "y", n=6, folds=2, rungs=2)
    lines = table.collect()
    first = [r for r in lines if r.rung == 0]
    assert len(first) == 12 and {r.rounds for r in first} == {3} and {r.draw for r in first} == set(range(6))
    assert len({r.draw for r in lines if r.rung == 1}) == 2 and {r.rounds for r in lines if r.rung == 1} == {9}
    assert best.getRegParam() == 0.0 and best.coefficients[0] == pytest.approx(3, abs=0.01)
