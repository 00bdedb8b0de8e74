"""Sinks, migrations and streams on small literals."""

from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from panelforge.session import scratch_dir, shuffle_partitions
from panelforge.sources import grids
from panelforge.sources import tables as T
from panelforge.streaming import jobs as J


def _rows(path, spark):
    return sorted(map(tuple, spark.read.parquet(path).select("k", "d", "v").collect()))


def test_replace_touches_only_its_partitions_and_is_idempotent(spark):
    path = scratch_dir(spark, "t")
    schema = "k string, d string, v int"
    T.create_or_replace_partitions(
        spark.createDataFrame([("A", "x1", 1), ("A", "x2", 2), ("B", "x1", 3)], schema), path, ["k", "d"]
    )
    batch = spark.createDataFrame([("A", "x2", 9), ("A", "x2", 8)], schema)
    for _ in range(2):
        T.create_or_replace_partitions(batch, path, ["k", "d"])
        assert _rows(path, spark) == [("A", "x1", 1), ("A", "x2", 8), ("A", "x2", 9), ("B", "x1", 3)]
    T.replace_partitions(batch.limit(0), path, ["k", "d"])
    assert len(_rows(path, spark)) == 4


def test_schema_grows_and_shrinks(spark):
    path = scratch_dir(spark, "t")
    T.append(spark.createDataFrame([(1, 2)], "a int, b int"), path)
    T.append(spark.createDataFrame([(3, 4, 5)], "a int, b int, c int"), path)
    T.append(spark.createDataFrame([(6,)], "a int"), path)
    got = sorted(map(tuple, T.read_evolving(spark, path).select("a", "b", "c").collect()))
    assert got == [(1, 2, None), (3, 4, 5), (6, None, None)]


def test_table_lifecycle(spark):
    df = spark.createDataFrame([("A", 1), ("B", 2)], "k string, v int")
    T.overwrite_table(df, "life", scratch_dir(spark, "life"), ["k"])
    assert T.partition_columns(spark, "life") == ["k"]
    assert T.partition_columns(spark, "no_such_table") == []
    T.unpartition_table(spark, "life", scratch_dir(spark, "life"))
    assert T.partition_columns(spark, "life") == []
    assert spark.table("life").count() == 2
    T.full_reload(df.limit(1), "life", scratch_dir(spark, "life"))
    assert spark.table("life").count() == 1
    T.ensure_schema(spark, "other")
    assert spark.catalog.currentDatabase() == "other"
    spark.catalog.setCurrentDatabase("default")


def test_backfill_adds_and_fills(spark):
    df = spark.createDataFrame([(datetime(2024, 1, 5, 3),)], "index timestamp")
    assert T.backfill_date(df).first()["date"] == "2024-01-05"
    part = df.withColumn("date", F.lit("kept"))
    assert T.backfill_date(part).first()["date"] == "kept"


def test_lineage_reads_the_day_from_the_file(spark):
    df = spark.createDataFrame([("all_20240229.bin",)], "f string")
    row = T.with_lineage(df, "run", F.col("f"), F.col("f")).first()
    assert (row["year"], row["month"], row["day"], row["load_id"]) == (2024, 2, 29, "run")


def test_partitions_follow_the_shuffle_size():
    assert shuffle_partitions(1024) == 200
    assert shuffle_partitions(20 * 1024**4) == 81920       # 20 TB in 256 MB pieces


class _Session:
    def __init__(self, **conf):
        self.conf = {k.replace("_", "."): v for k, v in conf.items()}


def test_scratch_lies_in_the_shared_folder_or_the_warehouse():
    warehouse = {"spark_sql_warehouse_dir": "hdfs://store/warehouse/"}
    assert scratch_dir(_Session(**warehouse), "x").startswith("hdfs://store/warehouse/_scratch-")
    assert scratch_dir(_Session(spark_checkpoint_dir="hdfs://store/shared", **warehouse), "x").startswith("hdfs://store/shared/x-")


def test_a_warehouse_on_one_machine_is_warned_of_on_a_cluster():
    with pytest.warns(UserWarning, match="spark.checkpoint.dir"):
        scratch_dir(_Session(spark_sql_warehouse_dir="file:/no/such/folder", spark_master="yarn"), "x")


def test_sample_is_stable(spark):
    df = spark.range(1000).repartition(7)
    again = spark.range(1000).repartition(3)
    a = {r["id"] for r in T.hashed_sample(df, "id", 100).collect()}
    assert len(a) == 100 and a == {r["id"] for r in T.hashed_sample(again, "id", 100).collect()}


def test_grid_with_a_missing_variable(spark):
    t1, t2 = datetime(2024, 1, 1), datetime(2024, 1, 2)
    rows = [(t1, "10u", [3.0, 0.0]), (t1, "10v", [4.0, 1.0]), (t1, "2t", [273.15, 280.0]), (t2, "2t", [300.0, 1.0])]
    cells = spark.createDataFrame([(0, 50.0, 5.0), (1, 50.0, 6.0)], "pos int, lat double, lon double")
    messages = spark.createDataFrame(rows, "timestamp timestamp, short_name string, values array<double>")
    out = {(r["timestamp"], r["lon"]): r for r in grids.flatten_grid(messages, cells).collect()}
    assert len(out) == 4
    assert out[(t1, 5.0)]["wind_speed"] == 5.0 and out[(t1, 5.0)]["temperature_c"] == pytest.approx(0)
    assert out[(t1, 5.0)]["ssrd"] is None and out[(t2, 6.0)]["u10"] is None


def test_stream_fill_carries_state_over_batches(spark):
    """Three deliveries in time order, one file each."""
    path, start = scratch_dir(spark, "in"), datetime(2024, 1, 1)
    rows = [
        (k, start + timedelta(hours=i), i, float(i) if (i % 7 == 0 and k == "a") else None)
        for i in range(60) for k in ("a", "b")
    ]
    df = spark.createDataFrame(rows, "k string, t timestamp, id int, v double")
    for part in range(3):
        df.filter((F.col("id") >= part * 20) & (F.col("id") < part * 20 + 20)).coalesce(1).write.parquet(
            f"{path}/part={part}"
        )
    stream = J.file_stream(spark, path, df.schema, files_per_batch=1)
    out = J.fill_forward(stream, "k", ["t", "id"], "v", scratch_dir(spark, "out"), span="6 hours")
    got = {(r["k"], r["id"]): r["filled"] for r in out.collect()}
    assert len(got) == 120
    assert all(got["a", i] == i // 7 * 7 for i in range(60))
    assert all(got["b", i] is None for i in range(60))


def test_stream_means_update_over_batches(spark):
    path, start = scratch_dir(spark, "in"), datetime(2024, 1, 1)
    for part in range(2):
        rows = [("a", start + timedelta(minutes=20 * i), float(part * 10 + i)) for i in range(3)]
        spark.createDataFrame(rows, "k string, t timestamp, v double").coalesce(1).write.parquet(f"{path}/part={part}")
    stream = J.file_stream(spark, path, "k string, t timestamp, v double", files_per_batch=1)
    out = J.hourly_mean(stream, "k", "t", "v", scratch_dir(spark, "out")).collect()
    assert [r["v"] for r in out] == [6.0]


def test_the_literal_table_is_the_broadcast_side(spark):
    dim = T.local_rows(spark, [("a", 1, None), (None, 2, None)], "k string, n int, v double")
    assert [tuple(r) for r in dim.collect()] == [("a", 1, None), (None, 2, None)]
    path = scratch_dir(spark, "facts")
    spark.range(1000).selectExpr("CASE WHEN id % 2 = 0 THEN 'a' ELSE 'b' END AS k").write.parquet(path)
    joined = spark.read.parquet(path).join(dim, "k")
    assert joined.count() == 500
    plan = joined._jdf.queryExecution().sparkPlan().toString()
    assert "BroadcastHashJoin" in plan and "BuildRight" in plan
    assert T.local_rows(spark, [], "k string, s struct<a:int>").dtypes == [("k", "string"), ("s", "struct<a:int>")]
