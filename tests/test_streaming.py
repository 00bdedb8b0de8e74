"""The jobs on several files, one in a batch, and on files that come after a run."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from panelforge.streaming import jobs as J

SCHEMA = "k string, t timestamp, id long, v double"


@pytest.fixture
def files(spark, tmp_path):
    """Writes rows as one more file of a folder; the stream takes one file a batch."""
    folder = str(tmp_path / "in")

    def add(rows):
        data = [(k, dt.datetime(2024, 1, 1, tzinfo=dt.timezone.utc) + dt.timedelta(minutes=m), i, v) for k, m, i, v in rows]
        spark.createDataFrame(data, SCHEMA).coalesce(1).write.mode("append").parquet(folder)

    def stream():
        return J.file_stream(spark, folder, SCHEMA, files_per_batch=1)

    return add, stream, str(tmp_path / "out")


def readings(first, n, day=0):
    return [("a" if i % 2 else "b", day * 1440 + i * 7 % 1440, i, float(i)) for i in range(first, first + n)]


def test_replace_days_keeps_rows_of_every_batch(files):
    add, stream, out = files
    made = lambda: J.replace_days(stream().withColumn("d", F.date_format("t", "yyyy-MM-dd")), out, ["d"], ["id"])
    add(readings(0, 50))
    add(readings(50, 50))
    add(readings(100, 20, day=1))
    assert made().count() == 120
    add([("a", 5, 3, 99.0)] + readings(200, 10))
    table = made()
    assert table.count() == 130 and table.where("id = 3").first().v == 99.0
    assert made().count() == 130


def test_deduplicated_goes_on_after_a_run(files):
    add, stream, out = files
    add(readings(0, 40))
    assert J.deduplicated(stream(), ["id"], "t", out, "3 days").count() == 40
    add(readings(20, 60))
    assert J.deduplicated(stream(), ["id"], "t", out, "3 days").count() == 80


@pytest.mark.parametrize("width", [None, "2 hours"])
def test_means_go_on_after_a_run(files, width):
    add, stream, out = files

    def run():
        if width:
            return J.sliding_mean(stream(), "k", "t", "v", out, width, late="3 days")
        return J.hourly_mean(stream(), "k", "t", "v", out, "3 days")

    for i in range(4):
        add([("a", 1, i, 10.0 * i)])
    first = run().collect()
    assert {r[2] for r in first} == {15.0}
    add([("a", 2, 9, 140.0)])
    assert {r[2] for r in run().collect()} == {40.0}


def test_fill_forward_in_any_order(spark, files):
    add, stream, out = files
    run = lambda: {(r.k, r.id): r.filled for r in J.fill_forward(stream(), "k", ["t", "id"], "v", out).collect()}
    add([("a", 10, 1, 1.0), ("a", 20, 2, None), (None, 5, 8, 3.0)])
    add([("a", 30, 3, None), (None, 6, 9, None), ("b", 1, 4, None)])
    assert run() == {("a", 1): 1.0, ("a", 2): 1.0, ("a", 3): 1.0, (None, 8): 3.0, (None, 9): 3.0, ("b", 4): None}
    add([("a", 15, 5, 7.0), ("b", 0, 6, 2.0)])
    add([("a", 40, 7, None)])
    assert run() == {("a", 1): 1.0, ("a", 5): 7.0, ("a", 2): 7.0, ("a", 3): 7.0, ("a", 7): 7.0, (None, 8): 3.0, (None, 9): 3.0, ("b", 6): 2.0, ("b", 4): 2.0}


def test_closed_hours_counts_every_batch(files):
    add, stream, out = files
    add([("a", 0, 1, 1.0), ("a", 600, 2, 1.0)])
    rows, dropped = J.closed_hours(stream(), "k", "t", out)
    assert rows.count() == 1 and dropped == 0
    for i in range(3):
        add([("a", 5 + i, 10 + i, 1.0)])
    rows, dropped = J.closed_hours(stream(), "k", "t", out)
    assert rows.count() == 1 and dropped == 3
