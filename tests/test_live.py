"""Jobs of several stateful steps: late rows, rows of one side, restarts, expiry."""

import datetime as dt

import pytest

from panelforge.streaming import jobs as J
from panelforge.streaming import live as V

SCHEMA = "k string, t timestamp, id long, v double"


def at(minutes):
    return dt.datetime(2024, 1, 1) + dt.timedelta(minutes=minutes)


@pytest.fixture
def folder(spark, tmp_path):
    def make(name):
        path = str(tmp_path / name)

        def add(rows):
            spark.createDataFrame([(k, at(m), i, v) for k, m, i, v in rows], SCHEMA).coalesce(1).write.mode("append").parquet(path)

        return add, lambda: J.file_stream(spark, path, SCHEMA, files_per_batch=1)

    return make


def test_margin_join_of_two_streams(folder, tmp_path):
    add_load, load = folder("load")
    add_plan, plan = folder("plan")
    out = str(tmp_path / "out")

    def run():
        hours = V.joined_hours(
            load().selectExpr("k", "t", "v AS load"), plan().selectExpr("k", "t", "v AS plan"), "k", "t", "load", "plan", out, late="1 hour"
        )
        return {(r.k, (r.t - at(0)).total_seconds() / 3600): (r.load, r.plan) for r in hours.collect()}

    add_load([("a", 0, 1, 10.0), ("a", 30, 2, 20.0), ("a", 70, 3, 5.0), (None, 10, 4, 1.0)])
    add_plan([("a", 5, 1, 12.0), ("b", 5, 2, 7.0), (None, 40, 3, 3.0)])
    assert run() == {}                                   # no watermark has passed an hour yet
    add_load([("a", 300, 5, 1.0)])
    assert run() == {}                                   # the slower stream holds them back
    add_plan([("a", 310, 4, 2.0)])
    add_load([("a", 301, 7, 1.0)])                       # a stream without new rows holds back, too
    closed = {("a", 0): (15.0, 12.0), ("a", 1): (5.0, None), ("b", 0): (None, 7.0), (None, 0): (1.0, 3.0)}
    assert run() == closed
    add_plan([("a", 65, 5, 9.0)])                        # too late for its hour
    add_load([("a", 302, 8, 1.0)])
    assert run() == closed
    add_load([("a", 900, 6, 1.0)])
    add_plan([("a", 900, 6, 1.0)])
    assert run() == closed | {("a", 5): (1.0, 2.0)}


def test_panes_equal_sliding_windows(folder, tmp_path):
    add, stream = folder("in")
    rows = [("a" if i % 3 else "b", i * 13 % 600, i, float(i)) for i in range(80)]
    add(rows)
    add([("a", 3000, 99, 0.0)])
    got = {(r.k, r.window_end): r.window_mean for r in V.pane_mean(stream(), "k", "t", "v", str(tmp_path / "out"), "3 hours").collect()}
    want = {}
    for k in "ab":
        for end in range(1, 13):
            own = [v for key, m, _, v in rows if key == k and (end - 3) * 60 <= m < end * 60]
            if own:
                want[k, at(end * 60)] = pytest.approx(sum(own) / len(own))
    assert got == want


def test_store_fills_over_batches_and_restarts(folder, tmp_path):
    add, stream = folder("in")
    out = str(tmp_path / "out")

    def run(**kw):
        return {(r.k, r.id): r.filled for r in V.fill_live(stream(), "k", "t", "id", "v", out, late="10 minutes", **kw).collect()}

    add([("a", 10, 1, 1.0), ("a", 20, 2, None), (None, 5, 8, 3.0)])
    add([("a", 30, 3, None), (None, 6, 9, None), ("b", 1, 4, None), ("a", 25, 5, 7.0)])   # rows out of order
    first = run()
    # Up to the watermark, 00:20; a row is late by the watermark of the batch before.
    assert first == {("a", 1): 1.0, ("a", 2): 1.0, (None, 8): 3.0, (None, 9): 3.0, ("b", 4): None}
    add([("a", 60, 6, None), ("b", 12, 7, 2.0)])                          # b's row is too late
    second = run()
    assert second == first | {("a", 5): 7.0, ("a", 3): 7.0}
    add([("a", 100, 10, None)])
    assert run() == second | {("a", 6): 7.0}


def test_store_forgets(folder, tmp_path):
    add, stream = folder("in")
    out = str(tmp_path / "out")
    add([("a", 0, 1, 1.0), ("a", 30, 2, None), ("a", 90, 3, None)])
    add([("z", 500, 4, 1.0)])
    rows = V.fill_live(stream(), "k", "t", "id", "v", out, late="1 minute", forget="1 hour").collect()
    assert {r.id: r.filled for r in rows} == {1: 1.0, 2: 1.0, 3: None}
    add([("a", 520, 5, None), ("z", 900, 6, None)])
    rows = V.fill_live(stream(), "k", "t", "id", "v", out, late="1 minute", forget="1 hour").collect()
    assert {r.id: r.filled for r in rows} == {1: 1.0, 2: 1.0, 3: None, 4: 1.0, 5: None}


def test_store_keeps_many_keys_in_few_buckets(spark, tmp_path, monkeypatch):
    path, out, ran = str(tmp_path / "in"), str(tmp_path / "out"), []
    run = V._run

    def watched(*args):
        ran.append(run(*args))
        return ran[-1]

    monkeypatch.setattr(V, "_run", watched)
    keys = [None, *range(2**60, 2**60 + 300)]
    for first, values in ((0, [1.5, None]), (300, [None, 2.5]), (9000, [None])):
        rows = [(k, at(first + i), first + i, None if v is None else v + n) for n, k in enumerate(keys) for i, v in enumerate(values)]
        spark.createDataFrame(rows, "k long, t timestamp, id long, v double").coalesce(1).write.mode("append").parquet(path)
        stream = J.file_stream(spark, path, "k long, t timestamp, id long, v double", files_per_batch=1)
        got = V.fill_live(stream, "k", "t", "id", "v", out, late="10 minutes", buckets=4)
    want = {(k, i): n + v for n, k in enumerate(keys) for i, v in ((0, 1.5), (1, 1.5), (300, 1.5), (301, 2.5))}
    rows = got.collect()
    assert {(r.k, r.id): r.filled for r in rows} == want and len(rows) == len(want)
    timers = [o["customMetrics"]["numRegisteredTimers"] for q in ran for p in q.recentProgress for o in p["stateOperators"]]
    assert 0 < max(timers) <= 4


@pytest.mark.parametrize("kind, keys", [
    ("binary", [b"\xff", b"a", None]), ("timestamp", [at(0), at(1), None]), ("double", [float("inf"), 0.1, None]),
    ("struct<a:int,b:string>", [(1, None), (None, "x"), None]), ("date", [at(0).date(), None]), ("boolean", [True, False, None]),
])
def test_keys_come_back_from_text(spark, kind, keys):
    rows = spark.createDataFrame([(k,) for k in keys], f"k {kind}")
    text, back = V._as_text("k", kind)
    assert rows.select(text.alias("k")).distinct().count() == len(keys)
    assert rows.select(text.alias("k")).select(back.alias("k")).collect() == rows.collect()
