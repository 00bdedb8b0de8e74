"""The as-of join against a plain search, with one key that holds most rows."""

import datetime as dt
import random

import pytest

from panelforge.operators.asof import asof_join

START = dt.datetime(2024, 1, 1)


def rows(seed, n, keys):
    draw = random.Random(seed)
    out = []
    for i in range(n):
        key = "hot" if draw.random() < 0.8 else draw.choice(keys)
        at = None if draw.random() < 0.02 else START + dt.timedelta(minutes=draw.randrange(3000))
        out.append((key, at, i, None if draw.random() < 0.1 else float(i)))
    return out


def plain(left, right, side, tolerance):
    out = []
    for key, at, i, _ in left:
        near = [r for r in right if r[0] == key and r[1] is not None and at is not None]
        before = max((r for r in near if r[1] <= at), key=lambda r: (r[1], r[2]), default=None)
        from_ = 0 if side == "after" else 1   # nearest: rows of the same time count as before
        after = min((r for r in near if (r[1] - at).total_seconds() >= from_), key=lambda r: (r[1], r[2]), default=None)
        fits = lambda r: r is not None and (tolerance is None or abs(r[1] - at) <= tolerance)
        before, after = (r if fits(r) else None for r in (before, after))
        hit = {"before": before, "after": after}.get(side)
        if side == "nearest":
            hit = after if before is None or (after is not None and after[1] - at < at - before[1]) else before
        out.append((i, None if hit is None else hit[2], None if hit is None else hit[3]))
    return sorted(out, key=str)


@pytest.mark.parametrize("side", ["before", "after", "nearest"])
@pytest.mark.parametrize("tolerance", [None, 20])
def test_equals_a_plain_search(spark, side, tolerance):
    left, right = rows(1, 300, ["a", "b", None]), rows(2, 120, ["a", "c", None])
    schema = "k string, t timestamp, id long, v double"
    joined = asof_join(
        spark.createDataFrame(left, schema), spark.createDataFrame(right, schema), ["k"], "t", side,
        tolerance and f"{tolerance} minutes", ties=["id"], span=25,
    )
    assert joined.columns == ["k", "t", "id", "v", "right_t", "right_id", "right_v"]
    got = sorted(((r.id, r.right_id, r.right_v) for r in joined.collect()), key=str)
    assert got == plain(left, right, side, tolerance and dt.timedelta(minutes=tolerance))


def test_empty_sides_and_inner(spark):
    schema = "k string, t timestamp, id long"
    left = spark.createDataFrame([("a", START, 1), ("b", START, 2)], schema)
    right = spark.createDataFrame([("a", START, 7)], schema)
    assert asof_join(left, right.limit(0), ["k"], "t").where("right_id IS NULL").count() == 2
    assert asof_join(left.limit(0), right, ["k"], "t").count() == 0
    assert [(r.id, r.right_id) for r in asof_join(left, right, ["k"], "t", how="inner").collect()] == [(1, 7)]
    with pytest.raises(ValueError):
        asof_join(left, right, ["k"], "t", "around")
