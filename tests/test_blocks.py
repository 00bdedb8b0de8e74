"""Block windows equal whole-key windows, whatever the span and the skew."""

import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from panelforge.operators import blocks as K

ORDER = ["t", "id"]


def _rows(seed):
    """One key holds most rows; times have gaps, ties and a NULL."""
    draw = random.Random(seed)
    start = datetime(2024, 1, 1)
    rows = []
    for i in range(400):
        key = "hot" if draw.random() < 0.7 else draw.choice(["a", "b", None])
        t = start + timedelta(minutes=draw.choice([draw.randrange(300), draw.randrange(20000)]))
        value = draw.choice([None, None, float(draw.randrange(100))])
        rows.append((key, t if draw.random() < 0.99 else None, i, value))
    return rows


def _frame(spark, seed):
    return spark.createDataFrame(_rows(seed), "k string, t timestamp, id int, v double")


def _set(df):
    return sorted(map(str, df.collect()))


@pytest.mark.parametrize("span", ["10 minutes", "3 hours", "30 days", "auto", 30])
def test_row_frames(spark, span):
    df = _frame(spark, 1)

    def columns(w):
        return {
            "lag5": F.lag("v", 5).over(w), "lead3": F.lead("v", 3).over(w),
            "mean": F.avg("v").over(w.rowsBetween(-7, 2)), "n": F.count("id").over(w.rowsBetween(-7, 0)),
        }

    whole = K.row_frames(df, ["k"], ORDER, columns)
    cut = K.row_frames(df, ["k"], ORDER, columns, before=7, after=3, span=span)
    assert _set(whole) == _set(cut)


@pytest.mark.parametrize("span", ["10 minutes", "3 hours", "30 days", 30])
def test_fill_frames(spark, span):
    df = _frame(spark, 2)
    kinds = {"forward": {"f": "v"}, "backward": {"b": "v"}, "both": {"x": "v"}}
    whole = K.fill_frames(df, ["k"], ORDER, **kinds)
    cut = K.fill_frames(df, ["k"], ORDER, **kinds, span=span)
    assert _set(whole) == _set(cut)
    assert whole.columns == cut.columns


def test_blocks_split_a_hot_key(spark):
    df = _frame(spark, 3).filter("k = 'hot'")
    sizes = df.groupBy(K.block_of("t", "3 hours").alias("b")).count()
    assert sizes.count() > 10


def test_counted_blocks_are_bounded_however_rows_lie(spark):
    """A burst of one minute, equal times, rows without a time, a row a year later."""
    start = datetime(2024, 1, 1)
    rows = [("hot", start + timedelta(milliseconds=17 * i), i, 1.0) for i in range(3000)]
    rows += [("hot", start, 10_000 + i, 1.0) for i in range(2000)]
    rows += [("late", None, 20_000 + i, 1.0) for i in range(2500)]
    rows += [("hot", start + timedelta(days=365), 1, 1.0)] + [(None, start + timedelta(days=i), i, 1.0) for i in range(900)]
    rows += [("equal", start, None, 1.0)] * 1500 + [("equal", None, None, 1.0)] * 1500
    df = spark.createDataFrame(rows, "k string, t timestamp, id int, v double")
    cut, whole = K.counted_blocks(df, ["k"], ORDER, 200)
    assert not whole and K.counted_blocks(df, ["k"], ORDER, 10_000)[1]
    sizes = [r["count"] for r in cut.groupBy("k", K.BLOCK).count().collect()]
    assert sum(sizes) == len(rows) and max(sizes) < 400
    # Blocks follow each other in the order of rows.
    place = F.struct(*ORDER, K.ROW)
    bounds = cut.groupBy("k", K.BLOCK).agg(F.min(place).alias("a"), F.max(place).alias("b"))
    window = Window.partitionBy("k").orderBy(K.BLOCK)
    assert bounds.withColumn("p", F.lag("b").over(window)).filter("p >= a").count() == 0
