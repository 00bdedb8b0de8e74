"""Live series out of several stateful steps.

Jobs here append: a row comes out once, when the watermark has passed it, and never
changes. Like those of ``jobs``, they run until the input is used up and go on from their
checkpoint when they are called again.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor

from panelforge.operators.blocks import span_seconds
from panelforge.operators.scores import with_load_errors, with_reserve_margin
from panelforge.streaming.jobs import _read, _run

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
PROVIDER = "spark.sql.streaming.stateStore.providerClass"


def _hours(stream: DataFrame, key: str, time: str, value: str, late: str) -> DataFrame:
    hour = F.window(time, "1 hour").alias("_w")
    # A NULL key is a key; two structs that hold NULL are equal, two NULLs aren't.
    return stream.withWatermark(time, late).groupBy(F.struct(F.col(key).alias("k")).alias("_key"), hour).agg(F.avg(value).alias(value))


def joined_hours(
    actual: DataFrame, forecast: DataFrame, key: str, time: str, load: str, predicted: str, out: str,
    late: str = "2 hours", checkpoint: str | None = None,
) -> DataFrame:
    """Hourly means of two streams that arrive apart, side by side: key, time, load, predicted.

    Both streams are averaged per key and hour and joined on these. An hour comes out once
    the slower stream's watermark has passed it; if only one stream had rows, the other's
    mean is NULL. Rows that come later than that are dropped. The state holds the hours
    that are still open, one row each, however many readings they have."""
    ours = _hours(actual, key, time, load, late)
    theirs = _hours(forecast, key, time, predicted, late)
    both = ours.join(theirs, ["_key", "_w"], "full_outer")
    rows = both.select(F.col("_key.k").alias(key), F.col("_w.start").alias(time), load, predicted)
    _run(rows, "append", out, checkpoint)
    return _read(actual.sparkSession, out, rows.schema)


def live_margin(hours: DataFrame, key: str, time: str, load: str, predicted: str) -> DataFrame:
    """Reserve margin and forecast error of what ``joined_hours`` gave so far. Hours
    without a load don't count for the trailing mean; those without a forecast have no
    error. A key has a row an hour, so its window is bounded."""
    known = hours.where(F.col(load).isNotNull())
    return with_load_errors(with_reserve_margin(known, [key], [time], load), load, predicted)


def pane_mean(
    stream: DataFrame, key: str, time: str, value: str, out: str, width: str = "24 hours", step: str = "1 hour",
    late: str = "2 hours", checkpoint: str | None = None,
) -> DataFrame:
    """Mean over sliding windows, named by their end, out of panes of one step: each row
    goes into one pane, and only panes are copied into the windows they belong to. A
    window comes out once the watermark has passed its end."""
    panes = (
        stream.withWatermark(time, late).groupBy(key, F.window(time, step).alias("_pane"))
        .agg(F.sum(value).alias("_sum"), F.count(value).alias("_n"))
    )
    windows = (
        panes.groupBy(key, F.window(F.window_time("_pane"), width, step).alias("_w"))
        .agg(F.try_divide(F.sum("_sum"), F.sum("_n")).alias("window_mean"))
        .select(key, F.col("_w.end").alias("window_end"), "window_mean")
    )
    _run(windows, "append", out, checkpoint)
    return _read(stream.sparkSession, out, windows.schema)


def _as_text(key: str, kind: str) -> tuple[Column, Column]:
    """A key as text that differs where keys differ, and the way back from it."""
    own = F.col(key)
    if kind == "binary":
        return F.hex(own), F.unhex(own)
    if kind == "timestamp":
        return F.unix_micros(own).cast("string"), F.timestamp_micros(own.cast("bigint"))
    if kind.startswith(("array", "struct")):
        return F.when(own.isNotNull(), F.to_json(F.struct(own), {"ignoreNullFields": "false"})), F.from_json(own, f"`{key}` {kind}")[key]
    return own.cast("string"), own.cast(kind)


def fill_live(
    stream: DataFrame, key: str, time: str, row: str, value: str, out: str, name: str = "filled",
    late: str = "2 hours", forget: str | None = None, checkpoint: str | None = None, buckets: int = 512,
) -> DataFrame:
    """Carry the last known value per key, with the state in the state store: key, time,
    row, value, ``name``.

    Keys are dealt to ``buckets`` by their hash, since every call of the state store and
    every value in it costs far more than a row: a batch makes a few calls a bucket, however
    many keys there are, and the rows that it brings to a bucket are one pickled value. A
    bucket's state is the last known value of each of its keys and the rows that the
    watermark hasn't passed. When it passes them, a timer of the bucket wakes: they come out
    in the order of time and ``row``, filled, in whatever order they arrived. So a batch
    touches the buckets that it brings or wakes, and no row that was written before is read
    again. With ``forget``, such as "30 days", a value is carried no longer than that, and a
    key without newer rows gives up its state then.

    Rows later than the watermark are dropped. ``row`` names a row within its key and isn't
    NULL; a NULL key is a key. A task holds the waiting rows and known values of one bucket:
    with many keys, raise ``buckets``. A checkpoint goes on with the number it began with."""
    spark, kind = stream.sparkSession, dict(stream.dtypes)
    keep = None if forget is None else span_seconds(forget) * 1_000_000
    micros, bucket = "micros", "bucket"
    while micros in (key, time, row, value, name):
        micros += "_"
    while bucket in (key, time, row, value, name):
        bucket += "_"
    schema = f"`{key}` string, {micros} bigint, `{row}` {kind[row]}, `{value}` {kind[value]}, `{name}` {kind[value]}"

    names = [key, micros, row, value, name]

    # Made here, so that it travels with the task.
    class Fill(StatefulProcessor):
        def init(self, handle) -> None:
            self.handle = handle
            self.waiting = handle.getListState("waiting", "rows binary")
            self.known = handle.getValueState("known", "pairs binary")
            self.timer = handle.getValueState("timer", "at bigint")

        @staticmethod
        def millis(at: int) -> int:
            return -(-at // 1000)

        def wake(self, at: int) -> None:
            old = self.timer.get()
            if old is not None:
                if old[0] <= at:
                    return
                self.handle.deleteTimer(old[0])
            self.handle.registerTimer(at)
            self.timer.update((at,))

        def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
            new = [
                (k, int(at), r, None if pd.isna(v) else v)
                for part in rows for k, at, r, v in zip(*(part.iloc[:, i].tolist() for i in (1, 3, 4, 5)))   # by place: names are changed
            ]
            self.waiting.appendValue((pickle.dumps(new),))
            self.wake(self.millis(min(x[1] for x in new)))
            yield from ()

        def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
            now = timerValues.getCurrentWatermarkInMs()
            self.timer.clear()
            due, rest = [], []
            for part in self.waiting.get():
                for x in pickle.loads(part[0]):
                    (due if self.millis(x[1]) <= now else rest).append(x)
            due.sort(key=lambda x: x[1:3])
            old = self.known.get()
            old = {} if old is None else pickle.loads(old[0])
            known, filled = dict(old), []
            for k, at, _, v in due:
                if v is not None:
                    known[k] = (at, v)
                last = known.get(k)
                filled.append(last[1] if last is not None and (keep is None or at - last[0] <= keep) else None)
            if due:
                self.waiting.put([(pickle.dumps(rest),)]) if rest else self.waiting.clear()
            if keep is not None:
                known = {k: x for k, x in known.items() if self.millis(x[0] + keep) >= now}
            if known != old:
                self.known.update((pickle.dumps(known),)) if known else self.known.clear()
            wakes = [self.millis(min(x[1] for x in rest))] if rest else []
            if known and keep is not None:
                wakes.append(self.millis(min(x[0] for x in known.values()) + keep) + 1)
            if wakes:
                self.wake(min(wakes))
            if due:
                columns = (*zip(*due), filled)
                yield pd.DataFrame({c: pd.Series(x, dtype=object) for c, x in zip(names, columns)})

        def close(self) -> None:
            pass

    text, back = _as_text(key, kind[key])
    dealt = F.pmod(F.xxhash64(text), F.lit(buckets)).alias(bucket)
    timed = stream.withWatermark(time, late).select(dealt, text.alias(key), time, F.unix_micros(time).alias(micros), row, value)
    before = spark.conf.get(PROVIDER)
    # Timers and lists of a bucket need this store; the query keeps what it started with.
    spark.conf.set(PROVIDER, ROCKSDB)
    try:
        done = timed.groupBy(bucket).transformWithStateInPandas(Fill(), schema, "append", "eventtime")
        rows = done.select(back.alias(key), F.timestamp_micros(micros).alias(time), row, value, name)
        _run(rows, "append", out, checkpoint)
    finally:
        spark.conf.set(PROVIDER, before)
    return _read(spark, out, rows.schema)
