"""The hourly re-run as Structured Streaming jobs.

Each job takes a streaming frame, runs until the available input is used up and keeps
its results in files below ``out``. Its checkpoint belongs to ``out`` (``_checkpoint``
there, unless another is named), so calling a job again goes on where it stopped: files
that came since are read, others are not read twice. Writes are per batch id; a batch
that is repeated after a failure overwrites itself.
"""

from __future__ import annotations

import threading
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQueryListener

from panelforge.operators.blocks import fill_frames
from panelforge.session import reliable_checkpoint
from panelforge.sources.tables import local_rows, replace_partitions

WAIT_SECONDS = 60   # for the last progress report of a query that has ended


def _is_file(spark: SparkSession, path: str) -> bool:
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    system = at.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())
    return system.exists(at) and system.getFileStatus(at).isFile()


def file_stream(
    spark: SparkSession, path: str, schema, pattern: str | None = None, files_per_batch: int = 100
) -> DataFrame:
    """Parquet files of a folder, of the folders below it, or one file, as a stream.

    ``schema`` may name partition columns of the folders below or leave them out."""
    path = path.rstrip("/")
    if not any(c in path for c in "*?[{") and _is_file(spark, path):
        # Spark streams a single file only if it is named by a pattern.
        path = f"{path[:-1]}[{path[-1]}]"
    reader = spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch)
    if pattern:
        reader = reader.option("pathGlobFilter", pattern)
    return reader.parquet(path)


def _run(df: DataFrame, mode: str, out: str, checkpoint: str | None, each: Callable | None = None, rows: str | None = None):
    writer = (
        df.writeStream.outputMode(mode)
        .option("checkpointLocation", checkpoint or f"{out}/_checkpoint")
        .trigger(availableNow=True)
    )
    query = (
        writer.foreachBatch(each).start() if each else writer.format("parquet").start(rows or out)
    )
    query.awaitTermination()
    return query


def _by_batch(path: str) -> Callable:
    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/batch={batch_id}")

    return write


def _newest(rows: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The last written version of each key."""
    rest = [c for c in rows.columns if c not in (*keys, "batch")]
    return (
        rows.groupBy(*keys)
        .agg(F.max_by(F.struct(*rest), "batch").alias("_row"))
        .select(*keys, "_row.*")
    )


def _read(spark: SparkSession, path: str, schema) -> DataFrame:
    """Rows written so far, none if there are none."""
    try:
        return spark.read.schema(schema).parquet(path)
    except Exception as error:
        if "PATH_NOT_FOUND" not in str(error):
            raise
        return local_rows(spark, [], schema)


def hourly_mean(
    stream: DataFrame, key: str, time: str, value: str, out: str, late: str = "2 hours", checkpoint: str | None = None
) -> DataFrame:
    """Running hourly means; an hour is updated until the watermark passes it."""
    hours = (
        stream.withWatermark(time, late)
        .groupBy(key, F.window(time, "1 hour").alias("_w"))
        .agg(F.avg(value).alias(value))
        .select(key, F.col("_w.start").alias(time), value)
    )
    _run(hours, "update", out, checkpoint, _by_batch(out))
    return _newest(stream.sparkSession.read.parquet(out), [key, time])


def sliding_mean(
    stream: DataFrame, key: str, time: str, value: str, out: str, width: str = "24 hours",
    step: str = "1 hour", late: str = "2 hours", checkpoint: str | None = None,
) -> DataFrame:
    """Mean over sliding windows, named by their end."""
    windows = (
        stream.withWatermark(time, late)
        .groupBy(key, F.window(time, width, step).alias("_w"))
        .agg(F.avg(value).alias("window_mean"))
        .select(key, F.col("_w.end").alias("window_end"), "window_mean")
    )
    _run(windows, "update", out, checkpoint, _by_batch(out))
    return _newest(stream.sparkSession.read.parquet(out), [key, "window_end"])


def deduplicated(
    stream: DataFrame, keys: Sequence[str], time: str, out: str, late: str = "2 hours", checkpoint: str | None = None
) -> DataFrame:
    """Each delivery once, however often it comes within the watermark."""
    once = stream.withWatermark(time, late).dropDuplicatesWithinWatermark(list(keys))
    _run(once, "append", out, checkpoint)
    return stream.sparkSession.read.parquet(out)


def _same(a: DataFrame, b: DataFrame, names: Sequence[str]) -> Column:
    """Equality of keys, NULL equal to NULL."""
    found = [a[n].eqNullSafe(b[n]) for n in names]
    return found[0] if len(found) == 1 else found[0] & _same(a, b, names[1:])


def replace_days(
    stream: DataFrame, out: str, partition_by: Sequence[str], keys: Sequence[str], checkpoint: str | None = None
) -> DataFrame:
    """Bring the partitions of a table up to date with each batch.

    A batch may hold any part of a partition. The touched partitions are read, rows
    that come again (by ``keys``) are replaced by their newest delivery, and these
    partitions alone are written anew, so a repeated batch changes nothing."""
    spark = stream.sparkSession
    table = f"{out}/rows"
    rest = [c for c in stream.columns if c not in (*partition_by, *keys)]

    def write(batch: DataFrame, _: int) -> None:
        batch = reliable_checkpoint(batch, "batch")
        touched = batch.select(*partition_by).distinct()
        old = _read(spark, table, stream.schema)
        old = old.join(touched, _same(old, touched, partition_by), "left_semi")
        both = old.withColumn("_new", F.lit(0)).unionByName(batch.withColumn("_new", F.lit(1)))
        newest = both.groupBy(*partition_by, *keys).agg(F.max(F.struct("_new", *rest)).alias("_row"))
        # Written aside first: what is read can't be overwritten at the same time.
        merged = reliable_checkpoint(newest.select(*partition_by, *keys, *(F.col(f"_row.{c}") for c in rest)), "merged")
        replace_partitions(merged.select(*stream.columns), table, partition_by)

    _run(stream, "append", out, checkpoint, write)
    return _read(spark, table, stream.schema)


def fill_forward(
    stream: DataFrame, key: str, order: Sequence[str], value: str, out: str, name: str = "filled",
    span: str | int = "auto", checkpoint: str | None = None,
) -> DataFrame:
    """Carry the last known value per key across batches that may come in any order.

    The state is a table with one row per key: the last place seen and the last known
    value. It joins a batch as a first row, so the batch is filled by the same block-wise
    operator as a table and no task holds a whole key. A key of which the batch brings
    earlier rows than were seen is filled again from all its rows; the newest version of
    a row counts. ``order`` names a row within its key."""
    spark = stream.sparkSession
    fields = [key, *order, value]
    place, kind = F.struct(*order), dict(stream.dtypes)
    if len(set(stream.columns)) != len(fields):
        stream = stream.select(*fields)
    rows_schema = ", ".join(f"`{c}` {kind[c]}" for c in fields) + f", `{name}` {kind[value]}, batch bigint"
    seen = "struct<" + ",".join(f"`{c}`:{kind[c]}" for c in order) + ">"
    state_schema = f"`{key}` {kind[key]}, _seen {seen}, _known struct<{','.join(f'`{c}`:{kind[c]}' for c in (*order, value))}>"

    def write(batch: DataFrame, batch_id: int) -> None:
        batch = batch.select(*fields)
        state = _read(spark, f"{out}/state/{batch_id - 1}", state_schema)
        earliest = batch.groupBy(key).agg(F.min(place).alias("_first"))
        behind = state.join(earliest, _same(state, earliest, [key])).where("_first <= _seen").select(state[key])
        behind = reliable_checkpoint(behind, "behind")
        before = _read(spark, f"{out}/rows", rows_schema).where(F.col("batch") < batch_id)
        again = before.join(behind, _same(before, behind, [key]), "left_semi")
        again = _newest(again, [key, *order]).select(*fields)
        carried = state.join(behind, _same(state, behind, [key]), "left_anti").where("_known IS NOT NULL").select(key, "_known.*")
        own = batch.unionByName(again).dropDuplicates([key, *order])
        every = own.withColumn("_own", F.lit(True)).unionByName(carried.withColumn("_own", F.lit(False)))
        filled = fill_frames(every, [key], order, forward={name: value}, span=span)
        filled.filter("_own").select(*fields, name).write.mode("overwrite").parquet(f"{out}/rows/batch={batch_id}")
        known = F.max(F.when(F.col(value).isNotNull(), F.struct(*order, value)))
        now = batch.groupBy(key).agg(F.max(place).alias("_seen"), known.alias("_known"))
        now = state.unionByName(now).groupBy(key).agg(F.max("_seen").alias("_seen"), F.max("_known").alias("_known"))
        now.write.mode("overwrite").parquet(f"{out}/state/{batch_id}")

    _run(stream, "append", out, checkpoint, write)
    return _newest(spark.read.schema(rows_schema).parquet(f"{out}/rows"), [key, *order])


class _Dropped(StreamingQueryListener):
    """Counts late rows over all progress reports of one query, however many."""

    def __init__(self):
        self.by_run: dict[str, dict[int, int]] = {}
        self.ended: dict[str, threading.Event] = {}

    def end(self, run: str) -> threading.Event:
        return self.ended.setdefault(run, threading.Event())

    def onQueryStarted(self, event):
        self.end(str(event.runId))

    def onQueryProgress(self, event):
        p = event.progress
        self.by_run.setdefault(str(p.runId), {})[p.batchId] = sum(op.numRowsDroppedByWatermark for op in p.stateOperators)

    def onQueryIdle(self, event):
        pass

    def onQueryTerminated(self, event):
        self.end(str(event.runId)).set()


def closed_hours(
    stream: DataFrame, key: str, time: str, out: str, late: str = "1 hour", checkpoint: str | None = None
) -> tuple[DataFrame, int]:
    """Row counts of hours the watermark has closed, and the number of late groups that
    this run dropped."""
    spark = stream.sparkSession
    hours = (
        stream.withWatermark(time, late)
        .groupBy(key, F.window(time, "1 hour").alias("_w"))
        .agg(F.count(F.lit(1)).alias("n"))
        .select(key, F.col("_w.start").alias(time), "n")
    )
    listener = _Dropped()
    spark.streams.addListener(listener)
    try:
        query = _run(hours, "append", out, checkpoint)
        run = str(query.runId)
        if not listener.end(run).wait(WAIT_SECONDS):
            raise TimeoutError("the query's reports did not arrive")
    finally:
        spark.streams.removeListener(listener)
    return spark.read.parquet(out), sum(listener.by_run.get(run, {}).values())
