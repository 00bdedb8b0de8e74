"""Gridded messages in files of their own, as a data source.

A message is one variable on a grid at one time: a file of 32-bit floats whose name says
which, ``<seconds since 1970>_<variable>.grid``. A partition is a run of messages: one as
long as they are few, else as many as ``TASK_BYTES`` and ``TASK_FILES`` allow, since a task
costs more than a small file. Filters on time and variable are answered from the names, so
a message that a query doesn't want is never opened; values reach Spark as Arrow lists.
"""

from __future__ import annotations

import datetime as dt
import re
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import datasource as D
from pyspark.sql import functions as F

NAME = re.compile(r"(-?\d+)_([^/_]+)\.grid$")
SCHEMA = "timestamp timestamp, short_name string, values array<float>"
PUSHDOWN = "spark.sql.python.filterPushdown.enabled"
FEW = 32                       # up to so many messages have a task each
TASK_BYTES, TASK_FILES = 32 * 1024**2, 4096
BATCH_BYTES, BATCH_FILES = 4 * 1024**2, 1024


def _open(path: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(re.sub(r"^file:(//)?(?=/)", "", path))


@dataclass
class Messages(D.InputPartition):
    """File names within the folder."""

    names: list[str]


def _runs(sizes: Sequence[int]) -> Iterator[tuple[int, int]]:
    """First place and the place after the last of each run of messages of these sizes:
    no run is larger than a task may be, and each is about a part in ``FEW`` at most."""
    weights = [size / TASK_BYTES + 1 / TASK_FILES for size in sizes]
    most = min(1.0, sum(weights) / FEW)
    first, held = 0, 0.0
    for i, weight in enumerate(weights):
        if i > first and (held + weight > most or len(sizes) <= FEW):
            yield first, i
            first, held = i, 0.0
        held += weight
    if sizes:
        yield first, len(sizes)


class MessageReader(D.DataSourceReader):
    def __init__(self, path: str):
        self.path, self.tests = path, []

    def pushFilters(self, filters: list[D.Filter]) -> Iterator[D.Filter]:
        """Takes comparisons of time and variable with constants, and gives back others."""
        for f in filters:
            test = self._test(f)
            if test is None:
                yield f
            else:
                self.tests.append(test)

    @staticmethod
    def _test(f: D.Filter):
        column = getattr(f, "attribute", None)
        if column not in (("timestamp",), ("short_name",)):
            return None
        i = 0 if column == ("timestamp",) else 1
        if isinstance(f, D.IsNotNull):
            return lambda m: True
        if isinstance(f, D.In):
            values = set(f.value)
            return lambda m: m[i] in values
        compare = {
            D.EqualTo: lambda a, b: a == b, D.GreaterThan: lambda a, b: a > b, D.GreaterThanOrEqual: lambda a, b: a >= b,
            D.LessThan: lambda a, b: a < b, D.LessThanOrEqual: lambda a, b: a <= b,
        }.get(type(f))
        value = getattr(f, "value", None)
        return None if compare is None or value is None else lambda m: compare(m[i], value)

    def partitions(self) -> Sequence[Messages]:
        """The names are listed once, on the driver; no file is opened."""
        system, root = _open(self.path)
        found = []
        for info in system.get_file_info(fs.FileSelector(root)):
            named = NAME.search(info.path)
            if named:
                seconds, variable = int(named[1]), named[2]
                at = dt.datetime.fromtimestamp(seconds, dt.timezone.utc)
                if all(test((at, variable)) for test in self.tests):
                    found.append((seconds, variable, info.base_name, info.size or 0))
        found.sort()
        return [Messages([m[2] for m in found[a:b]]) for a, b in _runs([m[3] for m in found])]

    def read(self, partition: Messages) -> Iterator[pa.RecordBatch]:
        system, root = _open(self.path)
        names, held, size = [], [], 0
        for name in partition.names:
            with system.open_input_stream(f"{root.rstrip('/')}/{name}") as f:
                held.append(np.frombuffer(f.read(), "<f4"))
            names.append(name)
            size += held[-1].nbytes
            if len(held) >= BATCH_FILES or size >= BATCH_BYTES:
                yield _batch(names, held)
                names, held, size = [], [], 0
        if held:
            yield _batch(names, held)


def _batch(names: Sequence[str], held: Sequence[np.ndarray]) -> pa.RecordBatch:
    named = [NAME.search(name) for name in names]
    ends = np.cumsum([0, *map(len, held)])
    lists = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.concatenate(held), pa.float32()))
    time = pa.array([int(n[1]) * 1_000_000 for n in named], pa.int64()).cast(pa.timestamp("us", "UTC"))
    return pa.RecordBatch.from_arrays([time, pa.array([n[2] for n in named]), lists], ["timestamp", "short_name", "values"])


class GridMessages(D.DataSource):
    """``spark.read.format("grid_messages").load(folder)``."""

    @classmethod
    def name(cls) -> str:
        return "grid_messages"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> MessageReader:
        return MessageReader(self.options["path"])


def read_messages(spark: SparkSession, path: str) -> DataFrame:
    """timestamp, short_name, values: a row for each message in the folder. An empty folder
    has no rows."""
    spark.conf.set(PUSHDOWN, "true")
    spark.dataSource.register(GridMessages)
    return spark.read.format("grid_messages").load(path)


def write_messages(messages: DataFrame, path: str) -> int:
    """Write (timestamp, short_name, values) rows as files; returns how many. Times are of
    whole seconds. A message is written aside and then named, so a task that is repeated
    leaves whole files; of two messages of one time and variable one stays. NULL values and
    messages without a time, a variable or values aren't written."""
    _open(path)[0].create_dir(_open(path)[1], recursive=True)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, root = _open(path)
        for batch in batches:
            names = []
            for i in range(batch.num_rows):
                name = f"{batch['seconds'][i].as_py()}_{batch['variable'][i].as_py()}.grid"
                values = batch["values"][i].values.drop_null().to_numpy(zero_copy_only=False)
                aside = f"{root}/.{name}.{batch['attempt'][i].as_py()}"
                with system.open_output_stream(aside) as f:
                    f.write(values.astype("<f4").tobytes())
                system.move(aside, f"{root}/{name}")
                names.append(name)
            yield pa.RecordBatch.from_arrays([pa.array(names, pa.string())], ["name"])

    rows = messages.select(
        F.unix_seconds("timestamp").alias("seconds"), F.col("short_name").alias("variable"), F.col("values").cast("array<float>").alias("values")
    ).dropna()
    # A file costs more than its bytes: rows are spread by number, not by size.
    parts = int(messages.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    named = rows.repartition(parts, "seconds", "variable").withColumn("attempt", F.uuid()).mapInArrow(run, "name string")
    return named.agg(F.count_distinct("name")).first()[0]
