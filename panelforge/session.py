"""Session defaults and the shared scratch folder."""

from __future__ import annotations

import atexit
import re
import shutil
import uuid
import warnings

from pyspark.sql import SparkSession

DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def shuffle_partitions(shuffle_bytes: int, target: int = 256 * 1024**2, least: int = 200) -> int:
    """Partitions for the largest shuffle so that each holds about ``target``."""
    return max(least, -(-shuffle_bytes // target))


def build_session(
    app: str = "panelforge", master: str | None = None, settings: dict | None = None,
    shuffle_bytes: int | None = None,
) -> SparkSession:
    """A session with the library defaults; ``settings`` come on top.

    ``shuffle_bytes`` is the size of the largest shuffle to expect. It sets the
    number of partitions adaptive execution starts from; smaller shuffles are
    coalesced from there."""
    if shuffle_bytes:
        count = str(shuffle_partitions(shuffle_bytes))
        settings = {"spark.sql.adaptive.coalescePartitions.initialPartitionNum": count,
                    "spark.sql.shuffle.partitions": count, **(settings or {})}
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**DEFAULTS, **(settings or {})}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


_RUN = uuid.uuid4().hex


def scratch_dir(spark: SparkSession, label: str) -> str:
    """A fresh folder for tables and checkpoints.

    It lies in the shared folder that ``spark.checkpoint.dir`` names or, where that is
    unset, in the warehouse, which driver and executors share as well; never in a
    folder of one machine. What a process wrote to a warehouse on its own disk is
    removed when it ends; a shared folder is emptied by whoever set it."""
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if not shared:
        shared = f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/_scratch-{_RUN}"
        own = re.sub(r"^file:(//)?(?=/)", "", shared)
        if own.startswith("/") and own not in _removed_at_exit:
            if not spark.conf.get("spark.master", "local").startswith("local"):
                warnings.warn(f"{own} must be a folder that all machines share; else set spark.checkpoint.dir", stacklevel=2)
            _removed_at_exit.add(own)
            atexit.register(shutil.rmtree, own, ignore_errors=True)
    return f"{shared.rstrip('/')}/{label}-{uuid.uuid4().hex}"


_removed_at_exit: set[str] = set()


CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


BATCH = "spark.sql.execution.arrow.maxRecordsPerBatch"


def reliable_checkpoint(df, label: str = "cut", batch_rows: int | None = None):
    """Cut lineage by writing ``df`` to the scratch folder and reading it back.

    The files outlive any executor, so lost executors cost no recomputation of
    the plan above. Shuffle files of the write are removed once it is done: nothing
    reads them again. ``batch_rows``: rows that go to a Python function at a time, for
    rows of long texts or lists, which are held on both sides."""
    spark, path = df.sparkSession, scratch_dir(df.sparkSession, label)
    settings = {CLEANUP: "true", **({BATCH: str(batch_rows)} if batch_rows else {})}
    before = {k: spark.conf.get(k, *(["false"] if k == CLEANUP else [])) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        df.write.mode("overwrite").parquet(path)
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    return spark.read.schema(df.schema).parquet(path)
