"""Loads that write only the partitions that changed.

Beside a partitioned table lies a small tree of digests: rows are hashed, a partition's
digest is made of the sums of its rows' hashes, and the table's of its partitions'. So the
order of rows and files doesn't matter, and one aggregate without a sort makes it. Where
the tables' digests agree nothing else is looked at.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from panelforge.operators.joins import join_on_keys
from panelforge.session import reliable_checkpoint
from panelforge.sources.tables import replace_partitions, stored

FACTS = ("n", "a", "b")


def partition_digests(df: DataFrame, partition_by: Sequence[str]) -> DataFrame:
    """partition columns, n, a, b: rows, and the sums of two hashes of each row. Columns
    count by name: their order doesn't matter, new ones do."""
    named = [c for name in sorted(df.columns) for c in (F.lit(name), F.col(f"`{name}`"), F.col(f"`{name}`").isNull())]
    total = lambda seed: F.sum(F.xxhash64(F.lit(seed), *named).cast("decimal(20,0)"))
    return df.groupBy(*partition_by).agg(F.count(F.lit(1)).alias("n"), total(1).alias("a"), total(2).alias("b"))


def changed_partitions(new: DataFrame, old: DataFrame | None, partition_by: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """The partitions of ``new`` digests that ``old`` doesn't hold alike, and those of
    ``old`` that are gone."""
    keys = list(partition_by)
    if old is None:
        return new.select(*keys), new.select(*keys).limit(0)
    if partition_digests(new, []).first() == partition_digests(old, []).first():
        return new.select(*keys).limit(0), new.select(*keys).limit(0)
    before = old.withColumnsRenamed({f: f"_{f}" for f in FACTS})
    same = " AND ".join(f"{f} <=> _{f}" for f in FACTS)
    differs = join_on_keys(new, before, keys, "left").where(f"NOT ({same})").select(*keys)
    return differs, _matched(old, new, keys, "left_anti").select(*keys)


def _matched(df: DataFrame, other: DataFrame, keys: Sequence[str], how: str) -> DataFrame:
    """Rows of ``df`` whose keys ``other`` holds (left_semi) or not, NULL equal to NULL."""
    named = {k: f"_k{i}" for i, k in enumerate(keys)}
    met = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(n)) for k, n in named.items()])
    return df.join(other.select(*[F.col(k).alias(n) for k, n in named.items()]), met, how)


def load_changed(df: DataFrame, path: str, partition_by: Sequence[str]) -> DataFrame:
    """Bring the partitioned table at ``path`` to the rows of ``df`` and return the
    partitions that were written or removed: partition columns, ``change``.

    Partitions with the same rows, in whatever order, aren't touched. The digests lie in
    ``<path>.digests``; they are written after the data, so a load that fails is done
    again. A table that was written otherwise has none and is written whole."""
    spark, keys, beside = df.sparkSession, list(partition_by), f"{path}.digests"
    new = reliable_checkpoint(partition_digests(df, keys), "digests")
    old = reliable_checkpoint(spark.read.schema(new.schema).parquet(beside), "before") if stored(spark, beside) and stored(spark, path) else None
    if old is None:
        _remove(spark, path)
    differs, gone = (reliable_checkpoint(x, "changes") for x in changed_partitions(new, old, keys))
    replace_partitions(_matched(df, differs, keys, "left_semi"), path, keys)
    # Names of folders, as many as partitions that went.
    for row in gone.collect():
        _remove(spark, path + "".join(f"/{k}={_folder(spark, row[k])}" for k in keys))
    new.write.mode("overwrite").parquet(beside)
    return differs.withColumn("change", F.lit("written")).unionByName(gone.withColumn("change", F.lit("removed")))


def _folder(spark: SparkSession, value) -> str:
    escape = spark._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils.escapePathName
    return "__HIVE_DEFAULT_PARTITION__" if value is None or value == "" else escape(str(value))


def _remove(spark: SparkSession, path: str) -> None:
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).delete(at, True)
