"""Reading, writing and migrating tables."""

from __future__ import annotations

from collections.abc import Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from panelforge.functions.timeparts import date_text


# ---- reading ---------------------------------------------------------------------
def scan(spark: SparkSession, name: str, columns: Sequence[str] | None = None) -> DataFrame:
    """A catalog table, or a parquet path when the name holds a slash."""
    df = spark.read.parquet(name) if "/" in name else spark.table(name)
    return df.select(*columns) if columns else df


def scan_sql(spark: SparkSession, text: str, **frames: DataFrame) -> DataFrame:
    """A SQL query over catalog tables and the given frames, used as {name}."""
    return spark.sql(text, **frames)


def local_rows(spark: SparkSession, rows: Sequence[tuple], schema: str) -> DataFrame:
    """A small literal table with an explicit schema. Made by way of Arrow, so that Spark
    knows its size: of a list it doesn't, and would broadcast the table it is joined with."""
    fields = spark.createDataFrame([], schema).schema
    columns = [pa.array([row[i] for row in rows]) for i in range(len(fields))]
    return spark.createDataFrame(pa.table(columns, names=fields.names), fields)


def read_csv(spark: SparkSession, path: str, schema: str) -> DataFrame:
    return spark.read.option("header", True).schema(schema).csv(path)


def read_evolving(spark: SparkSession, path: str) -> DataFrame:
    """All columns that any file of the table has; missing ones are NULL."""
    return spark.read.option("mergeSchema", True).parquet(path)


def union_sources(frames: Sequence[DataFrame]) -> DataFrame:
    """Rows of all frames by column name; missing columns are NULL."""
    first, *rest = frames
    for df in rest:
        first = first.unionByName(df, allowMissingColumns=True)
    return first


# ---- writing ---------------------------------------------------------------------
def write_csv(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("header", True).csv(path)


def overwrite_table(
    df: DataFrame, name: str, path: str, partition_by: Sequence[str] = ()
) -> None:
    """Replace a whole table, its schema and its partitioning included."""
    rows = _spread(df, partition_by) if partition_by else df
    writer = rows.write.mode("overwrite").option("path", path)
    writer = writer.option("partitionOverwriteMode", "static")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.saveAsTable(name)


def _spread(df: DataFrame, partition_by: Sequence[str]) -> DataFrame:
    """Rows of one output partition side by side, in tasks of even size: Spark
    splits a partition value that is too large and joins those too small."""
    return df.hint("rebalance", *partition_by)


def write_partitioned(df: DataFrame, path: str, partition_by: Sequence[str]) -> None:
    """First write of a partitioned table."""
    (
        _spread(df, partition_by)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "static")
        .partitionBy(*partition_by)
        .parquet(path)
    )


def replace_partitions(df: DataFrame, path: str, partition_by: Sequence[str]) -> None:
    """Replace just the partitions that occur in ``df``. Doing it twice changes
    nothing, and an empty batch leaves the table as it is."""
    (
        _spread(df, partition_by)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*partition_by)
        .parquet(path)
    )


def stored(spark: SparkSession, path: str) -> bool:
    """Whether something was written there."""
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = hadoop.getFileSystem(spark._jsc.hadoopConfiguration())
    return fs.exists(hadoop)


def create_or_replace_partitions(df: DataFrame, path: str, partition_by: Sequence[str]) -> None:
    """Create the table on the first batch, replace partitions on later ones."""
    write = replace_partitions if stored(df.sparkSession, path) else write_partitioned
    write(df, path, partition_by)


def append(df: DataFrame, path: str) -> None:
    """Append a batch whose schema may differ; see ``read_evolving``."""
    df.write.mode("append").parquet(path)


def full_reload(df: DataFrame, name: str, path: str, partition_by: Sequence[str] = ()) -> None:
    """Drop the table if it is there, then write it anew."""
    df.sparkSession.sql(f"DROP TABLE IF EXISTS {name}")
    overwrite_table(df, name, path, partition_by)


def ensure_schema(spark: SparkSession, name: str) -> None:
    """Create a schema if needed and make it the current one."""
    spark.sql(f"CREATE SCHEMA IF NOT EXISTS {name}")
    spark.catalog.setCurrentDatabase(name)


# ---- table facts and migrations --------------------------------------------------
def partition_columns(spark: SparkSession, name: str) -> list[str]:
    """Partition columns of a table; none if there is no such table."""
    if not spark.catalog.tableExists(name):
        return []
    return [c.name for c in spark.catalog.listColumns(name) if c.isPartition]


def backfill_column(df: DataFrame, name: str, value: Column) -> DataFrame:
    """Add the column if it is missing and fill its NULLs."""
    current = F.col(name) if name in df.columns else F.lit(None).cast("string")
    return df.withColumn(name, F.coalesce(current, value))


def backfill_date(df: DataFrame, time: str = "index", name: str = "date") -> DataFrame:
    return backfill_column(df, name, date_text(F.col(time).cast("timestamp")))


def unpartition_table(spark: SparkSession, name: str, new_path: str) -> None:
    """Copy a partitioned table into one without partitions, under its name."""
    twin = f"{name}__unpartitioned"
    spark.sql(f"DROP TABLE IF EXISTS {twin}")
    overwrite_table(spark.table(name), twin, new_path)
    spark.sql(f"DROP TABLE {name}")
    spark.sql(f"ALTER TABLE {twin} RENAME TO {name}")


def with_lineage(df: DataFrame, load_id: str, source_file: Column, day: Column) -> DataFrame:
    """Stamp the load id, load time, source file and the file's day, whose name
    holds it as yyyyMMdd."""
    digits = F.regexp_extract(day, r"(\d{8})", 1)
    stamp = F.try_to_date(digits, "yyyyMMdd")
    return df.withColumns(
        {
            "load_id": F.lit(load_id),
            "load_ts": F.current_timestamp(),
            "source_file": source_file,
            "year": F.year(stamp),
            "month": F.month(stamp),
            "day": F.dayofmonth(stamp),
        }
    )


def table_profile(frames: dict[str, DataFrame]) -> DataFrame:
    """(table_name, row_count, column_count), one row per frame."""
    parts = [
        df.agg(F.count(F.lit(1)).alias("row_count")).select(
            F.lit(name).alias("table_name"),
            "row_count",
            F.lit(len(df.columns)).cast("long").alias("column_count"),
        )
        for name, df in frames.items()
    ]
    return union_sources(parts)


def hashed_sample(df: DataFrame, key: str, n: int, seed: str = "42") -> DataFrame:
    """The same n rows on every run: those with the smallest keyed hash."""
    return df.orderBy(F.md5(F.concat(F.lit(f"{seed}|"), F.col(key).cast("string")))).limit(n)
