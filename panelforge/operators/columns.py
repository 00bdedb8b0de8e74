"""Choosing columns by type, name or content."""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from panelforge.config import (
    GENERATION_SUFFIXES,
    LEAKAGE_COLUMNS,
    LEGACY_COLUMNS,
    PROHIBITED_PARTS,
    SPARSE_LIMIT,
    TIME_CANDIDATES,
)
from panelforge.functions.timeparts import date_text, month_text

NUMERIC = ("double", "float", "int", "bigint")


def numeric_columns(df: DataFrame, exclude: Iterable[str] = ()) -> list[str]:
    skip = set(exclude)
    return [c for c, kind in df.dtypes if kind in NUMERIC and c not in skip]


def suffix_columns(df: DataFrame, suffixes: Sequence[str] = GENERATION_SUFFIXES) -> list[str]:
    return [c for c in numeric_columns(df) if c.endswith(tuple(suffixes))]


def existing_columns(df: DataFrame, wanted: Iterable[str]) -> list[str]:
    have = set(df.columns)
    return list(dict.fromkeys(c for c in wanted if c in have))


def drop_legacy(df: DataFrame, names: Sequence[str] = LEGACY_COLUMNS) -> DataFrame:
    return df.drop(*names)


def rename(df: DataFrame, mapping: dict[str, str]) -> DataFrame:
    return df.withColumnsRenamed(mapping)


def null_counts(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """One row: rows with NULL per column, plus ``row_count``. One pass."""
    names = list(columns or df.columns)
    return df.agg(
        F.count(F.lit(1)).alias("row_count"),
        *[F.count_if(F.col(f"`{c}`").isNull()).alias(c) for c in names],
    )


def null_counts_long(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """(column_name, null_count, null_pct), one row per column."""
    names = list(columns or df.columns)
    return (
        null_counts(df, names)
        .unpivot(["row_count"], names, "column_name", "null_count")
        .select(
            "column_name",
            "null_count",
            F.try_divide(F.col("null_count") * 100.0, F.col("row_count")).alias("null_pct"),
        )
    )


def all_null_columns(df: DataFrame, columns: Sequence[str]) -> list[str]:
    """Names of columns without any value. Runs one aggregate; one row returns."""
    if not columns:
        return []
    row = df.agg(*[F.count(F.col(f"`{c}`")).alias(c) for c in columns]).first()
    return [c for c in columns if row[c] == 0]


def drop_all_null(df: DataFrame, columns: Sequence[str], drop: Sequence[str] | None = None):
    """Drop empty columns: those found, or the fixed list ``drop``."""
    return df.drop(*(all_null_columns(df, columns) if drop is None else drop))


def dense_columns(
    df: DataFrame, columns: Sequence[str], limit: float = SPARSE_LIMIT
) -> list[str]:
    """Names of columns whose share of NULLs is below ``limit``."""
    if not columns:
        return []
    row = null_counts(df, columns).first()
    total = row["row_count"]
    return [c for c in columns if total and row[c] / total < limit]


def leaking_columns(
    columns: Iterable[str],
    prohibited: Sequence[str] = PROHIBITED_PARTS,
) -> list[str]:
    return [c for c in columns if any(part in c.lower() for part in prohibited)]


def feature_candidates(df: DataFrame, excluded: Sequence[str] = LEAKAGE_COLUMNS) -> list[str]:
    skip = set(excluded)
    return [c for c in df.columns if c not in skip]


def duplicate_columns(df: DataFrame) -> list[tuple[str, int]]:
    """Names that occur more than once, ignoring case as Spark does."""
    counts = Counter(c.lower() for c in df.columns)
    return sorted((c, n) for c, n in counts.items() if n > 1)


def canonical_value(
    df: DataFrame, keys: Sequence[str], name: str = "Value", first_any: bool = False
) -> DataFrame:
    """Keep the keys and one value column, renamed to ``name``.

    The only column wins; among several, the first numeric one (or simply the
    first, with ``first_any``)."""
    rest = [c for c in df.columns if c not in set(keys)]
    if not rest:
        raise ValueError(f"no value column besides {list(keys)}")
    numeric = [c for c in numeric_columns(df) if c in rest]
    chosen = rest[0] if first_any or len(rest) == 1 or not numeric else numeric[0]
    return df.select(*keys, F.col(f"`{chosen}`").alias(name))


def detect_timestamp(df: DataFrame, candidates: Sequence[str] = TIME_CANDIDATES) -> str:
    """The first usual time column, else the first column of all, that holds at
    least one readable time. One aggregate over all columns decides."""
    order = [c for c in candidates if c in df.columns]
    order += [c for c in df.columns if c not in order]
    kinds = {f.name: f.dataType for f in df.schema}

    def readable(name: str):
        column = F.col(f"`{name}`")
        if isinstance(kinds[name], (T.TimestampType, T.TimestampNTZType, T.DateType)):
            return F.count(column)
        if isinstance(kinds[name], T.StringType):
            return F.count(F.try_to_timestamp(column))
        return F.lit(0).cast("long")

    row = df.agg(*[readable(c).alias(f"c{i}") for i, c in enumerate(order)]).first()
    for i, name in enumerate(order):
        if row[f"c{i}"]:
            return name
    raise ValueError(f"no time column among {df.columns}")


def with_periods(df: DataFrame, time: str = "index") -> DataFrame:
    """Add text columns ``date`` (yyyy-MM-dd) and ``month`` (yyyy-MM)."""
    stamp = F.col(time).cast("timestamp")
    return df.withColumns({"date": date_text(stamp), "month": month_text(stamp)})


def one_hot(df: DataFrame, column: str, categories: Sequence[str], prefix: str | None = None):
    """0/1 columns for a fixed list of categories. Unknown values set none, and
    a category absent from the data still gets its column."""
    head = prefix or column
    return df.withColumns(
        {
            f"{head}_{k}": F.coalesce((F.col(column) == k).cast("int"), F.lit(0))
            for k in categories
        }
    )


def one_hot_decode(categories: Sequence[str], prefix: str, missing: str | None = None):
    """The label of the first category column with the largest value."""
    flags = F.array(*[F.col(f"`{prefix}_{k}`") for k in categories])
    labels = F.array(*[F.lit(k) for k in categories])
    return F.element_at(labels, F.array_position(flags, F.array_max(flags)).cast("int"))
