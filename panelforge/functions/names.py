"""Column-name rules. They work on schemas only, never on rows."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

_FORBIDDEN = re.compile(r"[^0-9A-Za-z_]+")


def clean_name(name: str) -> str:
    text = _FORBIDDEN.sub("_", name.strip().replace(" ", "_"))
    return f"_{text}" if text[:1].isdigit() else text


def clean_names(df: DataFrame) -> DataFrame:
    return df.toDF(*[clean_name(c) for c in df.columns])


def flatten_structs(df: DataFrame, joiner: str = "__") -> DataFrame:
    """Struct fields become columns named parent__child, at any depth."""

    def leaves(path: tuple[str, ...], kind: T.DataType):
        if isinstance(kind, T.StructType):
            for field in kind.fields:
                yield from leaves((*path, field.name), field.dataType)
        else:
            yield path

    def reference(path: tuple[str, ...]) -> Column:
        return F.col(".".join(f"`{p}`" for p in path)).alias(joiner.join(p for p in path if p))

    return df.select(*[reference(p) for f in df.schema for p in leaves((f.name,), f.dataType)])


def tidy_text(text: Column) -> Column:
    """The same rule as ``clean_name`` for a text column."""
    spaced = F.regexp_replace(F.trim(text), " ", "_")
    safe = F.regexp_replace(spaced, "[^0-9A-Za-z_]+", "_")
    return F.when(safe.rlike("^[0-9]"), F.concat(F.lit("_"), safe)).otherwise(safe)


def split_list(text: Column) -> Column:
    """'a, b ,c' -> [a, b, c]."""
    return F.transform(F.split(text, ","), lambda item: F.trim(item))
