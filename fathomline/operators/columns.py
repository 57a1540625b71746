"""Projection: rename, drop, cast, flatten."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def rename_all(df: DataFrame, names: Sequence[str]) -> DataFrame:
    """Rename every column by position."""
    return df.toDF(*names)


def rename(df: DataFrame, mapping: Mapping[str, str]) -> DataFrame:
    """Rename some columns by name."""
    return df.withColumnsRenamed(dict(mapping))


def drop_columns(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Drop the listed columns; absent names are ignored."""
    return df.drop(*columns)


def cast_columns(df: DataFrame, casts: Mapping[str, str]) -> DataFrame:
    """Cast columns in place; a value that does not parse becomes null."""
    return df.withColumns({name: F.col(f"`{name}`").try_cast(kind) for name, kind in casts.items()})


def flatten_stats(df: DataFrame, struct: str, suffix: str = "") -> DataFrame:
    """Replace a struct column by its fields, each named with ``suffix``."""
    fields = df.schema[struct].dataType.fieldNames()
    kept = [F.col(f"`{c}`") for c in df.columns if c != struct]
    return df.select(*kept, *[F.col(struct).getField(f).alias(f + suffix) for f in fields])
