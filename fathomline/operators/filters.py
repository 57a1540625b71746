"""Row filters, null counts and samples."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def filter_above(df: DataFrame, field: str | None = None, threshold: float = 1.0) -> DataFrame:
    """Rows whose field is strictly above the threshold; no field keeps every row."""
    return df if field is None else df.filter(F.col(field) > threshold)


def filter_equal(df: DataFrame, field: str, value) -> DataFrame:
    """Rows whose field equals a value."""
    return df.filter(F.col(field) == value)


def filter_lines(df: DataFrame, predicate: Column) -> DataFrame:
    """Rows that satisfy any boolean Column."""
    return df.filter(predicate)


def count_containing(df: DataFrame, column: str, text: str) -> DataFrame:
    """Number of rows whose text contains a substring, as a one-row table."""
    return df.agg(F.count_if(F.col(column).contains(text)).alias("n"))


def null_counts(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """``(column, nulls)`` for every listed column, in one pass."""
    names = list(columns or df.columns)
    counted = df.agg(*[F.count_if(F.col(f"`{c}`").isNull()).alias(f"n{i}") for i, c in enumerate(names)])
    pairs = F.array(*[F.struct(F.lit(c).alias("column"), F.col(f"n{i}").alias("nulls")) for i, c in enumerate(names)])
    return counted.select(F.inline(pairs))


def sample_fraction(df: DataFrame, fraction: float, seed: int) -> DataFrame:
    """Bernoulli sample without replacement."""
    return df.sample(False, fraction, seed)


def sample_by_keys(df: DataFrame, keys: Sequence[str], fraction: float, seed: int) -> DataFrame:
    """Bernoulli sample drawn by a digest of the keys and the seed, one row or all rows of equal keys.

    The sample depends neither on partitions nor on a repeated task, tables sampled by the same keys agree, and any
    engine with MD5 can draw it again. A row with a null key is drawn as if the key were empty.
    """
    text = F.concat_ws(":", F.lit(str(seed)), *[F.coalesce(F.col(f"`{k}`").cast("string"), F.lit("")) for k in keys])
    drawn = F.conv(F.substring(F.md5(text), 1, 12), 16, 10).cast("long")
    return df.filter(drawn < int(round(fraction * (1 << 48))))


def random_split(df: DataFrame, weights: Sequence[float], seed: int) -> list[DataFrame]:
    """Disjoint random parts with the given weights, drawn by a hash of the row and the seed.

    The same rows fall into the same parts however the input is partitioned; equal rows stay together.
    """
    drawn = F.pmod(F.xxhash64(F.lit(seed), *[F.col(f"`{c}`") for c in df.columns]), F.lit(1 << 52)) / float(1 << 52)
    total, edges = float(sum(weights)), [0.0]
    for weight in weights:
        edges.append(edges[-1] + weight / total)
    edges[-1] = 1.0
    return [df.filter((drawn >= low) & (drawn < high)) for low, high in zip(edges, edges[1:])]
