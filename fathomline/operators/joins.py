"""Equi-joins. No side is force-broadcast: Spark broadcasts a side only when its measured size is
below the session's threshold, and adaptive execution splits skewed keys otherwise."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fathomline.functions.filings import pad_security_id

# Fixed value: result for a key without a mapping.
NO_MAPPING = "no_mapping_found"


def join_using(a: DataFrame, b: DataFrame, key: str | Sequence[str]) -> DataFrame:
    """Inner join on equally named columns; the key appears once."""
    return a.join(b, key if isinstance(key, str) else list(key))


def lookup_with_default(df: DataFrame, dim: DataFrame, key: str, value: str, default=NO_MAPPING) -> DataFrame:
    """Add ``value`` from a dimension with unique keys; a missing key gets ``default``."""
    joined = df.join(dim.select(key, value), key, "left")
    return joined.withColumn(value, F.coalesce(F.col(value), F.lit(default)))


def enrich_security(
    df: DataFrame, dim: DataFrame, security: str = "cusip", columns: Sequence[str] = ("name", "ticker")
) -> DataFrame:
    """Add name and ticker of a security id, zero-padded to eight characters; missing ones are empty."""
    keyed = df.withColumn("__key", pad_security_id(F.col(security)))
    known = dim.select(F.col(security).alias("__key"), *columns)
    joined = keyed.join(known, "__key", "left").drop("__key")
    return joined.withColumns({c: F.coalesce(F.col(c), F.lit("")) for c in columns})


def enrich_company(df: DataFrame, stats: DataFrame, key: str = "symbol") -> DataFrame:
    """Add company statistics; symbols without statistics are dropped."""
    return df.join(stats, key)


def join_on_date(frames: Sequence[DataFrame], key: str = "date") -> DataFrame:
    """Join any number of series that share one date column."""
    return reduce(lambda a, b: a.join(b, key), frames)


def series_by_date(
    df: DataFrame, series: str, value: Column, names: Mapping[object, str], key: str = "date",
    measure: Callable[[Column], Column] = F.sum,
) -> DataFrame:
    """All series of a long table side by side, on the dates that every one of them has.

    ``names`` gives each value of ``series`` its column, ``measure`` reduces the values of one date. One scan and one
    shuffle, however many series; a date is one row per task before it. A series with rows on a date is there, even
    if all their values are null.
    """
    own = {name: F.col(series) == F.lit(v) for v, name in names.items()}
    rows = df.filter(F.col(series).isin(list(names))).groupBy(key).agg(
        *[measure(F.when(tag, value)).alias(name) for name, tag in own.items()],
        *[F.count_if(tag).alias(f"_rows_{name}") for name, tag in own.items()])
    return rows.filter(reduce(lambda a, b: a & b, [F.col(f"_rows_{name}") > 0 for name in own])).select(key, *own)


def compare_periods(
    earlier: DataFrame, later: DataFrame, key: str, measure: Column,
    names: Sequence[str] = ("earlier", "later", "diff"),
) -> DataFrame:
    """Aggregate two periods per key and subtract; keys must occur in both.

    Each period shrinks to one row per key before the join.
    """
    first, second, diff = names
    a = earlier.groupBy(key).agg(measure.alias(first))
    b = later.groupBy(key).agg(measure.alias(second))
    return a.join(b, key).withColumn(diff, F.col(second) - F.col(first))
