"""Exact medians, overall or per group.

Spark's exact percentile keeps every distinct value of a group in one buffer. That is used for
groups of up to ``max_buffered`` rows. A larger group is narrowed first: quantile sketches bracket
the wanted rank, the bracket shrinks until its distinct values fit, and the rank is read from
value counts. Brackets are checked by counting, so the result is exact. Integers and decimals keep their
type, and the mean of two of them is a decimal; other numbers are doubles.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fathomline.operators.ordering import heavy_keys, join_keys
from fathomline.session import materialize

MAX_BUFFERED = 500_000
_GRID = 256
_ACCURACY = 10_000


def median_by(
    df: DataFrame,
    by: Sequence[str],
    column: str,
    out: str = "median",
    max_buffered: int = MAX_BUFFERED,
) -> DataFrame:
    """True median of the non-null values per group: the mean of the two middle values."""
    return _middle(df, by, column, out, False, max_buffered)


def median_of(df: DataFrame, column: str, out: str = "median", max_buffered: int = MAX_BUFFERED) -> DataFrame:
    """True median of the non-null values, as a one-row table."""
    return _middle(df, [], column, out, False, max_buffered)


def upper_median(
    df: DataFrame,
    column: str,
    by: Sequence[str] = (),
    out: str = "upper_median",
    max_buffered: int = MAX_BUFFERED,
) -> DataFrame:
    """Value at position ``n // 2`` of the sorted non-null values."""
    return _middle(df, by, column, out, True, max_buffered)


def _middle(df, by, column, out, upper, max_rows):
    by = list(by)
    kind = df.schema[column].dataType
    exact = isinstance(kind, (T.IntegralType, T.DecimalType))
    value = F.col(column) if exact else F.col(column).cast("double")
    rows = df.select(*by, value.alias("__v")).filter(F.col("__v").isNotNull())
    keyed = rows if by else rows.withColumn("__all", F.lit(0))
    keys = by or ["__all"]
    heavy = heavy_keys(keyed, keys, max_rows)
    if exact:
        listed = F.sort_array(F.collect_list("__v"))
        low, high = (F.get(listed, ((F.size(listed) - k) / 2).cast("int")) for k in (1, 0))
        builtin = high if upper else _half(low, high, kind)
    elif upper:
        # Counting down, the discrete median stops on the upper of the two middle values.
        builtin = F.expr("percentile_disc(0.5) within group (order by __v desc)")
    else:
        builtin = F.median("__v")
    if heavy.isEmpty():
        return rows.groupBy(*by).agg(builtin.alias(out))

    light_rows = join_keys(keyed, heavy, keys, "left_anti")
    light = light_rows.groupBy(*keys).agg(builtin.alias(out))
    large = _large_groups(keyed, keys, heavy, upper, max_rows)
    middle = F.col("high") if upper else _half(F.col("low"), F.col("high"), kind if exact else None)
    large = large.select(*keys, middle.alias(out))
    return light.unionByName(large).select(*by, out)


def _half(low, high, kind):
    """Mean of two values, exact for integers and decimals."""
    if kind is None:
        return (low + high) / 2
    scale = kind.scale if isinstance(kind, T.DecimalType) else 0
    digits = min(38, (kind.precision if isinstance(kind, T.DecimalType) else 20) + 1)
    return ((low.cast(T.DecimalType(digits, scale)) + high.cast(T.DecimalType(digits, scale))) / 2).cast(
        T.DecimalType(38, min(scale + 1, 37)))


def _within(value):
    """Condition that a value lies in the bracket of its group; an open end is null."""
    return f"(lo is null or {value} >= lo) and (hi is null or {value} <= hi)"


def _inside(keyed, keys, state):
    return join_keys(keyed.select(*keys, "__v"), state, keys)


def _large_groups(keyed, keys, heavy, upper, max_rows):
    last = F.expr("n div 2")
    first = last if upper else F.expr("(n - 1) div 2")
    state = materialize(heavy.select(
        *keys,
        "n",
        first.alias("r1"),
        last.alias("r2"),
        F.lit(None).cast(keyed.schema["__v"].dataType).alias("lo"),
        F.lit(None).cast(keyed.schema["__v"].dataType).alias("hi"),
        F.lit(0).cast("long").alias("below"),
        F.col("n").alias("m"),
    ), "bracket")

    before = None
    while True:
        bracket = _inside(keyed, keys, state).filter(_within("__v"))
        fits = bracket.groupBy(*keys).agg(F.approx_count_distinct("__v").alias("d")).agg(F.max("d")).first()[0]
        size = state.agg(F.sum("m")).first()[0]
        if fits <= max_rows or size == before:  # brackets that no longer shrink hold few values, each very common
            break
        before = size
        grid = F.array(*[F.lit(i / _GRID) for i in range(_GRID + 1)])
        cuts = bracket.groupBy(*keys).agg(F.percentile_approx("__v", grid, _ACCURACY).alias("cuts"))
        step = F.expr(f"int((r1 - below) * {_GRID} / m)")
        step2 = F.expr(f"int((r2 - below) * {_GRID} / m)")
        tighter = join_keys(state, cuts, keys).select(
            *keys, "n", "r1", "r2",
            F.col("lo").alias("lo0"), F.col("hi").alias("hi0"), F.col("below").alias("below0"), F.col("m").alias("m0"),
            F.element_at("cuts", F.greatest(step - 1, F.lit(1))).alias("lo"),
            F.element_at("cuts", F.least(step2 + 4, F.lit(_GRID + 1))).alias("hi"),
        )
        counted = _inside(keyed, keys, tighter).groupBy(*keys, *[c for c in tighter.columns if c not in keys]).agg(
            F.count_if(F.expr("__v < lo")).alias("below"),
            F.count_if(F.expr(_within("__v"))).alias("m"),
        )
        # A bracket that missed its rank is given up for the previous one.
        good = F.expr("below <= r1 and r2 < below + m")
        state = materialize(counted.select(
            *keys, "n", "r1", "r2",
            F.when(good, F.col("lo")).otherwise(F.col("lo0")).alias("lo"),
            F.when(good, F.col("hi")).otherwise(F.col("hi0")).alias("hi"),
            F.when(good, F.col("below")).otherwise(F.col("below0")).alias("below"),
            F.when(good, F.col("m")).otherwise(F.col("m0")).alias("m"),
        ), "bracket")

    counts = (
        _inside(keyed, keys, state)
        .filter(_within("__v"))
        .groupBy(*keys, "r1", "r2", "below", "__v")
        .agg(F.count(F.lit(1)).alias("c"))
    )
    so_far = Window.partitionBy(*keys).orderBy("__v").rowsBetween(Window.unboundedPreceding, 0)
    ranked = counts.withColumn("upto", F.col("below") + F.sum("c").over(so_far))
    holds = lambda r: F.expr(f"upto - c <= {r} and {r} < upto")
    return ranked.groupBy(*keys).agg(
        F.max(F.when(holds("r1"), F.col("__v"))).alias("low"), F.max(F.when(holds("r2"), F.col("__v"))).alias("high"))
