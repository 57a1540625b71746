"""Numeric encodings of categorical and indicator columns."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fathomline.operators.ordering import with_row_index


def ratio(numerator: Column, denominator: Column) -> Column:
    """Quotient, null where the denominator is zero."""
    return F.try_divide(numerator, denominator)


def relative_change(newest: Column, oldest: Column) -> Column:
    """``newest / oldest - 1``."""
    return F.try_divide(newest, oldest) - 1


def difference(a: Column, b: Column) -> Column:
    """``a - b``."""
    return a - b


def encode_binary(column: Column, one: str = "male") -> Column:
    """1 for the given value, else 0."""
    return F.when(column == one, 1).otherwise(0)


def encode_ordinal(column: Column, levels: Sequence[str] = ("C", "Q")) -> Column:
    """Position of the value in ``levels``; anything else gets the next number."""
    code = F.lit(len(levels))
    for i in reversed(range(len(levels))):
        code = F.when(column == levels[i], i).otherwise(code)
    return code


def bucket_two(age: Column, limit: int = 40) -> Column:
    """1 up to and including ``limit``, 2 above; null stays null."""
    return F.when(age <= limit, 1).when(age > limit, 2)


def bucket_three(age: Column, low: int = 30, high: int = 60) -> Column:
    """1 up to ``low``, 2 below ``high``, 3 from ``high`` on; null stays null."""
    return F.when(age <= low, 1).when(age < high, 2).when(age >= high, 3)


def last_positive(columns: Sequence[Column]) -> Column:
    """One-based position of the last positive indicator, 0 if none is positive."""
    marks = [F.when(c > 0, i + 1).otherwise(0) for i, c in enumerate(columns)]
    return F.greatest(F.lit(0), *marks)


def one_hot_position(columns: Sequence[Column]) -> Column:
    """Zero-based position of the first 1 among the columns, -1 if there is none."""
    return F.array_position(F.array(*[c.cast("double") for c in columns]), F.lit(1.0)).cast("int") - 1


def un_one_hot(df: DataFrame, columns: Sequence[str], out: str) -> DataFrame:
    """Replace one-hot columns by the position of the set one."""
    return df.withColumn(out, one_hot_position([F.col(f"`{c}`") for c in columns])).drop(*columns)


def encode_sorted(df: DataFrame, column: str, out: str | None = None) -> DataFrame:
    """Replace each value by its rank among the sorted distinct values; null stays null.

    The dictionary is a distinct table joined back, so its size never limits the driver.
    """
    out = out or f"{column}_code"
    dictionary = df.select(F.col(column).alias("__value")).filter(F.col("__value").isNotNull()).distinct()
    ranked = with_row_index(dictionary, ["__value"], out)
    return df.join(ranked, df[column] == ranked["__value"], "left").drop("__value")
