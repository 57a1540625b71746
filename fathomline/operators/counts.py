"""Counting, summing, ranking and other grouped reductions."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fathomline.functions.filings import TRANSACTION_CODES, UNKNOWN_ISSUER
from fathomline.functions.text import characters


def count_by(df: DataFrame, key: str, out: str = "n") -> DataFrame:
    """Rows per key."""
    return df.groupBy(key).agg(F.count(F.lit(1)).alias(out))


def sum_by(df: DataFrame, key: str, measure: str, out: str = "total") -> DataFrame:
    """Sum per key, largest first."""
    return df.groupBy(key).agg(F.sum(measure).alias(out)).orderBy(F.desc(out), key)


def mean_of(df: DataFrame, column: str, out: str = "mean") -> DataFrame:
    """Mean of the non-null values, as a one-row table."""
    return df.agg(F.avg(column).alias(out))


def mean_by(df: DataFrame, group: str, column: str, out: str = "mean") -> DataFrame:
    """Mean per group."""
    return df.groupBy(group).agg(F.avg(column).alias(out))


def count_rows(df: DataFrame, out: str = "n") -> DataFrame:
    """Number of rows, as a one-row table."""
    return df.agg(F.count(F.lit(1)).alias(out))


def distinct_values(df: DataFrame, column: str) -> DataFrame:
    """Distinct values of a column."""
    return df.select(column).distinct()


def explode_tokens(df: DataFrame, column: str, sep: str = ",", out: str = "token") -> DataFrame:
    """One row per non-empty token; null texts give none."""
    return df.select(F.explode(F.split(F.col(column), r"\Q" + sep + r"\E")).alias(out)).filter(F.col(out) != "")


def count_tokens(df: DataFrame, column: str, sep: str = ",", out: str = "n") -> DataFrame:
    """Occurrences of each token over all rows."""
    return count_by(explode_tokens(df, column, sep), "token", out)


def explode_chars(df: DataFrame, column: str, out: str = "code") -> DataFrame:
    """One row per character."""
    return df.select(F.explode(characters(F.col(column))).alias(out)).filter(F.col(out) != "")


def count_codes(df: DataFrame, column: str = "codes", issuer: str | None = "issuer_cik") -> DataFrame:
    """Occurrences of each one-character code; empty filings are left out."""
    rows = df if issuer is None else df.filter(F.col(issuer) != UNKNOWN_ISSUER)
    return count_by(explode_chars(rows, column), "code")


def pivot_codes(
    df: DataFrame, key: str, code: str, codes: dict[str, str] | Sequence[str] = TRANSACTION_CODES
) -> DataFrame:
    """One row per key and one count column per code, 0 where the code is absent.

    The fixed code list makes this one conditional aggregate, with no pass to discover values.
    """
    named = codes if isinstance(codes, dict) else {c: c for c in codes}
    return df.groupBy(key).agg(*[F.count_if(F.col(code) == c).alias(name) for c, name in named.items()])


def top_k(df: DataFrame, by: str, k: int, ties: Sequence[str]) -> DataFrame:
    """The ``k`` rows with the largest ``by``; ``ties`` make the choice deterministic."""
    return df.orderBy(F.desc(by), *ties).limit(k)


def top_filers(index: DataFrame, form_type, n: int = 20, company: str = "cik", form: str = "form_type") -> DataFrame:
    """Companies with most filings of one form type."""
    filings = count_by(index.filter(F.col(form) == form_type), company, "filings")
    return top_k(filings, "filings", n, [company])


def _value_counts(df: DataFrame, columns: Sequence[str], kind: str) -> DataFrame:
    pairs = F.array(*[
        F.struct(F.lit(c).alias("column"), F.col(f"`{c}`").cast(kind).alias("value")) for c in columns
    ])
    return (
        df.select(F.inline(pairs)).filter(F.col("value").isNotNull())
        .groupBy("column", "value").agg(F.count(F.lit(1)).alias("n"))
    )


def _comparable(kind: T.DataType) -> str:
    """The type a column's values are counted and compared in."""
    if isinstance(kind, T.IntegralType):
        return "long"
    if isinstance(kind, T.DecimalType):
        return kind.simpleString()
    return "double" if isinstance(kind, T.NumericType) else "string"


def most_common(df: DataFrame, columns: str | Sequence[str]) -> DataFrame:
    """``(column, value, n)``: the most frequent non-null value of each column, as text.

    Ties go to the smallest value; numbers are compared as numbers. Counts are combined map-side
    and the winner is a mergeable minimum over (-n, value), so a column with many distinct values
    never sits in one buffer. Columns of one kind share a pass.
    """
    names = [columns] if isinstance(columns, str) else list(columns)
    kinds: dict[str, list[str]] = {}
    for name in names:
        kinds.setdefault(_comparable(df.schema[name].dataType), []).append(name)
    parts = []
    for kind, members in kinds.items():
        best = _value_counts(df, members, kind).groupBy("column").agg(
            F.min(F.struct((-F.col("n")).alias("negated"), "value")).alias("best")
        )
        parts.append(best.select(
            "column", F.col("best.value").cast("string").alias("value"), (-F.col("best.negated")).alias("n")
        ))
    return reduce(DataFrame.unionByName, parts)


def class_probabilities(df: DataFrame, label: str) -> DataFrame:
    """``(label, n, probability)`` in label order."""
    counts = count_by(df, label)
    total = counts.agg(F.sum("n").alias("total")).scalar()
    return counts.withColumn("probability", F.col("n") / total).orderBy(label)


def chance_agreement(train: DataFrame, test: DataFrame, label: str) -> DataFrame:
    """Probability that two independent draws, one per table, share their class."""
    a = class_probabilities(train, label).select(label, F.col("probability").alias("p"))
    b = class_probabilities(test, label).select(label, F.col("probability").alias("q"))
    return a.join(b, label).agg(F.coalesce(F.sum(F.col("p") * F.col("q")), F.lit(0.0)).alias("chance"))


def append_rows(df: DataFrame, filler: DataFrame) -> DataFrame:
    """Bag union by column name."""
    return df.unionByName(filler)


def align_forecasts(df: DataFrame, symbol: str = "symbol", position: str = "position") -> DataFrame:
    """Cut every symbol's series to the length of the shortest one.

    Positions count from 0 without gaps, so the shared length is one small scalar.
    """
    lengths = df.groupBy(symbol).agg(F.count(F.lit(1)).alias("n"))
    return df.filter(F.col(position) < lengths.agg(F.min("n").alias("n")).scalar())


def share(condition: Column) -> Column:
    """Share of rows that satisfy a condition; null on no rows."""
    return F.avg(F.when(condition, 1.0).otherwise(0.0))
