"""Imputation and table cleaning. Fill values are scalar subqueries of the same plan."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fathomline.functions.encoding import bucket_two, encode_binary, encode_ordinal
from fathomline.operators.counts import most_common
from fathomline.operators.ordering import join_keys
from fathomline.operators.quantiles import MAX_BUFFERED, median_by, median_of

# The passenger columns that are not used for learning, the label, and the
# listed medical columns with the one that is bucketed.
PASSENGER_TEXT = ["PassengerId", "Name", "Ticket", "Cabin", "Sex", "Embarked"]
PASSENGER_LABEL = "Survived"
MEDICAL_AGE = "Age"


def impute_mode(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Nulls of each listed column become its most frequent value; one counting pass for all."""
    names = list(columns)
    pivoted = most_common(df, names).agg(
        *[F.max(F.when(F.col("column") == c, F.col("value"))).alias(f"m{i}") for i, c in enumerate(names)]
    )
    # One row of a few values: the only thing that reaches the driver.
    modes = pivoted.first()
    return df.withColumns({
        name: F.coalesce(F.col(f"`{name}`"), F.lit(modes[f"m{i}"]).cast(df.schema[name].dataType))
        for i, name in enumerate(names)
    })


def impute_mean(df: DataFrame, column: str) -> DataFrame:
    """Nulls become the mean of the column."""
    mean = df.agg(F.avg(column).alias("mean")).scalar()
    return df.withColumn(column, F.coalesce(F.col(column), mean))


def impute_median(
    df: DataFrame, column: str, by: str | None = None, max_buffered: int = MAX_BUFFERED
) -> DataFrame:
    """Nulls become the median of the column, or the median of the row's group."""
    if by is None:
        median = median_of(df, column, "m", max_buffered).scalar()
        return df.withColumn(column, F.coalesce(F.col(column), median))
    medians = median_by(df, [by], column, "__m", max_buffered)
    joined = join_keys(df, medians, [by], "left")
    return joined.withColumn(column, F.coalesce(F.col(column), F.col("__m"))).drop("__m")


def impute_zero(df: DataFrame) -> DataFrame:
    """Every numeric null becomes 0."""
    return df.na.fill(0)


def clean_medical(df: DataFrame, columns: Sequence[str], age: str = MEDICAL_AGE) -> DataFrame:
    """Most frequent value for nulls, then age in two buckets."""
    return impute_mode(df, columns).withColumn(age, bucket_two(F.col(age)))


def clean_passengers(df: DataFrame) -> DataFrame:
    """Mean age, most frequent port, sex and port as numbers, label cast, text columns dropped."""
    filled = impute_mode(impute_mean(df, "Age"), ["Embarked"])
    coded = filled.withColumns({
        "SexInt": encode_binary(F.col("Sex")),
        "EmbarkedInt": encode_ordinal(F.col("Embarked")),
    })
    if PASSENGER_LABEL in df.columns:
        coded = coded.withColumn(PASSENGER_LABEL, F.col(PASSENGER_LABEL).try_cast("double"))
    return coded.drop(*PASSENGER_TEXT)
