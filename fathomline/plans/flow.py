"""Composition: extract-transform-load flows, chained transforms and SQL over a frame."""

from __future__ import annotations

from collections.abc import Callable, Iterable
from dataclasses import dataclass
from functools import reduce
from typing import Any

from pyspark.sql import DataFrame, SparkSession

Transform = Callable[[DataFrame], DataFrame]


@dataclass(frozen=True)
class Flow:
    """Extract, transform, load. Nothing runs until the load step acts."""

    extract: Callable[[SparkSession, Any], DataFrame]
    transform: Transform
    load: Callable[[DataFrame], Any]

    def plan(self, spark: SparkSession, source: Any) -> DataFrame:
        """The lazy result before loading."""
        return self.extract(spark, source).transform(self.transform)

    def run(self, spark: SparkSession, source: Any) -> Any:
        """Load the transformed source."""
        return self.load(self.plan(spark, source))


def compose(*steps: Transform) -> Transform:
    """One transform that applies the steps from left to right."""
    return lambda df: reduce(lambda frame, step: frame.transform(step), steps, df)


def run_steps(source: DataFrame, steps: Iterable[Transform]) -> DataFrame:
    """Fold a source through a list of steps."""
    return compose(*steps)(source)


def sql_over(df: DataFrame, view: str, query: str) -> DataFrame:
    """SQL over a frame under a name that holds for this query only; a name in use is refused."""
    spark = df.sparkSession
    if spark.catalog.tableExists(view):
        raise ValueError(f"{view} is the name of a table or view already")
    df.createTempView(view)
    try:
        return spark.sql(query)
    finally:
        spark.catalog.dropTempView(view)
