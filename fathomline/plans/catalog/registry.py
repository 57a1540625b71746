"""Registry of runnable queries. Each takes ``(spark, folder)`` and reads the tables in ``folder``.

``reference_sql`` is the same query in plain SQL, for comparison with another engine.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
REFERENCE_SQL: dict[str, str] = {}


def query(reference_sql: str | None = None) -> Callable[[Query], Query]:
    """Register a function under its own name."""

    def register(function: Query) -> Query:
        QUERIES[function.__name__] = function
        if reference_sql is not None:
            REFERENCE_SQL[function.__name__] = reference_sql
        return function

    return register


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """One table of the folder."""
    return spark.read.parquet(f"{folder}/{name}.parquet")
