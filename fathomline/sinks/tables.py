"""Batch sinks. Output stays partitioned; sorted output keeps its order across part files."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fathomline.sinks.single import write_single_csv


def write_csv(df: DataFrame, path: str, mode: str = "errorifexists", single_file: bool = False) -> None:
    """CSV with header; fails if the path exists unless another mode is given.

    As a single file it is complete or absent; the modes are then ``errorifexists`` and ``overwrite``.
    """
    if single_file:
        if mode not in ("errorifexists", "error", "overwrite"):
            raise ValueError(f"a single file cannot be written in mode {mode}")
        write_single_csv(df, path, overwrite=mode == "overwrite")
        return
    df.write.mode(mode).option("header", True).csv(path)


def write_ranked_csv(
    df: DataFrame, path: str, sort_field: str | None = None, ties: Sequence[str] = (), single_file: bool = False
) -> None:
    """CSV that replaces the path, optionally in descending order of one field, as one file if wanted."""
    if single_file:
        write_single_csv(df, path, [F.desc(sort_field), *ties] if sort_field else [], overwrite=True)
        return
    ordered = df.orderBy(F.desc(sort_field), *ties) if sort_field else df
    ordered.write.mode("overwrite").option("header", True).csv(path)


def write_parquet(df: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """Parquet output."""
    df.write.mode(mode).parquet(path)


def write_noop(df: DataFrame) -> None:
    """Run the whole plan and keep nothing."""
    df.write.format("noop").mode("overwrite").save()


def store_table(df: DataFrame, target: str, append: bool = False) -> None:
    """Write to a table name, or to a path if ``target`` holds a slash."""
    writer = df.write.mode("append" if append else "errorifexists")
    writer.parquet(target) if "/" in target else writer.saveAsTable(target)


def load_table(spark: SparkSession, target: str) -> DataFrame:
    """Read back what ``store_table`` wrote."""
    return spark.read.parquet(target) if "/" in target else spark.table(target)


def write_sorted_text(df: DataFrame, keys: Sequence[str], path: str, sep: str = "\t") -> None:
    """One line per row in global key order."""
    line = F.concat_ws(sep, *[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in df.columns])
    df.orderBy(*keys).select(line.alias("value")).write.text(path)


def write_documents(df: DataFrame, path: str, name: str = "name", content: str = "content") -> None:
    """Documents keyed by their full name."""
    df.select(F.col(name).alias("name"), F.col(content).alias("content")).write.parquet(path)
