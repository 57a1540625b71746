"""Streaming scans. Any other source works too: the operators take a streaming DataFrame."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _reader(spark: SparkSession, max_files: int | None):
    reader = spark.readStream
    return reader if max_files is None else reader.option("maxFilesPerTrigger", max_files)


def stream_lines(spark: SparkSession, folder: str, max_files: int | None = None) -> DataFrame:
    """Lines of text files dropped into a folder."""
    return _reader(spark, max_files).text(folder)


def stream_documents(spark: SparkSession, folder: str, max_files: int | None = None) -> DataFrame:
    """One row per dropped file in ``content``."""
    return _reader(spark, max_files).text(folder, wholetext=True).withColumnRenamed("value", "content")


def stream_table(spark: SparkSession, path: str, schema: T.StructType, max_files: int | None = None) -> DataFrame:
    """Rows of Parquet files arriving at a path."""
    return _reader(spark, max_files).schema(schema).parquet(path)


def message_lines(df: DataFrame, column: str = "value") -> DataFrame:
    """Messages of any source as text lines in ``value``."""
    return df.select(F.col(column).cast("string").alias("value"))
