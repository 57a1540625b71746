"""Scans of adjacency lists, ratings and item names."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def parse_adjacency(lines: DataFrame, column: str = "value") -> DataFrame:
    """Edges ``(src, dst)`` of lines holding a node followed by its neighbours."""
    words = F.filter(F.split(F.col(column), r"\s+"), lambda t: t != "")
    nodes = lines.select(F.transform(words, lambda t: t.try_cast("long")).alias("t")).filter(F.size("t") > 1)
    return nodes.select(F.get("t", F.lit(0)).alias("src"), F.explode(F.slice("t", F.lit(2), F.size("t") - 1)).alias("dst"))


def read_adjacency(spark: SparkSession, path: str) -> DataFrame:
    """Edges of an adjacency-list file."""
    return parse_adjacency(spark.read.text(path))


def _separator(sep: str | None) -> str:
    return r"\s+" if sep is None else r"\Q" + sep + r"\E"


def parse_ratings(lines: DataFrame, sep: str | None = None, column: str = "value") -> DataFrame:
    """``(user, item, rating)``; ``sep=None`` cuts at whitespace. Lines that do not parse are dropped."""
    parts = F.split(F.trim(F.col(column)), _separator(sep))
    rows = lines.select(
        F.get(parts, F.lit(0)).try_cast("long").alias("user"),
        F.get(parts, F.lit(1)).try_cast("long").alias("item"),
        F.get(parts, F.lit(2)).try_cast("double").alias("rating"),
    )
    return rows.dropna()


def read_ratings(spark: SparkSession, path: str, sep: str | None = None) -> DataFrame:
    """Ratings scan."""
    return parse_ratings(spark.read.text(path), sep)


def read_item_names(spark: SparkSession, path: str, sep: str = "|") -> DataFrame:
    """``(item, name)`` scan."""
    parts = F.split(F.col("value"), _separator(sep))
    rows = spark.read.text(path).select(
        F.get(parts, F.lit(0)).try_cast("long").alias("item"), F.get(parts, F.lit(1)).alias("name")
    )
    return rows.filter(F.col("item").isNotNull())
