"""Scans of price series and forecasts."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# The columns of a ticker file.
TICKER_SCHEMA = (
    "Date date, Open double, High double, Low double, Close double, Volume double, `Adj Close` double"
)
QUOTE_ARRAY = "array<struct<date: date, open: double, close: double, volume: double, changePercent: double>>"


def read_ticker(spark: SparkSession, path: str) -> DataFrame:
    """``(symbol, date, close)`` of ticker files; the symbol is the file name without suffix."""
    rows = spark.read.schema(TICKER_SCHEMA).csv(path, header=True)
    symbol = F.regexp_extract(F.col("_metadata.file_name"), r"^(.*?)(?:\.[^.]*)?$", 1)
    return rows.select(symbol.alias("symbol"), F.col("Date").alias("date"), F.col("Close").alias("close"))


def explode_quotes(df: DataFrame, json_column: str) -> DataFrame:
    """One row per quote of a JSON array; the array column is replaced by the quote's fields."""
    kept = [c for c in df.columns if c != json_column]
    quotes = df.select(*kept, F.explode(F.from_json(json_column, QUOTE_ARRAY)).alias("q"))
    return quotes.select(
        *kept, "q.date", "q.open", "q.close", "q.volume", F.col("q.changePercent").alias("change_percent")
    )


def explode_forecast(df: DataFrame, json_column: str, series: str = "Consensus") -> DataFrame:
    """``(…, position, label, value)`` of one series in a map-of-maps JSON, ordered by integer key."""
    kept = [c for c in df.columns if c != json_column]
    entries = F.map_entries(F.from_json(json_column, "map<string, map<string, string>>")[series])
    keyed = F.transform(entries, lambda e: F.struct(e["key"].try_cast("int").alias("k"), e["value"].alias("v")))
    rows = df.select(*kept, F.posexplode(F.array_sort(keyed)).alias("position", "entry"))
    return rows.select(
        *kept, "position", position_label(F.col("position")).alias("label"), F.col("entry.v").alias("value")
    )


def position_label(position):
    """``T0``, ``T1``, … for a zero-based position."""
    return F.concat(F.lit("T"), position.cast("string"))
