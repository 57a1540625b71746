"""Counts over streams. Every function also accepts a batch DataFrame."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fathomline.streaming.stateful import sliding_sums

# The counts a running word count starts from.
INITIAL_COUNTS = {"hello": 1, "world": 1}


def explode_words(df: DataFrame, column: str = "value", out: str = "word") -> DataFrame:
    """One row per word."""
    return df.select(F.explode(F.split(F.col(column), " ")).alias(out)).filter(F.col(out) != "")


def word_count(df: DataFrame, column: str = "value") -> DataFrame:
    """``(word, n)``; as the transform of ``write_batches`` it counts each batch by itself."""
    return explode_words(df, column).groupBy("word").agg(F.count(F.lit(1)).alias("n"))


def running_word_count(
    df: DataFrame, column: str = "value", initial: Mapping[str, int] | DataFrame = INITIAL_COUNTS
) -> DataFrame:
    """``(word, n)`` over the whole stream, on top of initial counts; use update mode.

    Counts are combined before the shuffle, so a very common word costs one row per task. The
    initial counts are joined after the aggregate; words that never arrive are not emitted.
    """
    counted = word_count(df, column)
    if isinstance(initial, DataFrame):
        seeds = initial.select("word", F.col("n").alias("seed"))
        return counted.join(seeds, "word", "left").select(
            "word", (F.col("n") + F.coalesce("seed", F.lit(0))).alias("n")
        )
    seed = F.lit(0)
    for word, n in initial.items():
        seed = F.when(F.col("word") == word, n).otherwise(seed)
    return counted.select("word", (F.col("n") + seed).alias("n"))


def event_count(df: DataFrame) -> DataFrame:
    """Number of rows, as a one-row table; per batch with ``write_batches``."""
    return df.agg(F.count(F.lit(1)).alias("n"))


def slide_counts(
    df: DataFrame, ts: str, key: Column | str, slide: str = "1 second", delay: str | None = None
) -> DataFrame:
    """``(slide_start, key, n)`` per slide-long tumbling window.

    One state row per slide and key, however many sliding windows overlap it. ``delay`` is the watermark after which a
    stream forgets a slide; without it, late events of any age are counted and the state grows for ever.
    """
    df = df.withWatermark(ts, delay) if delay and df.isStreaming else df
    name = key if isinstance(key, str) else "key"
    column = F.col(key) if isinstance(key, str) else key
    grouped = df.groupBy(F.window(ts, slide).alias("w"), column.alias(name))
    return grouped.agg(F.count(F.lit(1)).alias("n")).select(F.col("w.start").alias("slide_start"), name, "n")


def sliding_from_slides(
    slides: DataFrame, key: str, window: str = "300 seconds", slide: str = "1 second"
) -> DataFrame:
    """``(window_start, key, n)`` of every sliding window that holds an event, from slide counts in batch.

    A slide adds its count at the first window that covers it and takes it off behind the last; running totals of
    these changes are the counts. Time is cut into stretches of at least one window, so the totals of a key run in
    many tasks and a slide is copied twice at most. ``window`` must be a multiple of ``slide``.
    """
    long, short = (_micros(x) for x in (window, slide))
    stretch = F.lit(max(long, 3_600_000_000 // short * short))
    start = F.unix_micros(F.col("slide_start").cast("timestamp"))
    ranges = slides.select(key, "n", (start - long + short).alias("lo"), (start + short).alias("hi"))
    pieces = ranges.withColumn("stretch", F.explode(F.sequence(
        F.floor(F.col("lo") / stretch), F.floor((F.col("hi") - short) / stretch)))).select(
        key, "stretch", "n", F.greatest("lo", F.col("stretch") * stretch).alias("lo"),
        F.least("hi", (F.col("stretch") + 1) * stretch).alias("hi"))
    changes = pieces.select(key, "stretch", F.inline(F.array(
        F.struct(F.col("lo").alias("at"), F.col("n").alias("d")), F.struct(F.col("hi").alias("at"), (-F.col("n")).alias("d")))))
    changes = changes.groupBy(key, "stretch", "at").agg(F.sum("d").alias("d"))
    w = Window.partitionBy(key, "stretch").orderBy("at")
    totals = changes.select(key, "at", F.sum("d").over(w).alias("n"), F.lead("at").over(w).alias("upto")).filter("n > 0")
    starts = F.explode(F.sequence("at", F.col("upto") - short, F.lit(short)))
    return totals.select(starts.alias("at"), key, "n").select(F.timestamp_micros("at").alias("window_start"), key, "n")


def _micros(interval: str) -> int:
    """Length of an interval such as ``5 minutes``."""
    number, unit = interval.split()
    return int(number) * {"second": 1, "minute": 60, "hour": 3_600, "day": 86_400}[unit.rstrip("s")] * 1_000_000


def sliding_counts(
    df: DataFrame, ts: str, key: str, window: str = "300 seconds", slide: str = "1 second",
    delay: str | None = "10 minutes",
) -> DataFrame:
    """``(window_start, key, n)`` straight from events, in batch or append-mode streaming.

    ``delay`` is the watermark that lets finished windows leave the state. In batch, windows are running totals of
    slides; a stream keeps a ring of slide counts per key, and adds and takes off slides as windows end. Without a
    ``delay`` no window of a stream ever ends, so there it is needed.
    """
    if not df.isStreaming:
        return sliding_from_slides(slide_counts(df, ts, key, slide), key, window, slide)
    if delay is None:
        raise ValueError("sliding windows of a stream need a delay")
    return sliding_sums(df, ts, key, _micros(window), _micros(slide), delay)
