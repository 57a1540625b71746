"""Streams over table files, run until no input is left; results go through the shared folder."""

from __future__ import annotations

from pyspark.sql import functions as F

from fathomline.plans.catalog.filings import ownership_content
from fathomline.plans.catalog.registry import query, table
from fathomline.plans.reports import ownership_counts
from fathomline.session import fresh_path
from fathomline.streaming.counts import (
    INITIAL_COUNTS, event_count, running_word_count, slide_counts, sliding_counts, sliding_from_slides, word_count,
)
from fathomline.streaming.sinks import latest_values, read_batches, start_sink, write_batches
from fathomline.streaming.sources import message_lines, stream_table
from fathomline.streaming.stateful import living_counts


def _stream(spark, folder, name):
    # The braces make this a pattern, which a stream accepts for a file as well as for a folder.
    return stream_table(spark, f"{folder}/{{{name}.parquet}}", table(spark, folder, name).schema)


def _batches(spark, df, mode="append", transform=None):
    path = fresh_path(spark, "batches")
    write_batches(df, path, mode, transform).awaitTermination()
    return read_batches(spark, path)


_WORDS = """
with w as (select unnest(string_split(text, ' ')) as word from documents)
"""


@query(_WORDS + "select word, count(*) as n from w where word <> '' group by word")
def batch_word_counts(spark, folder):
    """Per-batch word counts, added up over the batches."""
    lines = message_lines(_stream(spark, folder, "documents"), "text")
    counts = _batches(spark, lines, transform=word_count)
    return counts.groupBy("word").agg(F.sum("n").alias("n"))


@query(_WORDS + """
select word, count(*) + case when word in ('hello', 'world') then 1 else 0 end as n
from w where word <> '' group by word
""")
def running_word_counts(spark, folder):
    """Running counts on top of initial counts; the last emitted value of each word."""
    lines = message_lines(_stream(spark, folder, "documents"), "text")
    updates = _batches(spark, running_word_count(lines, initial=INITIAL_COUNTS), "update")
    return latest_values(updates, ["word"], "n")


@query("select count(*) as n from events")
def batch_event_counts(spark, folder):
    counts = _batches(spark, _stream(spark, folder, "events"), transform=event_count)
    return counts.agg(F.sum("n").alias("n"))


def _by_size(windows, key):
    """How many windows of a key hold how many events, and the first and last of them."""
    text = "yyyy-MM-dd HH:mm:ss"
    return windows.groupBy(key, "n").agg(
        F.count(F.lit(1)).alias("windows"), F.date_format(F.min("window_start"), text).alias("first_window"),
        F.date_format(F.max("window_start"), text).alias("last_window"))


@query("""
with e as (select event_type, unnest(generate_series(date_trunc('second', ts) - interval 299 second,
                                                     date_trunc('second', ts), interval 1 second)) as start
           from events),
c as (select event_type, start, count(*) as n from e group by 1, 2)
select event_type, n, count(*) as windows, strftime(min(start), '%Y-%m-%d %H:%M:%S') as first_window,
       strftime(max(start), '%Y-%m-%d %H:%M:%S') as last_window
from c group by 1, 2
""")
def sliding_window_counts(spark, folder):
    """The stream keeps one count per second and type; windows of 300 s every second are run up from those.

    Reported is how many windows hold how many events.
    """
    events = _stream(spark, folder, "events").select("ts", "event_type")
    updates = _batches(spark, slide_counts(events, "ts", "event_type", "1 second"), "update")
    slides = latest_values(updates, ["slide_start", "event_type"], "n")
    return _by_size(sliding_from_slides(slides, "event_type", "300 seconds", "1 second"), "event_type")


@query("""
with o as (select max(ts) as newest from events),
e as (select event_type, unnest(generate_series(time_bucket(interval 10 minute, ts) - interval 50 minute,
                                               time_bucket(interval 10 minute, ts), interval 10 minute)) as start
      from events)
select event_type, strftime(start, '%Y-%m-%d %H:%M:%S') as window_start, count(*) as n
from e, o where start + interval 1 hour <= newest - interval 1 hour group by 1, 2
""")
def streamed_sliding_counts(spark, folder):
    """Windows of an hour every ten minutes, out of a ring of slide counts in the stream's state.

    Windows that end within the delay before the newest event are not out when the input ends.
    """
    events = _stream(spark, folder, "events").select("ts", "event_type")
    path = fresh_path(spark, "windows")
    start_sink(sliding_counts(events, "ts", "event_type", "1 hour", "10 minutes", "1 hour"), "parquet", path).awaitTermination()
    return spark.read.parquet(path).select(
        "event_type", F.date_format("window_start", "yyyy-MM-dd HH:mm:ss").alias("window_start"), "n")


@query("""
with o as (select max(ts) as newest from events),
s as (select user_id, time_bucket(interval 1 hour, ts) as slide, count(*) as n from events, o
      where time_bucket(interval 1 hour, ts) + interval 1 hour <= newest group by 1, 2),
g as (select *, case when slide - lag(slide) over (partition by user_id order by slide) <= interval 12 hour then 0 else 1 end as fresh
      from s),
i as (select *, sum(fresh) over (partition by user_id order by slide) as life from g)
select user_id, strftime(slide, '%Y-%m-%d %H:%M:%S') as slide_start,
       (sum(n) over (partition by user_id, life order by slide) + case when life = 1 and user_id < 10 then 100 else 0 end)::bigint as n
from i
""")
def living_user_counts(spark, folder):
    """Running counts per user and hour, from given counts, forgotten after twelve hours without an event."""
    events = _stream(spark, folder, "events").select("ts", "user_id")
    seeds = table(spark, folder, "events").select("user_id").filter("user_id < 10").distinct().withColumn("n", F.lit(100))
    path, hour = fresh_path(spark, "living"), 3_600_000_000
    counts = living_counts(events, "ts", "user_id", 12 * hour, hour, "0 seconds", seeds)
    start_sink(counts, "parquet", path).awaitTermination()
    return spark.read.parquet(path).select("user_id", F.date_format("slide_start", "yyyy-MM-dd HH:mm:ss").alias("slide_start"), "n")


@query("""
with e as (select '/u/' || user_id as url, unnest(generate_series(date_trunc('second', ts) - interval 299 second,
                                                     date_trunc('second', ts), interval 1 second)) as start
           from events),
c as (select url, start, count(*) as n from e group by 1, 2)
select url, n, count(*) as windows, strftime(min(start), '%Y-%m-%d %H:%M:%S') as first_window,
       strftime(max(start), '%Y-%m-%d %H:%M:%S') as last_window
from c group by 1, 2
""")
def sliding_url_counts(spark, folder):
    """The same windows in one batch plan, per address."""
    url = F.concat(F.lit("/u/"), F.col("user_id").cast("string"))
    events = table(spark, folder, "events").select("ts", url.alias("url"))
    return _by_size(sliding_counts(events, "ts", "url", "300 seconds", "1 second"), "url")


@query("""
select case when l_tax = 0 then '-1' else l_returnflag || l_linestatus end as codes, count(*) as n
from lineitem group by 1
""")
def streamed_ownership_filings(spark, folder):
    """Filings parsed as they arrive, equal ones of a batch once; each batch's counts are appended to a table."""
    documents = _stream(spark, folder, "lineitem").select(ownership_content().alias("content"))
    counts = _batches(spark, documents, transform=ownership_counts)
    return counts.groupBy("codes").agg(F.sum("n").alias("n"))
