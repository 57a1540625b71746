import random
from datetime import datetime, timedelta, timezone

import pytest
from pyspark.sql import functions as F

from fathomline.functions.text import parse_access_log, request_url
from fathomline.session import fresh_path
from fathomline.streaming import counts, sinks, sources
from fathomline.streaming.counts import sliding_counts
from fathomline.streaming.filings import stream_ownership
from fathomline.streaming.sinks import start_sink
from fathomline.streaming.stateful import living_counts


def drop(folder, name, text):
    folder.mkdir(exist_ok=True)
    (folder / name).write_text(text)


def test_batch_and_running_word_count(spark, tmp_path, rows):
    folder = tmp_path / "in"
    drop(folder, "1.txt", "hello spark\nhello again")
    drop(folder, "2.txt", "spark spark  x")
    lines = sources.stream_lines(spark, str(folder), max_files=1)
    out = fresh_path(spark, "words")
    sinks.write_batches(lines, out, transform=counts.word_count).awaitTermination()
    batches = sinks.read_batches(spark, out)
    assert batches.select("batch_id").distinct().count() == 2
    total = batches.groupBy("word").agg(F.sum("n").alias("n"))
    assert rows(total) == rows(counts.word_count(spark.read.text(str(folder))))

    running = fresh_path(spark, "running")
    sinks.write_batches(counts.running_word_count(lines), running, "update").awaitTermination()
    updates = sinks.read_batches(spark, running)
    last = sinks.latest_values(updates, ["word"], "n")
    assert rows(last, "word", "n") == [("again", 1), ("hello", 3), ("spark", 3), ("x", 1)]
    # A batch emits only the words it has touched, and "world" never arrived.
    per_batch = {r.batch_id: r.words for r in updates.groupBy("batch_id").agg(F.collect_set("word").alias("words")).collect()}
    assert sorted(sorted(w) for w in per_batch.values()) == [["again", "hello", "spark"], ["spark", "x"]]


def test_running_count_with_seed_table(spark, tmp_path, rows):
    folder = tmp_path / "in"
    drop(folder, "1.txt", "a b a")
    seeds = spark.createDataFrame([("a", 10), ("c", 5)], "word string, n int")
    lines = sources.stream_lines(spark, str(folder))
    out = fresh_path(spark, "seeded")
    sinks.write_batches(counts.running_word_count(lines, initial=seeds), out, "update").awaitTermination()
    assert rows(sinks.read_batches(spark, out), "word", "n") == [("a", 12), ("b", 1)]


def test_restart_continues_from_checkpoint(spark, tmp_path, rows):
    folder, checkpoint, out = tmp_path / "in", str(tmp_path / "checkpoint"), str(tmp_path / "out")
    for name, text in (("1.txt", "a a"), ("2.txt", "a b")):
        drop(folder, name, text)
        lines = sources.stream_lines(spark, str(folder))
        query = sinks.write_batches(counts.running_word_count(lines, initial={}), out, "update", checkpoint=checkpoint)
        query.awaitTermination()
    assert rows(sinks.latest_values(sinks.read_batches(spark, out), ["word"], "n")) == [("a", 3), ("b", 1)]


def test_event_count_per_batch(spark, tmp_path):
    folder = tmp_path / "in"
    drop(folder, "1.txt", "x\ny")
    drop(folder, "2.txt", "z")
    lines = sources.message_lines(sources.stream_lines(spark, str(folder), max_files=1))
    out = fresh_path(spark, "events")
    sinks.write_batches(lines, out, transform=counts.event_count).awaitTermination()
    assert sorted(r.n for r in sinks.read_batches(spark, out).collect()) == [1, 2]


def log_line(second, url):
    return f'10.0.0.1 - - [29/Nov/2015:03:50:{second:02d} +0000] "GET {url} HTTP/1.1" 200 1 "-" "agent"'


def test_sliding_url_counts(spark, tmp_path, rows):
    folder = tmp_path / "in"
    drop(folder, "1.txt", "\n".join(log_line(s, u) for s, u in [(0, "/a"), (1, "/a"), (3, "/b"), (9, "/a")]))
    drop(folder, "2.txt", log_line(2, "/a"))

    def parsed(lines):
        fields = parse_access_log(lines, "value")
        ts = F.to_timestamp(F.substring("time", 2, 20), "dd/MMM/yyyy:HH:mm:ss")
        return fields.select(ts.alias("ts"), request_url(F.col("request")).alias("url"))

    batch = parsed(spark.read.text(str(folder)))
    direct = batch.groupBy(F.window("ts", "4 seconds", "1 second").alias("w"), "url").count()
    expected = rows(direct.select(F.col("w.start"), "url", "count"))
    assert rows(counts.sliding_counts(batch, "ts", "url", "4 seconds", "1 second")) == expected

    stream = parsed(sources.stream_lines(spark, str(folder), max_files=1))
    out = fresh_path(spark, "slides")
    sinks.write_batches(counts.slide_counts(stream, "ts", "url", "1 second"), out, "update").awaitTermination()
    slides = sinks.latest_values(sinks.read_batches(spark, out), ["slide_start", "url"], "n")
    assert rows(counts.sliding_from_slides(slides, "url", "4 seconds", "1 second")) == expected

    finished = fresh_path(spark, "append")
    windows = counts.sliding_counts(stream, "ts", "url", "4 seconds", "1 second", delay="2 seconds")
    sinks.start_sink(windows, "parquet", finished).awaitTermination()
    assert set(rows(spark.read.parquet(finished))) <= set(expected)


def test_stream_ownership(spark, tmp_path, rows):
    folder = tmp_path / "in"
    body = (
        "<XML>\n<?xml version='1.0'?>\n<ownershipDocument>\n<issuer><issuerCik>42</issuerCik></issuer>\n<nonDerivativeTable>"
        "<nonDerivativeTransaction><transactionCoding><transactionCode>P</transactionCode></transactionCoding>"
        "</nonDerivativeTransaction></nonDerivativeTable>\n</ownershipDocument>\n</XML>"
    )
    drop(folder, "1.txt", body)
    drop(folder, "2.txt", "broken")
    query = sinks.start_sink(stream_ownership(spark, str(folder)), "memory", "ownership_rows")
    query.awaitTermination()
    assert rows(spark.table("ownership_rows")) == [("42", "P")]


def feed(spark, folder, batches, schema="ts timestamp, key string"):
    """A stream that reads one file of rows per batch."""
    for i, rows in enumerate(batches):
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(f"{folder}/{i}")
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(f"{folder}/*")


def at(second):
    return datetime(2024, 1, 1, 10, tzinfo=timezone.utc) + timedelta(seconds=second)


def run(spark, df, tmp_path, checkpoint=None):
    target = str(tmp_path / "out")
    start_sink(df, "parquet", target, checkpoint=checkpoint or str(tmp_path / "checkpoint")).awaitTermination()
    return spark.read.parquet(target)


def test_streamed_sliding_sums_equal_batch(spark, tmp_path):
    draw = random.Random(4)
    batches = [[(at(60 * b + draw.uniform(-20, 60)), draw.choice("aaab")) for _ in range(40)] for b in range(6)]
    batches.append([(at(2_000), "c"), (at(2_003), "a")])  # a silence longer than the window, then another one
    batches.append([(at(20_000), "z")])
    got = run(spark, sliding_counts(feed(spark, str(tmp_path / "in"), batches), "ts", "key", "60 seconds", "5 seconds", "30 seconds"), tmp_path)
    events = spark.createDataFrame([r for b in batches[:-1] for r in b], "ts timestamp, key string")
    want = sliding_counts(events, "ts", "key", "60 seconds", "5 seconds")
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))
    left = spark.read.format("statestore").option("stateVarName", "ring").option("operatorId", "0").load(str(tmp_path / "checkpoint"))
    assert left.count() == 0  # all slides but the last one, which is not closed, have left the state


@pytest.fixture
def default_store(spark):
    """Spark's own state store, as in a session that the library did not build."""
    name = "spark.sql.streaming.stateStore.providerClass"
    before = spark.conf.get(name)
    spark.conf.set(name, "org.apache.spark.sql.execution.streaming.state.HDFSBackedStateStoreProvider")
    yield
    spark.conf.set(name, before)


def test_streamed_sliding_sums_in_a_session_with_the_default_store(spark, tmp_path, default_store):
    batches = [[(at(0), "a"), (at(1), "b"), (at(2), "a")], [(at(500), "a")]]
    got = run(spark, sliding_counts(feed(spark, str(tmp_path / "in"), batches), "ts", "key", "10 seconds", "10 seconds", "30 seconds"), tmp_path)
    assert sorted((r.key, r.n) for r in got.collect()) == [("a", 2), ("b", 1)]


def test_living_counts_in_a_session_with_the_default_store(spark, tmp_path, default_store):
    batches = [[(at(0), "a"), (at(1), "a")], [(at(500), "b")]]
    seeds = spark.createDataFrame([("a", 5)], "key string, n long")
    counts = living_counts(feed(spark, str(tmp_path / "in"), batches), "ts", "key", 60_000_000, 10_000_000, "0 seconds", seeds)
    assert [(r.key, r.n) for r in run(spark, counts, tmp_path).collect()] == [("a", 7)]


def test_living_counts_start_from_seeds_expire_and_go_on_after_a_restart(spark, tmp_path):
    source, slide, life = str(tmp_path / "in"), 10_000_000, 60_000_000
    seeds = spark.createDataFrame([("a", 5), ("never", 7)], "key string, n long")
    feed(spark, source, [[(at(1), "a"), (at(2), "a"), (at(15), "b")], [(at(70), "b"), (at(71), "x")]])

    def counts():
        stream = spark.readStream.schema("ts timestamp, key string").option("maxFilesPerTrigger", 1).parquet(f"{source}/*")
        return living_counts(stream, "ts", "key", life, slide, "0 seconds", seeds)

    run(spark, counts(), tmp_path)
    spark.createDataFrame([(at(75), "a"), (at(125), "b"), (at(140), "a")], "ts timestamp, key string").coalesce(1).write.parquet(f"{source}/2")
    spark.createDataFrame([(at(400), "x")], "ts timestamp, key string").coalesce(1).write.parquet(f"{source}/3")
    got = run(spark, counts(), tmp_path)
    assert sorted((r.key, (r.slide_start.replace(tzinfo=timezone.utc) - at(0)).seconds, r.n) for r in got.collect()) == [
        ("a", 0, 7), ("a", 70, 1), ("a", 140, 1), ("b", 10, 1), ("b", 70, 2), ("b", 120, 3), ("x", 70, 1)]
    left = spark.read.format("statestore").option("stateVarName", "count").load(str(tmp_path / "checkpoint"))
    assert [r.key.key for r in left.collect()] == ["never"]
