import json
import os
import zipfile
from concurrent.futures import ThreadPoolExecutor

import pytest
from pyspark.sql import functions as F

from fathomline.plans.resumable import ResumableFlow, Step, files_fingerprint
from fathomline.sinks import batches
from fathomline.sinks.single import Folder
from fathomline.sources.archives import Member, ranges_of, read_zip_members
from fathomline.sources.filings import explode_zip, read_archives


def frame(spark, *ids):
    return spark.createDataFrame([(i, f"t{i}") for i in ids], "id long, text string")


def test_append_repeated(spark, tmp_path, rows):
    target = f"{tmp_path}/table"
    assert batches.append_batch(frame(spark, 1, 2), target, "a")
    staged = batches.stage_batch(frame(spark, 3), target)  # dies before the entry
    assert rows(batches.load_batches(spark, target), "id") == [(1,), (2,)]
    assert batches.unpublished(spark, target) == [f"{target}/data/{staged}"]
    assert batches.append_batch(frame(spark, 3), target, "b")
    assert not batches.append_batch(frame(spark, 3), target, "b")
    assert not batches.append_batch(frame(spark, 1, 2), target + "/", "a")
    assert rows(batches.load_batches(spark, target), "id") == [(1,), (2,), (3,)]
    assert rows(batches.batches(spark, target), "batch") == [("a",), ("b",)]


def test_append_of_one_batch_by_many(spark, tmp_path):
    target = f"{tmp_path}/table"
    schema = frame(spark, 1).schema
    folders = [batches.stage_batch(frame(spark, 1), target) for _ in range(4)]
    with ThreadPoolExecutor(4) as pool:
        won = list(pool.map(lambda f: batches.commit_batch(spark, target, 7, f, schema), folders))
    assert sum(won) == 1
    assert batches.load_batches(spark, target).count() == 1
    assert batches.batches(spark, target).first().folder == folders[won.index(True)]


def test_append_edges(spark, tmp_path, rows):
    target = f"{tmp_path}/table"
    with pytest.raises(FileNotFoundError):
        batches.load_batches(spark, target)
    assert batches.unpublished(spark, target) == []
    assert batches.append_batch(frame(spark), target, "")
    assert batches.load_batches(spark, target).count() == 0
    with pytest.raises(ValueError):
        batches.append_batch(frame(spark, 1).withColumn("more", F.lit(1)), target, "x")
    odd = spark.createDataFrame([(None, None), (5, ""), (5, "")], "id long, text string")
    assert batches.append_batch(odd, target, "../odd id\n")
    assert rows(batches.load_batches(spark, target)) == [(5, ""), (5, ""), (None, None)]


def test_append_from_stream(spark, tmp_path, rows):
    source, target = f"{tmp_path}/in", f"{tmp_path}/table"
    frame(spark, 1, 2).write.parquet(source)
    for attempt in range(2):  # a second query without the first one's checkpoint sends batch 0 again
        stream = spark.readStream.schema("id long, text string").parquet(source)
        writer = stream.writeStream.foreachBatch(lambda df, number: batches.append_batch(df, target, number) and None)
        writer.option("checkpointLocation", f"{tmp_path}/state{attempt}").trigger(availableNow=True).start().awaitTermination(60)
    assert rows(batches.load_batches(spark, target), "id") == [(1,), (2,)]


def flow_of(source, folder, log, fail=(), version="1"):
    def step(name, change):
        def transform(df):
            log.append(name)
            if name in fail:
                raise RuntimeError(name)
            return df.transform(change)
        return transform

    return ResumableFlow(
        lambda spark: spark.read.parquet(source), [source],
        [
            Step("plus", step("plus", lambda df: df.withColumn("id", F.col("id") + 1))),
            Step("even", step("even", lambda df: df.filter("id % 2 = 0")), version),
            Step("sum", step("sum", lambda df: df.agg(F.sum("id").alias("total")))),
        ],
        folder,
    )


def test_flow_goes_on(spark, tmp_path):
    source, folder, log = f"{tmp_path}/in", f"{tmp_path}/flow", []
    frame(spark, *range(10)).write.parquet(source)
    with pytest.raises(RuntimeError):
        flow_of(source, folder, log, fail=("sum",)).run(spark)
    assert log == ["plus", "even", "sum"]
    log.clear()
    flow = flow_of(source, folder, log)
    assert flow.run(spark).first().total == 30
    assert log == ["sum"]
    assert [(o.name, o.reused) for o in flow.outcomes] == [("even", True), ("sum", False)]
    log.clear()
    assert flow.run(spark).first().total == 30
    assert log == []


def test_flow_sees_changes(spark, tmp_path):
    source, folder, log = f"{tmp_path}/in", f"{tmp_path}/flow", []
    frame(spark, *range(10)).write.parquet(source)
    flow_of(source, folder, log).run(spark)
    log.clear()
    assert flow_of(source, folder, log, version="2").run(spark).first().total == 30
    assert log == ["even", "sum"]
    log.clear()
    frame(spark, 11).write.mode("append").parquet(source)
    assert flow_of(source, folder, log).run(spark).first().total == 42
    assert log == ["plus", "even", "sum"]


def test_flow_with_lost_result(spark, tmp_path):
    """A folder that a killed run left without its mark, or that was taken away, is computed again."""
    source, folder, log = f"{tmp_path}/in", f"{tmp_path}/flow", []
    frame(spark, *range(10)).write.parquet(source)
    flow = flow_of(source, folder, log)
    flow.run(spark)
    os.rename(flow.outcomes[-1].path, f"{tmp_path}/elsewhere")
    log.clear()
    assert flow.run(spark).first().total == 30
    assert log == ["sum"]
    with pytest.raises(ValueError):
        ResumableFlow(lambda s: s.range(1), [source], [Step("a", lambda d: d)] * 2, folder)


def test_fingerprint(spark, tmp_path):
    source = f"{tmp_path}/in"
    frame(spark, 1).write.parquet(source)
    first = files_fingerprint(spark, source)
    assert first == files_fingerprint(spark, source)
    frame(spark, 2).write.mode("append").parquet(source)
    assert first != files_fingerprint(spark, source)


def test_publish(spark, tmp_path):
    place = Folder(spark, str(tmp_path))
    assert place.publish(json.dumps({"a": "ü"}), f"{tmp_path}/new/e.json")
    assert not place.publish("other", f"{tmp_path}/new/e.json")
    assert json.loads(place.read(f"{tmp_path}/new/e.json")) == {"a": "ü"}
    assert [n for n in os.listdir(tmp_path / "new") if n.endswith(".draft")] == []


def test_ranges():
    members = [Member(str(i), 0, size, 0, 0, 0) for i, size in enumerate([300, 300, 3000, 0, 700, 0, 4])]
    assert [[m.size for m in run] for run in ranges_of(members, 1000)] == [[300, 300], [3000], [0, 700, 0], [4]]
    assert ranges_of([], 10) == []


def archive(path, members, method=zipfile.ZIP_DEFLATED):
    with zipfile.ZipFile(path, "w", method) as out:
        for name, data in members:
            with out.open(name, "w", force_zip64=True) as member:
                member.write(data)
    return str(path)


def test_zip_member_ranges(spark, tmp_path, rows):
    noise = os.urandom(300_000).hex().encode()
    small = [(f"d/{i}.txt", f"text {i} ü".encode()) for i in range(200)]
    archive(tmp_path / "one.zip", [("big", noise), ("empty", b""), ("d/", b""), *small])
    archive(tmp_path / "two.zip", small[:5], zipfile.ZIP_BZIP2)
    archive(tmp_path / "three.zip", small[5:9], zipfile.ZIP_STORED)
    (tmp_path / "none.zip").write_text("no archive")
    df = read_zip_members(spark, f"{tmp_path}/*.zip", range_bytes=1000)
    assert df.rdd.getNumPartitions() > 10
    whole = explode_zip(read_archives(spark, f"{tmp_path}/*.zip")).filter("name not like '%/'")
    assert rows(df, "name", "text") == rows(whole)
    assert df.filter("name = 'big'").first().text == noise.decode()
    assert rows(read_zip_members(spark, [f"{tmp_path}/two.zip"]), "name") == sorted((n,) for n, _ in small[:5])
    assert read_zip_members(spark, str(tmp_path)).count() == df.count()


def test_zip_member_damage(spark, tmp_path, rows):
    path = archive(tmp_path / "one.zip", [("a", b"first" * 50), ("b", b"second" * 50), ("c", b"third" * 50)], zipfile.ZIP_STORED)
    data = bytearray(open(path, "rb").read())
    data[data.index(b"secondsecond") + 3] ^= 1
    open(path, "wb").write(data)
    assert rows(read_zip_members(spark, path), "name") == [("a",), ("c",)]
    assert read_zip_members(spark, f"{tmp_path}/missing*.zip").count() == 0
    assert read_zip_members(spark, archive(tmp_path / "empty.zip", [])).count() == 0
    latin = archive(tmp_path / "latin.zip", [("l", "ü".encode("latin-1"))])
    assert rows(read_zip_members(spark, latin, encoding="latin-1"), "text") == [("ü",)]
