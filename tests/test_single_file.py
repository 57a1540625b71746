import csv
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from fathomline.sinks import single
from fathomline.sinks import tables as sinks


def frame(spark, n, parts):
    return spark.range(n).select("id", F.concat(F.lit('a "quoted", line '), F.col("id").cast("string")).alias("note")).repartition(parts)


def test_pieces_cover_the_whole():
    parts = [("a", 10), ("b", 3), ("c", 7)]
    pieces = single.pieces_of(parts, 4)
    assert [at for _, _, at, _ in pieces] == [0, 4, 8, 10, 13, 17]
    assert sum(size for *_, size in pieces) == 20 and max(size for *_, size in pieces) == 4


def test_hundred_parts_have_the_bytes_of_the_ordered_parts(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(single, "PIECE", 1_000)
    df = frame(spark, 20_000, 100)
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        spark.conf.set("spark.sql.shuffle.partitions", "100")
        sinks.write_ranked_csv(df, str(tmp_path / "one.csv"), "id", single_file=True)
        df.orderBy(F.desc("id")).write.csv(str(tmp_path / "parts"))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "8")
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    parts = sorted(Path(tmp_path / "parts").glob("part-*"))
    assert len(parts) == 100
    assert (tmp_path / "one.csv").read_bytes() == b"id,note\n" + b"".join(p.read_bytes() for p in parts)
    assert sorted(p.name for p in tmp_path.iterdir() if not p.name.startswith(".")) == ["one.csv", "parts"]


def test_existing_file_is_kept_or_replaced(spark, tmp_path):
    path = str(tmp_path / "x.csv")
    sinks.write_csv(frame(spark, 3, 1), path, single_file=True)
    before = Path(path).read_bytes()
    with pytest.raises(FileExistsError):
        sinks.write_csv(frame(spark, 5, 2), path, single_file=True)
    with pytest.raises(ValueError):
        sinks.write_csv(frame(spark, 5, 2), path, "append", single_file=True)
    assert Path(path).read_bytes() == before
    sinks.write_csv(frame(spark, 5, 2), path, "overwrite", single_file=True)
    with open(path, newline="") as f:
        assert sorted(int(r["id"]) for r in csv.DictReader(f, escapechar="\\")) == [0, 1, 2, 3, 4]


def test_a_failed_run_leaves_nothing(spark, tmp_path):
    bad = frame(spark, 50, 4).withColumn("note", F.when(F.col("id") == 40, F.raise_error(F.lit("no"))).otherwise(F.col("note")))
    with pytest.raises(Exception):
        sinks.write_csv(bad, str(tmp_path / "bad.csv"), single_file=True)
    assert [p for p in tmp_path.iterdir()] == []


def test_empty_frames(spark, tmp_path):
    none = frame(spark, 0, 1)
    sinks.write_csv(none, str(tmp_path / "head.csv"), single_file=True)
    assert (tmp_path / "head.csv").read_text() == "id,note\n"
    single.write_single_csv(none, str(tmp_path / "none.csv"), header=False)
    assert (tmp_path / "none.csv").read_bytes() == b""
