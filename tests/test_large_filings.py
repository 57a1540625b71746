import pytest
from pyspark.sql import functions as F

from fathomline.functions.filings import parse_holdings
from fathomline.sources.filings import read_documents, read_holding_ids


@pytest.fixture
def small_splits(spark):
    settings = {"spark.sql.files.maxPartitionBytes": "2000", "spark.sql.files.openCostInBytes": "0"}
    before = {key: spark.conf.get(key) for key in settings}
    for key, value in settings.items():
        spark.conf.set(key, value)
    yield
    for key, value in before.items():
        spark.conf.set(key, value)


def block(ids, prefix="", line="\n"):
    rows = line.join(f"<{prefix}infoTable><{prefix}cusip> {i} </{prefix}cusip></{prefix}infoTable>" for i in ids)
    return f'<XML>\n<?xml version="1.0"?>\n<{prefix}informationTable>{rows}</{prefix}informationTable>\n</XML>\n'


def test_large_filings(spark, tmp_path, rows, small_splits):
    filings = {
        "many": "head\n" + block(["old1", "old2"]) + block([f"a{i % 700}" for i in range(1500)]) + "tail\n",
        "one_line": block([f"b{i}" for i in range(900)], line="").replace("\n", ""),
        "prefix": block(["c1", "C1", "c2"], "n1:") + "<cusip>late</cusip>",
        "none": "no holdings <cusip>x1</cusip>\n",
        "blank": block(["", "d1"]),
        "empty": "",
        "long": "x" * 50_000 + block(["e1"]) + "y" * 50_000,
    }
    for name, text in filings.items():
        (tmp_path / f"{name}.txt").write_text(text)
    found = read_holding_ids(spark, str(tmp_path)).select(F.regexp_extract("path", r"(\w+)\.txt$", 1).alias("name"), "id")
    documents = read_documents(spark, str(tmp_path)).select(
        F.regexp_extract("path", r"(\w+)\.txt$", 1).alias("name"), F.explode(F.split(parse_holdings(F.col("content")), ",")).alias("id"))
    assert rows(found, "name", "id") == rows(documents.filter("id <> ''"), "name", "id")
    assert found.count() == 700 + 900 + 2 + 1 + 1
    assert spark.read.option("lineSep", "<").text(str(tmp_path)).rdd.getNumPartitions() > 50


def test_without_closed_block(spark, tmp_path):
    (tmp_path / "a.txt").write_text('<XML><?xml version="1.0"?><t><cusip>1</cusip></t>')
    (tmp_path / "b.txt").write_text(block(["1"]) + '<XML><?xml version="1.0"?><t><cusip>2</cusip>')
    assert read_holding_ids(spark, str(tmp_path)).count() == 0
