import io
import zipfile

import pytest
from pyspark.sql import functions as F

from fathomline.operators.counts import align_forecasts, top_filers
from fathomline.operators.moves import price_change
from fathomline.sinks import tables as sinks
from fathomline.sources import filings, market, relations, tables


def put(path, text):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text(text)
    return str(path)


def test_csv_modes(spark, tmp_path):
    path = put(tmp_path / "a.csv", 'Sector,Ticker\n"Oil, Gas",XLE\nTech,N/A\n')
    assert tables.read_csv(spark, path).columns == ["Sector", "Ticker"]
    assert tables.read_csv(spark, path, names=["s", "t"]).filter("s = 'Oil, Gas'").count() == 1
    numbers = put(tmp_path / "n.csv", "a,b\n1,x\n2,y\n")
    assert tables.read_csv(spark, numbers, infer_schema=True).dtypes[0] == ("a", "int")
    assert tables.read_csv(spark, numbers, schema="a long, b string").dtypes[0] == ("a", "bigint")
    assert tables.read_csv(spark, numbers, sample=1.0, seed=1).count() == 2
    carriage = put(tmp_path / "cr.csv", "1,2\r3,4\r")
    assert tables.read_positional(spark, carriage, ["a", "b"], lineSep="\r").count() == 2


def test_positional(spark, tmp_path, rows):
    path = put(tmp_path / "m.csv", "5,67,3,5,3,1\n4,?,1,1,?,0\n")
    df = tables.read_positional(spark, path, tables.MEDICAL_COLUMNS)
    assert rows(df, "`BI-RADS`", "Age", "Density") == [(4, None, None), (5, 67, 3)]
    assert len(tables.cover_type_columns()) == 55 and tables.cover_type_columns()[-1] == "Cover_Type"


def test_lines_and_json(spark, tmp_path):
    put(tmp_path / "q1" / "x.idx", "a\nb\n")
    put(tmp_path / "q2" / "x.idx", "c\n")
    assert tables.read_lines(spark, "q1/*.idx, q2/*.idx", f"{tmp_path}/").count() == 3
    path = put(tmp_path / "d.json", '{"hour":"1","month":"2","second":"3","year":"4","timezone":"u","day":"5","minute":"6"}\n')
    assert tables.read_json(spark, path, tables.DATE_PARTS_SCHEMA).first().minute == "6"
    assert tables.read_json(spark, path).first().year == "4"
    assert tables.relation(spark, [(1, "a")], "id int, s string").count() == 1


INDEX = """Description: Master Index
Last Data Received: x

CIK|Company Name|Form Type|Date Filed|File Name
--------------------------------------------------
1000|ALPHA INC|4|20160422|edgar/data/1000/0001.txt
1000|ALPHA INC|4|20160422|edgar/data/1000/0002.txt
2000|BETA|13F-HR|20160422|edgar/data/2000/0003.txt
short|line
"""


def test_filing_index(spark, tmp_path, rows):
    put(tmp_path / "a" / "master.idx", INDEX)
    put(tmp_path / "b" / "master.idx", INDEX)
    df = filings.read_filing_index(spark, "a/*,b/*", "4", f"{tmp_path}/")
    assert df.columns == ["cik", "company", "form_type", "file_name"]
    assert df.count() == 4
    everything = filings.read_filing_index(spark, f"{tmp_path}/a/master.idx")
    assert everything.count() == 3
    assert rows(top_filers(everything, "4", 20)) == [("1000", 2)]


def test_documents_and_archives(spark, tmp_path, rows):
    put(tmp_path / "docs" / "one.txt", "line 1\nline 2")
    put(tmp_path / "docs" / "two.txt", "x")
    docs = filings.read_documents(spark, f"{tmp_path}/docs")
    assert rows(docs, "content") == [("line 1\nline 2",), ("x",)]
    buffer = io.BytesIO()
    with zipfile.ZipFile(buffer, "w") as archive:
        archive.writestr("a.txt", "alpha")
        archive.writestr("b.txt", "beta")
    (tmp_path / "zips").mkdir()
    (tmp_path / "zips" / "good.zip").write_bytes(buffer.getvalue())
    (tmp_path / "zips" / "bad.zip").write_bytes(b"not an archive")
    members = filings.explode_zip(filings.read_archives(spark, f"{tmp_path}/zips"))
    assert rows(members) == [("a.txt", "alpha"), ("b.txt", "beta")]


def test_market_sources(spark, tmp_path, rows):
    head = "Date,Open,High,Low,Close,Volume,Adj Close\n"
    put(tmp_path / "t" / "AAA.csv", head + "2016-03-09,1,1,1,12.5,0,1\n2016-03-08,1,1,1,10.0,0,1\n")
    put(tmp_path / "t" / "BBB.csv", head + "2016-03-09,1,1,1,3,0,1\n2016-03-08,1,1,1,4,0,1\n2016-03-07,1,1,1,4,0,1\n")
    change = price_change(market.read_ticker(spark, f"{tmp_path}/t"))
    assert [(a, str(b), c, str(d)) for a, b, c, d in rows(change)] == [
        ("AAA", "2016-03-09", 2.5, "2016-03-08"), ("BBB", "2016-03-08", 0.0, "2016-03-07"),
        ("BBB", "2016-03-09", -1.0, "2016-03-08"),
    ]
    quotes = '[{"date":"2018-06-01","open":1,"close":2.5,"volume":9,"changePercent":0.1,"vwap":3},{"date":"2018-06-04","close":3}]'
    df = spark.createDataFrame([("A", quotes), ("B", None)], "symbol string, json string")
    got = market.explode_quotes(df, "json").orderBy("date").collect()
    assert [(r.symbol, r.close, r.open) for r in got] == [("A", 2.5, 1.0), ("A", 3.0, None)]
    forecast = '{"Fiscal":{"0":"Dec18"},"Consensus":{"10":"c","2":"b","0":"a"}}'
    short = '{"Consensus":{"0":"x"}}'
    df = spark.createDataFrame([("A", forecast), ("B", short)], "symbol string, json string")
    series = market.explode_forecast(df, "json")
    assert rows(series.drop("position")) == [("A", "T0", "a"), ("A", "T1", "b"), ("A", "T2", "c"), ("B", "T0", "x")]
    assert rows(align_forecasts(series).select("symbol", "value")) == [("A", "a"), ("B", "x")]


def test_relations(spark, tmp_path, rows):
    path = put(tmp_path / "graph.txt", "1 2 3\n4\n2 1 \n")
    assert rows(relations.read_adjacency(spark, path)) == [(1, 2), (1, 3), (2, 1)]
    spaced = put(tmp_path / "u.data", "1\t10\t3\t881250949\n2 11  4.5\nbad line\n")
    assert rows(relations.read_ratings(spark, spaced)) == [(1, 10, 3.0), (2, 11, 4.5)]
    colons = put(tmp_path / "r.dat", "1::10::5::9\n")
    assert rows(relations.read_ratings(spark, colons, "::")) == [(1, 10, 5.0)]
    names = put(tmp_path / "u.item", "10|Toy Story (1995)|x\nname|less\n")
    assert rows(relations.read_item_names(spark, names)) == [(10, "Toy Story (1995)")]


def test_sinks(spark, tmp_path, rows):
    df = spark.createDataFrame([("a", 1), ("b", 3), ("c", 2)], "name string, n int")
    base = str(tmp_path)
    sinks.write_csv(df, f"{base}/csv")
    with pytest.raises(Exception, match="(?i)already exists"):
        sinks.write_csv(df, f"{base}/csv")
    for _ in range(2):
        sinks.write_ranked_csv(df, f"{base}/ranked", "n")
    files = sorted((tmp_path / "ranked").glob("part-*.csv"))
    lines = [line for f in files for line in f.read_text().splitlines() if line != "name,n"]
    assert lines == ["b,3", "c,2", "a,1"]
    sinks.write_parquet(df, f"{base}/parquet")
    assert tables.read_parquet(spark, f"{base}/parquet").count() == 3
    sinks.write_noop(df)
    sinks.store_table(df, f"{base}/store")
    sinks.store_table(df, f"{base}/store", append=True)
    assert sinks.load_table(spark, f"{base}/store").count() == 6
    with pytest.raises(Exception, match="(?i)already exists"):
        sinks.store_table(df, f"{base}/store")
    sinks.store_table(df, "stored_names")
    assert sinks.load_table(spark, "stored_names").count() == 3
    sinks.write_sorted_text(df.orderBy(F.desc("n")), ["name"], f"{base}/text")
    parts = sorted((tmp_path / "text").glob("part-*"))
    assert [line for p in parts for line in p.read_text().splitlines()] == ["a\t1", "b\t3", "c\t2"]
    docs = spark.createDataFrame([("dir/0001.txt", "body")], "name string, content string")
    sinks.write_documents(docs, f"{base}/docs")
    assert rows(spark.read.parquet(f"{base}/docs")) == [("dir/0001.txt", "body")]
