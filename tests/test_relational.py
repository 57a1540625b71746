import pytest
from pyspark.sql import functions as F

from fathomline.functions import encoding, filings, text
from fathomline.operators import columns, counts, filters, joins
from fathomline.plans.flow import Flow, compose, run_steps, sql_over
from fathomline.sinks import tables as sinks


def one(spark, column, **given):
    row = spark.range(1).select(*[F.lit(v).alias(k) for k, v in given.items()]).select(column.alias("out")).first()
    return row.out


def test_token_count_golden(spark, rows):
    df = spark.createDataFrame([("abc,def,abc",), ("def,def,ghi",), ("",), (None,)], "ids string")
    assert rows(counts.count_tokens(df, "ids")) == [("abc", 2), ("def", 3), ("ghi", 1)]


def test_drop_and_rename_golden(spark):
    df = spark.createDataFrame([("PLAYER1", "TEAM1")], "PLAYER string, TEAM string")
    kept = columns.drop_columns(df, ["TEAM", "absent"])
    assert kept.columns == ["PLAYER"] and kept.collect() == [("PLAYER1",)]
    assert columns.rename_all(df, ["a", "b"]).columns == ["a", "b"]
    assert columns.rename(df, {"TEAM": "t"}).columns == ["PLAYER", "t"]


def test_casts_turn_dirt_into_null(spark):
    df = spark.createDataFrame([("1",), ("?",), ("",)], "`BI-RADS` string")
    assert [r[0] for r in columns.cast_columns(df, {"BI-RADS": "int"}).collect()] == [1, None, None]


def test_path_functions_golden(spark):
    path = F.col("p")
    given = {"p": "edgar/data/1718982/0001606587-18-000045.txt"}
    assert one(spark, filings.filing_folder_path(path), **given) == (
        "edgar/data/1718982/000160658718000045/0001606587-18-000045.txt"
    )
    assert one(spark, filings.filing_folder_path(path), p="a/b/0001-16-2.txt") == "a/b/0001162/0001-16-2.txt"
    assert one(spark, filings.financial_report_path(path), **given) == (
        "edgar/data/1718982/000160658718000045/Financial_Report.xlsx"
    )
    assert one(spark, filings.archive_url(path, "ftp://base"), p="x/y") == "ftp://base/x/y"
    assert one(spark, filings.archive_url(path), p="http://z") == "http://z"
    assert one(spark, filings.pad_security_id(path), p="12") == "00000012"
    assert one(spark, filings.pad_security_id(path), p="123456789") == "123456789"


HOLDINGS = (
    "header <?xml version='1.0'?><cover><cusip>no</cusip></cover></XML>\n<XML>\n<?xml version=\"1.0\"?>\n"
    "<ns1:informationTable xmlns:ns1='u'><ns1:infoTable><ns1:cusip>ab1</ns1:cusip></ns1:infoTable>"
    "<ns1:infoTable><ns1:cusip>C2</ns1:cusip></ns1:infoTable><ns1:infoTable><ns1:cusip>AB1</ns1:cusip></ns1:infoTable>"
    "</ns1:informationTable>\n</XML>\n"
)


@pytest.mark.parametrize("content, expected", [
    (HOLDINGS, "AB1,C2"),
    ("no markup", ""),
    ("", ""),
    ("<?xml version='1.0'?><a><infoTable></XML>", None),
    ("<?xml version='1.0'?><a><other>1</other></a></XML>", ""),
    ("<?xml version='1.0'?><a>never closed", None),
])
def test_holdings(spark, content, expected):
    df = spark.createDataFrame([(content,)], "content string")
    assert df.select(filings.parse_holdings(F.col("content"))).first()[0] == expected


def ownership(cik, *codes, derivative=()):
    def table(name, row, values):
        body = "".join(
            f"<{row}><transactionCoding><transactionCode>{c}</transactionCode></transactionCoding></{row}>" for c in values
        )
        return f"<{name}>{body}</{name}>" if values else ""

    return (
        f"<SEC>\n<XML>\n<?xml version='1.0'?>\n<ownershipDocument><issuer><issuerCik>{cik}</issuerCik></issuer>"
        + table("nonDerivativeTable", "nonDerivativeTransaction", codes)
        + table("derivativeTable", "derivativeTransaction", derivative)
        + "</ownershipDocument>\n</XML>"
    )


@pytest.mark.parametrize("content, expected", [
    (ownership("0000104894", "A"), ("0000104894", "A")),
    (ownership("0000073124", "F", "F"), ("0000073124", "FF")),
    (ownership("0001059386"), ("0001059386", "")),
    (ownership("7", "S", derivative=("M", "C")), ("7", "SMC")),
    ("", ("Unknown", "-1")),
    ("<ownershipDocument><issuer></ownershipDocument></XML>", None),
    ("plain text", None),
])
def test_ownership(spark, content, expected):
    df = spark.createDataFrame([(content,)], "content string")
    got = df.select(filings.parse_ownership(F.col("content"))).first()[0]
    assert (tuple(got) if got else None) == expected


def test_code_counts_skip_unknown(spark, rows):
    df = spark.createDataFrame([("1", "AF"), ("2", "A"), ("Unknown", "-1"), ("3", "")], "issuer_cik string, codes string")
    assert rows(counts.count_codes(df)) == [("A", 2), ("F", 1)]
    pivot = counts.pivot_codes(df.select("issuer_cik", F.explode(F.split("codes", "")).alias("c")), "issuer_cik", "c")
    assert len(pivot.columns) == 21
    first = {r.issuer_cik: r for r in pivot.collect()}
    assert (first["1"].award, first["1"].exercise, first["1"].sale) == (1, 1, 0)


def test_access_log(spark):
    good = '10.0.0.1 - bob [29/Nov/2015:03:50:05 +0000] "GET /a HTTP/1.1" 200 123 "ref" "Agent \\"x"'
    df = spark.createDataFrame([(good,), ("garbage",), (' - - [t] "x" 404 - "" ""',)], "line string")
    parsed = text.parse_access_log(df, "line").collect()
    assert (parsed[0].ip, parsed[0].user, parsed[0].status, parsed[0].bytes) == ("10.0.0.1", "bob", "200", "123")
    assert all(parsed[1][f] is None for f in text.ACCESS_LOG_FIELDS)
    assert parsed[2].status == "404"
    urls = spark.createDataFrame([("GET /a HTTP/1.1",), ("GET /a",), ("a b c d",)], "r string")
    assert [r[0] for r in urls.select(text.request_url(F.col("r"))).collect()] == ["/a", "[error]", "[error]"]


def test_scalars(spark):
    c = F.col("x")
    assert [one(spark, text.price_or_zero(c), x=v) for v in ("N/A", "1.5", "")] == [0.0, 1.5, 0.0]
    assert one(spark, text.as_of_text(F.to_date(c)), x="2016-03-08") == "03/08/2016"
    assert str(one(spark, text.as_of_date(F.to_timestamp(c)), x="2016-03-08 10:00:00")) == "2016-03-08"
    assert one(spark, text.split_words(c), x=" a  b ") == ["a", "b"]
    assert one(spark, F.array(*text.split_fields(c, "|", 0, 2, 5)), x="p|q|") == ["p", "", None]
    assert [one(spark, encoding.encode_binary(c), x=v) for v in ("male", "female")] == [1, 0]
    assert [one(spark, encoding.encode_ordinal(c), x=v) for v in ("C", "Q", "S")] == [0, 1, 2]
    assert [one(spark, encoding.bucket_two(c), x=v) for v in (40, 41)] == [1, 2]
    assert [one(spark, encoding.bucket_three(c), x=v) for v in (30, 31, 59, 60)] == [1, 2, 2, 3]
    assert one(spark, encoding.ratio(c, F.lit(0.0)), x=1.0) is None
    assert one(spark, encoding.relative_change(c, F.lit(2.0)), x=3.0) == 0.5
    assert one(spark, encoding.last_positive([c, F.lit(1), F.lit(0)]), x=1) == 2
    assert one(spark, encoding.last_positive([c]), x=0) == 0


def test_un_one_hot_and_sorted_codes(spark, rows):
    df = spark.createDataFrame([(0.0, 1.0, 0.0), (0.0, 0.0, 0.0), (1.0, 0.0, 0.0)], "a double, b double, c double")
    assert [r.k for r in encoding.un_one_hot(df, ["a", "b", "c"], "k").collect()] == [1, -1, 0]
    names = spark.createDataFrame([("S",), ("C",), ("Q",), ("C",), (None,)], "port string")
    assert rows(encoding.encode_sorted(names, "port", "code")) == [("C", 0), ("C", 0), ("Q", 1), ("S", 2), (None, None)]


def test_filters(spark, rows):
    df = spark.createDataFrame([(1.0, "ax"), (1.5, "b"), (None, None)], "v double, s string")
    assert filters.filter_above(df, "v").count() == 1
    assert filters.filter_above(df).count() == 3
    assert filters.filter_equal(df, "s", "b").count() == 1
    assert filters.filter_lines(df, F.col("s").startswith("a")).count() == 1
    assert filters.count_containing(df, "s", "x").first().n == 1
    assert rows(filters.null_counts(df)) == [("s", 1), ("v", 1)]
    big = spark.range(2000)
    assert rows(filters.sample_fraction(big, 0.3, 1)) == rows(filters.sample_fraction(big, 0.3, 1))
    parts = filters.random_split(big, [0.7, 0.3], 5)
    assert sum(p.count() for p in parts) == 2000 and parts[0].intersect(parts[1]).count() == 0


def test_joins(spark, rows):
    a = spark.createDataFrame([(1, "x"), (2, "y")], "k int, v string")
    b = spark.createDataFrame([(1, 10)], "k int, w int")
    assert joins.join_using(a, b, "k").columns == ["k", "v", "w"]
    dim = spark.createDataFrame([(1, "one")], "k int, name string")
    assert rows(joins.lookup_with_default(a, dim, "k", "name"), "k", "name") == [(1, "one"), (2, "no_mapping_found")]
    held = spark.createDataFrame([("12", 3), ("999999999", 1)], "cusip string, n int")
    known = spark.createDataFrame([("00000012", "Twelve", "TWL")], "cusip string, name string, ticker string")
    assert rows(joins.enrich_security(held, known)) == [("12", 3, "Twelve", "TWL"), ("999999999", 1, "", "")]
    assert joins.enrich_company(a.withColumnRenamed("k", "symbol"), b.withColumnRenamed("k", "symbol")).count() == 1
    days = [spark.createDataFrame([(1, i), (i + 1, i)], f"date int, c{i} int") for i in range(3)]
    assert joins.join_on_date(days).select("date").distinct().collect() == [(1,)]
    early = spark.createDataFrame([("a", 1), ("a", 1), ("b", 1)], "c string, n int")
    late = spark.createDataFrame([("a", 1), ("z", 1)], "c string, n int")
    assert rows(joins.compare_periods(early, late, "c", F.sum("n"))) == [("a", 2, 1, -1)]


def test_aggregates(spark, rows):
    df = spark.createDataFrame([("a", 1), ("a", 2), ("b", 5), ("b", None)], "k string, v int")
    assert counts.sum_by(df, "k", "v").collect() == [("b", 5), ("a", 3)]
    assert counts.mean_of(df, "v").first()[0] == pytest.approx(8 / 3)
    assert rows(counts.mean_by(df, "k", "v")) == [("a", 1.5), ("b", 5.0)]
    assert counts.count_rows(df).first().n == 4
    assert rows(counts.distinct_values(df, "k")) == [("a",), ("b",)]
    assert counts.top_k(counts.count_by(df, "k"), "n", 1, ["k"]).collect() == [("a", 2)]
    assert counts.append_rows(df, df.limit(1)).count() == 5
    assert rows(counts.explode_chars(spark.createDataFrame([("FF",), ("",)], "c string"), "c")) == [("F",), ("F",)]


def test_mode_ignores_nulls_and_breaks_ties(spark, rows):
    df = spark.createDataFrame(
        [(2, "b", None), (1, "a", None), (None, None, 9), (None, "b", 9), (None, "a", 10)], "n int, s string, m int"
    )
    assert rows(counts.most_common(df, ["n", "s", "m"])) == [("m", "9", 2), ("n", "1", 1), ("s", "a", 2)]


def test_chance_agreement_joins_on_label(spark):
    train = spark.createDataFrame([("x",), ("x",), ("y",), ("z",)], "label string")
    test = spark.createDataFrame([("x",), ("z",)], "label string")
    assert counts.chance_agreement(train, test, "label").first()[0] == pytest.approx(0.5 * 0.5 + 0.25 * 0.5)
    assert [r.probability for r in counts.class_probabilities(train, "label").collect()] == [0.5, 0.25, 0.25]


def test_align_forecasts(spark, rows):
    df = spark.createDataFrame([("a", 0), ("a", 1), ("a", 2), ("b", 0), ("b", 1)], "symbol string, position int")
    assert rows(counts.align_forecasts(df)) == [("a", 0), ("a", 1), ("b", 0), ("b", 1)]


def test_flow_composition(spark, tmp_path):
    flow = Flow(
        lambda s, n: s.range(n), lambda df: df.filter("id > 2"), lambda df: sinks.write_parquet(df, str(tmp_path / "out"))
    )
    flow.run(spark, 10)
    assert spark.read.parquet(str(tmp_path / "out")).count() == 7
    double = compose(lambda df: df.selectExpr("id * 2 as id"), lambda df: df.filter("id > 4"))
    assert [r.id for r in double(spark.range(5)).collect()] == [6, 8]
    assert run_steps(spark.range(5), []).count() == 5
    assert sql_over(spark.range(5), "numbers", "select sum(id) as s from numbers").first().s == 10


def test_series_by_date_keeps_dates_that_all_series_have(spark, rows):
    data = [("d1", "a", 1.0), ("d1", "a", 2.0), ("d1", "b", None), ("d2", "a", 1.0), ("d3", "b", 4.0), ("d3", "a", 5.0), ("d3", "c", 9.0)]
    df = spark.createDataFrame(data, "date string, s string, v double")
    out = joins.series_by_date(df, "s", F.col("v"), {"a": "first", "b": "second"})
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1 and plan.count("Scan") == 1
    assert rows(out) == [("d1", 3.0, None), ("d3", 5.0, 4.0)]


def test_sample_by_keys_does_not_depend_on_partitions(spark, rows):
    df = spark.range(20_000).select("id", (F.col("id") % 500).alias("key"))
    a = filters.sample_by_keys(df, ["key"], 0.2, 7)
    assert rows(a) == rows(filters.sample_by_keys(df.repartition(13), ["key"], 0.2, 7))
    assert all(n == 40 for (n,) in a.groupBy("key").count().select("count").collect())  # equal keys stay together
    assert 60 < a.select("key").distinct().count() < 140
    assert filters.sample_by_keys(df, ["id"], 0.0, 7).isEmpty() and filters.sample_by_keys(df, ["id"], 1.0, 7).count() == 20_000
    nulls = spark.createDataFrame([(None, 1), (None, 2)], "key long, n long")
    assert filters.sample_by_keys(nulls, ["key"], 0.5, 7).count() in (0, 2)


def test_holdings_block_is_cut_out_once(spark):
    block = "<ns1:a xmlns:ns1='u'><ns1:cusip>b1</ns1:cusip><ns1:cusip>a2</ns1:cusip></ns1:a>\n"
    documents = {
        f"<?xml ?><cusip>no</cusip></XML><?xml version='1.0'?>  {block}</XML>": "B1,A2",
        f"<?xml ?>{block}</XML>{block}</XML": "B1,A2",
        f"<?xml ?>{block}</XML><?xml ?>{block}": None,
        f"<?xml ?><b>{block}</XML>": None,
        block: "",
    }
    df = spark.createDataFrame([(d,) for d in documents], "content string")
    parsed = df.select("content", filings.parse_holdings(F.col("content")).alias("ids"))
    assert parsed._jdf.queryExecution().optimizedPlan().toString().count("substring_index(") == 1
    assert {r.content: r.ids for r in parsed.collect()} == documents
