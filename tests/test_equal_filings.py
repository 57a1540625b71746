"""Equal ownership filings are parsed once and counted."""

from fathomline.plans.reports import ownership_counts

CODED = "<transactionCoding><transactionCode>%s</transactionCode></transactionCoding>"


def filing(cik, code):
    return (f"<XML>\n<ownershipDocument><issuer><issuerCik>{cik}</issuerCik></issuer><nonDerivativeTable>"
            f"<nonDerivativeTransaction>{CODED % code}</nonDerivativeTransaction></nonDerivativeTable></ownershipDocument>\n</XML>")


def documents(spark, texts):
    return spark.createDataFrame([(t,) for t in texts], "content string")


def test_equal_filings_are_parsed_once(spark, rows, monkeypatch):
    """Copies reach the parser as one row with their number; filings that differ are not grouped."""
    texts = [filing(7, "A")] * 5 + [filing(8, "S")] * 3 + [""] * 4 + [None] * 2 + ["<ownershipDocument><a></ownershipDocument>"] * 2
    grouped, group = [], type(spark.range(1)).groupBy
    monkeypatch.setattr(type(spark.range(1)), "groupBy", lambda self, *keys: grouped.extend([len(keys)] * bool(keys)) or group(self, *keys))
    assert sorted(rows(ownership_counts(documents(spark, texts)))) == [("7", "A", 5), ("8", "S", 3), ("Unknown", "-1", 4)]
    assert grouped == [1, 2]
    different = documents(spark, [filing(i, "A") for i in range(9)])
    assert sorted(rows(ownership_counts(different))) == [(str(i), "A", 1) for i in range(9)]
    assert grouped == [1, 2, 2]


def test_no_filings_give_no_rows(spark, rows):
    assert rows(ownership_counts(documents(spark, []))) == []


def test_streamed_copies_are_parsed_once_a_batch(spark, tmp_path):
    """The streamed query's sums over batches, on order lines of its own that hold copies and a null tax."""
    from fathomline.plans.catalog.streams import streamed_ownership_filings

    lines = [(1, 0.0, "A", "F")] * 3 + [(2, 0.1, "N", "O")] * 4 + [(3, None, "R", "F")]
    frame = spark.createDataFrame(lines, "l_suppkey long, l_tax double, l_returnflag string, l_linestatus string")
    frame.write.parquet(str(tmp_path / "lineitem.parquet"))
    found = streamed_ownership_filings(spark, str(tmp_path))
    assert sorted(map(tuple, found.collect())) == [("-1", 3), ("NO", 4), ("RF", 1)]
