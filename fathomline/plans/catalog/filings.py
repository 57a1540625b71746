"""Filing documents built row by row from the order lines, then parsed and counted."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import functions as F

from fathomline.functions.filings import TRANSACTION_CODES, parse_holdings
from fathomline.operators.counts import pivot_codes
from fathomline.plans.catalog.registry import query, table
from fathomline.plans.reports import holdings_report, ownership_counts, ownership_report
from fathomline.session import fresh_path, spread
from fathomline.sources.filings import read_holding_ids
from fathomline.streaming.filings import ownership_rows


def _holdings(spark, folder):
    """A filing per order line: a first XML block to be skipped, then two holdings, one repeated."""
    entry = "<ns1:infoTable><ns1:cusip>%s</ns1:cusip></ns1:infoTable>"
    content = F.format_string(
        "<SEC-DOCUMENT>\n<XML>\n<?xml version=\"1.0\"?>\n<cover><cusip>NONE</cusip></cover>\n</XML>\n<XML>\n"
        "<?xml version=\"1.0\"?>\n<ns1:informationTable xmlns:ns1=\"urn:x\">" + entry * 3
        + "</ns1:informationTable>\n</XML>\n</SEC-DOCUMENT>",
        *[F.concat(F.lit(kind), F.col(c).cast("string")) for kind, c in (("p", "l_partkey"), ("s", "l_suppkey"), ("p", "l_partkey"))],
    )
    lines = table(spark, folder, "lineitem").select("l_partkey", "l_suppkey")
    return spread(lines).select(content.alias("content"))


@query("""
select token, count(*) as n from (
  select 'P' || l_partkey as token from lineitem union all select 'S' || l_suppkey from lineitem) group by token
""")
def holdings_counts(spark, folder):
    return holdings_report(_holdings(spark, folder))


@query("""
select 'P' || l_partkey || ',S' || l_suppkey as ids, count(*) as n from lineitem group by 1
""")
def holdings_lists(spark, folder):
    parsed = _holdings(spark, folder).select(parse_holdings(F.col("content")).alias("ids"))
    return parsed.groupBy("ids").agg(F.count(F.lit(1)).alias("n"))


@query("""
select 'P' || l_partkey as id from lineitem union select 'S' || l_suppkey from lineitem
""")
def large_filing_holdings(spark, folder):
    """One filing per partition of the order lines, each after a block to be skipped, read by splits and by tags."""
    path = fresh_path(spark, "filings")
    head = ["<SEC-DOCUMENT>", "<XML>", '<?xml version="1.0"?>', "<cover><cusip>NONE</cusip></cover>", "</XML>",
            "<XML>", '<?xml version="1.0"?>', '<ns1:informationTable xmlns:ns1="urn:x">']
    tail = ["</ns1:informationTable>", "</XML>", "</SEC-DOCUMENT>"]

    def framed(batches):
        yield pd.DataFrame({"value": head})
        yield from batches
        yield pd.DataFrame({"value": tail})

    entry = "<ns1:infoTable><ns1:cusip>p%s</ns1:cusip></ns1:infoTable><ns1:infoTable><ns1:cusip> s%s </ns1:cusip></ns1:infoTable>"
    lines = spread(table(spark, folder, "lineitem").select("l_partkey", "l_suppkey"))
    value = F.format_string(entry, F.col("l_partkey").cast("string"), F.col("l_suppkey").cast("string"))
    lines.select(value.alias("value")).mapInPandas(framed, "value string").write.text(path)
    return read_holding_ids(spark, path).select("id").distinct()


def ownership_content():
    """A filing per order line with one code in each of its two transaction tables."""
    coded = "<transactionCoding><transactionCode>%s</transactionCode></transactionCoding>"
    content = F.format_string(
        "<SEC-DOCUMENT>\n<XML>\n<?xml version=\"1.0\"?>\n<ownershipDocument><issuer><issuerCik>%s</issuerCik></issuer>"
        f"<nonDerivativeTable><nonDerivativeTransaction>{coded}</nonDerivativeTransaction></nonDerivativeTable>"
        f"<derivativeTable><derivativeTransaction>{coded}</derivativeTransaction></derivativeTable>"
        "</ownershipDocument>\n</XML>\n</SEC-DOCUMENT>",
        F.lpad(F.col("l_suppkey").cast("string"), 10, "0"), F.col("l_returnflag"), F.col("l_linestatus"),
    )
    # An empty document is a filing that could not be fetched.
    return F.when(F.col("l_tax") == 0, "").otherwise(content)


def _ownership(spark, folder):
    lines = table(spark, folder, "lineitem").select("l_suppkey", "l_tax", "l_returnflag", "l_linestatus")
    return spread(lines).select(ownership_content().alias("content"))


@query("""
select case when l_tax = 0 then 'Unknown' else lpad(l_suppkey::varchar, 10, '0') end as issuer_cik,
       case when l_tax = 0 then '-1' else l_returnflag || l_linestatus end as codes, count(*) as n
from lineitem group by 1, 2
""")
def ownership_filings(spark, folder):
    return ownership_counts(_ownership(spark, folder))


@query("""
select code, count(*) as n from (
  select l_returnflag as code from lineitem where l_tax <> 0 union all
  select l_linestatus from lineitem where l_tax <> 0) group by code
""")
def transaction_code_counts(spark, folder):
    return ownership_report(_ownership(spark, folder))


@query("""
select case when l_tax = 0 then 'Unknown' else lpad(l_suppkey::varchar, 10, '0') end as cik,
       count(*) filter (where l_tax <> 0 and l_returnflag = 'A') as award,
       count(*) filter (where l_tax <> 0 and l_linestatus = 'O') as out_of_money_exercise,
       count(*) filter (where l_tax <> 0 and l_linestatus = 'F') as exercise,
       {zeros}
from lineitem group by 1
""".format(zeros=", ".join(f"0::bigint as {n}" for c, n in TRANSACTION_CODES.items() if c not in "AOF")))
def transaction_code_pivot(spark, folder):
    """One row per issuer and one count per known code."""
    rows = ownership_rows(_ownership(spark, folder))
    coded = rows.select(F.col("issuer_cik").alias("cik"), F.explode(F.split("codes", "")).alias("code"))
    return pivot_codes(coded, "cik", "code")
