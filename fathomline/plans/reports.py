"""Ready-made plans for the filing and stock workloads."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fathomline.functions.filings import ownership_pairs, parse_holdings
from fathomline.operators.columns import drop_columns
from fathomline.operators.counts import count_codes, count_tokens, sum_by, top_k
from fathomline.operators.joins import enrich_security, join_using
from fathomline.streaming.filings import ownership_rows

# The columns a result file loses before it is joined, and those the second file
# loses besides.
RESULT_COLUMNS_DROPPED = [
    "Name", "LastSale", "MarketCap", "IPOYear", "Summary Quote", "month6ChangePercent", "month3ChangePercent",
    "month1ChangePercent", "day30ChangePercent", "day5ChangePercent",
]
SECOND_COLUMNS_DROPPED = ["industry", "sector"]


def holdings_report(documents: DataFrame, content: str = "content") -> DataFrame:
    """``(token, n)``: how many filings hold each security."""
    parsed = documents.select(parse_holdings(F.col(content)).alias("ids"))
    return count_tokens(parsed, "ids")


def ownership_counts(documents: DataFrame, content: str = "content") -> DataFrame:
    """``(issuer_cik, codes, n)``: filings by issuer and codes. Equal filings are parsed once where that saves half of them."""
    text = F.col(f"`{content}`")
    rows, different = documents.agg(F.count(F.lit(1)), F.approx_count_distinct(F.xxhash64(text))).first()
    if 2 * different <= rows:
        counted = documents.groupBy(text.alias("content")).agg(F.count(F.lit(1)).alias("n"))
    else:
        counted = documents.select(text.alias("content"), F.lit(1).cast("long").alias("n"))
    pairs = counted.select(F.inline(ownership_pairs(F.col("content"))), "n")
    return pairs.groupBy("issuer_cik", "codes").agg(F.sum("n").alias("n"))


def ownership_report(documents: DataFrame, content: str = "content") -> DataFrame:
    """``(code, n)``: how often each transaction code occurs."""
    return count_codes(ownership_rows(documents, content))


def top_holdings(counts: DataFrame, securities: DataFrame, k: int = 30) -> DataFrame:
    """The most held securities of ``(cusip, numfilings)`` rows, with name and ticker."""
    totals = sum_by(counts, "cusip", "numfilings")
    return enrich_security(top_k(totals, "total", k, ["cusip"]), securities)


def combined_results(
    first: DataFrame, second: DataFrame, key: str = "Symbol",
    dropped: Sequence[str] = tuple(RESULT_COLUMNS_DROPPED), second_dropped: Sequence[str] = tuple(SECOND_COLUMNS_DROPPED),
) -> DataFrame:
    """Two performance results side by side for the symbols both contain."""
    return join_using(drop_columns(first, dropped), drop_columns(second, [*dropped, *second_dropped]), key)


def emerging(
    results: DataFrame, recent: str, longer: str, key: str = "Symbol", k: int = 30, out: str = "diffs"
) -> DataFrame:
    """The ``k`` symbols whose recent return exceeds the longer one most."""
    gaps = results.withColumn(out, F.col(recent) - F.col(longer)).filter(F.col(out) > 0)
    return top_k(gaps, out, k, [key])
