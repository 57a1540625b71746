"""Paths, identifiers and XML payloads of regulatory filings."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Archive address and report file name.
ARCHIVE_BASE = "https://www.sec.gov/Archives"
REPORT_FILE = "/Financial_Report.xlsx"

# The result for an empty ownership document.
UNKNOWN_ISSUER = "Unknown"
UNKNOWN_CODES = "-1"

# Transaction codes and the column each one is counted in.
TRANSACTION_CODES = {
    "P": "purchase",
    "S": "sale",
    "V": "voluntary_transaction",
    "A": "award",
    "D": "disposition",
    "F": "exercise",
    "I": "discretionary_transaction",
    "M": "exercise_of_derivative",
    "C": "conversion",
    "E": "expiration_short",
    "H": "expiration_long",
    "O": "out_of_money_exercise",
    "X": "in_the_money_exercise",
    "G": "bona_fide_gift",
    "L": "small_acquisition",
    "W": "acquisition_or_disposition_by_will",
    "Z": "deposit_or_withdrawal",
    "J": "other_acquisition_or_disposition",
    "K": "transaction_in_equity_swap",
    "U": "disposition_on_change_of_control",
}


def filing_folder_path(path: Column) -> Column:
    """``a/b/0001-16-2.txt`` becomes ``a/b/0001162/0001-16-2.txt``."""
    name = F.substring_index(path, "/", -1)
    folder = F.replace(F.regexp_replace(name, r"\.txt$", ""), F.lit("-"), F.lit(""))
    parent = F.regexp_replace(path, r"[^/]*$", "")
    return F.concat(parent, folder, F.lit("/"), name)


def financial_report_path(path: Column) -> Column:
    """Every ``-`` and ``.txt`` removed from the whole path, then the report file name."""
    bare = F.replace(F.replace(path, F.lit("-"), F.lit("")), F.lit(".txt"), F.lit(""))
    return F.concat(bare, F.lit(REPORT_FILE))


def archive_url(path: Column, base: str = ARCHIVE_BASE) -> Column:
    """Absolute addresses stay; others are put below ``base``."""
    return F.when(path.startswith("http"), path).otherwise(F.concat(F.lit(base + "/"), path))


def pad_security_id(column: Column, width: int = 8) -> Column:
    """Left-pad with zeros up to ``width``, never truncating."""
    return F.when(F.length(column) < width, F.lpad(column, width, "0")).otherwise(column)


def _last_block(column: Column) -> Column:
    """Text after the last XML declaration up to the last ``</XML`` behind it; empty if either is absent."""
    head = F.concat(F.lit("<?xml"), F.substring_index(column, "<?xml", -1))
    # One search: an optional declaration, blanks, then all up to the last mark.
    body = F.regexp_extract(head, r"(?s)^(?:<\?xml[^>]*\?>)? *(.*)</XML", 1)
    return F.when(F.instr(column, "<?xml") > 0, body).otherwise(F.lit(""))


def _parsed_once(xml: Column, schema: str, use) -> Column:
    """``use(document)`` for XML that parses, else an empty array, as an array of at most one element.

    The document is the element of an array that is then transformed, so it is parsed once however
    often its fields are read.
    """
    options = {"ignoreNamespace": "true", "columnNameOfCorruptRecord": "_corrupt_record"}
    parsed = F.array(F.from_xml(xml, ", ".join(filter(None, [schema, "_corrupt_record string"])), options))
    good = F.filter(parsed, lambda d: d.isNotNull() & d["_corrupt_record"].isNull())
    return F.transform(good, use)


def parse_holdings(content: Column) -> Column:
    """Distinct upper-cased security ids of a holdings filing, comma-joined.

    No XML gives an empty string; XML that cannot be parsed gives null. Ids are found at any depth and under any
    namespace prefix; parsing only tells whether the document is sound.
    """
    def listed(xml: Column) -> Column:
        found = F.regexp_extract_all(xml, F.lit(r"<(?:[\w.-]+:)?cusip(?:\s[^>]*)?>([^<]*)</"), F.lit(1))
        ids = F.filter(F.transform(found, lambda v: F.trim(v)), lambda v: v != "")
        joined = F.array_join(F.array_distinct(F.transform(ids, F.upper)), ",")
        # No field is asked for, so the parser only passes over the document.
        return F.get(_parsed_once(xml, "", lambda _: joined), F.lit(0))

    # The block is an array's element, so it is cut out once for the parser and the ids.
    found = F.get(F.transform(F.array(_last_block(content)), listed), F.lit(0))
    return F.when(F.instr(content, "<?xml") == 0, F.lit("")).otherwise(found)


_TRANSACTION = "array<struct<transactionCoding: struct<transactionCode: string>>>"
_OWNERSHIP = (
    "issuer struct<issuerCik: string>, "
    f"nonDerivativeTable struct<nonDerivativeTransaction: {_TRANSACTION}>, "
    f"derivativeTable struct<derivativeTransaction: {_TRANSACTION}>"
)


def ownership_pairs(content: Column) -> Column:
    """Array with the ``(issuer_cik, codes)`` struct of an ownership filing, for ``explode``.

    ``codes`` joins all transaction codes in document order. An empty filing gives the fixed
    unknown pair; a filing without a parsable ownership document gives an empty array.
    """
    xml = F.regexp_extract(content, r"(?s)(<ownershipDocument>.*?</ownershipDocument>)", 1)

    def codes(rows: Column) -> Column:
        texts = F.transform(rows, lambda t: t["transactionCoding"]["transactionCode"])
        return F.coalesce(F.array_join(texts, ""), F.lit(""))

    def pair(doc: Column) -> Column:
        return F.struct(
            F.coalesce(doc["issuer"]["issuerCik"], F.lit("")).alias("issuer_cik"),
            F.concat(
                codes(doc["nonDerivativeTable"]["nonDerivativeTransaction"]),
                codes(doc["derivativeTable"]["derivativeTransaction"]),
            ).alias("codes"),
        )

    unknown = F.struct(F.lit(UNKNOWN_ISSUER).alias("issuer_cik"), F.lit(UNKNOWN_CODES).alias("codes"))
    parsed = _parsed_once(xml, _OWNERSHIP, pair)
    return F.when(content == "", F.array(unknown)).otherwise(parsed)


def parse_ownership(content: Column) -> Column:
    """The ``(issuer_cik, codes)`` struct of an ownership filing; null if it does not parse."""
    return F.get(ownership_pairs(content), F.lit(0))
