"""Scalar text functions; each takes and returns a Column and stays inside codegen."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Fixed value: the nine-part access-log pattern.
ACCESS_LOG_PATTERN = (
    r'(\d{1,3}\.\d{1,3}\.\d{1,3}\.\d{1,3})? (\S+) (\S+) (\[.+?\]) "(.*?)" (\d{3}) (\S+) "(.*?)" "(.*?)"'
)
ACCESS_LOG_FIELDS = ["ip", "client", "user", "time", "request", "status", "bytes", "referer", "agent"]

# Output for a request that is not made of three parts, and for an unknown code.
BAD_REQUEST = "[error]"


def split_fields(column: Column, sep: str, *positions: int) -> list[Column]:
    """The fields at ``positions`` after splitting on a literal separator; missing ones are null."""
    parts = F.split(column, r"\Q" + sep + r"\E", -1)
    return [F.get(parts, F.lit(p)) for p in positions]


def split_words(column: Column) -> Column:
    """The text cut at single spaces, empty pieces removed."""
    return F.filter(F.split(column, " "), lambda w: w != "")


def parse_access_log(df: DataFrame, column: str) -> DataFrame:
    """Add the nine fields of an access-log line; all are null where the line does not match."""
    whole = r"^(?:" + ACCESS_LOG_PATTERN + r")$"
    line = F.when(F.col(column).rlike(whole), F.col(column))
    return df.withColumns(
        {name: F.regexp_extract(line, whole, i + 1) for i, name in enumerate(ACCESS_LOG_FIELDS)}
    )


def request_url(request: Column) -> Column:
    """Middle part of a ``METHOD url PROTOCOL`` request, else a fixed error mark."""
    parts = F.split(request, " ")
    return F.when(F.size(parts) == 3, F.get(parts, F.lit(1))).otherwise(F.lit(BAD_REQUEST))


def as_of_date(column: Column) -> Column:
    """Calendar date of a timestamp."""
    return F.to_date(column)


def as_of_text(column: Column) -> Column:
    """Date written as month/day/year."""
    return F.date_format(column, "MM/dd/yyyy")


def price_or_zero(column: Column) -> Column:
    """Price text as a double; anything that is not a number is zero."""
    return F.coalesce(column.try_cast("double"), F.lit(0.0))


def upper(column: Column) -> Column:
    """Upper-case text."""
    return F.upper(column)


def characters(column: Column) -> Column:
    """The characters of a text as an array, for ``explode``; an empty text gives one empty piece."""
    return F.split(column, "")
