"""Ownership filings parsed as they arrive."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fathomline.functions.filings import ownership_pairs
from fathomline.streaming.sources import stream_documents


def ownership_rows(documents: DataFrame, content: str = "content") -> DataFrame:
    """``(issuer_cik, codes)`` of whole documents; those that do not parse are left out."""
    return documents.select(F.inline(ownership_pairs(F.col(content))))


def stream_ownership(spark: SparkSession, folder: str, max_files: int | None = None) -> DataFrame:
    """Parsed filings dropped into a folder, one file per filing."""
    return ownership_rows(stream_documents(spark, folder, max_files))
