"""Scans of filing indexes and filing documents."""

from __future__ import annotations

import io
import zipfile
import zlib
from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fathomline.session import materialize
from fathomline.sources.tables import expand_paths

# The fields of an index line and the text that marks its header line.
INDEX_FIELDS = ["cik", "company", "form_type", "date_filed", "file_name"]
INDEX_HEADER = "CIK"


def parse_filing_index(lines: DataFrame, form_type: str | None = None, column: str = "value") -> DataFrame:
    """``(cik, company, form_type, file_name)`` of index lines.

    Preamble and ruler lines have fewer than five fields; header rows are recognised by their
    first field, so any number of concatenated indexes can be read.
    """
    parts = F.split(F.col(column), r"\|", -1)
    rows = lines.filter(F.size(parts) >= len(INDEX_FIELDS)).select(
        *[F.get(parts, F.lit(i)).alias(name) for i, name in enumerate(INDEX_FIELDS)]
    )
    rows = rows.filter(F.col("cik") != INDEX_HEADER).drop("date_filed")
    return rows if form_type is None else rows.filter(F.col("form_type") == form_type)


def read_filing_index(spark: SparkSession, path: str, form_type: str | None = None, prefix: str = "") -> DataFrame:
    """Index scan filtered on form type."""
    return parse_filing_index(spark.read.text(expand_paths(path, prefix)), form_type)


def read_documents(spark: SparkSession, path: str | Sequence[str]) -> DataFrame:
    """``(path, content)``, one row per file; unreadable files are skipped, not fatal."""
    reader = spark.read.option("ignoreCorruptFiles", True).option("ignoreMissingFiles", True)
    return reader.text(path, wholetext=True).select(
        F.col("_metadata.file_path").alias("path"), F.col("value").alias("content")
    )


def read_archives(spark: SparkSession, path: str) -> DataFrame:
    """Binary scan ``(path, content)`` for ``explode_zip``."""
    reader = spark.read.format("binaryFile").option("ignoreCorruptFiles", True).option("ignoreMissingFiles", True)
    return reader.load(path).select("path", "content")


def _members(blob: bytes | None, encoding: str) -> Iterator[tuple[str, str]]:
    """``(name, text)`` of each member, read one at a time; a member that cannot be read is left out."""
    try:
        archive = zipfile.ZipFile(io.BytesIO(blob))
    except (zipfile.BadZipFile, TypeError):
        return
    with archive:
        for name in archive.namelist():
            try:
                text = archive.read(name).decode(encoding, "replace")
            except (zipfile.BadZipFile, zlib.error, RuntimeError, NotImplementedError, EOFError, OSError):
                continue  # damaged, encrypted or of an unknown method
            yield name, text


def explode_zip(
    archives: DataFrame, content: str = "content", encoding: str = "utf-8", batch_chars: int = 8_000_000
) -> DataFrame:
    """One row ``(name, text)`` per archive member; a broken archive or member gives no rows.

    Archives are opened one at a time and members handed back in batches of about ``batch_chars``, so neither a large
    archive nor a batch of archives is ever held unpacked as a whole.
    """

    def unpack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names, texts, size = [], [], 0

        def held() -> pa.RecordBatch:
            return pa.record_batch([pa.array(names, pa.string()), pa.array(texts, pa.string())], ["name", "text"])

        for batch in batches:
            for blob in batch.column(0):
                for name, text in _members(blob.as_py(), encoding):
                    names.append(name)
                    texts.append(text)
                    size += len(text)
                    if size >= batch_chars:
                        yield held()
                        names, texts, size = [], [], 0
        if names:
            yield held()

    return archives.select(content).mapInArrow(unpack, "name string, text string")


def read_holding_ids(spark: SparkSession, path: str | Sequence[str]) -> DataFrame:
    """``(path, id)``: the distinct upper-cased security ids of the last XML block of every filing below a path.

    For filings of any size: a file is read by splits, one row per tag, of which only block marks and ids stay. The
    ids are those that ``parse_holdings`` joins, but the block is not parsed, so a document that is not sound gives its
    ids too, and an id that a tag other than a closing one ends counts. A filing without a closed XML block gives no rows.
    """
    tag = F.col("value")
    kind = F.when(tag.startswith("?xml"), "open").when(tag.startswith("/XML"), "close").when(
        F.regexp_like(tag, F.lit(r"^(?:[\w.-]+:)?cusip(?:\s[^>]*)?>")), "id")
    place = F.struct(F.col("_metadata.file_block_start").alias("split"), F.monotonically_increasing_id().alias("row"))
    tags = spark.read.option("lineSep", "<").text(path).select(
        F.col("_metadata.file_path").alias("path"), place.alias("place"), kind.alias("kind"),
        F.when(kind == "id", F.upper(F.trim(F.substring_index(tag, ">", -1)))).alias("id"),
    )
    marks = materialize(tags.filter("kind is not null"), "holding-marks")
    last = marks.filter("kind <> 'id'").groupBy("path").agg(
        F.max(F.when(F.col("kind") == "open", F.col("place"))).alias("opened"),
        F.max(F.when(F.col("kind") == "close", F.col("place"))).alias("closed"),
    )
    inside = marks.filter("kind = 'id' and id <> ''").join(last, "path").filter("place > opened and place < closed")
    return inside.select("path", "id").distinct()
