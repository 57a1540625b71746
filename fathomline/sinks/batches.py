"""Appends that can be repeated: a batch is in the table once, however often it is written.

A table is a folder. A batch is written to a data folder of its own first, which no reader looks at; then one entry of
a few hundred bytes, named after the batch's id, makes it part of the table. The entry appears complete and only if
its name is free, so of two writers of the same batch one wins, and writers of different batches never wait for each other.
A run that dies before the entry leaves files that nobody reads; the repeated run writes its own.
"""

from __future__ import annotations

import hashlib
import json
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from fathomline.sinks.single import Folder

_ENTRIES = "_entries"
_DATA = "data"
_ENTRY = "batch string, folder string, schema string"


def _entry(target: str, batch: str) -> str:
    return f"{target}/{_ENTRIES}/{hashlib.sha256(batch.encode()).hexdigest()}.json"


def stage_batch(df: DataFrame, target: str) -> str:
    """Write a batch's rows where readers do not look; the name of their folder."""
    folder = f"{uuid.uuid4().hex}"
    df.write.parquet(f"{target.rstrip('/')}/{_DATA}/{folder}")
    return folder


def commit_batch(spark: SparkSession, target: str, batch: str | int, folder: str, schema: StructType) -> bool:
    """Make a staged folder part of the table, unless a batch of this id is there; says whether it did."""
    target, batch = target.rstrip("/"), str(batch)
    text = json.dumps({"batch": batch, "folder": folder, "schema": schema.json()})
    return Folder(spark, target).publish(text, _entry(target, batch))


def append_batch(df: DataFrame, target: str, batch: str | int) -> bool:
    """Append a frame under a batch id; a batch that the table has already is not written again.

    The id stands for the rows: a repeat with other rows is left out too. All batches of a table have the same columns,
    else the append is refused. ``True`` if the rows are new in the table. Fit for ``foreachBatch`` of a stream.
    """
    spark, target = df.sparkSession, target.rstrip("/")
    if has_batch(spark, target, batch):
        return False
    known = _any_schema(spark, target)
    if known is not None and [(f.name, f.dataType) for f in known] != [(f.name, f.dataType) for f in df.schema]:
        raise ValueError(f"{target} has the columns {known.simpleString()}, not {df.schema.simpleString()}")
    return commit_batch(spark, target, batch, stage_batch(df, target), df.schema)


def has_batch(spark: SparkSession, target: str, batch: str | int) -> bool:
    """Whether a batch of this id is in the table."""
    return Folder(spark, target).exists(_entry(target.rstrip("/"), str(batch)))


def batches(spark: SparkSession, target: str) -> DataFrame:
    """``(batch, folder, schema)`` of all batches in the table."""
    target = target.rstrip("/")
    if not Folder(spark, target).exists(f"{target}/{_ENTRIES}"):
        return spark.createDataFrame([], _ENTRY)
    return spark.read.schema(_ENTRY).option("pathGlobFilter", "*.json").json(f"{target}/{_ENTRIES}")


def _any_schema(spark: SparkSession, target: str) -> StructType | None:
    first = batches(spark, target).select("schema").first()
    return None if first is None else StructType.fromJson(json.loads(first[0]))


def load_batches(spark: SparkSession, target: str) -> DataFrame:
    """The table: the rows of all committed batches, in no order. The driver reads one folder name per batch."""
    target = target.rstrip("/")
    schema = _any_schema(spark, target)
    if schema is None:
        raise FileNotFoundError(f"{target} holds no batch")
    folders = [row[0] for row in batches(spark, target).select("folder").collect()]
    return spark.read.schema(schema).parquet(*[f"{target}/{_DATA}/{folder}" for folder in sorted(folders)])


def unpublished(spark: SparkSession, target: str) -> list[str]:
    """Data folders that belong to no batch: left by runs that died, or being written now."""
    target, place = target.rstrip("/"), Folder(spark, target)
    known = {row[0] for row in batches(spark, target).select(F.col("folder")).collect()}
    if not place.exists(f"{target}/{_DATA}"):
        return []
    names = [status.getPath().getName() for status in place.system.listStatus(place.path(f"{target}/{_DATA}"))]
    return sorted(f"{target}/{_DATA}/{name}" for name in names if name not in known)
