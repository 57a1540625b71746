"""Streaming sinks with checkpoints in the shared folder."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from fathomline.session import fresh_path


def start_sink(
    df: DataFrame,
    kind: str,
    target: str | None = None,
    mode: str = "append",
    checkpoint: str | None = None,
    available_now: bool = True,
) -> StreamingQuery:
    """Start a query into ``console``, ``memory`` (small results only), ``parquet`` or ``noop``."""
    writer = df.writeStream.outputMode(mode).format(kind)
    writer = writer.option("checkpointLocation", checkpoint or fresh_path(df.sparkSession, "stream"))
    if kind == "memory":
        writer = writer.queryName(target)
    if available_now:
        writer = writer.trigger(availableNow=True)
    return writer.start(target) if kind == "parquet" else writer.start()


def write_batches(
    df: DataFrame,
    path: str,
    mode: str = "append",
    transform: Callable[[DataFrame], DataFrame] | None = None,
    checkpoint: str | None = None,
    available_now: bool = True,
) -> StreamingQuery:
    """Write every micro-batch, after an optional transform, to ``path/batch_id=<id>``.

    A batch that is run again after a failure replaces its own folder, so nothing is doubled.
    """

    def store(batch: DataFrame, batch_id: int) -> None:
        rows = transform(batch) if transform else batch
        rows.write.mode("overwrite").parquet(f"{path}/batch_id={batch_id}")

    writer = df.writeStream.outputMode(mode).foreachBatch(store)
    writer = writer.option("checkpointLocation", checkpoint or fresh_path(df.sparkSession, "stream"))
    if available_now:
        writer = writer.trigger(availableNow=True)
    return writer.start()


def read_batches(spark: SparkSession, path: str) -> DataFrame:
    """What ``write_batches`` has stored, with ``batch_id``."""
    return spark.read.parquet(path)


def latest_values(batches: DataFrame, keys: list[str], value: str) -> DataFrame:
    """The newest value of each key over all batches of an update-mode query."""
    newest = F.max_by(value, "batch_id")
    return batches.groupBy(*keys).agg(newest.alias(value))
