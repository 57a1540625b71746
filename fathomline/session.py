"""Session defaults and the shared folder used for checkpoints and intermediate tables."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
}


def build_session(app: str = "fathomline", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the library's defaults; ``conf`` entries win over them."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**DEFAULTS, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """The folder every executor can reach, named by ``spark.checkpoint.dir``.

    Only a local master may fall back to a temporary folder: on a cluster such a folder would
    vanish with its machine, so an unset directory is an error there.
    """
    context = spark.sparkContext
    folder = context.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
    current = context.getCheckpointDir()
    if folder:
        if not current:
            context.setCheckpointDir(folder)
        return folder.rstrip("/")
    if current:
        return current.rstrip("/")
    if not context.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
    context.setCheckpointDir(tempfile.mkdtemp(prefix="fathomline-"))
    return context.getCheckpointDir().rstrip("/")


def application_folder(spark: SparkSession) -> str:
    """This application's part of the shared folder; it can be deleted when the application is done."""
    return f"{shared_folder(spark)}/fathomline/{spark.sparkContext.applicationId}"


def fresh_path(spark: SparkSession, label: str) -> str:
    """A new, unused path below the application's folder."""
    return f"{application_folder(spark)}/{label}-{uuid.uuid4().hex}"


def materialize(df: DataFrame, label: str) -> DataFrame:
    """Write a frame once below the shared folder and read it back.

    This cuts lineage as a checkpoint does, and the files keep column pruning and a known size,
    so a small result can be broadcast in the next join. Lost executors cost nothing.
    """
    path = fresh_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def materialize_by(df: DataFrame, key: str, label: str) -> DataFrame:
    """As ``materialize``, bucketed by a column: joins on it with frames that are stored alike move no rows.

    The catalog names such a table only while it is written; its files lie below the shared folder.
    """
    spark = df.sparkSession
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    name = f"{label.replace('-', '_')}_{uuid.uuid4().hex}"
    writer = df.repartition(buckets, key).write.format("parquet").option("path", fresh_path(spark, label))
    writer.bucketBy(buckets, key).sortBy(key).saveAsTable(name)
    stored = spark.table(name)
    stored.count()  # reads the file list and counts, before the name goes
    spark.sql(f"drop table {name}")
    return stored


def spread(df: DataFrame) -> DataFrame:
    """Give work that is heavy per row at least one partition per core.

    Meant for scans, whose partitions are known without running anything. Only an input with fewer
    partitions than cores is shuffled, so large inputs stay as they are.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df
