"""Scans of delimited, text, JSON, Parquet and in-memory tables."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from fathomline.operators.columns import cast_columns

# The seven string fields of a date-parts record.
DATE_PARTS_SCHEMA = T.StructType(
    [T.StructField(name, T.StringType()) for name in
     ("hour", "month", "second", "year", "timezone", "day", "minute")]
)

# The six columns of the medical masses table, in file order.
MEDICAL_COLUMNS = ["BI-RADS", "Age", "Shape", "Margin", "Density", "Severity"]


def cover_type_columns() -> list[str]:
    """The 55 columns of the forest cover table, in file order."""
    # The ten numeric columns that come first.
    numeric = [
        "Elevation", "Aspect", "Slope",
        "Horizontal_Distance_To_Hydrology", "Vertical_Distance_To_Hydrology",
        "Horizontal_Distance_To_Roadways",
        "Hillshade_9am", "Hillshade_Noon", "Hillshade_3pm",
        "Horizontal_Distance_To_Fire_Points",
    ]
    wilderness = [f"Wilderness_Area_{i}" for i in range(4)]
    soil = [f"Soil_Type_{i}" for i in range(40)]
    return [*numeric, *wilderness, *soil, "Cover_Type"]


def read_csv(
    spark: SparkSession,
    path: str | Sequence[str],
    header: bool = True,
    infer_schema: bool = False,
    schema: T.StructType | str | None = None,
    sample: float | None = None,
    seed: int = 0,
    names: Sequence[str] | None = None,
    sep: str = ",",
    **options: str,
) -> DataFrame:
    """Delimited scan with an optional declared schema, full rename and sample.

    Inference costs an extra pass over the files; declare ``schema`` for large inputs.
    """
    reader = spark.read.options(header=header, sep=sep, inferSchema=infer_schema and schema is None, **options)
    if schema is not None:
        reader = reader.schema(schema)
    df = reader.csv(path)
    if names is not None:
        df = df.toDF(*names)
    return df if sample is None else df.sample(False, sample, seed)


def read_positional(
    spark: SparkSession,
    path: str | Sequence[str],
    names: Sequence[str],
    casts: Mapping[str, str] | str = "int",
    sep: str = ",",
    **options: str,
) -> DataFrame:
    """Headerless scan: columns named by position, then cast; a dirty token becomes null."""
    schema = T.StructType([T.StructField(name, T.StringType()) for name in names])
    df = spark.read.options(header=False, sep=sep, **options).schema(schema).csv(path)
    wanted = {name: casts for name in names} if isinstance(casts, str) else casts
    return cast_columns(df, wanted)


def expand_paths(pattern: str, prefix: str = "") -> list[str]:
    """Paths of a comma-separated list, each below ``prefix``; globs stay for Spark to expand."""
    return [prefix + part.strip() for part in pattern.split(",") if part.strip()]


def read_lines(spark: SparkSession, pattern: str, prefix: str = "") -> DataFrame:
    """One row per text line in ``value``, over globs and comma-separated lists."""
    return spark.read.text(expand_paths(pattern, prefix))


def read_json(
    spark: SparkSession, path: str | Sequence[str], schema: T.StructType | str | None = None, multi_line: bool = False
) -> DataFrame:
    """JSON scan; with a declared schema there is no inference pass."""
    reader = spark.read.option("multiLine", multi_line)
    return (reader.schema(schema) if schema is not None else reader).json(path)


def read_parquet(spark: SparkSession, *paths: str) -> DataFrame:
    """Parquet scan with pushdown and pruning."""
    return spark.read.parquet(*paths)


def relation(spark: SparkSession, rows: Iterable, schema: T.StructType | str) -> DataFrame:
    """A small in-memory table with a declared schema."""
    return spark.createDataFrame(list(rows), schema)
