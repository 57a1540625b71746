"""Feature vectors and label indexes."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.feature import (
    IndexToString, StringIndexer, StringIndexerModel, VectorAssembler, VectorIndexer,
)
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fathomline.functions.encoding import last_positive


def assembler(columns: Sequence[str], out: str = "features", invalid: str = "error") -> VectorAssembler:
    """A stage that packs columns into one vector."""
    return VectorAssembler(inputCols=list(columns), outputCol=out, handleInvalid=invalid)


def assemble(df: DataFrame, label: str, out: str = "features") -> DataFrame:
    """Pack every column but the label."""
    return assembler([c for c in df.columns if c != label], out).transform(df)


def index_label(label: str, out: str = "indexed_label") -> StringIndexer:
    """A stage that numbers the label values."""
    return StringIndexer(inputCol=label, outputCol=out)


def invert_label(
    model: StringIndexerModel, column: str = "prediction", out: str = "predicted_label"
) -> IndexToString:
    """A stage that maps predictions back to the label values of a fitted index."""
    return IndexToString(inputCol=column, outputCol=out, labels=model.labels)


def index_features(max_categories: int = 5, column: str = "features", out: str = "indexed_features") -> VectorIndexer:
    """A stage that treats vector slots with few distinct values as categories."""
    return VectorIndexer(inputCol=column, outputCol=out, maxCategories=max_categories, handleInvalid="keep")


def to_labeled(
    df: DataFrame, target: int, indicators: Sequence[int] = (), label: str = "label", out: str = "features"
) -> DataFrame:
    """``(label, features)`` with the label taken by position.

    Indicator columns, if given, collapse into the position of the last positive one. That number
    takes the label's place among the features.
    """
    names = df.columns
    kept = [i for i in range(len(names)) if i not in set(indicators)]
    before, after = [names[i] for i in kept if i < target], [names[i] for i in kept if i > target]
    rows, group = df, []
    if indicators:
        rows, group = df.withColumn("__group", last_positive([F.col(f"`{names[i]}`") for i in indicators])), ["__group"]
    packed = assembler([*before, *group, *after], out).transform(rows)
    return packed.select(F.col(f"`{names[target]}`").cast("double").alias(label), out)
