"""Bounded parts of a batch of texts, and joins with sides of a checked size."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SLICE_CHARS = 2_000_000  # texts handled at once in a task


def slices(texts: list[str], most: int = SLICE_CHARS):
    """Ranges of positions with at most ``most`` characters each, one text at least."""
    start = total = 0
    for i, t in enumerate(texts):
        if i > start and total + len(t) > most:
            yield start, i
            start, total = i, 0
        total += len(t)
    if len(texts) > start:
        yield start, len(texts)


def small(stored: DataFrame, most: int, *arrays: str) -> DataFrame:
    """A stored frame, to be broadcast in a join if it is small, else as it is.

    It is small with at most ``most`` rows and at most ten times as many elements in its columns ``arrays``; its other
    columns are of a fixed width.
    """
    elements = sum((F.coalesce(F.size(a), F.lit(0)) for a in arrays), F.lit(0))
    rows, total = stored.agg(F.count(F.lit(1)), F.coalesce(F.sum(elements), F.lit(0))).first()
    return F.broadcast(stored) if rows <= most and total <= 10 * most else stored


def packed(docs: DataFrame, made: tuple[str, ...] = (), **needed: str) -> DataFrame:
    """``docs`` as one struct ``_row`` without the columns in ``made``, and the needed columns under the given names.

    Columns that an operator works with then never meet columns of the same name in ``docs``.
    """
    rest = [F.col(f"`{c}`") for c in docs.columns if c not in made]
    return docs.select(F.struct(*rest).alias("_row"), *[F.col(f"`{c}`").alias(name) for name, c in needed.items()])
