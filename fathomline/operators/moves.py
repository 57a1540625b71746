"""Row-to-row moves of ordered series."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fathomline.operators.ordering import MAX_ROWS_PER_TASK, with_neighbours


def price_change(
    quotes: DataFrame, keys: Sequence[str] = ("symbol",), order: Sequence[str] = ("date",), price: str = "close",
    max_rows_per_task: int = MAX_ROWS_PER_TASK,
) -> DataFrame:
    """``(keys, order, price_diff, prev_<order>)`` for every row that has a predecessor."""
    values = [price, order[0]]
    rows = quotes.select(*keys, *order, price)
    rows = with_neighbours(rows, keys, order, values, previous="prev", max_rows_per_task=max_rows_per_task)
    return rows.filter(F.col("prev").isNotNull()).select(
        *keys, *order,
        (F.col(price) - F.col(f"prev.{price}")).alias(f"{price}_diff"),
        F.col(f"prev.{order[0]}").alias(f"prev_{order[0]}"),
    )


def up_move(
    quotes: DataFrame, keys: Sequence[str] = ("symbol",), order: Sequence[str] = ("date",), price: str = "close",
    max_rows_per_task: int = MAX_ROWS_PER_TASK,
) -> DataFrame:
    """Add ``up``: 1 if the price rose since the previous row, else 0; the first row gets 0."""
    rows = with_neighbours(quotes, keys, order, [price], previous="__p", max_rows_per_task=max_rows_per_task)
    rose = F.col(price) > F.col(f"__p.{price}")
    return rows.withColumn("up", F.when(rose, 1).otherwise(0)).drop("__p")


def signed_move(
    quotes: DataFrame, keys: Sequence[str] = ("symbol",), order: Sequence[str] = ("date",), price: str = "close",
    max_rows_per_task: int = MAX_ROWS_PER_TASK,
) -> DataFrame:
    """Add ``move``: price minus the previous price, which counts as 0 before the first row."""
    rows = with_neighbours(quotes, keys, order, [price], previous="__p", max_rows_per_task=max_rows_per_task)
    before = F.when(F.col("__p").isNull(), F.lit(0)).otherwise(F.col(f"__p.{price}"))
    return rows.withColumn("move", F.col(price) - before).drop("__p")


def next_pair(
    quotes: DataFrame, keys: Sequence[str] = ("symbol",), order: Sequence[str] = ("date",), price: str = "close",
    filler: bool = True, max_rows_per_task: int = MAX_ROWS_PER_TASK,
) -> DataFrame:
    """Add the next price and whether it is higher; the last row is paired with 0, or left out."""
    rows = with_neighbours(quotes, keys, order, [price], following="__n", max_rows_per_task=max_rows_per_task)
    if not filler:
        rows = rows.filter(F.col("__n").isNotNull())
    after = F.when(F.col("__n").isNull(), F.lit(0)).otherwise(F.col(f"__n.{price}"))
    paired = rows.withColumn(f"next_{price}", after)
    return paired.withColumn("rising", F.col(f"next_{price}") > F.col(price)).drop("__n")
