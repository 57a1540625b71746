"""Period returns, Sharpe ratios and price statistics of series.

A series is ``keys`` (which series), ``order`` (a total order within it) and a price column.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from fathomline.operators.ordering import MAX_ROWS_PER_TASK, heavy_keys, join_keys, with_neighbours

# The period that ends at the middle of its history, the history it is read from,
# and the trading days of a year.
HALF_PERIOD = "3-6m"
HALF_PERIOD_HISTORY = "6m"
TRADING_DAYS = 250


def history_of(period: str) -> str:
    """The history to load for a period."""
    return HALF_PERIOD_HISTORY if period == HALF_PERIOD else period


def _endpoint(period: str):
    return F.expr("n div 2") if period == HALF_PERIOD else F.col("n") - 1


def _returns(price: str):
    return [
        F.max(F.when(F.col("pos") == 0, F.col(price))).alias("start_price"),
        F.max(F.when(F.col("pos") == F.col("endpoint"), F.col(price))).alias("latest_price"),
        F.max(price).alias("max_price"),
    ]


def _performance():
    return F.try_divide("latest_price", "start_price") - 1


def _daily_change(price: str):
    """Relative change of a row before the endpoint; null for the first row and from the endpoint on."""
    return F.when(F.col("pos") < F.col("endpoint"), F.try_divide(F.col(price), F.col(f"prev.{price}")) - 1)


def _sharpe(change):
    annual = F.lit(math.sqrt(TRADING_DAYS))
    return (annual * F.try_divide(F.avg(change), F.stddev_pop(change))).alias("sharpe_ratio")


def _days(price: str):
    below = F.col(price) < F.col("avg_price")
    return [
        F.min(price).alias("min_price"),
        F.count_if(below).alias("days_below_avg"),
        F.count_if(~below).alias("days_not_below_avg"),
    ]


def _positioned(quotes, keys, order, price, period, max_rows, **wanted):
    """Rows with their position and the position of the period's endpoint."""
    rows = with_neighbours(
        quotes.select(*keys, *order, price), keys, order, [price],
        position="pos", length="n", max_rows_per_task=max_rows, **wanted,
    )
    return rows.withColumn("endpoint", _endpoint(period))


def period_stats(
    quotes: DataFrame, period: str = "3m", keys: Sequence[str] = ("symbol",), order: Sequence[str] = ("date",),
    price: str = "close", max_rows_per_task: int = MAX_ROWS_PER_TASK,
) -> DataFrame:
    """``(keys, start_price, latest_price, max_price, performance)`` per series.

    A whole period needs only mergeable aggregates. The half period ends at the middle row, so
    positions are computed first.
    """
    keys, rank, p = list(keys), F.struct(*order), F.col(price)
    if period != HALF_PERIOD:
        stats = quotes.groupBy(*keys).agg(
            F.min_by(p, rank).alias("start_price"), F.max_by(p, rank).alias("latest_price"),
            F.max(p).alias("max_price"),
        )
    else:
        rows = _positioned(quotes, keys, list(order), price, period, max_rows_per_task)
        stats = rows.groupBy(*keys).agg(*_returns(price))
    return stats.withColumn("performance", _performance())


def sharpe_ratio(
    quotes: DataFrame, period: str = "3m", keys: Sequence[str] = ("symbol",), order: Sequence[str] = ("date",),
    price: str = "close", max_rows_per_task: int = MAX_ROWS_PER_TASK,
) -> DataFrame:
    """``(keys, sharpe_ratio)``: annualised mean over deviation of the daily relative changes.

    The endpoint quote takes no part. Null if there is no change or no deviation.
    """
    keys = list(keys)
    rows = _positioned(quotes, keys, list(order), price, period, max_rows_per_task, previous="prev")
    return rows.groupBy(*keys).agg(_sharpe(_daily_change(price)))


def price_stats(
    quotes: DataFrame, keys: Sequence[str] = ("symbol",), price: str = "close",
    max_rows_per_task: int = MAX_ROWS_PER_TASK,
) -> DataFrame:
    """``(keys, max_price, min_price, days_below_avg, days_not_below_avg)`` per series.

    The mean comes from a window over each series, or, if a series is too large for one task,
    from an aggregate that is joined back.
    """
    keys = list(keys)
    rows = quotes.select(*keys, price)
    if heavy_keys(rows, keys, max_rows_per_task).isEmpty():
        centred = rows.withColumn("avg_price", F.avg(price).over(Window.partitionBy(*keys)))
    else:
        centred = join_keys(rows, rows.groupBy(*keys).agg(F.avg(price).alias("avg_price")), keys)
    return centred.groupBy(*keys).agg(F.max(price).alias("max_price"), *_days(price))


def growth_ratio(
    quotes: DataFrame, keys: Sequence[str] = ("symbol",), order: Sequence[str] = ("date",), price: str = "close"
) -> DataFrame:
    """``(keys, growth)``: newest price over oldest price."""
    rank = F.struct(*order)
    return quotes.groupBy(*keys).agg(
        F.try_divide(F.max_by(F.col(price), rank), F.min_by(F.col(price), rank)).alias("growth")
    )


def stock_performance(
    quotes: DataFrame, companies: DataFrame, period: str = "3m", key: str = "symbol",
    order: Sequence[str] = ("date",), price: str = "close", max_rows_per_task: int = MAX_ROWS_PER_TASK,
) -> DataFrame:
    """Company rows with period statistics, Sharpe ratio and price statistics, period-suffixed.

    All statistics share one pass over the quotes and one partitioning by series.
    """
    rows = _positioned(quotes, [key], list(order), price, period, max_rows_per_task, previous="prev", mean="avg_price")
    stats = rows.groupBy(key).agg(*_returns(price), _sharpe(_daily_change(price)), *_days(price))
    stats = stats.withColumn("performance", _performance())
    named = stats.withColumnsRenamed({c: f"{c}_{period}" for c in stats.columns if c != key})
    return companies.join(named, key)
