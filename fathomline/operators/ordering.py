"""Ordered operators that stay distributed when one key holds most of the rows.

A plain ``Window.partitionBy(key)`` sorts a whole key inside one task. The operators here use
that plan only while every key is below ``max_rows_per_task``. A larger key is cut into chunks
along its own ordering column: window functions run inside ``(key, chunk)``, and what must cross
a chunk border travels in a summary of one row per chunk.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from fathomline.session import materialize

MAX_ROWS_PER_TASK = 2_000_000
MAX_TOP = 100_000
MAX_BROADCAST_ROWS = 100_000

_CHUNK = "__chunk"
_ROW = "__row"


def cut_series(df: DataFrame, keys: Sequence[str], order: Sequence[str], rows: int, max_rows: int) -> tuple[DataFrame, int]:
    """Add a row number and a chunk number that grow with ``order`` within each key, stored; also the most chunks there are.

    The cut is a range sort on the keys and all order columns, so columns of every orderable type are cut as a window
    sorts them: nulls first, ties of one column by the next. It is written once, so that later steps read the same
    chunks, and what ``df`` is computed from runs once. A range holds as many chunks of at most ``max_rows`` rows as it
    needs, so a low limit makes more chunks, not more tasks than the session has partitions.
    """
    pieces = max(2, 2 * math.ceil(rows / max_rows))
    wanted = max(2, 2 * math.ceil(rows / MAX_ROWS_PER_TASK))
    tasks = min(pieces, max(wanted, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))))
    by = [F.col(c).asc_nulls_first() for c in [*keys, *order]]
    placed = df.repartitionByRange(tasks, *by).sortWithinPartitions(*by).withColumn(_ROW, F.monotonically_increasing_id())
    inside = F.col(_ROW).bitwiseAND(F.lit((1 << 33) - 1))  # of its range
    chunk = F.col(_ROW) - inside + F.floor(inside / max_rows)
    return materialize(placed, "series").withColumn(_CHUNK, chunk), tasks + math.ceil(rows / max_rows)


def heavy_keys(df: DataFrame, keys: Sequence[str], max_rows: int) -> DataFrame:
    """Keys holding more than ``max_rows`` rows, with their row count ``n``."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > max_rows)


def join_keys(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "inner") -> DataFrame:
    """Equi-join in which null keys match each other; keys come from the left side."""
    renamed = right.withColumnsRenamed({k: f"__right_{k}" for k in keys})
    same = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"__right_{k}")) for k in keys])
    return left.join(renamed, same, how).drop(*[f"__right_{k}" for k in keys])


def _small(df: DataFrame, rows: int) -> DataFrame:
    """Mark a frame of a known number of rows for broadcast, if that number is small."""
    return F.broadcast(df) if rows <= MAX_BROADCAST_ROWS else df


def with_neighbours(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    values: Sequence[str],
    previous: str | None = None,
    following: str | None = None,
    position: str | None = None,
    length: str | None = None,
    mean: str | None = None,
    max_rows_per_task: int = MAX_ROWS_PER_TASK,
) -> DataFrame:
    """Add what a row can know about its series: neighbours, position, length, mean.

    ``previous`` and ``following`` name struct columns holding ``values`` of the adjacent row
    (null at the ends), ``position`` counts from 0, ``length`` is the row count of the key and
    ``mean`` the mean of the first of ``values``. ``order`` should be a total order within the
    key, of columns of any orderable type.
    """
    keys, order, values = list(keys), list(order), list(values)
    heavy = heavy_keys(df, keys, max_rows_per_task)
    found = heavy.agg(F.sum("n").alias("rows"), F.count(F.lit(1)).alias("keys")).first()
    row = F.struct(*values)
    measure = F.col(values[0]) if mean else F.lit(None).cast("double")

    if not found["keys"]:
        w, whole = Window.partitionBy(*keys).orderBy(*order), Window.partitionBy(*keys)
        wanted = {
            previous: F.lag(row).over(w),
            following: F.lead(row).over(w),
            position: F.row_number().over(w).cast("long") - 1,
            length: F.count(F.lit(1)).over(whole),
            mean: F.avg(measure).over(whole),
        }
        return df.withColumns({name: column for name, column in wanted.items() if name})

    flagged = _small(heavy.select(*keys, F.lit(True).alias("__heavy")), found["keys"])
    marked = join_keys(df, flagged, keys, "left").fillna({"__heavy": False})
    cut, pieces = cut_series(marked.filter("__heavy"), keys, order, found["rows"], max_rows_per_task)
    light = marked.filter(~F.col("__heavy")).withColumns({_ROW: F.lit(0).cast("long"), _CHUNK: F.lit(-1).cast("long")})
    chunked = cut.unionByName(light)

    parts = (
        cut.groupBy(*keys, _CHUNK)
        .agg(
            F.min_by(row, _ROW).alias("__first"),
            F.max_by(row, _ROW).alias("__last"),
            F.count(F.lit(1)).alias("__n"),
            F.sum(measure).alias("__sum"),
            F.count(measure).alias("__filled"),
        )
    )
    across, whole = Window.partitionBy(*keys).orderBy(_CHUNK), Window.partitionBy(*keys)
    borders = parts.select(
        *keys,
        _CHUNK,
        F.lag("__last").over(across).alias("__before"),
        F.lead("__first").over(across).alias("__after"),
        (F.sum("__n").over(across.rowsBetween(Window.unboundedPreceding, 0)) - F.col("__n")).alias("__offset"),
        F.sum("__n").over(whole).alias("__total"),
        F.try_divide(F.sum("__sum").over(whole), F.sum("__filled").over(whole)).alias("__mean"),
    )

    piece = Window.partitionBy(*keys, _CHUNK)
    inside = piece.orderBy(_ROW, *order)
    local = chunked.withColumns({
        "__prev": F.lag(row).over(inside),
        "__next": F.lead(row).over(inside),
        "__pos": F.row_number().over(inside).cast("long") - 1,
        "__count": F.count(F.lit(1)).over(piece),
        "__avg": F.avg(measure).over(piece),
    })
    borders = _small(borders, found["keys"] + pieces)
    joined = join_keys(local, borders, [*keys, _CHUNK], "left")
    wanted = {
        previous: F.coalesce("__prev", "__before"),
        following: F.coalesce("__next", "__after"),
        position: F.col("__pos") + F.coalesce("__offset", F.lit(0)),
        length: F.coalesce("__total", "__count"),
        mean: F.when(F.col("__heavy"), F.col("__mean")).otherwise(F.col("__avg")),
    }
    return joined.select(*df.columns, *[column.alias(name) for name, column in wanted.items() if name])


def running_totals(
    df: DataFrame,
    order: str,
    measures: Sequence[str],
    descending: bool = False,
    suffix: str = "_so_far",
    max_rows_per_task: int = MAX_ROWS_PER_TASK,
) -> DataFrame:
    """Cumulative sums over one global order, without sorting the whole table in one task.

    ``order`` must hold one row per value (aggregate first). Rows are cut into ranges; only the
    range totals, one row per range, meet in a single window.
    """
    direction = F.desc if descending else F.asc
    so_far = (Window.unboundedPreceding, 0)
    pieces = math.ceil(df.count() / max_rows_per_task)
    if pieces <= 1:
        w = Window.orderBy(direction(order)).rowsBetween(*so_far)
        return df.withColumns({f"{m}{suffix}": F.sum(m).over(w) for m in measures})

    placed = df.repartitionByRange(pieces, direction(order)).withColumn(_CHUNK, F.spark_partition_id())
    chunked = materialize(placed, "totals")
    inside = Window.partitionBy(_CHUNK).orderBy(direction(order)).rowsBetween(*so_far)
    local = chunked.withColumns({f"__{m}": F.sum(m).over(inside) for m in measures})

    before = Window.orderBy(_CHUNK).rowsBetween(*so_far)  # chunks are in the direction of the order
    offsets = chunked.groupBy(_CHUNK).agg(*[F.sum(m).alias(m) for m in measures])
    offsets = offsets.select(_CHUNK, *[(F.sum(m).over(before) - F.col(m)).alias(f"__off_{m}") for m in measures])
    totals = [(F.col(f"__{m}") + F.col(f"__off_{m}")).alias(f"{m}{suffix}") for m in measures]
    return local.join(_small(offsets, pieces), _CHUNK).select(*df.columns, *totals)


def with_row_index(df: DataFrame, order: Sequence[str], name: str = "row_index") -> DataFrame:
    """Zero-based index of each row in the global order of ``order``.

    The range-partitioned sort is written once, so partition numbers cannot change between
    counting the partitions and reading them. The offset table has one row per partition.
    """
    numbered = df.orderBy(*order).withColumn("__id", F.monotonically_increasing_id())
    placed = materialize(numbered, "row-index").withColumn("__part", F.shiftright("__id", 33))
    sizes = placed.groupBy("__part").agg(F.count(F.lit(1)).alias("__size"))
    so_far = Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, 0)
    offsets = sizes.select("__part", (F.sum("__size").over(so_far) - F.col("__size")).alias("__offset"))
    index = F.col("__offset") + F.col("__id").bitwiseAND(F.lit((1 << 33) - 1))
    # One row per shuffle partition.
    return placed.join(F.broadcast(offsets), "__part").select(*df.columns, index.alias(name))


def skip_rows(df: DataFrame, order: Sequence[str], n: int, max_top: int = MAX_TOP) -> DataFrame:
    """All rows but the first ``n`` of a total order.

    For a small ``n`` the border row comes from a top-``n`` plan, so the table itself is filtered, never sorted. A
    larger ``n`` is counted off along a range sort.
    """
    if n <= 0:
        return df
    if n > max_top:
        return with_row_index(df, order, "__index").filter(F.col("__index") >= n).drop("__index")
    rank = F.struct(*order)
    border = df.select(rank.alias("rank")).orderBy("rank").limit(n).agg(F.max("rank").alias("rank"))
    return df.filter(rank > border.scalar())
