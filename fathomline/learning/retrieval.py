"""Exact largest inner products of every user with all items, without scoring every pair.

Items are taken in order of falling norm, in tiers that are cut into blocks of neighbours. A product is at most the user's
norm times the item's, and at most that of the best corner of the block's box, so a user passes over every block whose bound
lies below the worst of the best ``k`` so far. Of items with equal factors only the ``k`` smallest ids can be among the
best, so the others are left out first. The bounds spare most products where factors are few or norms differ; in
the worst case every pair is scored, still without a row or a shuffle for any of them.

Items reach the tasks in slices of at most ``slice_bytes``, one slice a round; users that are done leave after a round.
A catalogue of a million items with ten factors is one slice. No user is shuffled and no pair is ever a row.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.ml.recommendation import ALSModel
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from fathomline.operators.ordering import with_row_index
from fathomline.session import materialize, spread

SLICE_BYTES = 96 << 20
_BLOCK = 512  # items scored at once
_USERS = 8192  # users taken at once
_GROUP = 256  # users scored at once
_SLACK = 1e-9  # of the bound, for rounding of norms and products

_STATE = "user long, factors array<double>, ids array<long>, scores array<double>, scored long, done boolean"


def _products(users: np.ndarray, items: np.ndarray) -> np.ndarray:
    """All inner products, each summed in the order of the factors, so that blocks do not change a bit of them."""
    out = np.zeros((len(users), len(items)))
    for f in range(users.shape[1]):
        out += users[:, f, None] * items[None, :, f]
    return out


def _neighbours(factors: np.ndarray, size: int) -> list[np.ndarray]:
    """Places of all rows in groups of at most ``size`` neighbours: halved along the widest factor until they fit."""
    waiting, parts = [np.arange(len(factors))], []
    while waiting:
        part = waiting.pop()
        if len(part) <= size:
            parts.append(part)
            continue
        values = factors[part]
        widest = values[:, (values.max(0) - values.min(0)).argmax()]
        half = -(-len(part) // (2 * size)) * size
        order = np.argpartition(widest, half - 1)
        waiting += [part[order[half:]], part[order[:half]]]
    return parts


def _in_blocks(ids: np.ndarray, norms: np.ndarray, factors: np.ndarray) -> dict:
    """A slice of items in order of falling norm, as blocks of neighbours with their boxes and largest norms.

    Tiers of the norm double in size, so the few largest items come by themselves; a tier is cut into blocks.
    """
    blocks, low = [], 0
    while low < len(ids):
        high = min(len(ids), max(_BLOCK, 2 * low))
        blocks += [low + part for part in _neighbours(factors[low:high], _BLOCK)]
        low = high
    width = factors.shape[1]
    return {
        "ids": ids, "factors": factors, "blocks": blocks, "norms": np.array([norms[b].max() for b in blocks]),
        "low": np.array([factors[b].min(0) for b in blocks]).reshape(-1, width),
        "high": np.array([factors[b].max(0) for b in blocks]).reshape(-1, width),
    }


def _scan(users: np.ndarray, ids: np.ndarray, scores: np.ndarray, items: dict, k: int):
    """The best ``k`` of each user after one slice; absent places hold an id of -1 and a score of minus infinity.

    No item of a block has a larger product than the corner of its box that suits the user best, nor than the product
    of the norms. Groups of users alike take blocks in the order of that bound, until it lies below all their worst places.
    """
    scored = np.zeros(len(users), dtype=np.int64)
    norms = np.sqrt((users * users).sum(1))
    for group in _neighbours(users, _GROUP) if len(users) and items["blocks"] else []:
        known, best_ids, best = users[group], ids[group], scores[group]
        slack = _SLACK * norms[group, None] * items["norms"]
        corner = np.maximum(known, 0) @ items["high"].T + np.minimum(known, 0) @ items["low"].T
        size = np.abs(known) @ np.maximum(np.abs(items["high"]), np.abs(items["low"])).T
        bounds = np.minimum(corner + _SLACK * size, norms[group, None] * items["norms"] + slack)
        most = bounds.max(axis=0)
        for at in np.argsort(-most, kind="stable"):
            if most[at] < best[:, -1].min():
                break
            active = np.flatnonzero(bounds[:, at] >= best[:, -1])
            if not len(active):
                continue
            block = items["blocks"][at]
            values = items["factors"][block]
            scored[group[active]] += len(block)
            # The plain product finds the users that gain; an equal score may have a smaller id.
            near = (known[active] @ values.T).max(axis=1) + slack[active, at] >= best[active, -1]
            active = active[near]
            found = _products(known[active], values)
            gains = np.nonzero(found >= best[active, -1:])
            row = np.concatenate([np.repeat(np.arange(len(active)), k), gains[0]])
            value = np.concatenate([best[active].ravel(), found[gains]])
            item = np.concatenate([best_ids[active].ravel(), items["ids"][block][gains[1]]])
            order = np.lexsort((item, -value, row))  # every row has k places at least
            first = np.searchsorted(row[order], np.arange(len(active)))
            kept = order[(first[:, None] + np.arange(k)).ravel()]
            best[active] = value[kept].reshape(-1, k)
            best_ids[active] = item[kept].reshape(-1, k)
        ids[group], scores[group] = best_ids, best
    return ids, scores, scored


def _matrix(column: pa.ChunkedArray) -> np.ndarray:
    """Factors as the rows of a matrix, without a Python object for any of them."""
    lists = column.combine_chunks()
    widths = pc.unique(pc.list_value_length(lists)).to_pylist()
    if len(widths) > 1:
        raise ValueError(f"factors of items differ in number: {sorted(widths)}")
    return lists.flatten().to_numpy(zero_copy_only=False).reshape(len(lists), widths[0] if widths else 0)


def _round(batches: Iterator[pa.RecordBatch], shared, k: int, following: float | None) -> Iterator[pa.RecordBatch]:
    items = shared.value
    width = items["factors"].shape[1]
    schema = pa.schema([("user", pa.int64()), ("factors", pa.list_(pa.float64())), ("ids", pa.list_(pa.int64())),
                        ("scores", pa.list_(pa.float64())), ("scored", pa.int64()), ("done", pa.bool_())])
    for whole in batches:
        for at in range(0, whole.num_rows, _USERS):
            rows = whole.slice(at, _USERS).to_pydict()
            if any(len(f) != width for f in rows["factors"]):
                raise ValueError(f"factors of users and items differ in number, items have {width}")
            users = np.array(rows["factors"], dtype=float).reshape(-1, width)
            ids = np.full((len(users), k), -1, dtype=np.int64)
            scores = np.full((len(users), k), -np.inf)
            for i, (known, values) in enumerate(zip(rows["ids"], rows["scores"], strict=True)):
                ids[i, : len(known)], scores[i, : len(known)] = known, values
            ids, scores, scored = _scan(users, ids, scores, items, k)
            if following is None:
                done = np.ones(len(users), dtype=bool)
            else:
                done = np.sqrt((users * users).sum(1)) * following * (1 + _SLACK) < scores[:, -1]
            kept = [int((row > -np.inf).sum()) for row in scores]
            yield pa.record_batch([
                pa.array(rows["user"], pa.int64()), pa.array(rows["factors"], schema.field("factors").type),
                pa.array([row[:n].tolist() for row, n in zip(ids, kept, strict=True)], schema.field("ids").type),
                pa.array([row[:n].tolist() for row, n in zip(scores, kept, strict=True)], schema.field("scores").type),
                pa.array(np.array(rows["scored"], dtype=np.int64) + scored), pa.array(done),
            ], schema=schema)


def top_products(users: DataFrame, items: DataFrame, k: int = 10, slice_bytes: int = SLICE_BYTES) -> DataFrame:
    """``(user, item, score, rank, scored)``: the ``k`` items of largest inner product for every row of ``users``.

    ``users`` holds ``(user, factors)``, ``items`` ``(item, factors)``; ids are integers, factors finite and of one
    number. Equal scores are ordered by ascending item. ``scored`` is the number of items scored for the user. Rows without an
    id, without factors or with a missing factor are left out; repeated users are answered each, and repeated items count each. With fewer
    than ``k`` items all are returned; without users or items the result is empty.
    """
    if k < 1:
        raise ValueError("k must be positive")
    spark = users.sparkSession
    factors = F.col("factors").cast("array<double>")
    norm = F.sqrt(F.aggregate(factors, F.lit(0.0), lambda total, x: total + x * x))
    whole = F.forall(factors, lambda x: x.isNotNull() & ~F.isnan(x))  # a product with a missing factor has no place
    known = items.filter("item is not null and factors is not null").filter(whole)
    known = known.select(F.col("item").cast("long").alias("item"), factors.alias("factors"), norm.alias("norm"))
    alike = Window.partitionBy("factors").orderBy("item")
    known = known.withColumn("copy", F.row_number().over(alike)).filter(F.col("copy") <= k).drop("copy")
    stored = materialize(with_row_index(known, [F.desc("norm"), "item"], "place"), "items-by-norm")
    first = stored.filter("place = 0").first()
    asked = users.filter("user is not null and factors is not null").filter(whole)
    state = spread(asked.select(
        F.col("user").cast("long").alias("user"), factors.alias("factors"), F.array().cast("array<long>").alias("ids"),
        F.array().cast("array<double>").alias("scores"), F.lit(0).cast("long").alias("scored"), F.lit(False).alias("done"),
    ))
    finished = []
    if first is not None:
        per_slice = max(1, slice_bytes // (8 * (len(first.factors) + 2)))
        for low in range(0, stored.count(), per_slice):
            cut = stored.filter((F.col("place") >= low) & (F.col("place") < low + per_slice)).orderBy("place").toArrow()
            following = stored.filter(F.col("place") == low + per_slice).select("norm").first()
            factors = _matrix(cut["factors"])
            shared = spark.sparkContext.broadcast(_in_blocks(cut["item"].to_numpy(), cut["norm"].to_numpy(), factors))
            after = None if following is None else following[0]
            scored = state.mapInArrow(lambda b, s=shared, a=after: _round(b, s, k, a), _STATE)
            held = materialize(scored, "best-items")
            shared.destroy()  # its users are stored, so no later round has the slice beside its own
            finished.append(held.filter("done"))
            state = held.filter("not done")
            if following is None or state.isEmpty():
                break
    best = reduce(DataFrame.unionByName, finished) if finished else spark.createDataFrame([], _STATE)
    pairs = F.arrays_zip(F.col("ids"), F.col("scores"))
    rows = best.select("user", "scored", F.posexplode(pairs).alias("place", "pair"))
    return rows.select(
        "user", F.col("pair.ids").alias("item"), F.col("pair.scores").alias("score"),
        (F.col("place") + 1).cast("int").alias("rank"), "scored",
    )


def recommend_all(model: ALSModel, users: DataFrame | None = None, k: int = 10) -> DataFrame:
    """``(user, item, score, rank, scored)`` for all users of a factor model, or for the given ones it knows."""
    known = model.userFactors.select(F.col("id").alias("user"), F.col("features").alias("factors"))
    if users is not None:
        known = known.join(users.select("user").distinct(), "user", "left_semi")
    return top_products(known, model.itemFactors.select(F.col("id").alias("item"), F.col("features").alias("factors")), k)
