"""Sweeps of trees and forests that share their fits.

A tree grows level by level and a level does not depend on the depth that is allowed, so the tree of a smaller depth is
the top of a deeper one. One fit at the largest depth therefore stands for all depths. The first trees of a forest are a
forest of fewer trees; Spark draws other rows for another number of trees, so a separate fit gives another forest
of the same kind. Impurities, bins and gains change the tree itself and are fitted each.

Equal rows are one weighted row to a tree, so its rows are condensed first; a forest draws rows and keeps them all.

Test rows are scored once per fit: each row's leaves name the paths through the trees, and the votes along them give the
predictions of every depth and number of trees. Tasks only count labels against predictions, so what comes back is
one confusion table per combination. Only the best model is kept.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from itertools import product
from threading import Lock

import numpy as np
import pandas as pd
from pyspark import inheritable_thread_target
from pyspark.ml.base import Model
from pyspark.ml.classification import DecisionTreeClassifier, RandomForestClassifier
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fathomline.learning.models import WEIGHT, condensed, weighs_rows
from fathomline.learning.tuning import Tuned
from fathomline.session import fresh_path

Confusion = dict[tuple[float, float], int]  # rows by label and prediction


def accuracy_of(rows: Confusion) -> float:
    total = sum(rows.values())
    return sum(n for (label, predicted), n in rows.items() if label == predicted) / total if total else 0.0


def _votes(nodes: pd.DataFrame, depths: Sequence[int]) -> np.ndarray:
    """``[leaf, depth, class]``: the share of each class in the node where a leaf's path stands at each depth.

    ``nodes`` are a tree's rows as a stored model has them, by id, which is the order in which leaves are numbered.
    """
    stats = np.array(nodes["impurityStats"].tolist(), dtype=float)
    shares = stats / np.maximum(stats.sum(axis=1, keepdims=True), 1e-300)
    left, right = nodes["leftChild"].to_numpy(), nodes["rightChild"].to_numpy()
    depth_of, parent = np.zeros(len(nodes), dtype=int), np.full(len(nodes), -1)
    for i in range(len(nodes)):  # children come after their parent
        for child in (left[i], right[i]):
            if child >= 0:
                depth_of[child], parent[child] = depth_of[i] + 1, i
    leaves = np.flatnonzero(left < 0)
    out = np.empty((len(leaves), len(depths), stats.shape[1]))
    for d, depth in enumerate(depths):
        at = leaves.copy()
        while (deep := depth_of[at] > depth).any():
            at[deep] = parent[at[deep]]
        out[:, d] = shares[at]
    return out


def _trees_of(model: Model, spark) -> list[pd.DataFrame]:
    """The node rows of every tree of a model, which the driver holds as the model already."""
    path = fresh_path(spark, "tree-model")
    model.write().save(path)
    rows = spark.read.parquet(f"{path}/data")
    flat = rows.select("nodeData.*", F.col("treeID").alias("tree")) if "nodeData" in rows.columns else rows.withColumn("tree", F.lit(0))
    frame = flat.select("tree", "id", "impurityStats", "leftChild", "rightChild").toPandas()
    return [part.sort_values("id").reset_index(drop=True) for _, part in sorted(frame.groupby("tree"), key=lambda x: x[0])]


def prefix_confusions(
    model: Model, test: DataFrame, depths: Sequence[int], trees: Sequence[int] = (1,), label: str = "label",
) -> dict[tuple[int, int], Confusion]:
    """By number of trees and depth, the confusion table of the model's prefix on ``test``."""
    spark = test.sparkSession
    votes = [_votes(nodes, depths) for nodes in _trees_of(model, spark)]
    if max(trees) > len(votes):
        raise ValueError(f"the model has {len(votes)} trees")
    held = spark.sparkContext.broadcast(votes[:max(trees)])  # as large as the model, which every task has anyway
    scored = model.setLeafCol("_leaf").transform(test)
    leaf = F.col("_leaf")
    leaves = vector_to_array(leaf) if len(votes) > 1 else F.array(leaf)
    counted_rows = F.col(WEIGHT).cast("long") if WEIGHT in test.columns else F.lit(1).cast("long")
    rows = scored.select(F.col(f"`{label}`").cast("double").alias("label"), leaves.alias("leaves"), counted_rows.alias("n"))

    def count(frames):
        totals = {}
        for frame in frames:
            at = np.stack(frame["leaves"].to_numpy()).astype(int) if len(frame) else np.zeros((0, 1), dtype=int)
            votes_so_far = 0.0
            for k, of_tree in enumerate(held.value):
                votes_so_far = votes_so_far + of_tree[at[:, k]]
                if k + 1 in trees:
                    best = votes_so_far.argmax(axis=2)
                    for d, depth in enumerate(depths):
                        for pair, n in frame.groupby(["label", best[:, d].astype(float)])["n"].sum().items():
                            totals[k + 1, depth, *pair] = totals.get((k + 1, depth, *pair), 0) + int(n)
        yield pd.DataFrame([(*key, n) for key, n in totals.items()], columns=["trees", "depth", "label", "prediction", "n"])

    counted = rows.mapInPandas(count, "trees int, depth int, label double, prediction double, n long")
    out = {(k, d): {} for k in trees for d in depths}
    for r in counted.groupBy("trees", "depth", "label", "prediction").agg(F.sum("n").alias("n")).collect():
        out[r.trees, r.depth][r.label, r.prediction] = r.n
    return out


def sweep_trees(
    estimator: DecisionTreeClassifier | RandomForestClassifier, train: DataFrame, test: DataFrame,
    depths: Sequence[int], values: Mapping[str, Sequence], trees: Sequence[int] = (1,),
    metric: Callable[[Confusion], float] = accuracy_of, parallelism: int = 4,
) -> Tuned:
    """Every combination of ``depths``, ``trees`` and ``values`` ranked by its metric on ``test``, larger being better.

    The number of fits is that of the combinations of ``values``. The returned model is fitted with the best
    parameters; of equal metrics the smaller depth and the fewer trees win.
    """
    label, forest = estimator.getLabelCol(), isinstance(estimator, RandomForestClassifier)
    if not forest and tuple(trees) != (1,):
        raise ValueError("a tree has no number of trees")
    names = list(values)
    narrow = not any(n in ("minInstancesPerNode", "weightCol", "featuresCol", "labelCol") for n in names)
    if weighs_rows(estimator) and narrow:
        train, test = (condensed(df, label, estimator.getFeaturesCol()) for df in (train, test))
        estimator = estimator.copy({estimator.weightCol: WEIGHT})
    held = [df.persist() for df in (train, test) if not (df.storageLevel.useMemory or df.storageLevel.useDisk)]
    most = {"maxDepth": max(depths), **({"numTrees": max(trees)} if forest else {})}
    lock, best, candidates = Lock(), [None, None], []

    def fitted(choice):
        given = dict(zip(names, choice, strict=True))
        model = estimator.fit(train, {estimator.getParam(n): v for n, v in {**most, **given}.items()})
        found = []
        for (k, d), rows in prefix_confusions(model, test, depths, trees, label).items():
            found.append(({**given, "maxDepth": d, **({"numTrees": k} if forest else {})}, metric(rows)))
        with lock:
            candidates.extend(found)
            top = max(found, key=_rank)
            if best[0] is None or _rank(top) > _rank(best[0]):
                whole = all(top[0][n] == v for n, v in most.items())
                best[:] = [top, model if whole else None]

    try:
        with ThreadPoolExecutor(max_workers=parallelism) as pool:
            list(pool.map(inheritable_thread_target(train.sparkSession)(fitted), product(*values.values())))
        (params, value), model = best
        if model is None:
            model = estimator.fit(train, {estimator.getParam(n): v for n, v in params.items()})
    finally:
        for df in held:
            df.unpersist()
    return Tuned(model, params, value, sorted(candidates, key=_rank, reverse=True))


def _rank(candidate: tuple[dict, float]) -> tuple:
    params, value = candidate
    return value, -params["maxDepth"], -params.get("numTrees", 0), [str(v) for v in params.values()]
