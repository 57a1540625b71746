"""Hyper-parameter search. Each candidate is a distributed fit; only metrics reach the driver."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from threading import Lock

from pyspark import inheritable_thread_target
from pyspark.ml import Pipeline
from pyspark.ml.base import Estimator
from pyspark.ml.evaluation import Evaluator, MulticlassClassificationEvaluator
from pyspark.ml.feature import VectorIndexer
from pyspark.ml.tuning import CrossValidator, ParamGridBuilder, TrainValidationSplit
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fathomline.learning.models import (
    DRAWN_FROM, WEIGHT, DrawnForest, condensed, counted, draws_rows, forest, halves, logistic, weighs_rows,
)

# The grids of the workloads.
TREE_GRID = {
    "impurity": ["gini", "entropy"], "maxDepth": [1, 20], "maxBins": [40, 300], "minInfoGain": [0.0, 0.05],
}
FOREST_GRID = {"numTrees": [1, 10], "minInfoGain": [0.0, 0.05]}
DEPTH_GRID = {"maxDepth": [2, 3]}
INVERSE_PENALTIES = [0.01, 0.1, 1.0, 10.0, 100.0]


@dataclass
class Tuned:
    """A search result: the refitted best model, its parameters and one metric per candidate."""

    model: object
    best_params: dict[str, object]
    best_metric: float
    candidates: list[tuple[dict[str, object], float]]


def grid_of(estimator: Estimator, values: Mapping[str, Sequence]) -> list:
    """All parameter combinations for an estimator."""
    builder = ParamGridBuilder()
    for name, choices in values.items():
        builder = builder.addGrid(estimator.getParam(name), list(choices))
    return builder.build()


def accuracy_evaluator(label: str = "label", metric: str = "accuracy", **options) -> MulticlassClassificationEvaluator:
    return MulticlassClassificationEvaluator(labelCol=label, metricName=metric, **options)


def _named(params) -> dict[str, object]:
    return {p.name: v for p, v in params.items()}


def _summary(model, grid, metrics, larger: bool) -> Tuned:
    best = (max if larger else min)(range(len(grid)), key=lambda i: metrics[i])
    candidates = [(_named(p), float(m)) for p, m in zip(grid, metrics, strict=True)]
    return Tuned(model.bestModel, candidates[best][0], candidates[best][1], candidates)


def tune_split(
    pipeline: Estimator, grid: list, train: DataFrame, evaluator: Evaluator | None = None,
    ratio: float = 0.9, seed: int = 42, parallelism: int = 2, drawn_from: int = DRAWN_FROM,
) -> Tuned:
    """Grid search on one train/validation split.

    A pipeline of a single tree is fitted and scored on condensed rows, with the split that Spark's search draws. So is
    one of a forest, also behind a stage that numbers categories, over ``drawn_from`` rows or more, half of them equal to others.
    """
    evaluator = evaluator or accuracy_evaluator()
    stages = pipeline.getStages() if isinstance(pipeline, Pipeline) else []
    if len(stages) == 1 and weighs_rows(stages[0]) and _counts_rows(evaluator, stages[0], grid):
        tree, made = stages[0], [stages[0].copy({stages[0].weightCol: WEIGHT})]
        return _tune_condensed(made, tree, tree.getFeaturesCol(), condensed, grid, train, evaluator, ratio, seed, parallelism)
    features = _drawn_features(stages)
    if features and _counts_rows(evaluator, stages[-1], grid) and halves(train, stages[-1].getLabelCol(), features, drawn_from):
        made = [*stages[:-1], DrawnForest(stages[-1])]
        return _tune_condensed(made, stages[-1], features, counted, grid, train, evaluator, ratio, seed, parallelism)
    search = TrainValidationSplit(
        estimator=pipeline, estimatorParamMaps=grid, evaluator=evaluator, trainRatio=ratio,
        seed=seed, parallelism=parallelism,
    )
    model = search.fit(train)
    return _summary(model, grid, model.validationMetrics, evaluator.isLargerBetter())


def _counts_rows(evaluator: Evaluator, tree: Estimator, grid: list) -> bool:
    changed = {p.name for params in grid for p in params}
    return (isinstance(evaluator, MulticlassClassificationEvaluator) and not evaluator.isSet(evaluator.weightCol)
            and evaluator.getMetricName() != "logLoss" and evaluator.getLabelCol() == tree.getLabelCol()
            and not changed & {"minInstancesPerNode", "weightCol", "labelCol", "featuresCol", "predictionCol",
                               "bootstrap", "subsamplingRate", "leafCol", "thresholds", "inputCol", "outputCol"})


def _drawn_features(stages: Sequence) -> str | None:
    """The features a search's forest can be fitted on by ``DrawnForest``, before a stage that looks at values, not at rows."""
    if not stages or not draws_rows(stages[-1]):
        return None
    features = stages[-1].getFeaturesCol()
    if len(stages) == 1:
        return features
    behind = len(stages) == 2 and isinstance(stages[0], VectorIndexer) and stages[0].getOutputCol() == features
    return stages[0].getInputCol() if behind else None


def _tune_condensed(stages, tree, features, rows_of, grid, train, evaluator, ratio, seed, parallelism) -> Tuned:
    """The search by ``stages`` that take ``rows_of`` a table, in which equal rows are one weighted row."""
    label, drawn = tree.getLabelCol(), F.col("_drawn")
    split = train.select("*", F.rand(seed).alias("_drawn"))
    held = [rows_of(df, label, features).persist() for df in (split.filter(drawn < ratio), split.filter(drawn >= ratio))]
    weighted = Pipeline(stages=stages)
    scored = evaluator.copy({evaluator.weightCol: WEIGHT})

    def measured(params):
        return scored.evaluate(weighted.fit(held[0], params).transform(held[1]))

    try:
        with ThreadPoolExecutor(max_workers=parallelism) as pool:
            metrics = list(pool.map(inheritable_thread_target(train.sparkSession)(measured), grid))
        best = (max if evaluator.isLargerBetter() else min)(range(len(grid)), key=lambda i: metrics[i])
        model = weighted.fit(rows_of(train, label, features), grid[best])
    finally:
        for df in held:
            df.unpersist()
    candidates = [(_named(p), float(m)) for p, m in zip(grid, metrics, strict=True)]
    return Tuned(model, candidates[best][0], candidates[best][1], candidates)


def tune_cv(
    pipeline: Estimator, grid: list, train: DataFrame, evaluator: Evaluator | None = None,
    folds: int = 3, seed: int = 42, parallelism: int = 2,
) -> Tuned:
    """Grid search with k-fold cross-validation."""
    evaluator = evaluator or accuracy_evaluator()
    search = CrossValidator(
        estimator=pipeline, estimatorParamMaps=grid, evaluator=evaluator, numFolds=folds,
        seed=seed, parallelism=parallelism,
    )
    model = search.fit(train)
    return _summary(model, grid, model.avgMetrics, evaluator.isLargerBetter())


def tune_forest(
    train: DataFrame, label: str = "label", features: str = "features", stages: Sequence = (),
    values: Mapping[str, Sequence] = FOREST_GRID, **options,
) -> Tuned:
    """Forest search over tree count and information gain, after optional indexing stages."""
    estimator = forest(label, features)
    pipeline = Pipeline(stages=[*stages, estimator])
    return tune_split(pipeline, grid_of(estimator, values), train, accuracy_evaluator(label), **options)


def tune_logistic_recall(
    train: DataFrame, label: str = "label", inverse_penalties: Sequence[float] = tuple(INVERSE_PENALTIES),
    folds: int = 3, positive: float = 1.0, **options,
) -> Tuned:
    """Logistic regression over l1/l2 penalty and strength, scored by recall of the positive class.

    An inverse strength ``C`` summed over rows equals ``1 / (C * rows)`` on Spark's mean loss.
    """
    rows = train.count()
    estimator = logistic(label, standardization=False)
    grid = grid_of(estimator, {
        "elasticNetParam": [1.0, 0.0], "regParam": [1.0 / (c * rows) for c in inverse_penalties],
    })
    evaluator = accuracy_evaluator(label, "recallByLabel", metricLabel=positive)
    return tune_cv(estimator, grid, train, evaluator, folds=folds, **options)


def sweep(
    estimator: Estimator, train: DataFrame, test: DataFrame, values: Mapping[str, Sequence],
    evaluator: Evaluator | None = None, parallelism: int = 4,
) -> Tuned:
    """Train every combination on ``train``, rank all by their metric on ``test``, keep the best model only.

    ``parallelism`` fits run side by side. Frames that the caller has cached stay cached. Trees and forests that
    differ in depth or number of trees are better swept by ``sweeps.sweep_trees``.
    """
    evaluator = evaluator or accuracy_evaluator()
    larger = evaluator.isLargerBetter()
    held = [df.persist() for df in (train, test) if not (df.storageLevel.useMemory or df.storageLevel.useDisk)]
    lock, best, candidates = Lock(), [], []

    def measured(params):
        model = estimator.fit(train, params)
        found = float(evaluator.evaluate(model.transform(test)))
        with lock:
            candidates.append((_named(params), found))
            if not best or (found > best[1] if larger else found < best[1]):
                best[:] = [model, found, _named(params)]

    try:
        with ThreadPoolExecutor(max_workers=parallelism) as pool:
            list(pool.map(inheritable_thread_target(train.sparkSession)(measured), grid_of(estimator, values)))
    finally:
        for df in held:
            df.unpersist()
    model, metric, params = best
    return Tuned(model, params, metric, sorted(candidates, key=lambda c: c[1], reverse=larger))
