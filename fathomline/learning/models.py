"""Training and scoring with the defaults of the workloads."""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor
from functools import reduce

import numpy as np
import pandas as pd
from pyspark import inheritable_thread_target
from pyspark.ml.base import Estimator, Model
from pyspark.ml.classification import (
    DecisionTreeClassifier, LinearSVC, LogisticRegression, RandomForestClassifier,
)
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.linalg import DenseVector
from pyspark.ml.recommendation import ALS, ALSModel
from pyspark.ml.regression import DecisionTreeRegressor
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fathomline.learning.retrieval import recommend_all
from fathomline.session import shared_folder


def _settings(label: str, features: str, given: dict, **defaults) -> dict:
    return {"labelCol": label, "featuresCol": features, **defaults, **given}


def tree(label: str = "label", features: str = "features", **params) -> DecisionTreeClassifier:
    """Decision tree: gini, depth 5, 32 bins unless given."""
    return DecisionTreeClassifier(**_settings(label, features, params, impurity="gini", maxDepth=5, maxBins=32, seed=42))


def forest(label: str = "label", features: str = "features", **params) -> RandomForestClassifier:
    """Random forest: gini, depth 4, 32 bins, 3 trees unless given."""
    return RandomForestClassifier(
        **_settings(label, features, params, impurity="gini", maxDepth=4, maxBins=32, numTrees=3, seed=42)
    )


def tree_regressor(label: str = "label", features: str = "features", **params) -> DecisionTreeRegressor:
    """Regression tree."""
    return DecisionTreeRegressor(**_settings(label, features, params, seed=42))


def logistic(label: str = "label", features: str = "features", **params) -> LogisticRegression:
    """Logistic regression."""
    return LogisticRegression(**_settings(label, features, params))


def svm(label: str = "label", features: str = "features", **params) -> LinearSVC:
    """Linear support vector machine, 150 iterations unless given."""
    return LinearSVC(**_settings(label, features, params, maxIter=150))


# Learner names accepted by ``learner``.
LEARNERS = {"DecisionTree": tree, "RandomForest": forest}


def learner(name: str, **params) -> Estimator:
    """An untrained learner by name."""
    try:
        return LEARNERS[name](**params)
    except KeyError:
        raise ValueError(f"unknown learner {name}; choose from {sorted(LEARNERS)}") from None


WEIGHT = "_rows"
# The rows from which trees are fitted apart (Spark's own forest shares their passes), and those of a task then.
DRAWN_FROM = 100_000
ROWS_PER_TASK = 50_000
ALS_BLOCKS = 10  # Spark's own number of blocks of users and of items
RATINGS_PER_BLOCK = 2_000_000


def halves(df: DataFrame, label: str = "label", features: str = "features", least: int = 0) -> bool:
    """Whether there are ``least`` rows or more and one row for all equal ones saves half of them."""
    kinds = F.approx_count_distinct(F.xxhash64(F.col(f"`{label}`"), F.col(f"`{features}`")))
    rows, different = df.agg(F.count(F.lit(1)), kinds).first()
    return rows >= least and 2 * different <= rows


def counted(df: DataFrame, label: str = "label", features: str = "features") -> DataFrame:
    """``label``, ``features`` and their number ``_rows``: equal rows as one weighted row."""
    return df.groupBy(F.col(f"`{label}`"), F.col(f"`{features}`")).agg(F.count(F.lit(1)).cast("double").alias(WEIGHT))


def condensed(df: DataFrame, label: str = "label", features: str = "features") -> DataFrame:
    """``counted`` rows where that saves half of them, else all with weight 1."""
    if halves(df, label, features):
        return counted(df, label, features)
    return df.select(F.col(f"`{label}`"), F.col(f"`{features}`"), F.lit(1.0).alias(WEIGHT))


def weighs_rows(estimator: Estimator) -> bool:
    """Whether a fit on ``condensed`` rows is the fit on all: a single tree that counts weights, not rows."""
    return (isinstance(estimator, DecisionTreeClassifier) and not estimator.isSet(estimator.weightCol)
            and estimator.getMinInstancesPerNode() == 1)


def draws_rows(estimator: Estimator) -> bool:
    """Whether ``DrawnForest`` stands for the estimator: a forest of whole bootstraps that counts weights, not rows."""
    return (isinstance(estimator, RandomForestClassifier) and estimator.getMinInstancesPerNode() == 1
            and estimator.getBootstrap() and estimator.getSubsamplingRate() == 1.0 and estimator.getLeafCol() == ""
            and not estimator.isSet(estimator.weightCol) and not estimator.isSet(estimator.thresholds))


def _draws(label: str, features: str, trees: int, seed: int) -> Column:
    """How often each tree draws any of ``_rows`` equal rows.

    A bootstrap takes every row a Poisson number of times with mean 1, so ``n`` equal rows together one with mean ``n``.
    The generator starts from a hash of the row: a draw depends neither on partitions nor on a repeated task.
    """

    @F.pandas_udf("array<double>")
    def drawn(key: pd.Series, rows: pd.Series) -> pd.Series:
        starts = zip(key.to_numpy().view(np.uint64).tolist(), rows, strict=True)
        return pd.Series([np.random.default_rng([seed % (1 << 64), k]).poisson(n, trees).astype(float) for k, n in starts])

    return drawn(F.xxhash64(F.col(f"`{label}`"), F.col(f"`{features}`")), F.col(WEIGHT))


class DrawnForestModel(Model):
    """Trees fitted apart whose votes are added as Spark's forest adds them."""

    def __init__(self, forest: RandomForestClassifier, trees: list[Model]):
        super().__init__()
        self.forest, self.trees = forest, trees

    @property
    def featureImportances(self) -> DenseVector:
        total = sum(tree.featureImportances.toArray() for tree in self.trees)
        return DenseVector(total / (total.sum() or 1.0))

    @property
    def toDebugString(self) -> str:
        return "\n".join(tree.toDebugString for tree in self.trees)

    def extractParamMap(self, extra: dict | None = None) -> dict:
        return self.forest.extractParamMap(extra)

    def _transform(self, dataset: DataFrame) -> DataFrame:
        rows, names = dataset, [f"_votes{i}" for i in range(len(self.trees))]
        for tree, name in zip(self.trees, names, strict=True):
            rows = tree.setRawPredictionCol(name).setProbabilityCol("").setPredictionCol("").transform(rows)
        votes = reduce(lambda a, b: F.zip_with(a, b, lambda x, y: x + y), [vector_to_array(name) for name in names])
        total = F.aggregate("_votes", F.lit(0.0), lambda a, v: a + v)
        forest, found = self.forest, {
            "rawPredictionCol": array_to_vector("_votes"),
            "probabilityCol": array_to_vector(F.transform("_votes", lambda v: v / F.col("_total"))),
            "predictionCol": (F.array_position("_votes", F.array_max("_votes")) - 1).cast("double"),
        }
        rows = rows.withColumn("_votes", votes).withColumn("_total", total)
        named = {forest.getOrDefault(param): column for param, column in found.items()}
        return rows.withColumns({name: c for name, c in named.items() if name}).drop("_votes", "_total", *names)


class DrawnForest(Estimator):
    """The forest of an estimator that ``draws_rows``, fitted on ``counted`` rows.

    Each tree gets equal rows as one row, weighted by how often it draws any of them, and is fitted by itself; so the
    fit's cost follows the different rows. Bins come from the drawn weights; rows that a tree does not draw stay with
    weight 0, so all trees know the same classes and categories.
    """

    def __init__(self, forest: RandomForestClassifier, parallelism: int = 4):
        super().__init__()
        self.forest, self.parallelism = forest, parallelism

    def copy(self, extra: dict | None = None) -> DrawnForest:
        return DrawnForest(self.forest.copy(extra or {}), self.parallelism)

    def _fit(self, dataset: DataFrame) -> DrawnForestModel:
        forest, n, seed = self.forest, self.forest.getNumTrees(), self.forest.getSeed()
        label, features = forest.getLabelCol(), forest.getFeaturesCol()
        strategy = forest.getFeatureSubsetStrategy()
        alone = {
            forest.numTrees: 1, forest.bootstrap: False, forest.weightCol: "_tree_rows",
            forest.featureSubsetStrategy: strategy if strategy != "auto" else "sqrt" if n > 1 else "all",
        }
        drawn = _draws(label, features, n, seed).alias("_drawn")
        held = dataset.select(F.col(f"`{label}`"), F.col(f"`{features}`"), drawn).persist()
        # Trees pass over the rows once per level, so few rows are better in few tasks.
        parts = 1 + held.count() // ROWS_PER_TASK

        def fitted(i: int) -> Model:
            rows = held.select(F.col(f"`{label}`"), F.col(f"`{features}`"), F.col("_drawn")[i].alias("_tree_rows"))
            return forest.copy({**alone, forest.seed: seed + i}).fit(rows.coalesce(parts))

        try:
            with ThreadPoolExecutor(max_workers=self.parallelism) as pool:
                trees = list(pool.map(inheritable_thread_target(dataset.sparkSession)(fitted), range(n)))
        finally:
            held.unpersist()
        return DrawnForestModel(forest, trees)


def fit_held(estimator: Estimator, df: DataFrame, drawn_from: int = DRAWN_FROM) -> Model:
    """Fit with the training rows kept on the executors, since every fit reads them many times.

    A forest over ``drawn_from`` rows or more, half of them equal to others, is fitted on the different ones.
    """
    if draws_rows(estimator):
        both = estimator.getLabelCol(), estimator.getFeaturesCol()
        if halves(df, *both, least=drawn_from):
            return DrawnForest(estimator).fit(counted(df, *both))
    if df.storageLevel.useMemory or df.storageLevel.useDisk:
        return estimator.fit(df)
    held = df.persist()
    try:
        return estimator.fit(held)
    finally:
        held.unpersist()


def train_tree(df: DataFrame, label: str = "label", **params) -> Model:
    return fit_held(tree(label, **params), df)


def train_forest(df: DataFrame, label: str = "label", **params) -> Model:
    return fit_held(forest(label, **params), df)


def train_tree_regressor(df: DataFrame, label: str = "label", **params) -> Model:
    return fit_held(tree_regressor(label, **params), df)


def train_logistic(df: DataFrame, label: str = "label", **params) -> Model:
    return fit_held(logistic(label, **params), df)


def train_svm(df: DataFrame, label: str = "label", **params) -> Model:
    return fit_held(svm(label, **params), df)


def score(model, df: DataFrame) -> DataFrame:
    """Predictions for a table without labels."""
    return model.transform(df)


def raw_scores(model, df: DataFrame, out: str = "score") -> DataFrame:
    """Predictions with the raw margin of class 1 and no threshold applied."""
    return model.transform(df).withColumn(out, F.get(vector_to_array("rawPrediction"), F.lit(1)))


def train_als(ratings: DataFrame, rank: int = 10, iterations: int = 6, reg: float = 0.01, seed: int = 42) -> ALSModel:
    """Matrix factorisation of ``(user, item, rating)``.

    A task holds the ratings of one block of users or items and the factors they meet, so the number of blocks follows the
    number of ratings; the first factors are drawn per block. Beyond Spark's ten blocks the item factors are stored after
    each iteration, so that the shuffles before it can be removed. Ratings are read twice.
    """
    blocks = max(ALS_BLOCKS, -(-ratings.count() // RATINGS_PER_BLOCK))
    als = ALS(
        rank=rank, maxIter=iterations, regParam=reg, seed=seed, numUserBlocks=blocks, numItemBlocks=blocks,
        userCol="user", itemCol="item", ratingCol="rating", coldStartStrategy="drop",
    )
    if blocks > ALS_BLOCKS:
        shared_folder(ratings.sparkSession)  # sets the folder of checkpoints
        als.setCheckpointInterval(1)
    return als.fit(ratings)


def recommend(model: ALSModel, users: DataFrame, names: DataFrame | None = None, k: int = 10) -> DataFrame:
    """``(user, item, score[, name])``: the best ``k`` items of each given user."""
    best = recommend_all(model, users, k)
    rows = best.select(F.col("user").cast("int"), F.col("item").cast("int"), F.col("score").cast("float"))
    return rows if names is None else rows.join(names.select("item", "name"), "item", "left")


def _stages(model) -> list:
    """The fitted stages of a pipeline, or the model itself."""
    return list(getattr(model, "stages", [model]))


def describe_model(model) -> DataFrame:
    """``(stage, name, value)``: the parameters of every stage and, for trees, their text form."""
    rows = []
    for stage in _stages(model):
        name = type(stage).__name__
        rows += [(name, param.name, str(value)) for param, value in stage.extractParamMap().items()]
        if hasattr(stage, "toDebugString"):
            rows.append((name, "tree", stage.toDebugString))
    schema = "stage string, name string, value string"
    return SparkSession.getActiveSession().createDataFrame(sorted(rows), schema)


def feature_importances(model, assembled: VectorAssembler | list[str]) -> DataFrame:
    """``(feature, importance)`` of a tree model, or of the last stage of a pipeline, largest first."""
    names = assembled if isinstance(assembled, list) else assembled.getInputCols()
    weights = _stages(model)[-1].featureImportances.toArray()
    rows = [(n, float(v)) for n, v in zip(names, weights, strict=True)]
    frame = SparkSession.getActiveSession().createDataFrame(rows, "feature string, importance double")
    return frame.orderBy(F.desc("importance"), "feature")
