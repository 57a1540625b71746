"""Forests fitted on different rows, weighted by how often a tree draws them."""

from __future__ import annotations

import numpy as np
import pytest
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from fathomline.learning import models, tuning
from fathomline.learning.features import assembler, index_features


@pytest.fixture(scope="module")
def rows(spark):
    """20,000 rows of 60 kinds: the label follows the first number, save for one row of ten."""
    numbers = spark.range(20_000, numPartitions=4).select((F.col("id") % 6).alias("a"), (F.col("id") % 5).alias("b"), "id")
    label = ((F.col("a") > 2) != (F.col("id") % 7 == 0)).cast("double").alias("label")
    return assembler(["a", "b"]).transform(numbers.select("a", "b", label)).select("label", "features").persist()


def test_a_fit_takes_one_row_of_equal_ones(rows, monkeypatch):
    taken = []
    fit = models.RandomForestClassifier._fit
    monkeypatch.setattr(models.RandomForestClassifier, "_fit", lambda self, df: taken.append(df.count()) or fit(self, df))
    model = models.fit_held(models.forest(numTrees=3), rows, drawn_from=20_000)
    assert taken == [60] * 3
    assert models.feature_importances(model, ["a", "b"]).first().feature == "a"
    right = model.transform(rows).agg(F.avg((F.col("prediction") == F.col("label")).cast("double"))).first()[0]
    assert right == pytest.approx(6 / 7, abs=0.01)


def test_few_or_different_rows_keep_the_forest_of_spark(rows):
    assert not isinstance(models.fit_held(models.forest(), rows, drawn_from=20_001), models.DrawnForestModel)
    different = rows.limit(100).select("label", "features").distinct()
    assert not isinstance(models.fit_held(models.forest(), different, drawn_from=0), models.DrawnForestModel)


def test_draws_are_those_of_a_bootstrap(rows):
    """Each tree draws about as many rows as there are, independently, and the same on other partitions."""
    counted = models.counted(rows).persist()

    def drawn(df):
        found = df.select("label", vector_to_array("features").alias("f"), models._draws("label", "features", 40, 7).alias("d"), "_rows")
        return {(r.label, *r.f): (r._rows, *r.d) for r in found.collect()}

    first = drawn(counted)
    assert first == drawn(counted.repartition(7))
    table = np.array(list(first.values()))
    apart = (table[:, 1:] - table[:, :1]) / np.sqrt(table[:, :1])  # Poisson: mean and variance are the number of rows
    assert abs(apart.mean()) < 0.1 and apart.var() == pytest.approx(1.0, abs=0.15)
    assert len({tuple(column) for column in table[:, 1:].T}) == 40


def test_votes_add_up_as_in_the_forest_of_spark(rows):
    """A forest whose trees stand apart predicts what the trees' votes, added by hand, say."""
    model = models.fit_held(models.forest(numTrees=3, maxDepth=2), rows, drawn_from=0)
    test = rows.select("label", "features").distinct()
    found = model.transform(test)
    assert found.columns == ["label", "features", "rawPrediction", "probability", "prediction"]
    for r in found.collect():
        votes = sum(tree.trees[0].predictRaw(r.features).toArray() / tree.trees[0].predictRaw(r.features).toArray().sum() for tree in model.trees)
        assert r.rawPrediction.toArray() == pytest.approx(votes)
        assert r.probability.toArray() == pytest.approx(votes / 3)
        assert r.prediction == votes.argmax()


def test_a_search_takes_one_row_of_equal_ones(rows, monkeypatch):
    taken = []
    fit = models.RandomForestClassifier._fit
    monkeypatch.setattr(models.RandomForestClassifier, "_fit", lambda self, df: taken.append(df.count()) or fit(self, df))
    found = tuning.tune_forest(rows, features="indexed_features", stages=[index_features(40)],
                               values={"numTrees": [1, 3]}, drawn_from=20_000)
    assert max(taken) == 60 and len(found.candidates) == 2
    assert found.best_metric == pytest.approx(6 / 7, abs=0.03)
    assert models.feature_importances(found.model, ["a", "b"]).first().feature == "a"
