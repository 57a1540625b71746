import random

import pytest
from pyspark.ml.feature import VectorAssembler

from fathomline.learning.models import forest, tree
from fathomline.learning.sweeps import accuracy_of, prefix_confusions, sweep_trees
from fathomline.learning.tuning import accuracy_evaluator, sweep


@pytest.fixture(scope="module")
def parts(spark):
    draw = random.Random(8)
    rows = [(float(draw.randrange(40)), float(draw.randrange(7)), draw.random()) for _ in range(1_500)]
    rows = [(a, b, c, float(int(a + 3 * b) // 15 % 3 if c < 0.85 else draw.randrange(3))) for a, b, c in rows]
    df = spark.createDataFrame(rows, "a double, b double, c double, label double")
    df = VectorAssembler(inputCols=["a", "b"], outputCol="features").transform(df)
    return df.filter("c < 0.7").cache(), df.filter("c >= 0.7 or c < 0.1").cache()


@pytest.mark.parametrize("options", [{"impurity": "gini"}, {"impurity": "entropy", "minInfoGain": 0.02}])
def test_prefixes_of_a_tree_are_the_trees_of_smaller_depth(parts, options):
    train, test = parts
    depths = [0, 1, 2, 4, 9]
    found = prefix_confusions(tree(maxDepth=9, maxBins=64, **options).fit(train), test, depths)
    for d in depths:
        alone = tree(maxDepth=d, maxBins=64, **options).fit(train).transform(test)
        want = {(r.label, r.prediction): r["count"] for r in alone.groupBy("label", "prediction").count().collect()}
        assert found[1, d] == want


def test_whole_forest_predicts_as_the_model(parts):
    train, test = parts
    model = forest(numTrees=5, maxDepth=4).fit(train)
    found = prefix_confusions(model, test, [2, 4], [1, 3, 5])
    want = {(r.label, r.prediction): r["count"] for r in model.transform(test).groupBy("label", "prediction").count().collect()}
    assert found[5, 4] == want
    assert {sum(c.values()) for c in found.values()} == {test.count()}


def test_sweep_equals_separate_fits_with_fewer_of_them(parts, monkeypatch):
    train, test = parts
    estimator, values, depths = tree(), {"impurity": ["gini", "entropy"], "maxBins": [8, 64]}, [1, 3, 6]
    fits = []
    fit = type(estimator)._fit
    monkeypatch.setattr(type(estimator), "_fit", lambda self, data: fits.append(1) or fit(self, data))
    shared = sweep_trees(estimator, train, test, depths, values)
    assert len(fits) <= 4 + 1  # and perhaps the best one at its depth
    apart = sweep(estimator, train, test, {**values, "maxDepth": depths})

    def plain(tuned):
        return sorted((sorted(p.items()), round(m, 12)) for p, m in tuned.candidates)

    assert plain(shared) == plain(apart)
    assert shared.best_metric == pytest.approx(apart.best_metric)
    assert accuracy_evaluator().evaluate(shared.model.transform(test)) == pytest.approx(shared.best_metric)


def test_accuracy_and_wrong_requests(parts):
    train, test = parts
    assert accuracy_of({}) == 0.0 and accuracy_of({(1.0, 1.0): 3, (1.0, 0.0): 1}) == 0.75
    with pytest.raises(ValueError):
        sweep_trees(tree(), train, test, [1], {}, trees=[1, 2])
    with pytest.raises(ValueError):
        prefix_confusions(tree(maxDepth=1).fit(train), test, [1], [2])
