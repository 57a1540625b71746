import math

import pytest
from pyspark.ml import Pipeline
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.sql import functions as F

from fathomline.learning import cleaning, evaluation, features, models, tuning
from fathomline.operators.filters import null_counts


@pytest.fixture(scope="module")
def points(spark):
    rows = [(float(i % 20), float((i * 7) % 13), 1.0 if (i % 20) > 9 else 0.0) for i in range(400)]
    df = spark.createDataFrame(rows, "x double, y double, label double")
    return features.assemble(df, "label").select("label", "features").cache()


def test_small_logistic(spark):
    rows = [(80.0, 250.0, 1.0), (70.0, 150.0, 0.0), (80.0, 207.0, 1.0), (65.0, 120.0, 0.0)]
    df = features.assemble(spark.createDataFrame(rows, "a double, b double, label double"), "label")
    model = models.train_logistic(df)
    new = features.assembler(["a", "b"]).transform(spark.createDataFrame([(90.0, 270.0), (62.0, 120.0)], "a double, b double"))
    assert [r.prediction for r in models.score(model, new).collect()] == [1.0, 0.0]


@pytest.mark.parametrize("name", ["DecisionTree", "RandomForest"])
def test_learners(points, name):
    model = models.learner(name).fit(points)
    assert evaluation.test_error(models.score(model, points)).first().test_error < 0.1
    ranked = models.feature_importances(model, ["x", "y"]).collect()
    assert ranked[0].feature == "x" and sum(r.importance for r in ranked) == pytest.approx(1)


def test_unknown_learner():
    with pytest.raises(ValueError):
        models.learner("Nothing")


def test_svm_scores_and_auroc(points):
    scored = models.raw_scores(models.train_svm(points), points)
    exact = evaluation.auroc(scored).first().auroc
    built_in = BinaryClassificationEvaluator(rawPredictionCol="score", numBins=0).evaluate(scored)
    assert exact == pytest.approx(built_in) and exact > 0.95


def test_regressor(points):
    model = models.train_tree_regressor(points)
    assert model.transform(points).filter("abs(prediction - label) > 0.2").count() == 0
    described = {r.name: r.value for r in models.describe_model(model).collect()}
    assert described["maxDepth"] == "5" and "If (feature 0" in described["tree"]


def test_label_round_trip(spark):
    df = spark.createDataFrame([("a",), ("b",), ("b",)], "kind string")
    model = features.index_label("kind").fit(df)
    back = features.invert_label(model, "indexed_label").transform(model.transform(df))
    assert back.filter("kind <> predicted_label").count() == 0


def test_to_labeled(spark):
    df = spark.createDataFrame([(0, 1, 1.0, 5.0), (0, 0, 0.0, 6.0)], "i1 int, i2 int, target double, z double")
    got = features.to_labeled(df, 2, [0, 1]).collect()
    assert [(r.label, list(r.features)) for r in got] == [(1.0, [2.0, 5.0]), (0.0, [0.0, 6.0])]
    assert features.to_labeled(df, 2).first().features.size == 3
    wide = spark.createDataFrame([(9, 0, 1, 8, 1.0, 5.0)], "first int, i1 int, i2 int, last int, target double, z double")
    assert list(features.to_labeled(wide, 4, [1, 2]).first().features) == [9.0, 8.0, 2.0, 5.0]


def test_als_prefers_liked_items(spark):
    rows = [(u, i, 5.0 if (u < 5) == (i < 5) else 1.0) for u in range(10) for i in range(10) if (u + i) % 4]
    df = spark.createDataFrame(rows, "user int, item int, rating float")
    names = spark.createDataFrame([(i, f"item {i}") for i in range(10)], "item int, name string")
    best = models.recommend(models.train_als(df), spark.createDataFrame([(0,)], "user int"), names, 4).collect()
    assert len(best) == 4 and all(r.item < 5 and r.name == f"item {r.item}" for r in best)


def test_tuning(points):
    train, test = points.randomSplit([0.7, 0.3], 1)
    estimator = models.tree()
    grid = tuning.grid_of(estimator, {"maxDepth": [1, 3], "impurity": ["gini", "entropy"]})
    tuned = tuning.tune_split(Pipeline(stages=[estimator]), grid, train)
    assert len(tuned.candidates) == 4 and tuned.best_metric == max(m for _, m in tuned.candidates)
    assert tuning.accuracy_evaluator().evaluate(tuned.model.transform(test)) > 0.9
    folds = tuning.tune_cv(estimator, tuning.grid_of(estimator, tuning.DEPTH_GRID), train)
    assert len(folds.candidates) == 2
    swept = tuning.sweep(estimator, train, test, {"maxDepth": [1, 2]})
    assert [m for _, m in swept.candidates] == sorted((m for _, m in swept.candidates), reverse=True)
    described = models.describe_model(tuned.model).collect()
    assert {"maxDepth", "tree"} <= {r.name for r in described}
    forest = tuning.tune_forest(train, features="indexed_features", stages=[features.index_features(40)], values={"numTrees": [1, 3]})
    assert forest.best_params["numTrees"] in (1, 3)
    assert models.feature_importances(forest.model, ["x", "y"]).first().feature == "x"
    recall = tuning.tune_logistic_recall(train, inverse_penalties=[0.1, 10.0])
    assert len(recall.candidates) == 4 and all(0 <= m <= 1 for _, m in recall.candidates)
    assert math.prod(len(v) for v in tuning.TREE_GRID.values()) == 16


def test_imputation(spark, rows):
    df = spark.createDataFrame(
        [(1, 10.0, "a"), (1, None, "a"), (2, 30.0, None), (2, 50.0, "b"), (None, None, "b"), (None, 4.0, None)],
        "g int, v double, s string",
    )
    assert rows(cleaning.impute_mode(df, ["s"]), "s") == [("a",)] * 4 + [("b",)] * 2
    assert rows(cleaning.impute_mean(df, "v"), "v").count((23.5,)) == 2
    assert rows(cleaning.impute_median(df, "v"), "v").count((20.0,)) == 2
    by = cleaning.impute_median(df, "v", "g")
    assert by.columns == df.columns
    assert rows(by, "g", "v") == [(1, 10.0), (1, 10.0), (2, 30.0), (2, 50.0), (None, 4.0), (None, 4.0)]
    assert cleaning.impute_zero(df).filter("v is null or g is null").count() == 0


def test_clean_medical_leaves_no_nulls(spark):
    df = spark.createDataFrame(
        [(4, 59, None), (None, 35, 1), (4, None, 1), (5, 59, 3)], "`BI-RADS` int, Age int, Shape int"
    )
    cleaned = cleaning.clean_medical(df, df.columns)
    assert {r.nulls for r in null_counts(cleaned).collect()} == {0}
    assert sorted(r.Age for r in cleaned.collect()) == [1, 2, 2, 2]
    assert cleaned.schema["Age"].dataType.simpleString() == "int"


def test_clean_passengers(spark):
    df = spark.createDataFrame(
        [(1, 3, "A, b", "male", 20.0, "S", "1"), (2, 1, "C", "female", None, None, "0"), (3, 1, "D", "male", 40.0, "S", "1")],
        "PassengerId int, Pclass int, Name string, Sex string, Age double, Embarked string, Survived string",
    )
    got = {r.Age: r for r in cleaning.clean_passengers(df).collect()}
    assert sorted(got) == [20.0, 30.0, 40.0]
    assert (got[30.0].SexInt, got[30.0].EmbarkedInt, got[30.0].Survived) == (0, 2, 0.0)
    assert "Name" not in got[30.0].asDict() and got[20.0].SexInt == 1


@pytest.fixture(scope="module")
def scored(spark):
    rows = [(1 if (i * 37) % 11 > i % 5 else 0, float((i * 13) % 17)) for i in range(120)]
    return spark.createDataFrame(rows, "label int, score double"), rows


@pytest.mark.parametrize("limit", [100_000, 4])
def test_curves_match_brute_force(scored, limit):
    df, rows = scored
    thresholds = sorted({s for _, s in rows}, reverse=True)
    p = sum(l for l, _ in rows)
    n = len(rows) - p
    points = []
    for t in thresholds:
        tp = sum(1 for l, s in rows if s >= t and l == 1)
        fp = sum(1 for l, s in rows if s >= t and l == 0)
        points.append((t, tp, fp))
    got = evaluation.curve(df, max_rows_per_task=limit).orderBy(F.desc("threshold")).collect()
    assert [(r.threshold, r.tp_so_far, r.fp_so_far) for r in got] == points
    area = sum((1 if a > b else 0.5 if a == b else 0) for la, a in rows if la for lb, b in rows if not lb) / (p * n)
    assert evaluation.auroc(df, max_rows_per_task=limit).first()[0] == pytest.approx(area)
    precision = [(abs(tp / (tp + fp) - 0.75), t, tp / p) for t, tp, fp in points] + [(0.25, 1e9, 0.0)]
    assert evaluation.recall_at_precision(df, 0.75, max_rows_per_task=limit).first()[0] == pytest.approx(min(precision)[2])
    roc = [(abs(fp / n - 0.16), -t, tp / p) for t, tp, fp in points] + [(0.16, -1e9, 0.0)]
    assert evaluation.tpr_at_fpr(df, 0.16, max_rows_per_task=limit).first()[0] == pytest.approx(min(roc)[2])


def test_counts_of_outcomes(spark, rows):
    df = spark.createDataFrame([(1, 1, 5.0), (1, 0, 1.0), (0, 0, 2.0), (0, 0, 2.5)], "label int, prediction int, score double")
    m = evaluation.binary_metrics(df).first()
    assert (m.accuracy, m.recall, m.precision) == (0.75, 0.5, 1.0)
    assert rows(evaluation.confusion_at(df, 2.0)) == [(0, 0, 1), (0, 1, 1), (1, 0, 1), (1, 1, 1)]
    assert evaluation.class_ratio(df).first().ratio == 0.5
    base = evaluation.majority_baseline(df.filter("label = 0"), df).first()
    assert (base.accuracy, base.recall) == (0.5, 0.0)
