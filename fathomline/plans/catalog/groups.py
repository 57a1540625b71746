"""Models on data whose best answer is known in closed form, so that SQL can state every prediction.

A tree that is deep enough predicts the majority (or the mean) of every distinct feature value, and so does a linear
model with one slot per value. The labels are not separable: every group holds both.
Orders whose key divides by five are kept for testing.
"""

from __future__ import annotations

from pyspark.ml import Pipeline
from pyspark.ml.feature import OneHotEncoder
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from fathomline.learning.features import assembler, index_features
from fathomline.learning.models import (
    describe_model, feature_importances, learner, raw_scores, score, train_forest, train_logistic, train_svm, train_tree,
    train_tree_regressor,
)
from fathomline.learning.tuning import grid_of, tune_cv, tune_forest, tune_split
from fathomline.plans.catalog.registry import query, table
from fathomline.session import spread

BINS = 64  # more than there are quantities, so every one is a bin of its own


def _lines(spark, folder, label, *features):
    """``label``, ``group``, ``features`` and ``test`` of all order lines; the first feature is the group."""
    lines = spread(table(spark, folder, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity", "l_discount"))
    return assembler(list(features)).transform(lines).select(
        label.cast("double").alias("label"), F.col(features[0]).cast("double").alias("group"), "features",
        (F.col("l_orderkey") % 5 == 0).alias("test"))


def _parts(rows):
    return rows.filter("not test").drop("test"), rows.filter("test").drop("test")


def _by_group(predicted):
    """Test rows and wrong ones of every group and prediction."""
    return predicted.groupBy("group", "prediction").agg(
        F.count(F.lit(1)).alias("n"), F.count_if(F.col("label") != F.col("prediction")).alias("wrong"))


def _majority(group, label):
    """SQL of ``_by_group`` for a model that predicts each group's majority of the training rows, ties as 0."""
    return f"""
with t as (select l_orderkey % 5 = 0 as test, {group}::double as g, ({label})::integer as label from lineitem),
m as (select g, (avg(label) > 0.5)::integer as major from t where not test group by g)
select t.g as "group", major::double as prediction, count(*) as n, count(*) filter (label <> major) as wrong
from t join m on t.g = m.g where test group by 1, 2
"""


# In bands of five quantities, turned over for some discounts: no tree below four levels follows it.
_BANDED_SQL = "(floor((l_quantity - 1) / 5)::integer % 2 = 1) <> (l_discount > 0.085)"
# Some line numbers, unless the discount is large: positive rows lie in positive groups only.
_NUMBERED_SQL = "l_linenumber in (2, 3, 6) and l_discount < 0.085"


def _banded():
    return (F.floor((F.col("l_quantity") - 1) / 5) % 2 == 1) != (F.col("l_discount") > 0.085)


def _numbered():
    return F.col("l_linenumber").isin(2, 3, 6) & (F.col("l_discount") < 0.085)


def _slots(rows):
    """The group as one slot per value instead of one number; the last value has none."""
    encoder = OneHotEncoder(inputCols=["group"], outputCols=["slots"])
    return encoder.fit(rows).transform(rows).drop("features").withColumnRenamed("slots", "features")


@query(_majority("l_quantity", _BANDED_SQL))
def grouped_tree(spark, folder):
    train, test = _parts(_lines(spark, folder, _banded(), "l_quantity"))
    return _by_group(score(train_tree(train, maxDepth=30, maxBins=BINS), test))


@query(_majority("l_quantity", _BANDED_SQL))
def grouped_forest(spark, folder):
    """Trees without resampling see the same rows, so the forest votes as one of them."""
    train, test = _parts(_lines(spark, folder, _banded(), "l_quantity"))
    return _by_group(score(train_forest(train, maxDepth=30, maxBins=BINS, bootstrap=False), test))


@query("""
with t as (select l_orderkey % 5 = 0 as test, l_quantity::double as g, l_discount * g as label from lineitem),
m as (select g, avg(label) as mean from t where not test group by g)
select t.g as "group", round(mean, 6) as prediction, count(*) as n, round(sqrt(avg((label - mean) ** 2)), 6) as rmse
from t join m on t.g = m.g where test group by 1, 2
""")
def grouped_regression(spark, folder):
    """Every quantity's mean of a label that grows with it, and the error left in its test rows."""
    train, test = _parts(_lines(spark, folder, F.col("l_discount") * F.col("l_quantity"), "l_quantity"))
    predicted = score(train_tree_regressor(train, maxDepth=30, maxBins=BINS), test)
    return predicted.groupBy("group", F.round("prediction", 6).alias("prediction")).agg(
        F.count(F.lit(1)).alias("n"), F.round(F.sqrt(F.avg((F.col("label") - F.col("prediction")) ** 2)), 6).alias("rmse"))


@query("""
with t as (select l_orderkey % 5 = 0 as test, l_linenumber::double as g, (l_quantity > 7 * l_linenumber)::integer as label from lineitem),
m as (select g, avg(label) as share from t where not test group by g)
select t.g as "group", (share > 0.5)::integer::double as prediction, round(share, 3) as probability, count(*) as n
from t join m on t.g = m.g where test group by 1, 2, 3
""")
def grouped_logistic(spark, folder):
    """Without penalty, the fitted probability of a group is its share of positive rows."""
    train, test = _parts(_slots(_lines(spark, folder, F.col("l_quantity") > 7 * F.col("l_linenumber"), "l_linenumber")))
    predicted = score(train_logistic(train, maxIter=200, tol=1e-10), test)
    chance = F.round(vector_to_array("probability")[1], 3).alias("probability")
    return predicted.groupBy("group", "prediction", chance).agg(F.count(F.lit(1)).alias("n"))


@query(_majority("l_linenumber", "l_quantity > 7 * l_linenumber"))
def grouped_support_vectors(spark, folder):
    """The least hinge loss of a group lies at the sign of its majority, with raw scores cut at zero."""
    train, test = _parts(_slots(_lines(spark, folder, F.col("l_quantity") > 7 * F.col("l_linenumber"), "l_linenumber")))
    scored = raw_scores(train_svm(train, maxIter=15), test)
    return _by_group(scored.withColumn("prediction", (F.col("score") > 0).cast("double")))


@query(_majority("l_quantity", _BANDED_SQL))
def grouped_split_search(spark, folder):
    """One validation part: the deep tree without a wanted gain wins and is fitted again on all training rows."""
    train, test = _parts(_lines(spark, folder, _banded(), "l_quantity"))
    estimator = learner("DecisionTree", maxBins=BINS)
    grid = grid_of(estimator, {"maxDepth": [1, 30], "minInfoGain": [0.0, 0.9]})
    return _by_group(score(tune_split(Pipeline(stages=[estimator]), grid, train).model, test))


@query(_majority("l_quantity", _BANDED_SQL))
def grouped_fold_search(spark, folder):
    """The same choice by three folds."""
    train, test = _parts(_lines(spark, folder, _banded(), "l_quantity"))
    estimator = learner("DecisionTree", maxBins=BINS)
    return _by_group(score(tune_cv(estimator, grid_of(estimator, {"maxDepth": [1, 30]}), train).model, test))


@query(_majority("l_linenumber", _NUMBERED_SQL))
def grouped_forest_search(spark, folder):
    """A gain of 0.9 cannot be had, so the forest that asks for none wins; line numbers are indexed before."""
    train, test = _parts(_lines(spark, folder, _numbered(), "l_linenumber"))
    tuned = tune_forest(train, features="indexed_features", stages=[index_features(40)],
                        values={"numTrees": [3], "minInfoGain": [0.0, 0.9]})
    return _by_group(score(tuned.model, test))


@query("""
with t as (select l_quantity::integer as q from lineitem where l_orderkey % 5 <> 0),
c as (select (max(q) filter (q <= 25) + min(q) filter (q > 25)) / 2 as cut from t)
select unnest([{name: 'impurity', value: 'gini'}, {name: 'maxBins', value: '64'}, {name: 'maxDepth', value: '3'}, {name: 'tree',
    value: 'depth=1, numNodes=3, numClasses=2, numFeatures=2|If (feature 0 <= ' || cut || ')|Predict: 0.0|Else (feature 0 > '
    || cut || ')|Predict: 1.0'}], recursive := true) from c
""")
def described_stump(spark, folder):
    """Text and parameters of a tree that needs one cut, half way between two quantities."""
    train, _ = _parts(_lines(spark, folder, F.col("l_quantity") > 25, "l_quantity", "l_discount"))
    described = describe_model(train_tree(train, maxDepth=3, maxBins=BINS))
    text = F.regexp_replace(F.regexp_replace(F.trim(F.regexp_replace("value", r"^DecisionTreeClassificationModel: uid=\w+, ", "")),
                                             r"\s*\n\s*", "|"), r"\|$", "")
    return described.filter(F.col("name").isin("impurity", "maxBins", "maxDepth", "tree")).select("name", text.alias("value"))


@query("select unnest([{feature: 'l_quantity', importance: 1.0::double}, {feature: 'l_discount', importance: 0.0::double}], recursive := true)")
def lone_importance(spark, folder):
    """All importance lies with the one feature that the label is made of."""
    train, _ = _parts(_lines(spark, folder, F.col("l_quantity") > 25, "l_quantity", "l_discount"))
    model = train_forest(train, numTrees=3, maxBins=BINS, featureSubsetStrategy="all")
    return feature_importances(model, ["l_quantity", "l_discount"])
