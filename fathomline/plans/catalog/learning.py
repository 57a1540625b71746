"""Feature building and models over order lines and documents."""

from __future__ import annotations

from pyspark.ml import Pipeline
from pyspark.ml.evaluation import RegressionEvaluator
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from fathomline.learning.cleaning import clean_medical
from fathomline.learning.evaluation import auroc, binary_metrics, test_error
from fathomline.learning.features import assemble, assembler, index_features, index_label, invert_label, to_labeled
from fathomline.learning.models import (
    describe_model, feature_importances, fit_held, learner, raw_scores, recommend, score, train_als, train_forest,
    train_logistic, train_svm, train_tree, train_tree_regressor,
)
from fathomline.learning.retrieval import top_products
from fathomline.learning.sweeps import prefix_confusions, sweep_trees
from fathomline.learning.tuning import (
    DEPTH_GRID, FOREST_GRID, TREE_GRID, accuracy_evaluator, grid_of, sweep, tune_cv, tune_forest, tune_logistic_recall,
    tune_split,
)
from fathomline.operators.filters import random_split
from fathomline.plans.catalog.registry import query, table
from fathomline.plans.catalog.similarity import ratings
from fathomline.session import materialize, spread

NUMBERS = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


def _lines(spark, folder):
    """Order lines labelled by whether they are expensive."""
    return spread(table(spark, folder, "lineitem").select(*NUMBERS)).select(
        *NUMBERS, F.when(F.col("l_extendedprice") > 30000, 1.0).otherwise(0.0).alias("label")
    )


def _vectors(spark, folder):
    return assembler(NUMBERS[:1] + NUMBERS[2:]).transform(_lines(spark, folder)).select("label", "features")


def _parts(spark, folder):
    return random_split(_vectors(spark, folder), [0.7, 0.3], 42)


def _metrics(spark, **values):
    """A one-row table of measured values."""
    return spark.range(1).select(*[F.lit(v).alias(k) for k, v in values.items()])


@query("""
select l_orderkey, l_linenumber, l_partkey, l_suppkey,
       round(l_quantity + l_extendedprice + l_discount + l_tax, 4) as total, 4 as width
from lineitem
""")
def assembled_features(spark, folder):
    keys = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"]
    packed = assembler(NUMBERS).transform(table(spark, folder, "lineitem").select(*keys, *NUMBERS))
    values = vector_to_array("features")
    return packed.select(
        *keys, F.round(F.aggregate(values, F.lit(0.0), lambda a, b: a + b), 4).alias("total"),
        F.size(values).alias("width"),
    )


@query("""
select event_type, (row_number() over (order by count(*) desc, event_type) - 1)::double as indexed_label
from events group by event_type
""")
def indexed_labels(spark, folder):
    rows = table(spark, folder, "events").select("event_type")
    return index_label("event_type").fit(rows).transform(rows).distinct()


@query("select event_type, event_type as predicted_label, count(*) as n from events group by 1")
def inverted_labels(spark, folder):
    rows = table(spark, folder, "events").select("event_type")
    model = index_label("event_type").fit(rows)
    back = invert_label(model, "indexed_label").transform(model.transform(rows))
    return back.groupBy("event_type", "predicted_label").agg(F.count(F.lit(1)).alias("n"))


@query("""
with d as (select n_regionkey as r, dense_rank() over (order by n_regionkey) - 1 as code from nation group by 1)
select c_custkey, code::double as region_index, c_acctbal as balance
from customer join nation on n_nationkey = c_nationkey join d on r = n_regionkey
""")
def indexed_features(spark, folder):
    """A vector slot with at most five values becomes a category; the other slot keeps its numbers."""
    nation = table(spark, folder, "nation").select("n_nationkey", "n_regionkey")
    rows = table(spark, folder, "customer").join(nation, F.col("c_nationkey") == F.col("n_nationkey"))
    packed = assembler(["n_regionkey", "c_acctbal"]).transform(rows)
    indexed = index_features(5).fit(packed).transform(packed)
    values = vector_to_array("indexed_features")
    return indexed.select("c_custkey", values[0].alias("region_index"), values[1].alias("balance"))


@query("""
select case when l_tax > 0.04 then 3 when l_discount > 0.05 then 2 when l_quantity > 25 then 1 else 0 end::double
         as marked, l_linenumber::double as label, count(*) as n, round(sum(l_extendedprice), 1) as price
from lineitem group by 1, 2
""")
def labeled_rows(spark, folder):
    """Label by position, leading indicators collapsed into the first feature."""
    rows = table(spark, folder, "lineitem").select(
        (F.col("l_quantity") - 25).alias("a"), (F.col("l_discount") - 0.05).alias("b"),
        (F.col("l_tax") - 0.04).alias("c"), "l_linenumber", "l_extendedprice",
    )
    values = vector_to_array("features")
    packed = to_labeled(rows, 3, [0, 1, 2]).select("label", values[0].alias("marked"), values[1].alias("p"))
    return packed.groupBy("marked", "label").agg(
        F.count(F.lit(1)).alias("n"), F.round(F.sum("p"), 1).alias("price")
    )


@query("""
with g as (select nullif(p_size, 1) as age, nullif(p_brand, 'Brand#1') as shape from part),
f as (select coalesce(age, (select age from g where age is not null group by age order by count(*) desc, age limit 1))
               as age,
             coalesce(shape, (select shape from g where shape is not null group by shape
                              order by count(*) desc, shape limit 1)) as shape from g)
select case when age <= 40 then 1 else 2 end as bucket, shape, count(*) as n from f group by 1, 2
""")
def cleaned_medical(spark, folder):
    """The medical cleaning steps on a table of the same shape."""
    rows = table(spark, folder, "part").select(
        F.nullif("p_size", F.lit(1)).alias("Age"), F.nullif("p_brand", F.lit("Brand#1")).alias("shape")
    )
    cleaned = clean_medical(rows, ["Age", "shape"])
    return cleaned.groupBy(F.col("Age").alias("bucket"), "shape").agg(F.count(F.lit(1)).alias("n"))


@query()
def decision_tree(spark, folder):
    train, test = _parts(spark, folder)
    return test_error(score(train_tree(train), test))


@query()
def named_learners(spark, folder):
    """Both learners by name, compared on the same split."""
    train, test = _parts(spark, folder)
    frames = [
        test_error(score(fit_held(learner(name), train), test)).withColumn("learner", F.lit(name))
        for name in ("DecisionTree", "RandomForest")
    ]
    return frames[0].unionByName(frames[1])


@query()
def random_forest(spark, folder):
    train, test = _parts(spark, folder)
    indexer = index_features(40).fit(train)
    model = train_forest(
        indexer.transform(train), features="indexed_features", numTrees=5, impurity="entropy", maxDepth=30, maxBins=300)
    return test_error(score(model, indexer.transform(test)))


@query()
def forest_importances(spark, folder):
    model = train_forest(_vectors(spark, folder), numTrees=10)
    return feature_importances(model, NUMBERS[:1] + NUMBERS[2:])


@query()
def tree_regression(spark, folder):
    rows = assemble(_lines(spark, folder).select("l_quantity", "l_discount", "l_tax", "l_extendedprice"), "l_extendedprice")
    train, test = random_split(rows, [0.7, 0.3], 42)
    model = train_tree_regressor(train, "l_extendedprice")
    rmse = RegressionEvaluator(labelCol="l_extendedprice", metricName="rmse").evaluate(model.transform(test))
    return _metrics(spark, rmse=rmse)


@query()
def logistic_regression(spark, folder):
    train, test = _parts(spark, folder)
    return binary_metrics(score(train_logistic(train), test))


@query()
def support_vectors(spark, folder):
    """Raw margins without a threshold, measured by the area under the ROC curve."""
    train, test = _parts(spark, folder)
    return auroc(raw_scores(train_svm(train, maxIter=150), test))


@query()
def recommendations(spark, folder):
    rows = materialize(ratings(spark, folder).select(
        F.col("user").cast("int"), F.col("item").cast("int"), F.col("rating").cast("float")
    ), "ratings")
    names = table(spark, folder, "part").select(F.col("p_partkey").cast("int").alias("item"), F.col("p_name").alias("name"))
    model = train_als(rows)
    return recommend(model, rows.select("user").distinct(), names, 10)


@query("""
with u as (select c_custkey as user, c_nationkey - 12 as a, floor(c_acctbal / 500)::bigint as b, length(c_mktsegment) - 8 as c
           from customer),
i as (select p_partkey as item, p_size - 10 as a, floor(p_retailprice / 100)::bigint as b, length(p_name) - 9 as c from part),
s as (select user, item, (u.a * i.a + u.b * i.b + u.c * i.c)::double as score from u cross join i),
r as (select *, row_number() over (partition by user order by score desc, item)::integer as rank from s)
select user, item, score, rank from r where rank <= 10
""")
def largest_products(spark, folder):
    """Ten parts of largest inner product for every customer, on factors of whole numbers, so that ties are exact."""

    def factors(*columns):
        return F.array(*[c.cast("double") for c in columns]).alias("factors")

    users = table(spark, folder, "customer").select(F.col("c_custkey").alias("user"), factors(
        F.col("c_nationkey") - 12, F.floor(F.col("c_acctbal") / 500), F.length("c_mktsegment") - 8))
    items = table(spark, folder, "part").select(F.col("p_partkey").alias("item"), factors(
        F.col("p_size") - 10, F.floor(F.col("p_retailprice") / 100), F.length("p_name") - 9))
    return top_products(users, items, 10).drop("scored")


@query()
def tuned_split(spark, folder):
    train, test = _parts(spark, folder)
    estimator = learner("DecisionTree")
    grid = grid_of(estimator, TREE_GRID)
    tuned = tune_split(Pipeline(stages=[estimator]), grid, train, ratio=0.9)
    accuracy = accuracy_evaluator()
    return _metrics(
        spark, depth=tuned.best_params["maxDepth"], validation=tuned.best_metric,
        train_accuracy=accuracy.evaluate(tuned.model.transform(train)),
        test_accuracy=accuracy.evaluate(tuned.model.transform(test)),
    )


@query()
def tuned_forest(spark, folder):
    train, _ = _parts(spark, folder)
    tuned = tune_forest(train, features="indexed_features", stages=[index_features(40)], values=FOREST_GRID)
    return _metrics(spark, trees=tuned.best_params["numTrees"], validation=tuned.best_metric)


@query()
def tuned_folds(spark, folder):
    train, test = _parts(spark, folder)
    estimator = learner("DecisionTree")
    tuned = tune_cv(estimator, grid_of(estimator, DEPTH_GRID), train)
    return _metrics(
        spark, depth=tuned.best_params["maxDepth"], validation=tuned.best_metric,
        test_accuracy=accuracy_evaluator().evaluate(tuned.model.transform(test)),
    )


@query()
def tuned_recall(spark, folder):
    train, _ = _parts(spark, folder)
    tuned = tune_logistic_recall(train)
    rows = [(p["elasticNetParam"], p["regParam"], m) for p, m in tuned.candidates]
    return spark.createDataFrame(rows, "elastic_net double, reg double, recall double")


@query()
def parameter_sweep(spark, folder):
    """Every combination trained on one part and ranked on the other; both depths come from one fit."""
    train, test = _parts(spark, folder)
    swept = sweep_trees(learner("DecisionTree"), train, test, [1, 20], {"impurity": ["gini", "entropy"], "maxBins": [10, 300]})
    rows = [(p["impurity"], p["maxDepth"], p["maxBins"], m) for p, m in swept.candidates]
    return spark.createDataFrame(rows, "impurity string, depth int, bins int, accuracy double")


def _taxed(spark, folder):
    """Order lines that are large or highly taxed, but not both; every fifth order is kept for testing."""
    lines = spread(table(spark, folder, "lineitem").select("l_orderkey", "l_quantity", "l_tax"))
    odd = (F.col("l_quantity") > 30) != (F.col("l_tax") > 0.075)
    return assembler(["l_quantity", "l_tax"]).transform(lines).select(
        odd.cast("double").alias("label"), "features", (F.col("l_orderkey") % 5 == 0).alias("test"))


_TAXED = """
with t as (select l_orderkey % 5 = 0 as test, l_quantity > 30 as big, (l_quantity > 30) <> (l_tax > 0.075) as label from lineitem),
m as (select avg(label::int) > 0.5 as major from t where not test),
s as (select 0 as depth, avg((label = major)::int) as accuracy from t, m where test
      union all select 1, avg((label = big)::int) from t where test union all select 2, 1.0 union all select 20, 1.0)
"""


@query(_TAXED + """
select impurity, bins, depth, round(accuracy, 9) as accuracy
from s, (select unnest(['gini', 'entropy']) as impurity) i, (select unnest([64, 128]) as bins) b
""")
def shared_sweep(spark, folder):
    """All depths of a sweep out of one fit per impurity and number of bins, on a rule that two levels express."""
    rows = _taxed(spark, folder)
    swept = sweep_trees(learner("DecisionTree"), rows.filter("not test"), rows.filter("test"), [0, 1, 2, 20],
                        {"impurity": ["gini", "entropy"], "maxBins": [64, 128]})
    found = [(p["impurity"], p["maxBins"], p["maxDepth"], round(m, 9)) for p, m in swept.candidates]
    return spark.createDataFrame(found, "impurity string, bins int, depth int, accuracy double")


@query(_TAXED + "select (select min(depth) from s where accuracy = 1.0) as depth, 1.0::double as accuracy, 3 as leaves_above")
def swept_winner(spark, folder):
    """The smallest depth among the best, and how many splits its tree has."""
    rows = _taxed(spark, folder)
    best = sweep_trees(learner("DecisionTree"), rows.filter("not test"), rows.filter("test"), [0, 1, 2, 20], {"maxBins": [64]})
    return _metrics(spark, depth=best.best_params["maxDepth"], accuracy=best.best_metric, leaves_above=(best.model.numNodes - 1) // 2)


@query("""
select l_shipmode as label, count(*) as n from (select case when l_quantity > 25 then 1.0 else 0.0 end as l_shipmode, l_orderkey
from lineitem) where l_orderkey % 5 = 0 group by 1
""")
def forest_prefix_rows(spark, folder):
    """Rows of the test part by label, as every prefix of a forest has counted them."""
    lines = spread(table(spark, folder, "lineitem").select("l_orderkey", "l_quantity", "l_discount"))
    rows = assembler(["l_quantity", "l_discount"]).transform(lines).select(
        (F.col("l_quantity") > 25).cast("double").alias("label"), "features", (F.col("l_orderkey") % 5 == 0).alias("test"))
    model = learner("RandomForest", numTrees=4, maxDepth=3).fit(rows.filter("not test"))
    counts = prefix_confusions(model, rows.filter("test"), [1, 3], [1, 4])
    by_label = {frozenset(_by_label(c).items()) for c in counts.values()}
    (only,) = by_label  # the same rows, whatever the prefix predicts
    return spark.createDataFrame(sorted(only), "label double, n long")


def _by_label(confusion):
    found = {}
    for (label, _), n in confusion.items():
        found[label] = found.get(label, 0) + n
    return found


@query()
def described_model(spark, folder):
    return describe_model(train_tree(_vectors(spark, folder), maxDepth=2))
