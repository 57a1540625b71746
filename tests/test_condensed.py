"""Trees on weighted rows; archives and pages handled piece by piece."""

import io
import zipfile

import pandas as pd
import pytest
from pyspark.ml import Pipeline
from pyspark.ml.classification import DecisionTreeClassifier
from pyspark.ml.tuning import TrainValidationSplit
from pyspark.sql.readwriter import DataFrameWriter

from fathomline.learning.features import assembler
from fathomline.learning.models import condensed, learner
from fathomline.learning.sweeps import sweep_trees
from fathomline.learning.tuning import accuracy_evaluator, grid_of, tune_split
from fathomline.plans.catalog.scans import whole_document_scan
from fathomline.sources.filings import explode_zip

GRID = {"maxDepth": [1, 5], "minInfoGain": [0.0, 0.05]}


@pytest.fixture(scope="module")
def repeated(spark):
    rows = spark.range(3000).selectExpr("id % 10 a", "id % 7 b", "double((id % 10 > 4) != (id % 7 > 4 and id % 11 < 9)) label")
    return assembler(["a", "b"]).transform(rows).select("label", "features").cache()


@pytest.fixture
def fitted_rows(monkeypatch):
    seen, fit = [], DecisionTreeClassifier._fit
    monkeypatch.setattr(DecisionTreeClassifier, "_fit", lambda self, df: seen.append(df.count()) or fit(self, df))
    return seen


def test_condensed_rows_weigh_what_they_stand_for(spark, repeated):
    got = condensed(repeated)
    assert got.count() == repeated.distinct().count() < 200 and got.agg({"_rows": "sum"}).first()[0] == 3000
    unique = assembler(["x"]).transform(spark.range(50).selectExpr("double(id % 2) label", "id x"))
    assert {r._rows for r in condensed(unique).collect()} == {1.0} and condensed(unique).count() == 50


def test_split_search_is_that_of_spark_on_fewer_rows(repeated, fitted_rows):
    tree = learner("DecisionTree")
    grid = grid_of(tree, GRID)
    got = tune_split(Pipeline(stages=[tree]), grid, repeated, ratio=0.8)
    assert fitted_rows and max(fitted_rows) < 200
    spark_search = TrainValidationSplit(
        estimator=Pipeline(stages=[tree]), estimatorParamMaps=grid, evaluator=accuracy_evaluator(), trainRatio=0.8, seed=42)
    want = spark_search.fit(repeated)
    assert [m for _, m in got.candidates] == pytest.approx(want.validationMetrics)
    assert got.model.stages[0].toDebugString.split("\n")[1:] == want.bestModel.stages[0].toDebugString.split("\n")[1:]


def test_sweep_of_trees_fits_weighted_rows(repeated, fitted_rows):
    swept = sweep_trees(learner("DecisionTree"), repeated, repeated, [1, 5], {"impurity": ["gini"]})
    assert fitted_rows and max(fitted_rows) < 200
    for params, found in swept.candidates:
        model = DecisionTreeClassifier(seed=42, impurity="gini", maxDepth=params["maxDepth"]).fit(repeated)
        assert found == pytest.approx(accuracy_evaluator().evaluate(model.transform(repeated)))


def test_archives_are_opened_one_by_one(spark):
    blobs = []
    for k in range(3):
        buffer = io.BytesIO()
        with zipfile.ZipFile(buffer, "w") as archive:
            archive.writestr(f"{k}.txt", "é" * k)
        blobs.append((bytearray(buffer.getvalue()),))
    got = explode_zip(spark.createDataFrame([*blobs, (None,), (bytearray(b"no"),)], "content binary"), batch_chars=1)
    assert "MapInArrow" in got._jdf.queryExecution().executedPlan().toString()
    assert sorted(tuple(r) for r in got.collect()) == [("0.txt", ""), ("1.txt", "é"), ("2.txt", "éé")]


def test_pages_are_published_by_their_tasks(spark, tmp_path, monkeypatch):
    pd.DataFrame({"page_id": range(5), "html": [f"<p>{k}</p>\n" * k for k in range(5)]}).to_parquet(tmp_path / "pages.parquet")
    given, option = {}, DataFrameWriter.option
    monkeypatch.setattr(DataFrameWriter, "option", lambda self, k, v: given.update({k: v}) or option(self, k, v))
    assert [tuple(r) for r in whole_document_scan(spark, str(tmp_path)).collect()] == [(5, 90)]
    assert given["mapreduce.fileoutputcommitter.algorithm.version"] == "2"
