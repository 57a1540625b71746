"""Quality measures of predictions and scores, as one-row (or few-row) tables.

All of them are grouped sums. Curves first shrink to one row per distinct score and then use
``running_totals``, so no task has to sort every score.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fathomline.operators.counts import count_by
from fathomline.operators.ordering import MAX_ROWS_PER_TASK, running_totals
from fathomline.session import materialize


def _number(column: str) -> Column:
    return F.col(column).cast("double")


def test_error(pred: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    """``(test_error, accuracy)``."""
    wrong = F.avg(F.when(_number(label) != _number(prediction), 1.0).otherwise(0.0))
    return pred.agg(wrong.alias("test_error")).withColumn("accuracy", 1 - F.col("test_error"))


test_error.__test__ = False  # not a test case, whatever its name


def class_ratio(df: DataFrame, label: str = "label", positive: float = 1) -> DataFrame:
    """Share of the positive class."""
    return df.agg(F.avg(F.when(F.col(label) == positive, 1.0).otherwise(0.0)).alias("ratio"))


def binary_metrics(
    pred: DataFrame, label: str = "label", prediction: str = "prediction", positive: float = 1
) -> DataFrame:
    """``(accuracy, recall, precision)``; a measure without cases is 0."""
    actual, said = F.col(label) == positive, F.col(prediction) == positive
    counts = pred.agg(
        F.count(F.lit(1)).alias("n"), F.count_if(F.col(label) == F.col(prediction)).alias("right"),
        F.count_if(actual & said).alias("tp"), F.count_if(actual).alias("p"), F.count_if(said).alias("pp"),
    )
    return counts.select(
        F.try_divide("right", "n").alias("accuracy"),
        F.coalesce(F.try_divide("tp", "p"), F.lit(0.0)).alias("recall"),
        F.coalesce(F.try_divide("tp", "pp"), F.lit(0.0)).alias("precision"),
    )


def majority_baseline(train: DataFrame, test: DataFrame, label: str = "label", positive: float = 1) -> DataFrame:
    """``(accuracy, recall)`` on ``test`` of always answering the majority class of ``train``."""
    majority = (
        count_by(train.filter(F.col(label).isNotNull()), label)
        .orderBy(F.desc("n"), label).limit(1).select(label).scalar()
    )
    said = test.withColumn("__said", majority)
    return binary_metrics(said, label, "__said", positive).select("accuracy", "recall")


def confusion_at(scores: DataFrame, threshold: float, label: str = "label", score: str = "score") -> DataFrame:
    """``(label, predicted, n)`` with ``predicted`` 1 strictly above the threshold; four rows always."""
    said = F.when(F.col(score) > threshold, 1).otherwise(0)
    cells = [(a, p) for a in (0, 1) for p in (0, 1)]
    counts = scores.agg(*[F.count_if((F.col(label) == a) & (said == p)).alias(f"c{a}{p}") for a, p in cells])
    rows = F.array(*[
        F.struct(F.lit(a).alias("label"), F.lit(p).alias("predicted"), F.col(f"c{a}{p}").alias("n")) for a, p in cells
    ])
    return counts.select(F.inline(rows))


def curve(
    scores: DataFrame, label: str = "label", score: str = "score", positive: float = 1,
    max_rows_per_task: int = MAX_ROWS_PER_TASK,
) -> DataFrame:
    """``(threshold, tp, fp, tp_so_far, fp_so_far, positives, negatives)``, one row per distinct score.

    The running counts cover every row scored at or above the threshold.
    """
    hit = F.col(label) == positive
    points = materialize(
        scores.groupBy(F.col(score).alias("threshold")).agg(
            F.count_if(hit).alias("tp"), F.count_if(~hit).alias("fp")
        ),
        "curve",
    )
    totals = points.agg(F.sum("tp").alias("positives"), F.sum("fp").alias("negatives"))
    rows = running_totals(points, "threshold", ["tp", "fp"], descending=True, max_rows_per_task=max_rows_per_task)
    return rows.withColumns({
        "positives": totals.select("positives").scalar(), "negatives": totals.select("negatives").scalar(),
    })


def _divide(a: str, b: str) -> Column:
    return F.coalesce(F.try_divide(a, b), F.lit(0.0))


def auroc(scores: DataFrame, **options) -> DataFrame:
    """Exact area under the ROC curve; tied scores count half."""
    rows = curve(scores, **options)
    area = F.sum(F.col("fp") * (F.col("tp_so_far") - F.col("tp") / 2))
    return rows.agg(
        F.try_divide(area, F.max("positives") * F.max("negatives")).alias("auroc")
    )


def recall_at_precision(scores: DataFrame, precision: float = 0.75, **options) -> DataFrame:
    """Recall at the precision-recall point whose precision is nearest; ties go to the lowest threshold.

    The curve ends in the point (precision 1, recall 0).
    """
    rows = curve(scores, **options).select(
        "threshold", _divide("tp_so_far", "positives").alias("recall"),
        F.abs(F.expr("tp_so_far / (tp_so_far + fp_so_far)") - precision).alias("gap"),
    )
    best = rows.agg(F.min("gap").alias("gap"), F.min_by("recall", F.struct("gap", "threshold")).alias("recall"))
    end = abs(1.0 - precision)
    return best.select(F.when(F.col("gap") <= end, F.col("recall")).otherwise(F.lit(0.0)).alias("recall"))


def tpr_at_fpr(scores: DataFrame, fpr: float = 0.16, **options) -> DataFrame:
    """True-positive rate at the ROC point whose false-positive rate is nearest; ties go to the
    highest threshold. The curve starts in the point (0, 0)."""
    rows = curve(scores, **options).select(
        "threshold", _divide("tp_so_far", "positives").alias("tpr"),
        F.abs(_divide("fp_so_far", "negatives") - fpr).alias("gap"),
    )
    best = rows.agg(
        F.min("gap").alias("gap"),
        F.min_by("tpr", F.struct(F.col("gap"), (-F.col("threshold")).alias("t"))).alias("tpr"),
    )
    return best.select(F.when(F.col("gap") < abs(fpr), F.col("tpr")).otherwise(F.lit(0.0)).alias("tpr"))
