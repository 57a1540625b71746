"""Quality measures: document quality labels, with the text length as the score."""

from __future__ import annotations

from pyspark.sql import functions as F

from fathomline.learning.evaluation import (
    auroc, binary_metrics, class_ratio, confusion_at, curve, majority_baseline, recall_at_precision, test_error,
    tpr_at_fpr,
)
from fathomline.operators.counts import chance_agreement, class_probabilities
from fathomline.plans.catalog.registry import query, table


def _scored(spark, folder):
    labels = table(spark, folder, "labels").select("doc_id", F.col("quality").alias("label"))
    documents = table(spark, folder, "documents").select("doc_id", "lang", F.col("n_chars").alias("score"))
    return labels.join(documents, "doc_id")


def _predicted(spark, folder):
    return _scored(spark, folder).withColumn("prediction", F.when(F.col("score") > 1500, 1).otherwise(0))


_SCORED = """
with s as (select l.quality as label, d.n_chars as score, d.lang from labels l join documents d using (doc_id)),
p as (select *, case when score > 1500 then 1 else 0 end as prediction from s)
"""

_CURVE = _SCORED + """
, g as (select score as threshold, count(*) filter (where label = 1) as tp, count(*) filter (where label <> 1) as fp
        from s group by score),
c as (select threshold, tp, fp, (sum(tp) over w)::bigint as tp_so_far, (sum(fp) over w)::bigint as fp_so_far,
             (sum(tp) over ())::bigint as positives, (sum(fp) over ())::bigint as negatives
      from g window w as (order by threshold desc rows between unbounded preceding and current row))
"""


@query("""
select event_type, count(*) as n, count(*) / (select count(*) from events) as probability from events group by 1
""")
def class_shares(spark, folder):
    return class_probabilities(table(spark, folder, "events"), "event_type")


@query("""
with a as (select n_regionkey as k, count(*) / sum(count(*)) over () as p
           from customer join nation on n_nationkey = c_nationkey group by 1),
b as (select n_regionkey as k, count(*) / sum(count(*)) over () as q
      from supplier join nation on n_nationkey = s_nationkey group by 1)
select round(sum(p * q), 9) as chance from a join b using (k)
""")
def chance_of_agreement(spark, folder):
    nation = table(spark, folder, "nation").select("n_nationkey", "n_regionkey")
    customers = table(spark, folder, "customer").join(nation, F.col("c_nationkey") == F.col("n_nationkey"))
    suppliers = table(spark, folder, "supplier").join(nation, F.col("s_nationkey") == F.col("n_nationkey"))
    rows = chance_agreement(customers.select("n_regionkey"), suppliers.select("n_regionkey"), "n_regionkey")
    return rows.select(F.round("chance", 9).alias("chance"))


@query("select round(avg(case when toxic = 1 then 1.0 else 0.0 end), 9) as ratio from labels")
def positive_share(spark, folder):
    return class_ratio(table(spark, folder, "labels"), "toxic").select(F.round("ratio", 9).alias("ratio"))


@query(_SCORED + """
, m as (select label from s where lang = 'en' group by label order by count(*) desc, label limit 1)
select round(count(*) filter (where label = (select label from m)) / count(*), 9) as accuracy,
       round(coalesce(count(*) filter (where label = 1 and (select label from m) = 1)
             / nullif(count(*) filter (where label = 1), 0), 0), 9) as recall
from s where lang <> 'en'
""")
def majority_class_baseline(spark, folder):
    rows = _scored(spark, folder)
    result = majority_baseline(rows.filter("lang = 'en'"), rows.filter("lang <> 'en'"))
    return result.select(F.round("accuracy", 9).alias("accuracy"), F.round("recall", 9).alias("recall"))


@query(_SCORED + """
select round(count(*) filter (where label = prediction) / count(*), 9) as accuracy,
       round(count(*) filter (where label = 1 and prediction = 1) / count(*) filter (where label = 1), 9) as recall,
       round(count(*) filter (where label = 1 and prediction = 1) / count(*) filter (where prediction = 1), 9)
         as precision
from p
""")
def prediction_metrics(spark, folder):
    rows = binary_metrics(_predicted(spark, folder))
    return rows.select(*[F.round(c, 9).alias(c) for c in ("accuracy", "recall", "precision")])


@query(_SCORED + """
select round(avg(case when label <> prediction then 1.0 else 0.0 end), 9) as test_error,
       round(1 - avg(case when label <> prediction then 1.0 else 0.0 end), 9) as accuracy from p
""")
def prediction_error(spark, folder):
    rows = test_error(_predicted(spark, folder))
    return rows.select(*[F.round(c, 9).alias(c) for c in ("test_error", "accuracy")])


@query(_SCORED + """
, cells as (select a.x as label, b.x as predicted from (values (0), (1)) a(x), (values (0), (1)) b(x))
select c.label, c.predicted, count(p.label) as n
from cells c left join p on p.label = c.label and p.prediction = c.predicted group by 1, 2
""")
def confusion_matrix(spark, folder):
    return confusion_at(_scored(spark, folder), 1500)


@query(_CURVE + "select threshold, tp_so_far, fp_so_far, positives, negatives from c")
def score_curve(spark, folder):
    return curve(_scored(spark, folder)).select("threshold", "tp_so_far", "fp_so_far", "positives", "negatives")


@query(_SCORED + """
, r as (select label, rank() over (order by score) + (count(*) over (partition by score) - 1) / 2 as rk from s)
select round((sum(rk) filter (where label = 1)
              - count(*) filter (where label = 1) * (count(*) filter (where label = 1) + 1) / 2)
             / (count(*) filter (where label = 1) * count(*) filter (where label <> 1)), 9) as auroc
from r
""")
def area_under_roc(spark, folder):
    return auroc(_scored(spark, folder)).select(F.round("auroc", 9).alias("auroc"))


@query(_CURVE + """
, pr as (select threshold, tp_so_far / positives as recall, tp_so_far / (tp_so_far + fp_so_far) as prec from c
         union all select 1e18, 0, 1)
select round(recall, 9) as recall from pr order by abs(prec - 0.75), threshold limit 1
""")
def recall_near_precision(spark, folder):
    return recall_at_precision(_scored(spark, folder)).select(F.round("recall", 9).alias("recall"))


@query(_CURVE + """
, roc as (select threshold, tp_so_far / positives as tpr, fp_so_far / negatives as fpr from c
          union all select 1e18, 0, 0)
select round(tpr, 9) as tpr from roc order by abs(fpr - 0.16), threshold desc limit 1
""")
def tpr_near_fpr(spark, folder):
    return tpr_at_fpr(_scored(spark, folder)).select(F.round("tpr", 9).alias("tpr"))
