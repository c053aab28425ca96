"""Metric and split queries over a table of labels, scores and predictions."""

from __future__ import annotations

from pyspark.sql import functions as F

from depotkit.catalog.registry import query
from depotkit.ml import evaluate as ev, splits

_MAPE = "coalesce(avg(case when actual > 0 then least(abs(actual - predicted) / actual, 1) end) * 100, 0)"


@query(
    "m_mae_rmse",
    "r:mae r:rmse",
    "select avg(abs(actual - predicted)) as mae, sqrt(avg((actual - predicted) ** 2)) as rmse from {predictions}",
)
def m_mae_rmse(t):
    return ev.regression_metrics(t.predictions, "actual", "predicted")


@query("m_mape", "r:mape", f"select {_MAPE} as mape from {{predictions}}")
def m_mape(t):
    return ev.regression_metrics(t.predictions, "actual", "predicted")


@query(
    "m_auc",
    "r:auc",
    """with ranked as (select label, rank() over (order by score) + (count(*) over (partition by score) - 1) / 2.0 as r
                       from {predictions}),
       out as (select (sum(r) filter (where label = 1) - count(*) filter (where label = 1)
                 * (count(*) filter (where label = 1) + 1) / 2.0)
                 / (count(*) filter (where label = 1) * count(*) filter (where label = 0)) as auc from ranked)""",
)
def m_auc(t):
    return ev.roc_auc(t.predictions, "label", "score")


_BINARY = """select count(*) filter (where label = 1 and score >= 0.5) as tp,
    count(*) filter (where label = 0 and score >= 0.5) as fp, count(*) filter (where label = 1 and score < 0.5) as fn
    from {predictions}"""


def _flagged(t):
    return t.predictions.withColumn("flagged", (F.col("score") >= 0.5).cast("int"))


@query(
    "m_prf",
    "r:precision r:recall r:f1",
    f"""select tp / (tp + fp) as precision, tp / (tp + fn) as recall, 2 * tp / (2 * tp + fp + fn) as f1 from ({_BINARY})""",
)
def m_prf(t):
    return ev.binary_metrics(_flagged(t), "label", "flagged")


_REPORT = """per as (select c as class, (select count(*) from {predictions} where tier = c and predicted_tier = c) as tp,
      (select count(*) from {predictions} where tier = c) as support,
      (select count(*) from {predictions} where predicted_tier = c) as claimed
      from (select distinct tier as c from {predictions} union select distinct predicted_tier from {predictions}) k),
    report as (select class, case when claimed = 0 then 0 else tp / claimed end as precision,
      case when support = 0 then 0 else tp / support end as recall,
      case when claimed + support = 0 then 0 else 2 * tp / (claimed + support) end as f1, support from per)"""


@query("m_class_report", "i:class r:precision r:recall r:f1 i:support", f"with {_REPORT}, out as (select * from report)")
def m_class_report(t):
    return ev.class_report(t.predictions, "tier", "predicted_tier")


@query(
    "m_f1_macro",
    "r:f1_macro r:f1_weighted",
    f"with {_REPORT}, out as (select avg(f1) as f1_macro, sum(f1 * support) / sum(support) as f1_weighted from report)",
)
def m_f1_macro(t):
    return ev.f1_averages(t.predictions, "tier", "predicted_tier")


@query(
    "m_confusion",
    "i:label i:prediction i:n",
    """select a.c as label, b.c as prediction, (select count(*) from {predictions} where tier = a.c and predicted_tier = b.c) as n
       from (select distinct tier as c from {predictions}) a, (select distinct tier as c from {predictions}) b""",
)
def m_confusion(t):
    return ev.confusion(t.predictions, "tier", "predicted_tier")


@query(
    "m_roc_points",
    "r:threshold r:fpr r:tpr",
    """with s as (select score, sum(label) as pos, sum(1 - label) as neg from {predictions} group by score),
       out as (select score as threshold, sum(neg) over w / (select sum(neg) from s) as fpr,
               sum(pos) over w / (select sum(pos) from s) as tpr from s
               window w as (order by score desc rows unbounded preceding))""",
)
def m_roc_points(t):
    return ev.roc_points(t.predictions, "label", "score")


@query(
    "m_histogram",
    "i:label i:bin i:n r:left",
    """with b as (select min(score) as lo, max(score) as hi, (max(score) - min(score)) / 40 as w from {predictions}),
       c as (select label, least(floor((score - lo) / w), 39) as bin, count(*) as n from {predictions}, b group by 1, 2),
       g as (select label, unnest(generate_series(0, 39)) as bin from (select distinct label from {predictions})),
       out as (select g.label, g.bin, coalesce(n, 0) as n, lo + g.bin * w as "left"
               from b, g left join c on g.label is not distinct from c.label and g.bin = c.bin)""",
)
def m_histogram(t):
    return ev.histogram(t.predictions, "score", 40, ["label"])


@query(
    "m_residual_histogram",
    "i:bin i:n r:left",
    """with r as (select actual - predicted as e from {predictions}),
       b as (select min(e) as lo, (max(e) - min(e)) / 50 as w from r),
       c as (select least(floor((e - lo) / w), 49) as bin, count(*) as n from r, b group by 1),
       g as (select unnest(generate_series(0, 49)) as bin),
       out as (select g.bin, coalesce(n, 0) as n, lo + g.bin * w as "left" from b, g left join c on g.bin = c.bin)""",
)
def m_residual_histogram(t):
    return ev.histogram(t.predictions.withColumn("e", F.col("actual") - F.col("predicted")), "e", 50)


def _keyed(t):
    """Distinct (product, day) rows: a total order for row splits."""
    return t.part_sales.groupBy("product_id", "sale_date").agg(F.sum("quantity_sold").alias("y"))


_KEYED = "(select product_id, sale_date, sum(quantity_sold) as y from {part_sales} group by product_id, sale_date)"
_FOLD = """case when rk < total - 5 * (total // 6) then -1
    else least((rk - (total - 5 * (total // 6))) // (total // 6), 4) end"""


@query(
    "m_fold_ids",
    "i:product_id d:sale_date i:fold",
    f"""with r as (select product_id, sale_date, row_number() over (order by product_id, sale_date) - 1 as rk,
                  count(*) over () as total from {_KEYED} k),
        out as (select product_id, sale_date, {_FOLD} as fold from r)""",
)
def m_fold_ids(t):
    return splits.ranked(_keyed(t), "product_id", "sale_date", "rows").withColumn("fold", splits.fold(5))


@query(
    "m_fold_ids_time",
    "i:product_id d:sale_date i:fold",
    f"""with k as {_KEYED}, d as (select sale_date, count(*) as n from k group by sale_date),
        c as (select sale_date, coalesce(sum(n) over (order by sale_date rows between unbounded preceding and 1 preceding), 0)
              as rk, (select count(*) from k) as total from d),
        out as (select product_id, k.sale_date, {_FOLD} as fold from k join c on k.sale_date = c.sale_date)""",
)
def m_fold_ids_time(t):
    return splits.ranked(_keyed(t), "product_id", "sale_date", "time").withColumn("fold", splits.fold(5))


@query(
    "m_holdout_split",
    "i:product_id d:sale_date is_test",
    f"""with r as (select product_id, sale_date, row_number() over (order by product_id, sale_date) - 1 as rk,
                  count(*) over () as total from {_KEYED} k),
        out as (select product_id, sale_date, rk >= floor(total * 0.8) as is_test from r)""",
)
def m_holdout_split(t):
    return splits.ranked(_keyed(t), "product_id", "sale_date", "rows").withColumn("is_test", splits.holdout())


@query(
    "m_fold_summary",
    "metric r:mean r:std",
    f"""with f as (select row_id % 5 as fold, avg(abs(actual - predicted)) as mae,
          sqrt(avg((actual - predicted) ** 2)) as rmse, {_MAPE} as mape from {{predictions}} group by row_id % 5),
        out as (select 'mae' as metric, avg(mae) as mean, stddev_pop(mae) as std from f
          union all select 'rmse', avg(rmse), stddev_pop(rmse) from f
          union all select 'mape', avg(mape), stddev_pop(mape) from f)""",
)
def m_fold_summary(t):
    per = ev.regression_metrics(t.predictions.withColumn("fold", F.col("row_id") % 5), "actual", "predicted", ["fold"])
    return ev.fold_summary(per, ["mae", "rmse", "mape"])
