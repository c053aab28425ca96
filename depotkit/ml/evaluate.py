"""Model metrics as aggregates over a table of labels, scores and predictions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from depotkit.operators.ordering import running_totals


def error_metrics(label: Column, predicted: Column) -> dict[str, Column]:
    """Aggregates: MAE, RMSE and the percentage error capped at 100 over positive labels."""
    error = F.abs(label - predicted)
    share = F.when(label > 0, F.least(error / label, F.lit(1.0)))
    return {
        "mae": F.avg(error),
        "rmse": F.sqrt(F.avg(error * error)),
        "mape": F.coalesce(F.avg(share) * 100, F.lit(0.0)),
    }


def regression_metrics(df: DataFrame, label: str, predicted: str, by: Sequence[str] = ()) -> DataFrame:
    y, p = F.col(label).cast("double"), F.col(predicted).cast("double")
    return df.groupBy(*by).agg(*[m.alias(n) for n, m in error_metrics(y, p).items()])


def binary_metrics(df: DataFrame, label: str, predicted: str) -> DataFrame:
    """Precision, recall and F1 of class 1; a zero denominator gives 0."""
    y, p = F.col(label) == 1, F.col(predicted) == 1
    counts = df.agg(F.count_if(y & p).alias("tp"), F.count_if(~y & p).alias("fp"), F.count_if(y & ~p).alias("fn"))
    return counts.select(
        _ratio(F.col("tp"), F.col("tp") + F.col("fp")).alias("precision"),
        _ratio(F.col("tp"), F.col("tp") + F.col("fn")).alias("recall"),
        _ratio(2 * F.col("tp"), 2 * F.col("tp") + F.col("fp") + F.col("fn")).alias("f1"),
    )


def _ratio(a: Column, b: Column) -> Column:
    return F.coalesce(F.try_divide(a, b), F.lit(0.0))


def confusion(df: DataFrame, label: str, predicted: str) -> DataFrame:
    """Counts on the full grid of classes seen as label or prediction."""
    counts = df.groupBy(F.col(label).alias("label"), F.col(predicted).alias("prediction")).agg(
        F.count("*").alias("n")
    )
    # Classes are few by definition of a classifier; their list is one row.
    classes = counts.select(F.explode(F.array("label", "prediction")).alias("c")).agg(F.collect_set("c").alias("cs"))
    grid = classes.select(F.explode("cs").alias("label"), "cs").select("label", F.explode("cs").alias("prediction"))
    return grid.join(counts, ["label", "prediction"], "left").fillna(0, subset=["n"])


def class_report(df: DataFrame, label: str, predicted: str) -> DataFrame:
    """Precision, recall, F1 and support per class in labels or predictions."""
    counts = df.groupBy(label, predicted).agg(F.count("*").alias("n"))
    sides = counts.select(
        F.inline(
            F.array(
                F.struct(
                    F.col(label).alias("class"),
                    F.when(F.col(label) == F.col(predicted), F.col("n")).otherwise(0).alias("tp"),
                    F.col("n").alias("support"),
                    F.lit(0).cast("long").alias("claimed"),
                ),
                F.struct(
                    F.col(predicted).alias("class"),
                    F.lit(0).cast("long").alias("tp"),
                    F.lit(0).cast("long").alias("support"),
                    F.col("n").alias("claimed"),
                ),
            )
        )
    )
    per = sides.groupBy("class").agg(*[F.sum(c).alias(c) for c in ("tp", "support", "claimed")])
    return per.select(
        "class",
        _ratio(F.col("tp"), F.col("claimed")).alias("precision"),
        _ratio(F.col("tp"), F.col("support")).alias("recall"),
        _ratio(2 * F.col("tp"), F.col("claimed") + F.col("support")).alias("f1"),
        "support",
    )


def f1_averages(df: DataFrame, label: str, predicted: str) -> DataFrame:
    per = class_report(df, label, predicted)
    weighted = F.sum(F.col("f1") * F.col("support")) / F.sum("support")
    return per.agg(F.avg("f1").alias("f1_macro"), weighted.alias("f1_weighted"))


def _score_steps(df: DataFrame, label: str, score: str) -> DataFrame:
    """One row per distinct score, highest first, with running counts of both classes."""
    steps = df.groupBy(F.col(score).alias("score")).agg(
        F.count_if(F.col(label) == 1).alias("pos"), F.count_if(F.col(label) != 1).alias("neg")
    )
    return running_totals(steps, [F.col("score").desc()], {"tp": "pos", "fp": "neg"})


def roc_points(df: DataFrame, label: str, score: str) -> DataFrame:
    """Threshold, false and true positive rate at every distinct score."""
    steps = _score_steps(df, label, score)
    totals = df.agg(F.count_if(F.col(label) == 1), F.count_if(F.col(label) != 1)).first()
    p, n = (F.lit(float(x)) for x in totals)
    return steps.select(
        F.col("score").alias("threshold"), F.try_divide("fp", n).alias("fpr"), F.try_divide("tp", p).alias("tpr")
    )


def roc_auc(df: DataFrame, label: str, score: str) -> DataFrame:
    """Area under the ROC curve, ties counted half; NULL if a class is missing."""
    area = F.sum(F.col("neg") * (F.col("tp") - F.col("pos") / 2))
    out = _score_steps(df, label, score).agg(area.alias("a"), F.sum("pos").alias("p"), F.sum("neg").alias("n"))
    return out.select(F.try_divide(F.col("a"), F.col("p") * F.col("n")).alias("auc"))


def histogram(df: DataFrame, value: str, bins: int, by: Sequence[str] = ()) -> DataFrame:
    """Equal-width counts between the smallest and largest value, of every bin also if it is empty
    (of each group, if grouped); the last bin is closed. No values, no bins."""
    low, high = df.agg(F.min(value), F.max(value)).first()
    width = (high - low) / bins if high is not None and high > low else 1.0
    x = F.col(value)
    index = F.least(F.floor((x - F.lit(low)) / F.lit(width)), F.lit(bins - 1)).cast("int")
    known = df.filter(x.isNotNull())
    counts = known.groupBy(*by, index.alias("bin")).agg(F.count("*").alias("n"))
    empty = counts.select(*by).distinct() if by else counts.agg(F.count("*").alias("n")).filter("n > 0")
    every = empty.select(*by, F.explode(F.sequence(F.lit(0), F.lit(bins - 1))).alias("bin"), F.lit(0).cast("long").alias("n"))
    return (
        counts.unionByName(every).groupBy(*by, "bin").agg(F.sum("n").alias("n"))
        .withColumn("left", F.lit(low) + F.col("bin") * F.lit(width))
    )


def fold_summary(df: DataFrame, metrics: Sequence[str]) -> DataFrame:
    """Mean and population deviation of per-fold metrics, one row per metric."""
    long = df.unpivot(["fold"], list(metrics), "metric", "value")
    return long.groupBy("metric").agg(F.avg("value").alias("mean"), F.stddev_pop("value").alias("std"))
