import datetime as dt

import numpy as np
import pytest
from pyspark.ml.feature import VectorAssembler
from pyspark.ml import Pipeline
from pyspark.ml.regression import LinearRegression
from pyspark.sql import functions as F

from depotkit.ml import evaluate as ev, features as ft, importance as imp, splits, train as tr
from depotkit.operators import relational as rel


def scored(spark, rows):
    return spark.createDataFrame(rows, "label int, score double")


def brute_auc(rows):
    pos = [s for y, s in rows if y]
    neg = [s for y, s in rows if not y]
    return sum((p > n) + 0.5 * (p == n) for p in pos for n in neg) / (len(pos) * len(neg))


def test_auc_with_ties_equals_all_pairs(spark):
    rng = np.random.default_rng(3)
    rows = [(int(rng.random() < 0.3), float(rng.integers(0, 12)) / 12) for _ in range(300)]
    assert ev.roc_auc(scored(spark, rows), "label", "score").first().auc == pytest.approx(brute_auc(rows))
    loss = imp.auc_loss("label", lambda: F.col("score"), buckets=12)(scored(spark, rows).withColumn("g", F.lit(1)), ["g"])
    assert 1 - loss.first().loss == pytest.approx(brute_auc(rows))
    assert ev.roc_auc(scored(spark, [(1, 0.5)]), "label", "score").first().auc is None


def test_roc_points_end_at_one(spark):
    rows = [(1, 0.9), (0, 0.9), (1, 0.4), (0, 0.1)]
    got = [(r.threshold, r.fpr, r.tpr) for r in ev.roc_points(scored(spark, rows), "label", "score").orderBy(F.desc("threshold")).collect()]
    assert got == [(0.9, 0.5, 0.5), (0.4, 0.5, 1.0), (0.1, 1.0, 1.0)]


def test_regression_metrics(spark):
    df = spark.createDataFrame([(0.0, 3.0), (2.0, 10.0), (4.0, 3.0)], "y double, p double")
    got = ev.regression_metrics(df, "y", "p").first()
    assert got.mae == pytest.approx(4.0)
    assert got.rmse == pytest.approx(np.sqrt((9 + 64 + 1) / 3))
    assert got.mape == pytest.approx((1.0 + 0.25) / 2 * 100)  # zero label left out, error above 100 % capped
    none = spark.createDataFrame([(0.0, 3.0)], "y double, p double")
    assert ev.regression_metrics(none, "y", "p").first().mape == 0.0


def test_class_report_with_a_class_never_predicted(spark):
    rows = [(0, 0), (0, 1), (1, 1), (2, 0)]
    df = spark.createDataFrame(rows, "y int, p int")
    got = {r["class"]: (r.precision, r.recall, r.f1, r.support) for r in ev.class_report(df, "y", "p").collect()}
    assert got[0] == (0.5, 0.5, 0.5, 2) and got[2] == (0.0, 0.0, 0.0, 1)
    assert got[1] == (0.5, 1.0, pytest.approx(2 / 3), 1)
    avg = ev.f1_averages(df, "y", "p").first()
    assert avg.f1_macro == pytest.approx((0.5 + 2 / 3) / 3) and avg.f1_weighted == pytest.approx((1 + 2 / 3) / 4)
    grid = {(r.label, r.prediction): r.n for r in ev.confusion(df, "y", "p").collect()}
    assert len(grid) == 9 and grid[2, 0] == 1 and grid[2, 2] == 0
    flags = spark.createDataFrame([(1, 0), (0, 0)], "y int, p int")
    assert tuple(ev.binary_metrics(flags, "y", "p").first()) == (0.0, 0.0, 0.0)


def test_histogram_closes_the_last_bin(spark):
    df = spark.createDataFrame([(float(x),) for x in (0, 1, 9, 10)], "v double")
    assert {r.bin: r.n for r in ev.histogram(df, "v", 10).collect()} == {0: 1, 1: 1, 9: 2} | dict.fromkeys(range(2, 9), 0)


def panel(spark, entities=7, days=23):
    rows = [(e, dt.date(2024, 1, 1) + dt.timedelta(days=d)) for e in range(entities) for d in range(days)]
    return spark.createDataFrame(rows, "e int, day date")


def test_row_folds_follow_the_public_rule(spark):
    n, k = 7 * 23, 5
    got = splits.ranked(panel(spark), "e", "day", "rows").withColumn("f", splits.fold(k)).orderBy("rank").toPandas()
    assert list(got["rank"]) == list(range(n)) and list(got.e) == sorted(got.e)
    size = n // (k + 1)
    first = n - k * size
    assert list(got.f) == [-1 if i < first else (i - first) // size for i in range(n)]


def test_time_folds_never_train_on_the_future(spark):
    d = splits.ranked(panel(spark), "e", "day").withColumns({"f": splits.fold(5), "t": splits.holdout()}).toPandas()
    assert d.groupby("day").f.nunique().max() == 1
    for f in range(5):
        assert d[d.f < f].day.max() < d[d.f == f].day.min()
    assert d[~d.t].day.max() < d[d.t].day.min()


@pytest.mark.parametrize("n", [1, 2, 100, 200, 600, 133_260])
def test_permutations_are_random_bijections(spark, n):
    got = imp.permutations(spark.range(n).withColumnRenamed("id", "_i"), n, 2, 42).toPandas()
    for _, one in got.groupby("repeat"):
        one = one.sort_values("_i")
        assert sorted(one._j) == list(range(n))
        if n >= 100:
            steps = (one._j - one._i) % n
            assert steps.value_counts().iloc[0] < n / 10  # no fixed stride
            assert abs(np.corrcoef(one._i, one._j)[0, 1]) < 0.3


def test_permutation_importance_finds_the_feature_that_matters(spark):
    rng = np.random.default_rng(0)
    rows = [(i, float(rng.normal()), float(rng.normal())) for i in range(400)]
    df = spark.createDataFrame(rows, "id int, a double, b double").withColumn("label", F.col("a") * 5)
    model = Pipeline(stages=[VectorAssembler(inputCols=["a", "b"], outputCol="features"), LinearRegression()]).fit(df)
    got = imp.permutation_importance(model, df, ["a", "b"], ["id"], "label", imp.mae_loss("label"), n_repeats=3).collect()
    assert [r.feature for r in got] == ["a", "b"]
    assert got[0].importance > 3 and abs(got[1].importance) < 0.01


def test_lookahead_columns_are_refused(spark):
    df = spark.createDataFrame([(1, 2)], "future_min_stock int, dow int")
    with pytest.raises(ValueError):
        tr.inputs(df, ["dow", "future_min_stock"])
    assert tr.inputs(df, ft.STOCKOUT_FEATURES) == ["dow"]


def test_balanced_weights(spark):
    df = spark.createDataFrame([(0.0,)] * 3 + [(1.0,)], "label double")
    got = {r.label: r.weight for r in rel.class_weights(df, "label").collect()}
    assert got == {0.0: pytest.approx(4 / 6), 1.0: 2.0}
    assert {r.label: r.weight for r in tr.with_weights(df).collect()} == got


def test_search_prefers_the_better_mean():
    scores = {(1, 0): 0.4, (1, 1): 0.6, (2, 0): 0.7, (2, 1): 0.1}
    best, table = tr.search(tr.grid({"x": [1, 2]}), [0, 1], lambda p, f: scores[p["x"], f], True)
    assert best == {"x": 1} and len(table) == 2


def test_auc_loss_is_exact_for_close_scores(spark):
    from pyspark.sql import functions as F

    from depotkit.ml import evaluate, importance

    rows = [(0, 0.5000001), (0, 0.5000002), (1, 0.5000003), (1, 0.50000015), (0, 0.1), (1, 0.9), (1, 0.1)]
    df = spark.createDataFrame(rows, "label int, p double").withColumn("all", F.lit(1))
    loss = importance.auc_loss("label", lambda: F.col("p"))(df, ["all"]).first()["loss"]
    assert abs(1 - loss - evaluate.roc_auc(df, "label", "p").first()["auc"]) < 1e-12


def test_histogram_has_every_bin(spark):
    from depotkit.ml import evaluate

    df = spark.createDataFrame([("a", 0.0), ("a", 0.1), (None, 10.0), ("b", None)], "g string, x double")
    got = {r.bin: r.n for r in evaluate.histogram(df, "x", 5).collect()}
    assert got == {0: 2, 1: 0, 2: 0, 3: 0, 4: 1}
    grouped = {(r.g, r.bin): r.n for r in evaluate.histogram(df, "x", 5, ["g"]).collect()}
    assert len(grouped) == 10 and grouped["a", 0] == 2 and grouped[None, 4] == 1
    assert evaluate.histogram(df.limit(0), "x", 5).count() == 0


def test_folds_without_a_score_leave_the_mean(spark):
    from depotkit.ml.train import _summary, search

    assert _summary([{"auc": None}, {"auc": 0.8}]) == {"cv_auc_mean": 0.8, "cv_auc_std": 0.0}
    scores = {(1, 0): None, (1, 1): 0.6, (2, 0): 0.5, (2, 1): 0.5}
    best, _ = search([{"a": 1}, {"a": 2}], [0, 1], lambda c, f: scores[c["a"], f], True)
    assert best == {"a": 1}
