import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from depotkit.catalog import models as queries
from depotkit.catalog.views import Tables
from depotkit.ml import boosting as bo, importance as imp, train as tr
from depotkit.operators.ordering import global_quantiles
from tests.test_boosting import FEATURES, frame, table

SQUARED = bo.Spec(rounds=12, rate=0.3, depth=3, min_leaf=5, patience=3)
SAMPLED = bo.Spec(rounds=6, rate=0.2, depth=4, min_leaf=3, l2=0.1, subsample=0.7, max_leaves=9)
SOFTMAX = bo.Spec(loss="softmax", classes=3, rounds=5, depth=2)
LANES = [bo.Lane(SQUARED, ("before", 2)), bo.Lane(SOFTMAX, ("other", 1), 1), bo.Lane(SQUARED, ("train",)), bo.Lane(SAMPLED, ("all",))]


def plain(spark, monkeypatch, x, lanes, edges):
    with monkeypatch.context() as m:
        m.setattr(bo, "JOB_PASSES", 10**9)
        return [f.to_json() for f in bo.fit_all(table(spark, x), FEATURES, ["y", "k"], ["id"], lanes, edges)]


@pytest.mark.parametrize("task_rows", [16_384, 150])
def test_one_job_grows_the_models_of_many(spark, monkeypatch, task_rows):
    x = frame(1200)
    edges = bo.bin_edges(table(spark, x), FEATURES)
    monkeypatch.setattr(bo, "TASK_ROWS", task_rows)
    want = plain(spark, monkeypatch, x, LANES, edges)
    monkeypatch.setattr(bo, "JOB_PASSES", 0)
    monkeypatch.setattr(bo, "_histograms", lambda *_: pytest.fail("a job for a pass"))
    assert [f.to_json() for f in bo.fit_all(table(spark, x), FEATURES, ["y", "k"], ["id"], LANES, edges)] == want


def test_fits_of_many_passes_are_one_job(spark, monkeypatch):
    monkeypatch.setattr(bo, "_histograms", lambda *_: pytest.fail("a job for a pass"))
    x = frame()
    assert len(bo.fit(table(spark, x), FEATURES, "y", ["id"], bo.Spec(rounds=40, depth=3)).rounds) == 40
    some = table(spark, x).withColumn("y", F.when(F.col("id") < 0, F.col("y")))
    assert bo.fit(some, FEATURES, "y", ["id"], bo.Spec(rounds=40)).rounds == []


def test_other_clusters_grow_by_passes(spark, monkeypatch):
    assert bo._tasks_of_a_job(spark, 40_000, [bo.Lane(bo.Spec(rounds=100), ("all",))]) == 3
    assert bo._tasks_of_a_job(spark, 40_000, [bo.Lane(bo.Spec(rounds=2), ("all",))]) == 0
    monkeypatch.setattr(bo, "HELD_ROWS", 10_000)
    assert bo._tasks_of_a_job(spark, 40_000, [bo.Lane(bo.Spec(rounds=100), ("all",))]) == 0
    monkeypatch.undo()
    monkeypatch.setattr(bo, "shared_folder", lambda _: "viewfs://store/kept")
    assert bo._tasks_of_a_job(spark, 40_000, [bo.Lane(bo.Spec(rounds=100), ("all",))]) == 0


def test_a_lost_job_goes_on(spark, monkeypatch, tmp_path):
    class Context:
        get = classmethod(lambda cls: cls())
        partitionId = lambda self: 0
        getTaskInfos = lambda self: [None]
        allGather = lambda self, text: [text]

    x = frame()
    lanes = [bo.Lane(bo.Spec(rounds=14, depth=3, min_leaf=5), ("train",)), bo.Lane(SAMPLED, ("all",))]
    edges = bo.bin_edges(table(spark, x), FEATURES)
    sizes = [len(e) + 2 for e in edges]
    blocks = bo.to_blocks(table(spark, x), FEATURES, edges, ["y", "k"], ["id"])
    batches, begun = blocks.toArrow().to_batches(), lambda: bo._begun(blocks, lanes, len(sizes))
    monkeypatch.setattr(bo, "BarrierTaskContext", Context)
    grown, trees = [], lambda models: [[[vars(t) for t in ts] for ts in m.rounds] for m in models]
    level = bo._level
    monkeypatch.setattr(bo, "_level", lambda *args: grown.append(1) or level(*args))
    (tmp_path / "a").mkdir()
    want = trees(bo._fit_in_a_task(iter(batches), begun(), sizes, str(tmp_path / "a")))
    whole = len(grown)
    grown.clear()
    assert trees(bo._fit_in_a_task(iter(batches), begun(), sizes, str(tmp_path / "a"))) == want
    assert 0 < len(grown) < whole / 2  # the first ten rounds were written


def test_features_counted_together():
    sizes = [256, 3, 2, 255, 17, 4, 9]
    groups = bo._joint(sizes)
    assert sorted(f for g in groups for f in g) == list(range(len(sizes))) and len(groups) < len(sizes)
    assert all(np.prod([sizes[f] for f in g]) <= bo.JOINT_BINS for g in groups)


def test_cuts_of_shares_give_the_best_of_all():
    rng, spec = np.random.default_rng(5), bo.Spec(min_leaf=2, l2=0.1)
    x, g = rng.integers(0, 6, (5, 300)), np.rint(rng.normal(size=300) * 8)
    x[3] = x[1]  # ties
    sizes = [7] * 5
    hist = np.stack([np.concatenate([np.bincount(c, w, 7) for c in x]) for w in (g, None)])
    want = bo.best_split(hist, sizes, spec, 0.5)
    for cut in range(6):
        left = bo.candidates(hist[:, :7 * cut], sizes[:cut], spec, 0.5)
        right = [(w, f + cut, *rest) for w, f, *rest in bo.candidates(hist[:, 7 * cut:], sizes[cut:], spec, 0.5)]
        got = bo.pick([*left, *right])
        assert got[:4] == want[:4] and all((a == b).all() for a, b in zip(got[4:], want[4:]))


@pytest.mark.parametrize(("n", "points"), [(3000, 20_000), (3001, 40), (2000, 300), (6, 2), (1, 2)])
def test_medians_are_exact(spark, monkeypatch, n, points):
    monkeypatch.setattr(bo, "POINTS", points)
    rng = np.random.default_rng(n)
    x = pd.DataFrame({"a": rng.normal(size=n), "b": rng.integers(0, 5, n) * 1.0, "c": rng.normal(size=n).round(1), "d": np.nan, "e": rng.exponential(size=n)})
    x.loc[rng.random(n) < 0.3, "e"] = np.nan
    df = spark.createDataFrame(x).repartition(5)
    got = tr.medians(df.withColumn("is_test", F.lit(False)), list(x))
    assert got == {c: v[0] for c, v in global_quantiles(df, list(x), [0.5]).items() if c != "d"}
    assert got == pytest.approx({c: np.median(v) for c in x if len(v := x[c].dropna())})


def test_edges_of_parts_with_very_many_values(spark, monkeypatch):
    x = pd.DataFrame({"v": np.random.default_rng(2).normal(size=5000)})
    df = spark.createDataFrame(x).repartition(5)
    exact = bo.bin_edges(df, ["v"], 64)[0]
    ranks = np.ceil(np.arange(1, 65) / 64 * 5000).astype(int) - 1
    values = np.sort(x.v.to_numpy())[np.concatenate([[0], ranks])]
    assert exact == ((values[:-1] + values[1:]) / 2)[:63].tolist()
    monkeypatch.setattr(bo, "POINTS", 200)
    about = np.searchsorted(np.sort(x.v), bo.bin_edges(df, ["v"], 64)[0])
    assert len(about) == 63 and abs(about - np.searchsorted(np.sort(x.v), exact)).max() <= 5000 / 200 + 5


def test_a_query_of_one_supplier_model_fits_that_model(spark, folder, monkeypatch):
    asked, train = [], tr.train_suppliers
    few = {"delay": {"rounds": 2, "depth": 2}, "tier": {"rounds": 2, "depth": 2}}
    monkeypatch.setattr(queries, "_FITTED", {})
    monkeypatch.setattr(queries, "_SCORES", {})
    monkeypatch.setattr(tr, "train_suppliers", lambda df, models: asked.append(models) or train(df, few, models=models))
    t = Tables(spark, folder)
    [delay] = queries._suppliers(t, "delay")
    assert asked == [["delay"]] and queries._suppliers(t, "delay", "tier")[0] is delay and asked == [["delay"], ["tier"]]
    monkeypatch.setattr(queries, "_FITTED", {})
    monkeypatch.setattr(queries, "_SCORES", {})
    both = queries._suppliers(t, "delay", "tier")
    assert asked[2:] == [["delay", "tier"]] and both[0].metrics == delay.metrics and both[0].model.to_json() == delay.model.to_json()


@pytest.mark.parametrize("fills", [None, {"a": 3.0}])
def test_swapped_values_of_a_boosted_model_are_scored_without_copies(spark, fills):
    x = frame()
    spec = bo.Spec(rounds=9, depth=4, rate=0.3, min_leaf=5)
    model = bo.fit(table(spark, x), FEATURES, "y", ["id"], spec, fills=fills)
    calls, transform = [], model.transform
    model.transform = lambda d: calls.append(d.count()) or transform(d)
    ask = lambda **more: [tuple(r) for r in imp.permutation_importance(
        model, table(spark, x), FEATURES, ["id"], "y", imp.mae_loss("y", 0, 9), n_repeats=3, **more).collect()]
    got = ask(swaps=imp.boosted_swaps(model))
    assert calls == [len(x)]  # no copy a feature and repeat goes through the model
    want = ask()
    assert [r[0] for r in got] == [r[0] for r in want] and got[0][1] > 0.1
    assert [v for r in got for v in r[1:]] == pytest.approx([v for r in want for v in r[1:]], abs=1e-12)


def test_scores_of_suppliers_are_made_once(spark, folder, monkeypatch):
    made, scores = [], queries.series.risk_scores
    monkeypatch.setattr(queries, "_SCORES", {})
    monkeypatch.setattr(queries.series, "risk_scores", lambda t: made.append(1) or scores(t))
    t = Tables(spark, folder)
    got, want = queries._supplier_risk(t), queries.series.features.supplier_risk_features(scores(t), t.suppliers)
    assert queries._supplier_risk(t).columns == got.columns and made == [1]
    assert "InMemoryTableScan" in got._jdf.queryExecution().executedPlan().toString()
    assert got.exceptAll(want).count() == 0 == want.exceptAll(got).count()
    queries._SCORES.popitem()[1].unpersist()
