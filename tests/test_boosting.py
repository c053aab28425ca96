import numpy as np
import pandas as pd
import pytest
from pyspark.ml import Pipeline
from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from depotkit.ml import boosting as bo, features as ft, importance as imp, train as tr
from depotkit.session import shared_folder

FEATURES = ["a", "b", "c", "d"]


def frame(n=600, seed=1):
    rng = np.random.default_rng(seed)
    x = pd.DataFrame({"a": rng.integers(0, 40, n) / 4, "b": rng.integers(0, 6, n) * 1.0, "c": rng.normal(size=n).round(1), "d": np.nan})
    x.loc[rng.random(n) < 0.15, "a"] = np.nan
    x.loc[rng.random(n) < 0.1, "c"] = np.nan
    x["y"] = np.where(x.a.isna(), 4, x.a) + 3 * (x.b > 2) * x.c.fillna(-1) + rng.normal(size=n).round(2) / 3
    x["k"] = np.digitize(x.y, [3, 7]).astype(float)
    x["id"], x["fold"] = np.arange(n), np.arange(n) * 4 // n
    x["is_test"], x["is_validation"] = x.id >= n * 0.8, x.id % 10 == 3
    return x


def table(spark, x, parts=5):
    df = spark.createDataFrame(x)
    return df.withColumns({c: F.when(~F.isnan(c), F.col(c)) for c in FEATURES}).repartition(parts, "id")


def plain_tree(x, g, h, spec, depth=0):
    """(value of each row) of a tree grown by trying every cut of every feature on the rows themselves."""
    weight = h.sum() + spec.l2
    value = np.full(len(g), -spec.rate * g.sum() / weight)
    best = None
    if depth < spec.depth:
        for f in range(x.shape[1]):
            col = x[:, f]
            known = np.unique(col[~np.isnan(col)])
            cuts = list((known[:-1] + known[1:]) / 2) + ([np.inf] if np.isnan(col).any() and len(known) else [])
            for cut in cuts:
                for missing_left in (False, True) if np.isnan(col).any() else (None,):
                    left = np.where(np.isnan(col), bool(missing_left), col <= cut)
                    if min(left.sum(), (~left).sum()) < max(1, spec.min_leaf):
                        continue
                    part = lambda m: g[m].sum() ** 2 / (h[m].sum() + spec.l2)
                    gain = part(left) + part(~left) - g.sum() ** 2 / weight
                    if gain > 1e-9 and (best is None or gain > best[0] * (1 + 1e-9)):
                        best = (gain, left)
    if best:
        for m in (best[1], ~best[1]):
            value[m] = plain_tree(x[m], g[m], h[m], spec, depth + 1)
    return value


def plain_boost(x, y, spec):
    x = x[FEATURES].to_numpy(float)
    if spec.loss == "squared":
        raw = np.full((1, len(y)), y.mean())
    else:
        raw = np.repeat(np.log(np.bincount(y.astype(int), minlength=spec.classes) / len(y))[:, None], len(y), 1)
    for _ in range(spec.rounds):
        if spec.loss == "squared":
            g, h = raw - y, np.ones_like(raw)
        else:
            p = np.exp(raw) / np.exp(raw).sum(axis=0)
            g, h = p - (y == np.arange(spec.classes)[:, None]), p * (1 - p)
        raw = raw + np.array([plain_tree(x, g[k], h[k], spec) for k in range(len(raw))])
    return raw


def raw_of(model, x):
    return model.raw([x[c].to_numpy(float) for c in FEATURES])


@pytest.mark.parametrize("spec", [
    bo.Spec(rounds=4, rate=0.3, depth=3, min_leaf=7, l2=0.5),
    bo.Spec(rounds=3, rate=0.5, depth=2, min_leaf=1),
    bo.Spec(loss="softmax", classes=3, rounds=3, rate=0.4, depth=2, min_leaf=5, l2=0.1),
])
def test_like_trying_every_cut(spark, spec):
    x = frame()
    label = "k" if spec.loss == "softmax" else "y"
    model = bo.fit(table(spark, x), FEATURES, label, ["id"], spec)
    want = plain_boost(x, x[label].to_numpy(), spec)
    assert np.allclose(raw_of(model, x), want, atol=1e-8)
    got = model.transform(table(spark, x)).orderBy("id").toPandas()["prediction"]
    assert np.allclose(got, want[0] if spec.loss == "squared" else want.argmax(axis=0), atol=1e-8)


def test_rows_dealt_otherwise_give_the_same_model(spark, monkeypatch):
    x = frame()
    spec = bo.Spec(rounds=7, rate=0.2, depth=4, min_leaf=3, l2=0.1, subsample=0.7, max_leaves=9)
    want = bo.fit(table(spark, x), FEATURES, "y", ["id"], spec).to_json()
    assert bo.fit(table(spark, x, 1), FEATURES, "y", ["id"], spec).to_json() == want
    for name, value in (("BLOCK_ROWS", 50), ("WRITE_EVERY", 2), ("DIRECT_TASKS", 0), ("TASK_ROWS", 100)):
        monkeypatch.setattr(bo, name, value)
    assert bo.fit(table(spark, x, 7), FEATURES, "y", ["id"], spec).to_json() == want


def test_rows_go_down_the_trees_of_a_round_once(spark, monkeypatch):
    pending, find = [], bo._histograms
    monkeypatch.setattr(bo, "_histograms", lambda blocks, tasks, *rest: pending.extend(len(t["pending"]) for t in tasks.values()) or find(blocks, tasks, *rest))
    x, spec = frame(), bo.Spec(rounds=6, depth=2)
    model = bo.fit(table(spark, x), FEATURES, "y", ["id"], spec)
    assert len(model.rounds) == 6 and set(pending) == {0}
    assert np.allclose(raw_of(model, x), plain_boost(x, x["y"].to_numpy(), spec), atol=1e-8)


def test_models_grown_together_equal_those_grown_alone(spark):
    x = frame()
    spec = bo.Spec(rounds=12, rate=0.3, depth=3, min_leaf=5, patience=3)
    short = bo.Spec(loss="softmax", classes=3, rounds=2, depth=2)
    lanes = [bo.Lane(spec, ("before", 2)), bo.Lane(short, ("other", 1), 1), bo.Lane(spec, ("train",))]
    edges = bo.bin_edges(table(spark, x), FEATURES)
    together = bo.fit_all(table(spark, x), FEATURES, ["y", "k"], ["id"], lanes, edges)
    alone = [bo.fit_all(table(spark, x), FEATURES, [["y", "k"][lane.label]], ["id"], [bo.Lane(lane.spec, lane.rows)], edges)[0] for lane in lanes]
    assert [m.to_json() for m in together] == [m.to_json() for m in alone]
    before = x[(x.fold < 2) & ~x.is_validation]
    assert together[0].start == [pytest.approx(before.y.mean())]
    other = x[~x.is_test & (x.fold != 1)]
    assert np.allclose(np.exp(together[1].start), np.bincount(other.k.astype(int)) / len(other))


def test_patience_ends_a_fit(spark):
    x = frame()
    x["y"] = np.random.default_rng(0).normal(size=len(x))  # nothing to learn
    spec = bo.Spec(rounds=200, rate=0.5, depth=4, patience=5)
    model = bo.fit(table(spark, x), FEATURES, "y", ["id"], spec)
    assert 5 <= len(model.rounds) < 60
    assert len(bo.fit(table(spark, x), FEATURES, "y", ["id"], bo.Spec(rounds=8, rate=0.5, depth=2)).rounds) == 8


def test_awkward_tables(spark):
    x = frame(60)
    model = bo.fit(table(spark, x).limit(0), FEATURES, "y", ["id"], bo.Spec(rounds=3))
    assert model.start == [0.0] and model.rounds == [] and model.transform(table(spark, x)).select(F.max("prediction")).first()[0] == 0
    same = bo.fit(table(spark, x).withColumn("y", F.lit(2.5)), FEATURES, "y", ["id"], bo.Spec(rounds=3))
    assert set(same.transform(table(spark, x)).toPandas()["prediction"]) == {2.5}
    some = table(spark, x).withColumn("y", F.when(F.col("id") % 2 == 0, F.col("y")))
    assert sum(bo.fit(some, FEATURES, "y", ["id"], bo.Spec(rounds=1, depth=1)).rounds[0][0].n[1:]) == 30  # rows without a label train nothing
    with pytest.raises(ValueError):
        bo.bin_edges(table(spark, x), FEATURES, 300)


def test_many_values_share_bins(spark):
    x = pd.DataFrame({"v": np.random.default_rng(2).normal(size=5000), "few": np.arange(5000) % 3})
    edges = bo.bin_edges(spark.createDataFrame(x), ["v", "few"], 64)
    assert edges[1] == [0.5, 1.5] and 55 <= len(edges[0]) <= 63
    counts = np.bincount(bo.to_bins([x.v.to_numpy()], edges[:1])[0])
    assert counts.max() < 3 * 5000 / 64


def test_saved_models_predict_the_same(spark, tmp_path):
    x = frame()
    model = bo.fit(table(spark, x), FEATURES, "y", ["id"], bo.Spec(rounds=3), fills={"a": 1.5})
    model.save(spark, str(tmp_path / "m"))
    again = bo.Boosted.load(spark, str(tmp_path / "m"))
    assert again.to_json() == model.to_json() and again.fills == {"a": 1.5}
    nodes = model.nodes(spark).toPandas()
    assert len(nodes) == sum(len(t.feature) for ts in model.rounds for t in ts)
    assert sum(model.importance().values()) == pytest.approx(1)


def test_contributions_add_up(spark):
    x = frame()
    model = bo.fit(table(spark, x), FEATURES, "y", ["id"], bo.Spec(rounds=9, depth=4, rate=0.2))
    base, parts = bo.contributions(model)
    got = imp.explain(model.transform(table(spark, x)), base, parts, FEATURES, 3).toPandas()
    assert np.allclose(got.explained, got.prediction) and np.allclose(got.base_value, base)
    first = got.iloc[0].top_features
    assert len(first) == 3 and abs(first[0]["contribution"]) >= abs(first[1]["contribution"]) >= abs(first[2]["contribution"])
    assert all(p["direction"] == ("increases" if p["contribution"] > 0 else "decreases") for row in got.top_features for p in row)
    assert base == pytest.approx(got.prediction.mean())  # the mean of all rows trained on


def test_forest_contributions_add_up_to_the_probability(spark):
    x = frame().fillna(0)
    df = spark.createDataFrame(x).withColumn("label", (F.col("k") > 0).cast("double")).withColumn("w", 1 + F.col("b"))
    forest = RandomForestClassifier(numTrees=7, maxDepth=5, weightCol="w", seed=3)
    model = Pipeline(stages=[VectorAssembler(inputCols=FEATURES, outputCol="features"), forest]).fit(df)
    nodes = imp.forest_nodes(model, shared_folder(spark))
    assert nodes.select("tree").distinct().count() == 7
    got = imp.explain(model.transform(df), *imp.forest_contributions(nodes, FEATURES), FEATURES).select(
        "explained", vector_to_array("probability")[1].alias("p"), "top_features").toPandas()
    assert np.allclose(got.explained, got.p) and set(map(len, got.top_features)) == {4}


def test_permuted_copies_are_scored_down_the_paths_of_their_row(spark):
    x = frame().fillna(0)
    df = spark.createDataFrame(x).withColumn("label", (F.col("k") + F.col("a") > 1).cast("double")).withColumn("w", 1 + F.col("b"))
    df = df.withColumn("id", F.monotonically_increasing_id())
    forest = RandomForestClassifier(numTrees=9, maxDepth=6, weightCol="w", seed=3)
    model = Pipeline(stages=[VectorAssembler(inputCols=FEATURES, outputCol="features"), forest]).fit(df)
    swaps = imp.forest_swaps(imp.forest_nodes(model, shared_folder(spark)), FEATURES)
    calls, transform = [], model.transform
    model.transform = lambda d: calls.append(d.count()) or transform(d)
    probability = lambda: vector_to_array("probability")[1]
    ask = lambda score, **more: [tuple(r) for r in imp.permutation_importance(
        model, df, FEATURES, ["id"], "label", imp.auc_loss("label", score), n_repeats=3, **more).collect()]
    got = ask(lambda: F.col("score"), swaps=swaps)
    assert calls == [df.count()]  # no copy a feature and repeat goes through the model
    assert got == ask(probability) and got[0][1] > 0


def test_rows_walk_down_a_tree_as_in_a_table_of_their_own(spark):
    rng = np.random.default_rng(2)
    bins = rng.integers(0, 6, (3, 500)).astype(np.uint8)
    bins[rng.random(bins.shape) < 0.2] = bo.MISSING_BIN
    tree = (np.array([0, 2, -1, -1, 1, -1, -1]), np.full(7, 2, np.uint8), np.array([True, False] * 3 + [True]),
            np.array([1, 2, 0, 0, 5, 0, 0]), np.array([4, 3, 0, 0, 6, 0, 0]), np.zeros(7))
    rows = np.flatnonzero(rng.random(500) < 0.6)
    assert (bo.walk(tree, bins, rows) == bo.walk(tree, np.ascontiguousarray(bins[:, rows]))).all()
    assert (bo.walk(tree, bins, rows) == bo.walk(tree, bins)[rows]).all()


def test_the_forest_keeps_the_nodes_of_its_rows(spark):
    df = spark.createDataFrame(frame().fillna(0)).withColumn("label", (F.col("k") > 0).cast("double")).withColumn("weight", 1 + F.col("b"))
    made = tr.stockout_pipeline(FEATURES, {"numTrees": 5, "maxDepth": 6})
    assert made.getStages()[1].getCacheNodeIds()
    trees = lambda: [t.toDebugString.split("\n", 1)[1] for t in made.fit(df).stages[-1].trees]
    kept = trees()
    made.getStages()[1].setCacheNodeIds(False)
    assert kept == trees()  # the same trees as without


def demand_rows(spark, entities=3, days=90):
    rng = np.random.default_rng(4)
    rows = [(e, d, float(rng.poisson(3 + d % 7)), d % 7, 1 + d // 30) for e in range(entities) for d in range(days)]
    df = spark.createDataFrame(rows, "product_id int, d int, daily_demand double, dow int, month int")
    return df.select("product_id", F.date_add(F.lit("2024-01-01").cast("date"), "d").alias("sale_date"), "daily_demand", "dow", "month")


def test_a_stopped_search_goes_on(spark, tmp_path, monkeypatch):
    df, path = demand_rows(spark), str(tmp_path / "ledger")
    candidates = tr.grid({"rounds": [2, 4], "rate": [0.1, 0.5], "depth": [2], "min_leaf": [5], "l2": [0.0]})
    want = tr.train_demand(df, run_grid=True, n_splits=2, candidates=candidates)
    monkeypatch.setattr(bo, "LANES", 2)
    fit_all, calls = bo.fit_all, []

    def breaks(*args, **settings):
        calls.append(len(args[4]))
        if len(calls) == 3:
            raise RuntimeError("lost")
        return fit_all(*args, **settings)

    monkeypatch.setattr(bo, "fit_all", breaks)
    with pytest.raises(RuntimeError):
        tr.train_demand(df, run_grid=True, n_splits=2, candidates=candidates, ledger=path)
    assert spark.read.parquet(path).count() == 4  # two candidates of two folds are known
    got = tr.train_demand(df, run_grid=True, n_splits=2, candidates=candidates, ledger=path)
    assert calls == [2, 2, 2, 2, 2, 3]  # the two open ones, then the folds and the final model
    assert got.params == want.params and got.extra["grid"] == pytest.approx(want.extra["grid"])
    again = tr.train_demand(df.withColumn("dow", F.col("dow") + 1), run_grid=True, n_splits=2, candidates=candidates[:1], ledger=path)
    assert again.params == candidates[0] and spark.read.parquet(path).count() == 10  # another table, other scores


def test_presets_name_spec_fields():
    for preset, more in ((ft.DEMAND_PRESET, ft.DEMAND_FIXED), (ft.DELAY_PRESET, {}), (ft.TIER_PRESET, {})):
        bo.Spec(**preset, **more)
    for grid in (ft.DEMAND_GRID, ft.DELAY_GRID, ft.TIER_GRID):
        assert [bo.Spec(**c) for c in tr.grid(grid)]
    assert len(tr.grid(ft.DEMAND_GRID)) == 32


def test_macro_f1_by_fold(spark):
    df = spark.createDataFrame([(0, 0.0, 0.0), (0, 1.0, 0.0), (0, 1.0, 1.0), (1, 2.0, 2.0), (1, 0.0, 1.0)], "fold int, label double, prediction double")
    got = {r["fold"]: r["score"] for r in tr._fold_f1(df).collect()}
    assert got == {0: pytest.approx(2 / 3), 1: pytest.approx(1 / 3)}
