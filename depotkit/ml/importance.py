"""Feature importance and prediction explanation."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Sequence

import numpy as np
import pandas as pd
from pyspark.ml import PipelineModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from depotkit.functions import scalar as fn
from depotkit.ml import boosting
from depotkit.ml.boosting import Boosted
from depotkit.operators.ordering import row_index
from depotkit.operators.relational import top_k


def permutations(indexed: DataFrame, n: int, n_repeats: int, seed: int) -> DataFrame:
    """(_i, repeat, _j): for each repeat a random permutation of the ``n`` positions ``_i``.

    Positions are ordered by a seeded hash; one range-partitioned ordering serves all repeats, as
    repeat r fills the places from r * n on.
    """
    dealt = indexed.select("_i", F.explode(F.sequence(F.lit(0), F.lit(n_repeats - 1))).alias("repeat"))
    dealt = dealt.withColumn("_hash", F.xxhash64("_i", "repeat", F.lit(seed)))
    placed = row_index(dealt, [F.col(c).asc() for c in ("repeat", "_hash", "_i")], "_place")
    return placed.select("_i", "repeat", (F.col("_place") - F.col("repeat") * F.lit(n)).alias("_j"))


def permutation_importance(
    model: PipelineModel | Boosted,
    test: DataFrame,
    features: Sequence[str],
    keys: Sequence[str],
    label: str,
    loss: Callable[[DataFrame, list[str]], DataFrame],
    n_repeats: int = 10,
    top_n: int = 15,
    seed: int = 42,
    swaps: Callable[[Column, Column], Column] | None = None,
) -> DataFrame:
    """Mean and deviation of the loss increase when one feature column is permuted.

    ``loss(scored, by)`` returns columns ``by`` and ``loss`` (larger is worse). One job
    scores every (repeat, feature) copy: rows meet their permuted partners by row index, then
    fan out to one copy per feature inside the task that scores and pre-aggregates them.
    ``swaps(own, other)`` may give the scores of all copies of a row at once, as an array by feature,
    without making the copies; ``loss`` then reads them as ``score`` (of a boosted model: ``prediction``).
    """
    columns = [F.col(f"`{c}`") for c in features]
    rows = test.select(*keys, label, *columns)
    indexed = row_index(rows, [F.col(k).asc() for k in keys], "_i").select("_i", label, *columns)
    n = indexed.count()
    vector = F.array(*columns)
    donors = indexed.select(F.col("_i").alias("_j"), vector.alias("_other"))
    own = indexed.select("_i", label, vector.alias("_own"))
    paired = permutations(indexed, n, n_repeats, seed).join(own, "_i").join(donors, "_j")
    if swaps is not None:
        name = "prediction" if isinstance(model, Boosted) else "score"
        scored = paired.select(label, "repeat", F.posexplode(swaps(F.col("_own"), F.col("_other"))).alias("feature", name))
    else:
        copies = paired.select(
            label, "repeat", "_own", "_other", F.explode(F.sequence(F.lit(0), F.lit(len(features) - 1))).alias("feature")
        )
        mixed = [
            F.when(F.col("feature") == i, F.col("_other")[i]).otherwise(F.col("_own")[i]).alias(c) for i, c in enumerate(features)
        ]
        scored = model.transform(copies.select(label, "repeat", "feature", *mixed))
    permuted = loss(scored, ["repeat", "feature"])
    whole = model.transform(indexed.drop("_i"))
    if swaps is not None and not isinstance(model, Boosted):
        whole = whole.withColumn("score", vector_to_array("probability")[1])
    base = loss(whole.withColumn("_all", F.lit(1)), ["_all"]).first()["loss"]
    names = F.array(*[F.lit(c) for c in features])
    summary = permuted.groupBy("feature").agg(
        (F.avg("loss") - F.lit(base)).alias("importance"), F.stddev_pop("loss").alias("std")
    )
    named = summary.select(F.element_at(names, F.col("feature") + 1).alias("feature"), "importance", "std")
    return top_k(named, F.col("importance"), top_n, ["feature"])


def mae_loss(label: str, lo: float | None = None, hi: float | None = None) -> Callable[[DataFrame, list[str]], DataFrame]:
    """Mean absolute error per group, of predictions clipped to the given bounds."""
    def loss(scored: DataFrame, by: list[str]) -> DataFrame:
        return scored.groupBy(*by).agg(F.avg(F.abs(F.col(label) - fn.clip("prediction", lo, hi))).alias("loss"))

    return loss


def auc_loss(label: str, score: Callable[[], Column], buckets: int = 100_000) -> Callable[[DataFrame, list[str]], DataFrame]:
    """1 - AUC per group, from counts per exact score, ties counted half; NULL if a class is missing.

    Running totals go inside ranges of scores, ``buckets`` to the unit, and over the totals of the
    ranges, so that no window holds all scores of a group.
    """
    def loss(scored: DataFrame, by: list[str]) -> DataFrame:
        found = scored.withColumn("_score", score())
        counts = found.groupBy(*by, F.floor(F.col("_score") * buckets).alias("_step"), "_score").agg(
            F.count_if(F.col(label) == 1).alias("pos"), F.count_if(F.col(label) != 1).alias("neg")
        )
        higher = Window.partitionBy(*by).orderBy(F.col("_step").desc()).rowsBetween(Window.unboundedPreceding, -1)
        ranges = counts.groupBy(*by, "_step").agg(F.sum("pos").alias("_pos"))
        ranges = ranges.select(*by, "_step", F.coalesce(F.sum("_pos").over(higher), F.lit(0)).alias("_above"))
        inside = Window.partitionBy(*by, "_step").orderBy(F.col("_score").desc()).rowsBetween(Window.unboundedPreceding, 0)
        area = F.col("neg") * (F.col("_above") + F.sum("pos").over(inside) - F.col("pos") / 2)
        return (
            counts.join(ranges, [*by, "_step"]).withColumn("area", area).groupBy(*by)
            .agg((1 - F.try_divide(F.sum("area"), F.sum("pos") * F.sum("neg"))).alias("loss"))
        )

    return loss


def native_importance(model: PipelineModel, features: Sequence[str], top_n: int = 20) -> DataFrame:
    """Impurity importance of the last stage, largest first."""
    values = model.stages[-1].featureImportances.toArray()
    rows = [(c, float(v)) for c, v in zip(features, values)]
    df = SparkSession.active().createDataFrame(rows, "feature string, importance double")
    return top_k(df, F.col("importance"), top_n, ["feature"])


def forest_nodes(model: PipelineModel, folder: str) -> DataFrame:
    """The trees of a fitted forest of two classes as a table, one row a node; ``value`` is the share of
    class 1 among the (weighted) rows of the node. The forest is written to ``folder`` and read back."""
    path = f"{folder.rstrip('/')}/forest-{uuid.uuid4().hex}"
    model.stages[-1].write().save(path)
    node = SparkSession.active().read.parquet(f"{path}/data").select("treeID", "nodeData.*")
    inner = F.col("leftChild") >= 0
    return node.select(
        F.col("treeID").alias("tree"), F.col("id").alias("node"), F.when(inner, F.col("split.featureIndex")).alias("feature"),
        F.when(inner, F.col("split.leftCategoriesOrThreshold")[0]).alias("threshold"), F.when(inner, F.col("leftChild")).alias("left"),
        F.when(inner, F.col("rightChild")).alias("right"), (F.col("impurityStats")[1] / (F.col("impurityStats")[0] + F.col("impurityStats")[1])).alias("value"),
        (F.col("impurityStats")[0] / (F.col("impurityStats")[0] + F.col("impurityStats")[1])).alias("rest"))


def _trees(nodes: DataFrame) -> list[tuple[np.ndarray, ...]]:
    """Feature (-1: leaf), threshold, children and shares of class 1 and 0 of each tree's nodes, by node."""
    trees = []
    for _, t in nodes.toPandas().sort_values(["tree", "node"]).groupby("tree"):
        whole = lambda c, t=t: t[c].fillna(-1).to_numpy(np.int64)
        trees.append((whole("feature"), t["threshold"].to_numpy(np.float64), whole("left"), whole("right"), t["value"].to_numpy(np.float64), t["rest"].to_numpy(np.float64)))
    return trees


def _paths(tree: tuple[np.ndarray, ...], k: int) -> np.ndarray:
    """Nodes x features: whether a split above the node asks for the feature; children stand behind their parents."""
    feature, _, left, right, *_ = tree
    asked = np.zeros((len(feature), k), bool)
    for i in np.flatnonzero(feature >= 0):
        for child in (left[i], right[i]):
            asked[child] = asked[i]
            asked[child, feature[i]] = True
    return asked


def _leaves(tree: tuple[np.ndarray, ...], n: int, value: Callable[[np.ndarray, np.ndarray], np.ndarray]) -> np.ndarray:
    """The leaf each of ``n`` rows ends in; ``value(feature, row)`` are their values."""
    feature, cut, left, right, *_ = tree
    rows, at = np.arange(n), np.zeros(n, np.int64)
    while len(rows := rows[feature[at[rows]] >= 0]):
        node = at[rows]
        at[rows] = np.where(value(feature[node], rows) <= cut[node], left[node], right[node])
    return at


def forest_swaps(nodes: DataFrame, features: Sequence[str]) -> Callable[[Column, Column], Column]:
    """A forest's probabilities of class 1 of a row's values (an array) with one after another taken from
    its donor's. A tree is walked again only for the features a row meets on its way down, as the others
    lead to the same leaf. The node table is sent to all tasks."""
    k, trees = len(features), _trees(nodes)
    shared = nodes.sparkSession.sparkContext.broadcast([(t, _paths(t, k)) for t in trees])

    def run(own: pd.Series, other: pd.Series) -> pd.Series:
        x, y = (np.ascontiguousarray(np.vstack(s.to_numpy()).T.astype(np.float64)) for s in (own, other))
        differs, n = x != y, x.shape[1]
        votes = np.zeros((2, k, n))
        for tree, paths in shared.value:
            leaf = _leaves(tree, n, lambda f, r: x[f, r])
            swapped, row = np.nonzero(paths[leaf].T & differs)
            found = _leaves(tree, len(row), lambda f, i: np.where(f == swapped[i], y[f, row[i]], x[f, row[i]]))
            for sums, share in zip(votes, tree[4:]):
                mine = np.repeat(share[leaf][None, :], k, 0)
                mine[swapped, row] = share[found]
                sums += mine
        return pd.Series(list((votes[0] / (votes[0] + votes[1])).T))

    return F.pandas_udf(run, T.ArrayType(T.DoubleType()))


def boosted_swaps(model: Boosted) -> Callable[[Column, Column], Column]:
    """A boosted model's scores of a row's values (an array) with one after another taken from its donor's. A tree
    is walked again only for the features a row meets on its way down, as the others lead to the same leaf."""
    text, k = model.to_json(), len(model.features)

    def run(own: pd.Series, other: pd.Series) -> pd.Series:
        mine = boosting.loaded(text)
        x, y = (boosting.to_bins(list(np.vstack(s.to_numpy()).T.astype(np.float64)), mine.edges) for s in (own, other))
        differs, n = x != y, x.shape[1]
        scores = np.full((k, n), mine.start[0])
        for [arrays] in mine.arrays_by_round:
            feature, value = arrays[0], arrays[5]
            leaf = boosting.walk(arrays, x)
            before = value[leaf]
            met = _paths((feature, None, arrays[3], arrays[4]), k)
            change = {}
            for f in np.unique(feature[feature >= 0]):
                rows = np.flatnonzero(met[leaf, f] & differs[f])
                if len(rows):
                    kept, x[f, rows] = x[f, rows], y[f, rows]
                    change[f] = rows, value[boosting.walk(arrays, x, rows)]
                    x[f, rows] = kept
            for f in range(k):
                after = before
                if f in change:
                    after = before.copy()
                    after[change[f][0]] = change[f][1]
                scores[f] += after
        return pd.Series(list(scores.T))

    def swaps(own: Column, other: Column) -> Column:
        known = lambda v: F.array(*[F.coalesce(v[i].cast("double"), F.lit(float(model.fills.get(c, "nan")))) for i, c in enumerate(model.features)])
        return F.pandas_udf(run, T.ArrayType(T.DoubleType()))(known(own), known(other))

    return swaps


def forest_contributions(nodes: DataFrame, features: Sequence[str]) -> tuple[float, Column]:
    """(base value, column of one contribution a feature) of a forest's probability of class 1. The
    node table is sent to all tasks; trees and depth bound its size."""
    trees = _trees(nodes)
    shared = nodes.sparkSession.sparkContext.broadcast(trees)

    def run(*columns: pd.Series) -> pd.Series:
        x = np.array([c.to_numpy(np.float64) for c in columns])
        out, n = np.zeros(x.shape), x.shape[1]
        for feature, cut, left, right, value, _ in shared.value:
            rows, at = np.arange(n), np.zeros(n, np.int64)
            while len(rows := rows[feature[at[rows]] >= 0]):
                node = at[rows]
                child = np.where(x[feature[node], rows] <= cut[node], left[node], right[node])
                out[feature[node], rows] += (value[child] - value[node]) / len(shared.value)
                at[rows] = child
        return pd.Series(list(out.T))

    base = sum(float(t[4][0]) for t in trees) / len(trees)
    return base, F.pandas_udf(run, T.ArrayType(T.DoubleType()))(*[F.coalesce(F.col(f"`{c}`").cast("double"), F.lit(0.0)) for c in features])


def explain(scored: DataFrame, base: float, parts: Column, features: Sequence[str], top_n: int = 10) -> DataFrame:
    """Every row with base_value, explained (base value and all contributions, which is the model's
    score) and its ``top_n`` features: the contribution, the row's value and the direction, strongest
    first, equal ones in the order of ``features``."""
    out = scored.withColumn("_parts", parts)
    named = F.array(*[
        F.struct((-F.abs(F.col("_parts")[i])).alias("order"), F.lit(i).alias("place"), F.lit(c).alias("feature"),
                 F.col("_parts")[i].alias("contribution"), F.col(f"`{c}`").cast("double").alias("value"))
        for i, c in enumerate(features)])
    shown = F.transform(F.slice(F.array_sort(named), 1, top_n), lambda p: F.struct(
        p["feature"].alias("feature"), p["contribution"].alias("contribution"), p["value"].alias("value"),
        F.when(p["contribution"] > 0, "increases").otherwise("decreases").alias("direction")))
    total = F.aggregate("_parts", F.lit(float(base)), lambda a, x: a + x)
    return out.withColumns({"base_value": F.lit(float(base)), "explained": total, "top_features": shown}).drop("_parts")
