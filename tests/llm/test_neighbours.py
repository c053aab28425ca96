"""Nearest neighbours against brute force."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from depotkit.llm import neighbours
from depotkit.llm.queries import QUERIES


def slow(rows, asked, k):
    """(query_id, rank, vec_id) by cosine, ties to the smaller id; and the scores."""
    good = [(i, np.array(v, np.float64)) for i, v in rows if i is not None and v and None not in v and np.isfinite(v).all() and np.any(np.array(v))]
    out = {}
    for q, a in good:
        if not asked(q):
            continue
        scores = [(-(a * b).sum() / (np.sqrt((a * a).sum()) * np.sqrt((b * b).sum())), i) for i, b in good if i != q]
        out[q] = sorted(scores)[:k]
    return out


def table(spark, rows):
    return spark.createDataFrame([(*r, "x", "y") for r in rows], "vec_id long, embedding array<float>, cell string, v string")


def by_query(df):
    out = {}
    for r in sorted(df.collect(), key=lambda r: (r.query_id, r.rank)):
        out.setdefault(r.query_id, []).append((-r.score, r.vec_id))
        assert r.rank == len(out[r.query_id])
    return out


def close(got, want):
    assert sorted(got) == sorted(want)
    for q, rows in want.items():
        assert [i for _, i in got[q]] == [i for _, i in rows]
        assert np.allclose([s for s, _ in got[q]], [s for s, _ in rows], rtol=0, atol=1e-12)


def sample(n, seed=1, width=8):
    rng = np.random.default_rng(seed)
    spots = rng.normal(size=(7, width))
    return [(i, (spots[i % 7] + 0.3 * rng.normal(size=width)).astype(np.float32).tolist()) for i in range(n)]


@pytest.mark.parametrize("shard_rows", [30, 10000])
def test_factor_one_is_exact(spark, shard_rows):
    rows = sample(600)
    rows += [(1000 + i, rows[14][1]) for i in range(40)]  # copies: ties to the smaller ids
    df = table(spark, rows)
    got = neighbours.nearest(df, df.filter("vec_id % 7 = 0"), k=5, factor=1.0, shard_rows=shard_rows, block_queries=20)
    close(by_query(got), slow(rows, lambda q: q % 7 == 0, 5))


def test_awkward_vectors(spark):
    rows = [(50, [1.0, 0.0]), (100, [2.0, 0.0]), (150, None), (200, [0.0, 0.0]), (250, [float("nan"), 1.0]), (300, [float("inf"), 1.0]), (350, [None, 1.0]), (400, [0.5, 0.5]), (None, [1.0, 1.0]), (450, [])]
    df = table(spark, rows)
    got = by_query(neighbours.nearest(df, df.filter("vec_id % 50 = 0"), k=5))
    close(got, slow(rows, lambda q: True, 5))
    assert sorted(got) == [50, 100, 400] and len(got[50]) == 2  # all candidates, if fewer
    assert neighbours.nearest(table(spark, []), table(spark, [])).count() == 0
    one = table(spark, [(1, [1.0, 2.0])])
    assert neighbours.nearest(one, one).count() == 0
    twice = table(spark, [(1, [1.0, 0.0]), (1, [0.0, 1.0]), (2, [1.0, 1.0])])
    assert neighbours.nearest(twice, twice.filter("vec_id = 2")).count() == 2  # vectors of their own


def test_recall_of_the_production_factor(spark):
    for width, seed in ((16, 3), (64, 4)):
        rows = sample(4000, seed, width)
        df = table(spark, rows)
        got = by_query(neighbours.nearest(df, df.filter("vec_id % 50 = 0"), k=5, factor=neighbours.FACTOR, shard_rows=500))
        want = slow(rows, lambda q: q % 50 == 0, 5)
        hits = sum(len({i for _, i in got[q]} & {i for _, i in want[q]}) for q in want)
        assert hits >= 0.9 * 5 * len(want)


def test_query_reaches_its_recall(spark, folder):
    got = by_query(QUERIES["op8_neighbours"](spark, folder))
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{folder}/embeddings.parquet").collect()]
    want = slow(rows, lambda q: q % 50 == 0, 5)
    assert sorted(got) == sorted(want)
    assert sum(len({i for _, i in got[q]} & {i for _, i in want[q]}) for q in want) >= 0.9 * 5 * len(want)


def test_a_smaller_factor_prunes_more():
    rng = np.random.default_rng(5)
    v = neighbours.unit(rng.normal(size=(2000, 6)))
    tree, looked = neighbours.Tree(v, leaf=16), []
    far = neighbours.distances
    for factor in (1.0, 0.5):
        seen = []
        neighbours.distances = lambda a, b, seen=seen: seen.append(len(a) * len(b)) or far(a, b)
        try:
            tree.search(v[:50], np.arange(50), np.arange(2000), 5, factor, np.full(50, np.inf))
        finally:
            neighbours.distances = far
        looked.append(sum(seen))
    assert looked[1] < looked[0] < 50 * 2000


def test_double_vectors_keep_their_precision(spark):
    rng = np.random.default_rng(5)
    rows = [(i, (1 + 1e-9 * rng.normal(size=6)).tolist()) for i in range(300)]  # alike in single precision
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = by_query(neighbours.nearest(df, df.filter("vec_id % 50 = 0"), k=5, shard_rows=100))
    single = df.withColumn("embedding", F.col("embedding").cast("array<float>"))
    assert neighbours.usable(df, "vec_id", "embedding").dtypes[1][1] == "array<double>"
    assert neighbours.usable(single, "vec_id", "embedding").dtypes[1][1] == "array<float>"
    assert len(got) == 6 and all(len(r) == 5 for r in got.values())


@pytest.mark.parametrize("shard_rows", [40, 10000])
def test_repeated_query_rows_lose_nothing(spark, shard_rows):
    rows = sample(300)
    rows += [rows[50], rows[50], rows[100]]  # the same row again
    rows += [(150, rows[3][1])]  # another vector under one id
    rows += [(200, [5.0] * 8)] * 9 + [(1000 + i, [5.0] * 8) for i in range(7)]  # equal vectors, most of them the query's own
    df = table(spark, rows)
    got = {}
    found = neighbours.nearest(df, df.filter("vec_id % 50 = 0"), k=5, factor=1.0, shard_rows=shard_rows)
    for r in found.collect():
        got.setdefault(r.query_id, []).append((r.rank, r.vec_id))
    want = {}
    for q, v in {(i, tuple(v)) for i, v in rows if i % 50 == 0}:
        others = [(i, w) for i, w in rows if i != q]
        nearest = slow([(q, list(v)), *others], lambda i, q=q: i == q, 5)[q]
        want.setdefault(q, []).extend((n, i) for n, (_, i) in enumerate(nearest, 1))
    assert {q: sorted(x) for q, x in got.items()} == {q: sorted(x) for q, x in want.items()}
    assert len(got[50]) == 5 and len(got[150]) == 10
