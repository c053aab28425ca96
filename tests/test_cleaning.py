import datetime as dt

import numpy as np
import pandas as pd
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from depotkit.operators import cleaning as cl
from depotkit.operators import ordering
from depotkit.operators.ordering import global_quantiles, group_quantiles, key_value, row_index, running_totals, sort_key


def test_global_quantiles_equal_numpy(spark):
    rng = np.random.default_rng(7)
    skewed = np.concatenate([np.full(900, 3.0), rng.lognormal(0, 3, 1201), rng.integers(0, 5, 400), -rng.lognormal(0, 9, 300)])
    df = spark.createDataFrame([(float(v), float(i % 7)) for i, v in enumerate(skewed)], "v double, w double")
    df = df.unionByName(spark.createDataFrame([(None, None), (float("nan"), None)], "v double, w double"))
    probs = [0.0, 0.25, 0.5, 0.9, 1.0]
    got = global_quantiles(df, ["v", "w"], probs)
    np.testing.assert_allclose(got["v"], np.quantile(skewed, probs), rtol=1e-12)
    np.testing.assert_allclose(got["w"], np.quantile(np.arange(len(skewed)) % 7, probs), rtol=1e-12)


EDGES = [0.0, -0.0, 5e-324, -5e-324, 2.2250738585072014e-308, 2.225073858507201e-308, 1.7976931348623157e308, -1.7976931348623157e308,
         float("inf"), float("-inf"), 1.0, 0.9999999999999999, 1.0000000000000002, 2.0, 4.0, 3.9999999999999996, 8.0, 1e22, 0.1]


@settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.floats(allow_nan=False), min_size=1, max_size=300))
def test_sort_keys_are_the_bits_and_come_back(spark, xs):
    xs = xs + EDGES
    df = spark.createDataFrame([(x,) for x in xs], "v double").withColumn("k", sort_key(F.col("v"))).withColumn("again", key_value(F.col("k")))
    got = df.toPandas()
    bits = np.abs(np.array(xs)).view(np.int64)
    assert got["k"].tolist() == np.where(np.array(xs) < 0, -bits, bits).tolist()
    assert got["again"].tolist() == [x + 0.0 for x in xs]
    assert spark.createDataFrame([(None,), (float("nan"),)], "v double").filter(sort_key(F.col("v")).isNotNull()).count() == 0


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.floats(-1e6, 1e6), min_size=1, max_size=40))
def test_global_quantiles_property(spark, xs):
    df = spark.createDataFrame([(x,) for x in xs], "v double")
    got = global_quantiles(df, ["v"], [0.25, 0.75])["v"]
    np.testing.assert_allclose(got, np.quantile(xs, [0.25, 0.75]), rtol=1e-9, atol=1e-9)


def test_quantiles_without_values(spark):
    df = spark.createDataFrame([(None,)], "v double")
    assert global_quantiles(df, ["v"], [0.5]) == {"v": [None]}
    assert global_quantiles(df.limit(0), ["v"], [0.5]) == {"v": [None]}
    assert group_quantiles(df.withColumn("g", F.lit(1)), ["v"], [0.5], ["g"]).count() == 0


def test_group_quantiles_equal_pandas(spark):
    rng = np.random.default_rng(3)
    pdf = pd.DataFrame({"c": rng.choice(list("aaaaab"), 3000), "v": rng.normal(size=3000).round(2), "w": rng.normal(size=3000)})
    pdf.loc[pdf.index % 11 == 0, "v"] = np.nan
    df = spark.createDataFrame(pdf).withColumn("v", F.nanvl("v", F.lit(None)))
    got = group_quantiles(df, ["v", "w"], [0.1, 0.5], ["c"]).orderBy("c").toPandas()
    for c in ("v", "w"):
        want = pdf.groupby("c")[c].quantile([0.1, 0.5]).unstack()
        np.testing.assert_allclose(got[[f"{c}_q0", f"{c}_q1"]], want, rtol=1e-12)


def test_quantiles_of_one_hot_group(spark):
    df = spark.range(200_000).select(F.lit("hot").alias("g"), (F.col("id") % 1000 / 8).alias("v"))
    assert group_quantiles(df, ["v"], [0.5], ["g"]).first()["v_q0"] == 62.4375


@pytest.mark.parametrize("few", [False, True])
def test_keep_one_null_keys_and_order(spark, few):
    rows = [(1, "b", 2), (1, "a", 9), (None, "x", 1), (None, "w", 0), (2, None, 5)]
    df = spark.createDataFrame(rows, "k int, s string, v int")
    first = {tuple(r) for r in cl.keep_one(df, ["k"], ["v"], few_copies=few).collect()}
    assert first == {(1, "b", 2), (None, "w", 0), (2, None, 5)}
    last = {tuple(r) for r in cl.keep_one(df, ["k"], ["v"], last=True, few_copies=few).collect()}
    assert last == {(1, "a", 9), (None, "x", 1), (2, None, 5)}


@pytest.mark.parametrize("words", [1, 4, cl.FILTER_WORDS])
def test_keep_one_with_a_crowded_filter(spark, words):
    """A filter whose bits are nearly all set sends lone rows through the comparison, which keeps them."""
    rng = np.random.default_rng(3)
    rows = [(int(k), int(v), f"t{v % 5}") for k, v in zip(rng.integers(0, 300, 500), rng.integers(0, 40, 500))]
    df = spark.createDataFrame([*rows, *rows[:20]], "k int, v int, s string")
    single, repeated = cl._split_repeated(df, ["k"], words)
    counts = {r["k"]: r["count"] for r in df.groupBy("k").count().collect()}
    assert all(counts[r.k] == 1 for r in single.collect())
    assert single.count() + repeated.count() == len(rows) + 20
    assert any(counts[r.k] == 1 for r in repeated.collect()) == (words < cl.FILTER_WORDS)
    for last, pick in ((False, min), (True, max)):
        want = {}
        for r in rows:
            want[r[0]] = pick(want.get(r[0], r), r)
        got = cl.keep_one(df, ["k"], last=last, few_copies=True, words=words).collect()
        assert sorted(tuple(r) for r in got) == sorted(want.values())


@pytest.mark.parametrize("few", [False, True])
def test_keep_one_with_maps_and_odd_names(spark, few):
    rows = [(1, {"b": 2, "a": 1}, 1.0), (1, {"a": 0, "c": 5}, 2.0), (2, None, 3.0), (2, {"x": 1}, 4.0), (3, {}, 5.0), (4, None, None)]
    df = spark.createDataFrame(rows, "k int, m map<string,int>, `x.y` double")
    assert sorted(map(tuple, cl.keep_one(df, ["k"], few_copies=few).collect())) == [(1, {"a": 0, "c": 5}, 2.0), (2, None, 3.0), (3, {}, 5.0), (4, None, None)]
    assert cl.keep_one(df.limit(0), ["k"], few_copies=few).collect() == []
    assert cl.keep_one(df, ["k"], few_copies=few).dtypes == df.dtypes


@pytest.mark.parametrize("few", [False, True])
def test_keep_one_zeros_and_nan_are_one_key(spark, few):
    df = spark.createDataFrame([(0.0, 2), (-0.0, 1), (float("nan"), 4), (float("nan"), 3)], "k double, v int")
    assert sorted(r.v for r in cl.keep_one(df, ["k"], few_copies=few).collect()) == [1, 3]


def test_group_median_falls_back_to_the_filled_global_median(spark):
    rows = [("a", 1.0), ("a", 3.0), ("a", None), ("b", None), ("b", None), (None, None), ("c", 10.0)]
    df = spark.createDataFrame(rows, "g string, v double")
    got = sorted((r.g or "", r.v) for r in cl.group_median_impute(df, ["v"], "g").collect())
    # a's gap becomes 2; the global median of 1, 3, 2, 10 is 2.5
    assert got == [("", 2.5), ("a", 1.0), ("a", 2.0), ("a", 3.0), ("b", 2.5), ("b", 2.5), ("c", 10.0)]


def test_iqr_cap(spark):
    xs = [1.0, 2.0, 3.0, 4.0, 1000.0, None]
    df = spark.createDataFrame([(x,) for x in xs], "v double")
    got = [r.v for r in cl.iqr_cap(df, cl.iqr_bounds(df, ["v"])).collect()]
    assert got == [1.0, 2.0, 3.0, 4.0, 10.0, None]


def test_clean_sales_steps(spark):
    rows = [
        ("1", "7", "2024-01-05", "3", "9.5", " Web ", "North", "150", "YES", "x"),
        ("1", "7", "2024-01-06", "4", "9.5", "Store", "North", None, "0", "x"),
        ("2", "7", "bad", "3", "9.5", "b2b", "North", "5", None, "x"),
        ("3", None, "2024-01-05", "3", "9.5", "b2b", "North", "5", None, "x"),
        ("4", "7", "2024-01-05", "-3", "9.5", "b2b", "North", "5", None, "x"),
        ("5", "8", "2024-01-05", "2", "n/a", None, "North", "-5", "1.0", "x"),
    ]
    cols = "sale_id product_id sale_date quantity_sold unit_price channel region discount_pct is_returned created_at"
    df = spark.createDataFrame(rows, ", ".join(f"{c} string" for c in cols.split()))
    got = {r.sale_id: r for r in cl.clean_sales(df).collect()}
    assert set(got) == {1, 5}
    assert (got[1].sale_date, got[1].channel, got[1].discount_pct, got[1].is_returned) == (dt.date(2024, 1, 5), "online", 100.0, True)
    assert (got[5].unit_price, got[5].channel, got[5].discount_pct, got[5].is_returned) == (None, None, 0.0, False)


def test_clean_inventory_keeps_last_and_clamps_reserved(spark):
    rows = [
        (1, 7, "2024-01-05", "W", "10", "30", "no", "5"),
        (2, 7, "2024-01-05", "W", "8", None, "1", "5"),
        (3, 7, "2024-01-06", "W", "-8", "2", "1", "x"),
    ]
    ddl = "inventory_id long, product_id long, snapshot_date string, warehouse_id string, quantity_on_hand string, quantity_reserved string, reorder_triggered string, unit_cost_snapshot string"
    got = {r.inventory_id: r for r in cl.clean_inventory(spark.createDataFrame(rows, ddl)).collect()}
    assert set(got) == {2, 3}
    assert (got[2].quantity_on_hand, got[2].quantity_reserved, got[2].reorder_triggered) == (8, 0, True)
    assert (got[3].quantity_on_hand, got[3].quantity_reserved, got[3].unit_cost_snapshot) == (0, 0, None)


def test_running_totals_and_row_index(spark):
    rng = np.random.default_rng(1)
    keys = rng.permutation(500)
    df = spark.createDataFrame([(int(k), int(k % 13)) for k in keys], "k int, v int")
    got = running_totals(df, [F.col("k").desc()], {"t": "v"}).orderBy(F.col("k").desc()).toPandas()
    np.testing.assert_array_equal(got.t, (got.k % 13).cumsum())
    idx = row_index(df, [F.col("k").asc()], "i").toPandas()
    np.testing.assert_array_equal(idx.i, idx.k)


def test_quantiles_need_two_passes_of_counts(spark, monkeypatch):
    """Values of few leading digits are told apart by two passes, each of which reads the table again."""
    passes = []
    settle = ordering.cut_lineage
    monkeypatch.setattr(ordering, "cut_lineage", lambda df: passes.append(1) or settle(df))
    df = spark.range(3000).select((F.col("id") % 3).alias("g"), (F.col("id") * 0.00001 + 900).alias("v"))
    rows = {r["g"]: r["v_q0"] for r in group_quantiles(df, ["v"], [0.5], ["g"]).collect()}
    for g in range(3):
        np.testing.assert_allclose(rows[g], np.median(np.arange(g, 3000, 3) * 0.00001 + 900), rtol=1e-12)
    assert len(passes) <= 2


def test_text_keys_are_told_apart_by_a_hash_first(spark, monkeypatch):
    """Texts that begin alike would be fetched and compared at every step of the sort."""
    rows = [(f"9007199254740{i % 700:03d}", i) for i in range(1000)]
    df = spark.createDataFrame(rows, "k string, v long")
    plan = lambda d: d._jdf.queryExecution().executedPlan().toString()
    assert "xxhash64" in plan(cl.keep_one(df, ["k"])) and "xxhash64" in plan(cl.keep_one(df, ["v", "k"]))
    assert "xxhash64" not in plan(cl.keep_one(df, ["v"]))
    want = sorted((f"9007199254740{i:03d}", i) for i in range(700))
    assert sorted(map(tuple, cl.keep_one(df, ["k"]).collect())) == want
    monkeypatch.setattr(cl.F, "xxhash64", lambda *_: F.lit(1).cast("long"))
    assert sorted(map(tuple, cl.keep_one(df, ["k"]).collect())) == want


def test_ids_of_whole_types_need_no_pass(spark):
    boom = F.raise_error(F.lit("read")).cast("long")
    sales = spark.range(3).select(boom.alias("sale_id"), F.lit("x").alias("product_id"))
    assert cl.text_ids({"sales": sales}) == {"product_id"}
    assert cl.text_ids({"sales": sales.drop("product_id")}) == set()


def test_quantiles_of_a_table_move_no_rows_after_the_first_pass(spark, monkeypatch):
    """Few rows in the open buckets: the second pass is the last, and rows are compared with literals."""
    plans, literals = [], ordering._literals
    monkeypatch.setattr(ordering, "_literals", lambda df, rows: plans.append(df._jdf.queryExecution().executedPlan().toString()) or literals(df, rows))
    df = spark.range(3000).select((F.col("id") * 2.0**-40 + 900).alias("v"), (F.col("id") % 2 * 1.0).alias("w"))
    got = global_quantiles(df, ["v", "w"], [0.25, 0.5])
    x = np.arange(3000) * 2.0**-40 + 900
    assert got == {"v": np.quantile(x, [0.25, 0.5]).tolist(), "w": np.quantile(np.arange(3000) % 2, [0.25, 0.5]).tolist()}
    assert len(plans) == 2 and "SortMergeJoin" not in plans[1]


def test_quantiles_of_a_table_with_full_buckets_take_three_passes(spark, monkeypatch):
    monkeypatch.setattr(ordering, "SHIFTS", (44, 8, 0))
    df = spark.range(3000).select((F.col("id") * 2.0**-40 + 900).alias("v"))
    passes, literals = [], ordering._literals
    monkeypatch.setattr(ordering, "_literals", lambda df, rows: passes.append(1) or literals(df, rows))
    np.testing.assert_array_equal(global_quantiles(df, ["v"], [0.25, 0.9])["v"], np.quantile(np.arange(3000) * 2.0**-40 + 900, [0.25, 0.9]))
    assert len(passes) == 3
