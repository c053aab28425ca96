import datetime as dt

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from depotkit.operators import labels, windows as win
from depotkit.plans import features


def series_of(spark, *lists):
    rows = [(e, i, v) for e, xs in enumerate(lists) for i, v in enumerate(xs)]
    return spark.createDataFrame(rows, "e int, i int, v double")


def spec():
    return Window.partitionBy("e").orderBy("i")


def test_trailing_statistics_equal_pandas(spark):
    rng = np.random.default_rng(0)
    lists = [[4.0], [1.0, 2.0], [5.0, 5.0, 5.0], rng.normal(size=40).tolist()]
    got = (
        series_of(spark, *lists)
        .withColumns({"m": win.trailing_mean("v", 7, spec()), "s": win.trailing_std("v", 7, spec())})
        .orderBy("e", "i").toPandas()
    )
    for e, xs in enumerate(lists):
        mine, before = got[got.e == e], pd.Series(xs).shift(1).rolling(7, min_periods=1)
        np.testing.assert_allclose(mine.m.astype(float), before.mean(), atol=1e-9)
        np.testing.assert_allclose(mine.s, before.std().fillna(0), atol=1e-7)


def test_fill_both_ways(spark):
    df = series_of(spark, [None, 1.0, None, 2.0, None], [None, None])
    got = df.withColumn("f", win.fill_both_ways("v", spec())).orderBy("e", "i").collect()
    assert [r.f for r in got] == [1.0, 1.0, 1.0, 2.0, 2.0, None, None]


def test_slope_equals_least_squares(spark):
    xs = [3.0, 1.0, 4.0, None, 5.0, 9.0, 2.0]
    got = [r.s for r in series_of(spark, xs).withColumn("s", win.slope3("v", spec())).orderBy("i").collect()]
    for i in range(len(xs)):
        part = xs[max(0, i - 2) : i + 1]
        want = None if len(part) < 2 or None in part else np.polyfit(range(len(part)), part, 1)[0]
        assert (got[i] is None) == (want is None)
        if want is not None:
            assert got[i] == pytest.approx(want)


def test_run_length_resets(spark):
    df = series_of(spark, [0.0, 1.0, 1.0, 0.0, 1.0, 1.0, 1.0], [1.0, 1.0]).withColumn("p", F.row_number().over(spec()))
    got = df.withColumn("r", win.run_length(F.col("v") == 1, "p", spec())).orderBy("e", "i").collect()
    assert [r.r for r in got] == [0, 1, 2, 0, 1, 2, 3, 1, 2]


@pytest.mark.parametrize("max_rows", [1000, 7])
def test_floored_balance_equals_a_loop(spark, max_rows):
    rng = np.random.default_rng(5)
    moves = [[int(x) for x in rng.integers(-9, 9, n)] for n in (1, 30, 200)]
    moves[2][0] = moves[2][50] = None  # no change
    entities = [0, None, 2]
    rows = [(e, i, v) for e, xs in zip(entities, moves) for i, v in enumerate(xs)]
    df = spark.createDataFrame(rows, "e int, i int, v int")
    got = df.transform(win.floored_balance(F.lit(5), "v", ["e"], ["i"], max_rows)).collect()
    want = {}
    for e, xs in zip(entities, moves):
        q = 5
        for i, x in enumerate(xs):
            q = max(0, q + (x or 0))
            want[e, i] = q
    assert {(r.e, r.i): r.balance for r in got} == want and len(got) == len(rows)


def test_floored_balance_of_one_long_series_is_cut(spark, monkeypatch):
    seen = []
    cut = win.cut_lineage
    monkeypatch.setattr(win, "cut_lineage", lambda df: seen.append(cut(df)) or seen[-1])
    df = spark.range(5000).select(F.lit("one").alias("e"), "id", (F.pmod("id", F.lit(7)) - 3).alias("v"))
    got = df.transform(win.floored_balance(F.lit(0), "v", ["e"], ["id"], 500))
    q, want = 0, []
    for i in range(5000):
        q = max(0, q + i % 7 - 3)
        want.append(q)
    assert [r.balance for r in got.orderBy("id").collect()] == want
    sizes = [r["count"] for r in seen[0].groupBy("_block").count().collect()]
    assert len(sizes) >= 8 and max(sizes) <= 1500


def test_floored_balance_of_no_rows(spark):
    df = spark.createDataFrame([], "e int, i int, v int")
    assert df.transform(win.floored_balance(F.lit(5), "v", ["e"], ["i"])).collect() == []


def test_fill_days_spans_the_whole_table(spark):
    d = lambda n: dt.date(2024, 1, 1) + dt.timedelta(days=n)
    rows = [(1, d(3), 5.0), (1, d(5), 6.0), (2, d(0), 1.0), (3, d(9), 2.0)]
    df = spark.createDataFrame(rows, "e int, day date, v double")
    got = win.fill_days(df, "e", "day", win.day_bounds(df, "day")).orderBy("e", "day").collect()
    assert len(got) == 3 * 10 and len({(r.e, r.day) for r in got}) == 30
    assert {(r.e, r.day, r.v) for r in got if r.v is not None} == set(rows)


def test_label_looks_at_today_and_ahead(spark):
    rows = [(1, dt.date(2024, 1, 1 + i), v) for i, v in enumerate([5, 4, 3, 2, 9])]
    df = spark.createDataFrame(rows, "product_id int, snapshot_date date, quantity_on_hand long")
    got = labels.stockout_cells(df, 2).orderBy("snapshot_date").collect()
    assert [r.future_min_stock for r in got] == [3, 2, 2, None, None]
    assert [r.stockout_in_horizon for r in got] == [0, 0, 0, 1, 1]
    null_edge = labels.stockout_cells(df, 2, "null").orderBy("snapshot_date").collect()
    assert [r.stockout_in_horizon for r in null_edge] == [0, 0, 0, None, None]


def test_label_equals_the_grid_definition(spark):
    rng = np.random.default_rng(11)
    rows = [
        (p, dt.date(2024, 1, 1) + dt.timedelta(days=int(d) * 2), w, int(rng.integers(0, 4)))
        for p in range(6) for d in range(25) for w in range(2) if rng.random() < (0.97 if p else 0.6)
    ]
    pdf = pd.DataFrame(rows, columns=["product_id", "snapshot_date", "w", "quantity_on_hand"])
    wide = pdf.pivot_table(index="snapshot_date", columns="product_id", values="quantity_on_hand", aggfunc="min")
    got = labels.stockout_cells(spark.createDataFrame(pdf.drop(columns="w")), 3).toPandas()
    for r in got.itertuples():
        at = list(wide.index).index(r.snapshot_date)
        frame = wide[r.product_id].iloc[at : at + 4]
        low = frame.min() if len(frame) == 4 and frame.notna().all() else None
        assert r.stockout_in_horizon == (1 if low is None else int(low == 0))


def stock_tables(spark, seed=2, products=4, days=60, warehouses=3):
    rng = np.random.default_rng(seed)
    rows, sales, i = [], [], 0
    for p in range(products):
        for d in range(days):
            day = dt.date(2024, 1, 1) + dt.timedelta(days=d)
            for w in range(warehouses if p else 1):
                if rng.random() < 0.9:
                    i += 1
                    rows.append((i, p, day, f"W{w}", int(rng.integers(0, 20)), int(rng.integers(0, 3)), False, 2.0))
            sales.append((p, day, int(rng.integers(0, 9))))
    inv = spark.createDataFrame(
        rows,
        "inventory_id long, product_id long, snapshot_date date, warehouse_id string, quantity_on_hand long, "
        "quantity_reserved long, reorder_triggered boolean, unit_cost_snapshot double",
    )
    prod = spark.createDataFrame(
        [(p, 8, 20, 3 + p, 1.5) for p in range(products)],
        "product_id long, reorder_point long, reorder_quantity long, lead_time_days long, unit_cost double",
    )
    sold = spark.createDataFrame(sales, "product_id long, sale_date date, net_quantity long")
    return features.transform_inventory(inv, prod), sold, prod


@pytest.mark.parametrize("limit", [31, 50])
def test_blocked_series_equal_plain_ones(spark, limit):
    tables = stock_tables(spark)
    plain = features.stockout_features(*tables).toPandas()
    blocked = features.stockout_features(*tables, max_series_rows=limit).toPandas()
    columns = list(plain.columns)
    a = plain.sort_values("inventory_id")[columns].reset_index(drop=True)
    b = blocked.sort_values("inventory_id")[columns].reset_index(drop=True)
    assert plain.consec_low_stock_days.max() > 3
    pd.testing.assert_frame_equal(a, b, check_exact=False, rtol=1e-9, atol=1e-9)


def test_stockout_windows_equal_pandas(spark):
    inv, sold, prod = stock_tables(spark, seed=4)
    got = features.stockout_features(inv, sold, prod).toPandas().set_index("inventory_id").sort_index()
    p = inv.toPandas().merge(
        sold.toPandas().rename(columns={"sale_date": "snapshot_date", "net_quantity": "y"}), how="left",
        on=["product_id", "snapshot_date"],
    )
    p["y"] = p.y.fillna(0)
    p = p.sort_values(["product_id", "snapshot_date", "warehouse_id", "inventory_id"])
    g = p.groupby("product_id")
    p["m7"] = g.y.transform(lambda s: s.shift(1).rolling(7, min_periods=1).mean())
    p["low"] = (p.quantity_available <= p.reorder_point).astype(int)
    run, runs, last = 0, [], None
    for r in p.itertuples():
        run = 0 if r.product_id != last else run
        run, last = (run + 1 if r.low else 0), r.product_id
        runs.append(run)
    p["run"] = runs
    p = p[p.m7.notna()].set_index("inventory_id").sort_index()
    assert list(p.index) == list(got.index)
    np.testing.assert_allclose(got.demand_mean_7d, p.m7)
    np.testing.assert_allclose(got.consec_low_stock_days, p.run)


def test_supplier_features_blocked_equal_plain(spark):
    rng = np.random.default_rng(9)
    rows = [
        (s * 100 + m, s, None if m == 9 else dt.datetime(2024, 1 + m % 12, 1 + m // 12), float(rng.random()), "low", 10.0,
         None if m == 5 else float(rng.random() * 9), 1.0, 0.5, 60)
        for s in range(3) for m in range(24)
    ]
    risk = spark.createDataFrame(
        rows, "risk_id long, supplier_id long, scored_at timestamp, delay_probability double, risk_tier string, "
        "composite_risk_score double, hist_mean_delay_days double, hist_delay_variance double, hist_on_time_rate double, "
        "orders_evaluated long",
    )
    sup = spark.createDataFrame(
        [(s, 9.0, 30, "India", "Asia", dt.date(2020, 1, 1)) for s in range(3)],
        "supplier_id long, reliability_score double, payment_terms_days long, country string, region string, onboarded_at date",
    )
    a = features.supplier_risk_features(risk, sup).toPandas().sort_values("risk_id").reset_index(drop=True)
    b = features.supplier_risk_features(risk, sup, max_series_rows=5).toPandas().sort_values("risk_id").reset_index(drop=True)
    assert len(a) == 3 * 23
    pd.testing.assert_frame_equal(a, b[a.columns], rtol=1e-9)
