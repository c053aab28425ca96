import datetime as dt
import os

import numpy as np
import pandas as pd
import pytest

from depotkit.operators.cleaning import clean_all
from depotkit.plans import pipeline
from depotkit.schemas import CONTRACTS, LOAD_ORDER, RAW_COLUMNS
from depotkit.sources import layers, readers, sinks


@pytest.fixture(scope="module")
def raw(tmp_path_factory):
    """Raw CSV files of 8 products, 4 suppliers and 120 days, with a few dirty rows."""
    rng = np.random.default_rng(42)
    out = tmp_path_factory.mktemp("raw")
    days = [dt.date(2024, 1, 1) + dt.timedelta(days=i) for i in range(120)]
    cats = ["Electronics", "Apparel", "Food & Beverage", "Home & Garden"]

    def save(name, rows):
        pd.DataFrame(rows, columns=RAW_COLUMNS[name]).to_csv(out / f"{name}.csv", index=False)

    products = [(p, f"S{p}", f"P{p}", cats[p % 4], "s", 5.0 + p, 15.0 * (p + 1), 3 + p, 30, 60, p != 3, "2023-01-01", "2024-01-01") for p in range(8)]
    save("products", products + [(0, "DUP", "late copy", cats[0], "s", 1, 1, 1, 1, 1, True, "", "")])
    save("suppliers", [(s, f"N{s}", "a@b", ["China", "USA", "Kenya", "Bangladesh"][s], ["Asia", "Americas", "Africa", "Asia"][s], 8.5, 30, True, "2022-06-01", "", "") for s in range(4)])
    sales = [(i, i % 8, days[i % 120], int(rng.integers(1, 9)), 20.0, " Web ", "North", 5, i % 50 == 0, "") for i in range(2000)]
    sales[5] = (5, 5, "broken", 1, 20.0, "web", "North", 5, False, "")
    save("sales", sales + [(0, 1, days[0], 99, 1.0, "b2b", "South", 0, False, "")])
    save("inventory", [(p * 120 + d, p, days[d], "W1", int(rng.integers(0, 40)), 2, False, 5.0, "") for p in range(8) for d in range(120)])
    save("forecasts", [(i, i % 8, days[i % 120], "", "m", "1", 5.0, 6.0, 4.0, 5.0, 0.1, 1.0, 1.2, 7) for i in range(100)])
    save("risk_scores", [
        (s * 24 + m, s, f"{2023 + m // 12}-{m % 12 + 1:02d}-01T00:00:00Z", "m", "1", float(rng.random()), 1.0,
         ["low", "medium", "high", "critical"][(s + m) % 4], float(rng.random() * 100), float(rng.random() * 5), 1.0,
         float(rng.random()), 60, "{'on_time_rate': 0.5}", "x", "")
        for s in range(4) for m in range(24)
    ])
    return str(out)


def test_tables_features_models(spark, raw, tmp_path):
    work = str(tmp_path)
    clean, audit = pipeline.run_etl(spark, raw, work)
    rows = {(r.table, r.stage, r.check): r for r in audit.collect()}
    assert rows["sales", "extract", "file_read"].detail == "2,001 rows, 10 cols from sales.csv"
    assert rows["sales", "validate", "pk_unique"].detail == "1 duplicate PKs in 'sale_id'"
    assert rows["products", "clean", "complete"].detail == "Dropped 1 duplicates; nulls imputed with category medians"
    assert (rows["sales", "clean", "complete"].rows_in, rows["sales", "clean", "complete"].rows_out) == ("2001", "1999")
    assert ("inventory", "transform", "derived_cols") in rows and ("forecasts", "load", "parquet_write") in rows
    # keep-first means file order
    assert clean["products"].filter("product_id = 0").first().sku == "S0"
    assert clean["sales"].filter("sale_id = 0").first().quantity_sold != 99
    assert os.path.isdir(f"{layers.folder_of(spark, f'{work}/clean', 'sales')}/sales/part_month=2024-01")

    sets, profiles = pipeline.run_features(spark, work)
    assert sets["demand"].count() == 8 * 120
    assert sets["stockout"].count() == 8 * 119
    assert sets["supplier_risk"].count() == 96
    assert profiles["demand"].first().rows == 960

    small = {"rounds": 3, "depth": 3}
    candidates = {
        "demand": [small, small | {"l2": 0.1}], "stockout": [{"numTrees": 3, "maxDepth": 3, "featureSubsetStrategy": s} for s in ("sqrt", "0.5")],
        "delay": [small | {"subsample": 0.8}, small], "tier": [{"rounds": 2, "depth": 2}, {"rounds": 2, "depth": 3}],
    }
    results, report = pipeline.run_models(spark, work, run_grid=True, n_splits=2, n_repeats=1, candidates=candidates)
    assert all(r.params in candidates[k] for k, r in zip(("demand", "stockout", "delay", "tier"), results))
    ledger = spark.read.parquet(f"{work}/model_outputs/grid_ledger")
    assert {(r["model"], r["count"]) for r in ledger.groupBy("model").count().collect()} == {("demand", 4), ("stockout", 4), ("delay", 10), ("tier", 10)}
    names = {r.name for r in results}
    assert {r.model for r in report.collect()} == names and len(names) == 4
    assert 0 <= results[1].metrics["test_auc"] <= 1
    made = {"stockout_prediction_v1_class_report", "supplier_risk_classifier_v1_confusion", "stockout_prediction_v1_roc", "demand_forecasting_v1_residuals"}
    assert made <= set(os.listdir(f"{work}/model_outputs/evaluation"))
    runs = spark.read.parquet(f"{work}/model_outputs/runs")
    assert runs.select("run_id").distinct().count() == 4
    summary = spark.read.json(f"{work}/model_outputs/demand_forecasting_v1_summary").first()
    assert summary.model == "demand_forecasting_v1" and "lag_7" in summary.features
    again = sinks.load_model(spark, f"{work}/models", "demand_forecasting_v1", boosted=True)
    test = results[0].test
    assert again.transform(test.withColumnRenamed("prediction", "before")).filter("prediction = before").count() == test.count()
    assert len(sinks.load_model(spark, f"{work}/models", "stockout_prediction_v1", boosted=False).stages[-1].trees) == 3


def test_missing_inputs(spark, raw, tmp_path):
    with pytest.raises(FileNotFoundError):
        pipeline.run_etl(spark, str(tmp_path / "nothing"), str(tmp_path), ["products"])
    failed = spark.read.option("header", True).csv(f"{tmp_path}/audit/etl_audit").first()
    assert (failed.check, failed.status) == ("file_exists", "FAIL")
    with pytest.raises(FileNotFoundError, match="run_etl"):
        readers.read_clean(spark, "sales", str(tmp_path))


def test_csv_layer(spark, raw, tmp_path):
    clean, audit = pipeline.run_etl(spark, raw, str(tmp_path), ["suppliers"], fmt="csv")
    assert clean["suppliers"].count() == 4
    assert audit.filter("stage = 'load'").first()["check"] == "csv_write"


@pytest.mark.parametrize("fmt", ["parquet", "csv"])
def test_a_stopped_run_leaves_the_tables_of_the_last_one(spark, raw, tmp_path, monkeypatch, fmt):
    folder, work = tmp_path / "raw", str(tmp_path / "work")
    folder.mkdir()
    names = ["products", "suppliers", "inventory"]

    def lay(price):
        for name in names:
            df = pd.read_csv(f"{raw}/{name}.csv", dtype=str, keep_default_na=False)
            if name == "products":
                df["unit_price"] = price
            df.to_csv(folder / f"{name}.csv", index=False)

    def prices():
        clean = readers.read_clean(spark, "products", f"{work}/clean", fmt)
        assert readers.read_clean(spark, "inventory", f"{work}/clean", fmt).count() == 960
        return {r[0] for r in clean.select("unit_price").collect()}

    lay(10.0)
    pipeline.run_etl(spark, str(folder), work, names, fmt=fmt)
    assert prices() == {10.0}
    first = layers.published(spark, f"{work}/clean")
    lay(20.0)
    whole = sinks.write_table

    def stops(df, name, to, fmt="parquet"):
        if name == "inventory" and "/clean/" in to:
            raise RuntimeError("driver lost")
        return whole(df, name, to, fmt)

    monkeypatch.setattr(sinks, "write_table", stops)
    with pytest.raises(RuntimeError, match="driver lost"):
        pipeline.run_etl(spark, str(folder), work, names, fmt=fmt)
    monkeypatch.undo()
    assert prices() == {10.0} and layers.published(spark, f"{work}/clean") == first
    opened = readers.read_clean(spark, "products", f"{work}/clean", fmt)
    pipeline.run_etl(spark, str(folder), work, names, fmt=fmt)
    assert prices() == {20.0}
    assert {r[0] for r in opened.select("unit_price").collect()} == {10.0}


def test_layers_carry_tables_over_and_remove_old_runs(spark, tmp_path):
    layer, made = str(tmp_path / "layer"), []
    for n in range(4):
        run = layers.Run(spark, layer)
        made.append(run.name)
        run.write(spark.range(n + 1), "a")
        if n == 0:
            run.write(spark.range(7), "kept")
        assert run.publish() == n + 1
        assert readers.read_layer(spark, "a", layer, "-").count() == n + 1
        assert readers.read_layer(spark, "kept", layer, "-").count() == 7
    # the first run still holds a table; the second is named by no publication that is kept
    assert sorted(os.listdir(f"{layer}/runs")) == sorted([made[0], made[2], made[3]])
    assert [n for n in sorted(os.listdir(f"{layer}/published")) if n[0] not in "._"] == ["0000000003.json", "0000000004.json"]
    sinks.write_table(spark.range(5), "by_hand", layer)
    assert readers.read_layer(spark, "by_hand", layer, "-").count() == 5
    with pytest.raises(FileNotFoundError, match="some step"):
        readers.read_layer(spark, "none", layer, "some step")


def test_database_load_order_and_options():
    shuffled = dict.fromkeys(["sales", "product_supplier", "products", "risk_scores", "suppliers"])
    assert sinks.load_sequence(shuffled) == [t for t in LOAD_ORDER if t in shuffled]
    options = sinks.jdbc_options("sales", "jdbc:postgresql://h/db", {"user": "u"})
    assert options["truncate"] == options["cascadeTruncate"] == "true"
    assert options["batchsize"] == "5000" and options["user"] == "u"


def test_tables_in_any_order_and_alone(spark, raw, tmp_path):
    clean, _ = pipeline.run_etl(spark, raw, str(tmp_path / "both"), ["inventory", "products"])
    assert {"quantity_available", "is_below_reorder"} <= set(clean["inventory"].columns)
    clean, audit = pipeline.run_etl(spark, raw, str(tmp_path / "alone"), ["inventory"])
    assert "quantity_available" not in clean["inventory"].columns
    assert audit.filter("stage = 'transform'").count() == 0


def test_all_raw_tables_and_their_cleaning(spark, raw):
    tables = readers.read_all_raw(spark, raw, arrival=True)
    assert set(tables) == set(CONTRACTS)
    clean = clean_all(tables, readers.arrival_order())
    assert {t: clean[t].count() for t in ("products", "suppliers", "sales", "risk_scores")} == {
        "products": 8, "suppliers": 4, "sales": 1999, "risk_scores": 96}


def test_csv_layer_keeps_types(spark, raw, tmp_path):
    work = str(tmp_path)
    clean, _ = pipeline.run_etl(spark, raw, work, fmt="csv")
    types = dict(clean["inventory"].dtypes)
    assert (types["inventory_id"], types["snapshot_date"], types["is_below_reorder"]) == ("bigint", "date", "boolean")
    sets, _ = pipeline.run_features(spark, work, save=False, fmt="csv")
    assert {n: df.count() for n, df in sets.items()} == {"demand": 960, "stockout": 952, "supplier_risk": 96}


def test_text_ids_stay_apart(spark, raw, tmp_path):
    folder = tmp_path / "raw"
    folder.mkdir()
    for name in ("products", "inventory", "sales"):
        df = pd.read_csv(f"{raw}/{name}.csv", dtype=str, keep_default_na=False)
        df["product_id"] = "P-" + df["product_id"]
        if name == "sales":
            df["sale_id"] = [f"{i}.5" for i in range(len(df))]
        df.to_csv(folder / f"{name}.csv", index=False)
    clean, _ = pipeline.run_etl(spark, str(folder), str(tmp_path / "out"), ["products", "inventory", "sales"])
    assert clean["products"].count() == 8 and clean["sales"].count() == 2000
    assert dict(clean["inventory"].dtypes)["product_id"] == "string"
    assert clean["inventory"].join(clean["products"].select("product_id"), "product_id").count() == 960


def test_whole_ids_of_any_spelling_are_one(spark):
    from depotkit.functions import scalar as fn

    rows = [("7",), (" 7.0 ",), ("9007199254740993",), ("x",), ("",), (None,), ("7.5",), ("1e30",)]
    df = spark.createDataFrame(rows, "i string")
    assert [r[0] for r in df.select(fn.text_id("i")).collect()] == ["7", "7", "9007199254740993", "x", None, None, "7.5", "1e30"]
    assert [r[0] for r in df.select(fn.whole_number("i")).collect()] == [7, 7, 9007199254740993, None, None, None, None, None]


def test_months_do_not_depend_on_the_session_zone(spark):
    from depotkit.functions import scalar as fn

    texts = ["2024-03-01T00:00:00Z", "2024-03-01 00:30:00", "2024-03-01", "2024-03-01T01:00:00+02:00", "2024-02-29T23:59:59.9Z", "junk", None]
    want = ["2024-03-01"] * 3 + ["2024-02-01"] * 2 + [None, None]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    zone = spark.conf.get("spark.sql.session.timeZone")
    try:
        for other in ("America/Los_Angeles", "Asia/Tokyo", "UTC"):
            spark.conf.set("spark.sql.session.timeZone", other)
            got = df.select(fn.month_of(fn.utc_timestamp("t")).cast("string"), fn.month_of(fn.day("t")).cast("string")).collect()
            assert [r[0] for r in got] == want
            assert got[2][1] == "2024-03-01"
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)
