"""The three end-to-end runs: tables, features, models."""

from __future__ import annotations

import uuid
from datetime import datetime, timezone

from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from depotkit.ml import evaluate as ev, importance as imp, train as tr
from depotkit.operators import quality as qa, relational as rel
from depotkit.operators.cleaning import clean_all
from depotkit.plans import features
from depotkit.schemas import CONTRACTS, LOAD_ORDER
from depotkit.sources import layers, readers, sinks

# The notes of the reconciliation rows; {n} is the number of rows dropped.
CLEAN_NOTES = {
    "products": "Dropped {n} duplicates; nulls imputed with category medians",
    "suppliers": "Dropped {n} duplicates",
    "sales": "Removed {n} invalid/duplicate rows; qty+price capped at 3xIQR",
    "inventory": "Removed {n} rows; reserved clamped to on_hand",
    "forecasts": "Removed {n} rows; prediction bounds sanitised",
    "risk_scores": "Removed {n} rows; tiers validated",
}
TRANSFORM_NOTES = {
    "sales": "Added: revenue, net_quantity, year, month, week, dow",
    "inventory": "Added: quantity_available, is_below_reorder",
}

TRANSFORMED = {"sales": {"revenue", "net_quantity"}, "inventory": {"quantity_available", "is_below_reorder"}}


def run_etl(
    spark: SparkSession,
    raw_dir: str,
    work_dir: str,
    tables: list[str] | None = None,
    jdbc_url: str | None = None,
    fmt: str = "parquet",
) -> tuple[dict[str, DataFrame], DataFrame]:
    """Extract, validate, clean, transform, load. Returns the clean tables and the audit rows.

    Raw text is parsed once into ``<work_dir>/staged`` (with arrival order, so keep-first
    means file order), and records that are no rows go to ``<work_dir>/quarantine``; validation and the
    quantile passes of the cleaners then read columns. The clean tables change for readers all at once,
    when the last one is written.
    """
    run_ts = datetime.now(timezone.utc).strftime("%Y%m%d_%H%M%S")
    work_dir = work_dir.rstrip("/")
    # parents first, in whatever order they were named
    names = sorted(tables, key=lambda t: LOAD_ORDER.index(t) if t in LOAD_ORDER else -1) if tables else list(CONTRACTS)
    audit: list[DataFrame] = []

    def note(*row):
        audit.append(qa.audit_row(spark, *row))

    staged: dict[str, DataFrame] = {}
    rows: dict[str, int] = {}
    for t in names:
        try:
            raw = readers.parse_raw(spark, t, raw_dir)
        except FileNotFoundError:
            note(t, "extract", "file_exists", "FAIL", 0, 0, f"Not found: {raw_dir}/{t}.csv")
            sinks.write_audit(qa.combine(audit), f"{work_dir}/audit", run_ts)
            raise
        path, records = sinks.write_table(raw, t, f"{work_dir}/staged")
        scan = readers.split_scan(spark.read.parquet(path))
        staged[t], width = scan.rows, len(scan.rows.columns) - len(readers.ARRIVAL)
        reasons = {r["_reason"]: r["count"] for r in scan.rejected.groupBy("_reason").count().collect()}
        rows[t] = records - sum(reasons.values())
        note(t, "extract", "file_read", "PASS", 0, rows[t], f"{rows[t]:,} rows, {width} cols from {t}.csv")
        if reasons:
            sinks.write_table(scan.rejected, t, f"{work_dir}/quarantine")
            for reason, n in sorted(reasons.items()):
                note(t, "extract", reason.replace(" ", "_"), "WARN", records, rows[t], f"{n:,} records set aside in quarantine/{t}")
    checked = {t: staged[t].drop(*readers.ARRIVAL) for t in names}
    if contracted := {t: df for t, df in checked.items() if t in CONTRACTS}:
        audit.append(qa.validate_all(contracted, checked))

    written: dict[str, DataFrame] = {}
    derived: dict[str, bool] = {}
    counts: dict[str, int] = {}
    cleaned = clean_all(staged, readers.arrival_order())
    load_rows = []
    layer = layers.Run(spark, f"{work_dir}/clean")
    # Parents come first, as inventory reads the clean products.
    for t in names:
        clean = cleaned[t].drop(*readers.ARRIVAL)
        if t == "sales":
            clean = features.transform_sales(clean)
        elif t == "inventory":
            clean = features.transform_inventory(clean, written["products"]) if "products" in written else clean
        derived[t] = TRANSFORMED.get(t, set()) <= set(clean.columns)
        path, counts[t] = layer.write(clean, t, fmt)
        written[t] = readers.load(spark, t, layer.folder, fmt)
        load_rows.append((t, "load", f"{fmt}_write", "PASS", counts[t], counts[t],
                          f"→ {t}.{fmt}  ({sinks.size_kb(spark, path):.1f} KB)"))
    layer.publish()
    for t in names:
        if t in CLEAN_NOTES:
            gone = f"{rows[t] - counts[t]:,}" if t in ("sales", "inventory", "forecasts", "risk_scores") else rows[t] - counts[t]
            note(t, "clean", "complete", "PASS", rows[t], counts[t], CLEAN_NOTES[t].format(n=gone))
    for t in TRANSFORM_NOTES:
        if t in names and derived[t]:
            note(t, "transform", "derived_cols", "PASS", counts[t], counts[t], TRANSFORM_NOTES[t])
    for r in load_rows:
        note(*r)
    if jdbc_url:
        for t in sinks.load_jdbc(written, jdbc_url):
            note(t, "load", "jdbc_insert", "PASS", counts[t], counts[t], f"{counts[t]:,} rows → {t}")
    path = sinks.write_audit(qa.combine(audit), f"{work_dir}/audit", run_ts)
    log = spark.read.option("header", True).csv(path).filter(F.col("run_ts") == run_ts)
    return written, log


TARGETS = {"demand": "daily_demand", "stockout": "stockout_in_horizon", "supplier_risk": "delay_probability"}


def run_features(
    spark: SparkSession, work_dir: str, save: bool = True, fmt: str = "parquet"
) -> tuple[dict[str, DataFrame], dict[str, DataFrame]]:
    """Build the three feature tables from the clean layer in ``fmt``; returns them and their profiles."""
    work_dir = work_dir.rstrip("/")
    clean = {
        t: readers.read_clean(spark, t, f"{work_dir}/clean", fmt)
        for t in ("products", "suppliers", "sales", "inventory", "risk_scores")
    }
    sets = {
        "demand": features.demand_features(clean["sales"], clean["products"]),
        "stockout": features.stockout_features(clean["inventory"].drop(sinks.MONTH_COLUMN), clean["sales"], clean["products"]),
        "supplier_risk": features.supplier_risk_features(clean["risk_scores"], clean["suppliers"]),
    }
    if save:
        layer = layers.Run(spark, f"{work_dir}/features")
        for name, df in sets.items():
            layer.write(df, f"features_{name}")
            sets[name] = readers.load(spark, f"features_{name}", layer.folder).drop(sinks.MONTH_COLUMN)
        layer.publish()
    return sets, {n: rel.feature_profile(df, TARGETS[n]) for n, df in sets.items()}


def run_models(
    spark: SparkSession,
    work_dir: str,
    run_grid: bool = True,
    params: dict[str, dict] | None = None,
    n_splits: int = 5,
    split: str = "time",
    n_repeats: int = 10,
    candidates: dict[str, list[dict]] | None = None,
) -> tuple[list[tr.Trained], DataFrame]:
    """Train all models, write models, summaries, importances and the run table.

    Without grid search the presets apply, or ``params`` by model (demand, stockout, delay, tier).
    With it, ``candidates`` by model replace the grids, and scores are kept in ``grid_ledger``: a
    run that was stopped goes on with them.
    """
    work_dir = work_dir.rstrip("/")
    models, outputs = f"{work_dir}/models", f"{work_dir}/model_outputs"
    given, chosen, ledger = params or {}, candidates or {}, f"{outputs}/grid_ledger" if run_grid else None
    more = lambda name: {"ledger": ledger, "candidates": chosen.get(name)}
    demand = tr.train_demand(
        readers.read_features(spark, "demand", f"{work_dir}/features"), given.get("demand"), run_grid, n_splits, split, **more("demand")
    )
    stockout = tr.train_stockout(
        readers.read_features(spark, "stockout", f"{work_dir}/features"), given.get("stockout"), run_grid, n_splits, split, **more("stockout")
    )
    risk = readers.read_features(spark, "supplier_risk", f"{work_dir}/features")
    both = tr.train_suppliers(risk, {m: given[m] for m in ("delay", "tier") if m in given}, run_grid, split, ledger, chosen)
    delay, tier = both["delay"], both["tier"]
    results = [demand, stockout, delay, tier]
    probability = lambda: vector_to_array(F.col("probability"))[1]
    ranked = {
        demand.name: imp.permutation_importance(
            demand.model, demand.test, demand.features, ["product_id", "sale_date"], "label", imp.mae_loss("label"), n_repeats
        ),
        stockout.name: imp.permutation_importance(
            stockout.model, stockout.test, stockout.features, ["inventory_id"], "label",
            imp.auc_loss("label", probability), n_repeats,
        ),
        delay.name: imp.permutation_importance(
            delay.model, delay.test, delay.features, ["supplier_id", "year_month", "risk_id"], "delay_probability",
            imp.mae_loss("delay_probability", 0, 1), n_repeats,
        ),
    }
    for r in results:
        sinks.save_model(spark, r.model, models, r.name)
        sinks.write_summary(spark, outputs, r.name, r.metrics, r.params, r.features)
        artefacts = [r.name]
        if r.name in ranked:
            sinks.write_importance(ranked[r.name], outputs, r.name)
            artefacts.append(f"{r.name}_importance")
        sinks.log_run(spark, outputs, uuid.uuid4().hex, "supply_chain", r.params, r.metrics, artefacts)
    sinks.write_importance(imp.native_importance(stockout.model, stockout.features), outputs, f"{stockout.name}_native")
    for name, table in evaluation_tables(demand, stockout, delay, tier).items():
        sinks.write_table(table, name, f"{outputs}/evaluation")
    summary = tr.report(results)
    for r in results:
        r.extra["data"].unpersist()
    return results, summary


def evaluation_tables(demand: tr.Trained, stockout: tr.Trained, delay: tr.Trained, tier: tr.Trained) -> dict[str, DataFrame]:
    """Tables on the hold-out rows: class reports, confusion counts, ROC points, histograms of
    probabilities by label and of residuals."""
    flagged = stockout.test.select("label", "prediction", vector_to_array("probability")[1].alias("probability"))
    out = {}
    for name, scored, label in ((stockout.name, flagged, "label"), (tier.name, tier.test, "tier_label")):
        out[f"{name}_class_report"] = ev.class_report(scored, label, "prediction")
        out[f"{name}_confusion"] = ev.confusion(scored, label, "prediction")
    out[f"{stockout.name}_roc"] = ev.roc_points(flagged, "label", "probability")
    out[f"{stockout.name}_histogram"] = ev.histogram(flagged, "probability", 40, ["label"])
    for r, label in ((demand, "label"), (delay, "delay_probability")):
        residuals = r.test.select((F.col(label) - F.col("prediction")).alias("residual"))
        out[f"{r.name}_residuals"] = ev.histogram(residuals, "residual", 50)
    return out
