"""The three feature tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from depotkit.functions import scalar as fn
from depotkit.operators import labels, relational as rel, windows as win

DEMAND_LAGS = (7, 14, 21, 30)
TRAILING = (7, 14, 30)


def transform_sales(sales: DataFrame) -> DataFrame:
    d = F.col("sale_date")
    return sales.withColumns(
        {
            "revenue": fn.revenue("quantity_sold", "unit_price", "discount_pct"),
            "net_quantity": fn.net_quantity("quantity_sold", "is_returned"),
            "year": F.year(d),
            "month": F.month(d),
            "week": F.weekofyear(d),
            "dow": fn.weekday0(d),
        }
    )


def transform_inventory(inventory: DataFrame, products: DataFrame) -> DataFrame:
    d = rel.enrich(inventory, products, "product_id", ["reorder_point", "reorder_quantity"])
    d = d.withColumn("quantity_available", fn.available("quantity_on_hand", "quantity_reserved"))
    return d.withColumn("is_below_reorder", fn.below("quantity_available", "reorder_point"))


def demand_features(
    sales: DataFrame,
    products: DataFrame,
    min_history_days: int = 30,
    categories: Sequence[str] | None = None,
) -> DataFrame:
    """One row per product and calendar day between the first and last sale of the table.

    Sales are folded to product x day before anything else; every window then runs over
    one partitioning by product, on series no longer than the calendar.
    """
    bounds = win.day_bounds(sales.filter(F.col("product_id").isNotNull()), "sale_date")
    daily = win.fill_days(rel.daily_demand(sales), "product_id", "sale_date", bounds)
    w = Window.partitionBy("product_id").orderBy("sale_date")
    d = daily.withColumns(
        {
            **{c: F.coalesce(c, F.lit(0)) for c in ("daily_demand", "num_transactions", "return_count")},
            **{c: win.fill_both_ways(c, w) for c in ("avg_unit_price", "avg_discount_pct")},
        }
    )
    y = "daily_demand"
    out = {f"lag_{k}": win.lag(y, k, w) for k in DEMAND_LAGS}
    for k in TRAILING:
        out[f"rolling_mean_{k}d"] = win.trailing_mean(y, k, w)
        out[f"rolling_std_{k}d"] = win.trailing_std(y, k, w)
    out["roll_price_7d"] = win.trailing_mean("avg_unit_price", 7, w)
    out["roll_discount_7d"] = win.trailing_mean("avg_discount_pct", 7, w)
    out["demand_delta_7d"] = win.difference(y, 7, w)
    out["demand_accel"] = win.second_difference(y, w)
    out["_history"] = F.count(y).over(Window.partitionBy("product_id"))
    d = d.withColumns(out).filter(F.col("_history") >= min_history_days).drop("_history")
    d = d.withColumns(fn.calendar("sale_date"))
    domain = rel.one_hot_domain(products, "category") if categories is None else categories
    meta = products.select("product_id", "category", "unit_cost", "unit_price", "lead_time_days", "reorder_point")
    meta = rel.one_hot(meta.withColumn("price_tier", fn.price_tier("unit_price")), "category", "cat", domain)
    return d.join(meta.drop("category"), "product_id", "left")


def stockout_features(
    inventory: DataFrame,
    sales: DataFrame,
    products: DataFrame,
    horizon_days: int = 7,
    edge: str = "parity",
    max_series_rows: int = 2_000_000,
) -> DataFrame:
    """Inventory rows with demand, cover, stock-risk and calendar features and the label.

    Windows count rows of a product, warehouses interleaved by day, so a product's series
    is not bounded by the calendar: see :func:`depotkit.operators.windows.series`.
    """
    demand = rel.daily_sum(sales, "net_quantity", "daily_demand").withColumnRenamed("sale_date", "snapshot_date")
    key = ["product_id", "snapshot_date"]
    # Label and demand share the key of the inventory shuffle.
    label = labels.stockout_cells(inventory, horizon_days, edge).drop("cell_min")
    d = inventory.join(demand, key, "left").join(label, key, "left")
    d = d.withColumns(
        {
            "daily_demand": F.coalesce("daily_demand", F.lit(0.0)),
            "is_zero_stock": fn.flag(F.col("quantity_on_hand") == 0),
            "is_low_stock": fn.flag(F.col("quantity_available") <= F.col("reorder_point")),
        }
    )
    s = win.series(d, "product_id", "snapshot_date", ["warehouse_id", "inventory_id"], 30, max_series_rows, inventory)
    w = s.window
    out = {}
    for k in TRAILING:
        out[f"demand_mean_{k}d"] = win.trailing_mean("daily_demand", k, w)
        out[f"demand_std_{k}d"] = win.trailing_std("daily_demand", k, w)
    out["avg_stock_30d"] = win.trailing_mean("quantity_on_hand", 30, w)
    out["stockout_rate_30d"] = win.trailing_mean("is_zero_stock", 30, w)
    out["demand_accel_7d"] = win.difference("daily_demand", 7, w)
    d = s.run_length(s.frame.withColumns(out), F.col("is_low_stock") == 1, "consec_low_stock_days")
    d = s.finish(d)
    d = rel.enrich(
        d, products, "product_id", ["lead_time_days", "reorder_point", "reorder_quantity", "unit_cost"]
    )
    d = d.withColumns(
        {
            "inventory_turnover_30d": fn.turnover("demand_mean_30d", "avg_stock_30d"),
            "days_of_inventory": fn.days_of_cover("quantity_available", "demand_mean_7d"),
            "lead_time_coverage": fn.lead_time_cover("quantity_available", "demand_mean_7d", "lead_time_days"),
            "demand_to_stock_ratio": fn.demand_to_stock("demand_mean_7d", "quantity_on_hand"),
        }
    )
    d = d.withColumns(fn.calendar("snapshot_date"))
    if edge == "null":
        d = d.dropna(subset=["stockout_in_horizon"])
    return d.dropna(subset=["demand_mean_7d", "days_of_inventory"])


def supplier_risk_features(
    risk_scores: DataFrame,
    suppliers: DataFrame,
    regions: Sequence[str] | None = None,
    max_series_rows: int = 2_000_000,
) -> DataFrame:
    """One row per risk score with trailing delay statistics and supplier metadata."""
    d = risk_scores.withColumn("year_month", fn.month_of("scored_at"))
    s = win.series(d, "supplier_id", "year_month", ["scored_at", "risk_id"], 3, max_series_rows)
    w = s.window
    delay, on_time, prob = "hist_mean_delay_days", "hist_on_time_rate", "delay_probability"
    d = s.frame.withColumns(
        {
            "rolling_delay_mean_3m": win.trailing_mean(delay, 3, w),
            "rolling_delay_std_3m": win.trailing_std(delay, 3, w),
            "rolling_on_time_rate_3m": win.trailing_mean(on_time, 3, w),
            "rolling_delay_prob_3m": win.trailing_mean(prob, 3, w),
            "delay_trend_3m": win.slope3(delay, w),
            "lag_1m_delay_mean": win.lag(delay, 1, w),
            "lag_1m_delay_prob": win.lag(prob, 1, w),
            "lag_2m_delay_mean": win.lag(delay, 2, w),
        }
    )
    d = s.finish(d)
    domain = rel.one_hot_domain(suppliers, "region") if regions is None else regions
    meta = suppliers.select(
        "supplier_id",
        "reliability_score",
        "payment_terms_days",
        fn.country_tier("country").alias("country_risk_tier"),
        fn.tenure_years("onboarded_at").alias("years_active"),
        "country",
        "region",
    )
    d = d.join(meta, "supplier_id", "left").withColumns(
        {
            "delay_spike_flag": fn.spike(delay, "rolling_delay_mean_3m", "rolling_delay_std_3m"),
            "risk_tier_encoded": fn.tier_code("risk_tier"),
            "reliability_x_ontime": F.col("reliability_score") * F.col(on_time),
            "delay_var_x_mean": F.col("hist_delay_variance") * F.col(delay),
        }
    )
    d = rel.one_hot(d, "region", "region", domain)
    return d.dropna(subset=[delay, on_time, prob, "composite_risk_score"])
