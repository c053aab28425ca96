"""Table contracts and fixed values."""

from __future__ import annotations

from dataclasses import dataclass, field


@dataclass(frozen=True)
class Contract:
    """What a raw table promises. ``primary_key`` is None for tables without a check."""

    table: str
    primary_key: str
    required: tuple[str, ...]
    not_null: tuple[str, ...]
    non_negative: tuple[str, ...] = ()
    ranges: dict[str, tuple[int, int]] = field(default_factory=dict)
    dates: tuple[str, ...] = ()
    foreign_keys: dict[str, str] = field(default_factory=dict)


# The data contract of the six tables.
CONTRACTS: dict[str, Contract] = {
    c.table: c
    for c in (
        Contract(
            table="products",
            primary_key="product_id",
            required=(
                "product_id", "sku", "product_name", "category", "unit_cost", "unit_price",
                "lead_time_days", "reorder_point", "reorder_quantity",
            ),
            not_null=("product_id", "sku", "category", "unit_cost", "unit_price"),
            non_negative=("unit_cost", "unit_price", "lead_time_days", "reorder_point", "reorder_quantity"),
            dates=("created_at", "updated_at"),
        ),
        Contract(
            table="suppliers",
            primary_key="supplier_id",
            required=("supplier_id", "supplier_name", "country", "reliability_score", "payment_terms_days"),
            not_null=("supplier_id", "supplier_name", "country"),
            non_negative=("payment_terms_days",),
            ranges={"reliability_score": (0, 10)},
            dates=("onboarded_at", "created_at", "updated_at"),
        ),
        Contract(
            table="sales",
            primary_key="sale_id",
            required=("sale_id", "product_id", "sale_date", "quantity_sold", "unit_price"),
            not_null=("sale_id", "product_id", "sale_date", "quantity_sold"),
            non_negative=("quantity_sold", "unit_price", "discount_pct"),
            ranges={"discount_pct": (0, 100)},
            dates=("sale_date", "created_at"),
            foreign_keys={"product_id": "products"},
        ),
        Contract(
            table="inventory",
            primary_key="inventory_id",
            required=("inventory_id", "product_id", "snapshot_date", "warehouse_id", "quantity_on_hand"),
            not_null=("inventory_id", "product_id", "snapshot_date", "warehouse_id"),
            non_negative=("quantity_on_hand", "quantity_reserved"),
            dates=("snapshot_date", "created_at"),
            foreign_keys={"product_id": "products"},
        ),
        Contract(
            table="forecasts",
            primary_key="forecast_id",
            required=("forecast_id", "product_id", "forecast_date", "predicted_demand", "model_name"),
            not_null=("forecast_id", "product_id", "forecast_date", "predicted_demand"),
            non_negative=("predicted_demand",),
            dates=("forecast_date", "generated_at"),
            foreign_keys={"product_id": "products"},
        ),
        Contract(
            table="risk_scores",
            primary_key="risk_id",
            required=("risk_id", "supplier_id", "scored_at", "delay_probability", "risk_tier"),
            not_null=("risk_id", "supplier_id", "delay_probability", "risk_tier"),
            ranges={"delay_probability": (0, 1), "composite_risk_score": (0, 100)},
            dates=("scored_at", "created_at"),
            foreign_keys={"supplier_id": "suppliers"},
        ),
    )
}

# Columns of the seven raw tables, in file order.
RAW_COLUMNS: dict[str, tuple[str, ...]] = {
    "products": (
        "product_id", "sku", "product_name", "category", "sub_category", "unit_cost", "unit_price",
        "lead_time_days", "reorder_point", "reorder_quantity", "is_active", "created_at", "updated_at",
    ),
    "suppliers": (
        "supplier_id", "supplier_name", "contact_email", "country", "region", "reliability_score",
        "payment_terms_days", "is_active", "onboarded_at", "created_at", "updated_at",
    ),
    "product_supplier": (
        "id", "product_id", "supplier_id", "is_primary", "quoted_lead_time_days", "last_quoted_price",
        "contract_start", "contract_end", "created_at",
    ),
    "sales": (
        "sale_id", "product_id", "sale_date", "quantity_sold", "unit_price", "channel", "region",
        "discount_pct", "is_returned", "created_at",
    ),
    "inventory": (
        "inventory_id", "product_id", "snapshot_date", "warehouse_id", "quantity_on_hand", "quantity_reserved",
        "reorder_triggered", "unit_cost_snapshot", "created_at",
    ),
    "forecasts": (
        "forecast_id", "product_id", "forecast_date", "generated_at", "model_name", "model_version",
        "predicted_demand", "lower_bound_95", "upper_bound_95", "actual_demand", "mae", "mape",
        "confidence_score", "horizon_days",
    ),
    "risk_scores": (
        "risk_id", "supplier_id", "scored_at", "model_name", "model_version", "delay_probability",
        "avg_delay_days_pred", "risk_tier", "composite_risk_score", "hist_mean_delay_days",
        "hist_delay_variance", "hist_on_time_rate", "orders_evaluated", "shap_top_features",
        "recommended_action", "created_at",
    ),
}

# Fixed value: parents before children, the order rows may be inserted into a database.
LOAD_ORDER = (
    "products", "suppliers", "product_supplier", "sales", "inventory", "forecasts", "risk_scores",
)

AUDIT_DDL = (
    "`table` string, stage string, check string, status string, rows_in long, rows_out long, detail string"
)
AUDIT_COLUMNS = ("table", "stage", "check", "status", "rows_in", "rows_out", "detail")
