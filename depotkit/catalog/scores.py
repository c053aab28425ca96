"""Supplier scoring, forecast accuracy, seasonal index, blackout and band queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from depotkit.catalog.registry import query
from depotkit.catalog.relations import _SCORED, _profile
from depotkit.catalog.series import RISK
from depotkit.functions import scalar as fn
from depotkit.operators import relational as rel, scoring


@query(
    "r_supplier_risk_score",
    "i:supplier_id d:period r:delay_probability r:avg_delay_days_pred risk_tier r:composite_risk_score "
    "r:hist_mean_delay_days r:hist_delay_variance r:hist_on_time_rate i:orders_evaluated recommended_action",
    f"with {RISK}, out as (select * from risk)",
)
def r_supplier_risk_score(t):
    return scoring.supplier_risk_scores(t.deliveries)


@query(
    "r_top_features",
    "i:supplier_id d:period r:hist_mean_delay r:on_time_rate r:order_frequency",
    f"""with {RISK}, out as (select supplier_id, period, round_even(m * 1000, 0) / 1000 as hist_mean_delay,
        round_even(on_time * 1000, 0) / 1000 as on_time_rate, orders_evaluated::double as order_frequency from risk)""",
)
def r_top_features(t):
    """The feature text written by the scoring, parsed back."""
    parsed = scoring.parse_top_features("shap_top_features")
    d = scoring.supplier_risk_scores(t.deliveries).withColumn("m", parsed)
    return d.select("supplier_id", "period", *[F.col("m")[k].alias(k) for k in ("hist_mean_delay", "on_time_rate", "order_frequency")])


@query(
    "r_forecast_accuracy",
    "i:product_id d:forecast_date r:predicted_demand r:actual_demand r4:mae r4:mape r4:confidence_score",
    f"with {_SCORED}, out as (select * from accuracy)",
)
def r_forecast_accuracy(t):
    return scoring.forecast_accuracy(rel.forecast_with_actual(t.forecasts, t.sales))


@query(
    "r_interval",
    "i:product_id d:forecast_date r2:lower_bound_95 e2:upper_bound_95",
    """select product_id, forecast_date,
       greatest(0, round_even((predicted_demand - predicted_demand * 0.2) * 100, 0) / 100) as lower_bound_95,
       round_even((predicted_demand + predicted_demand * 0.2) * 100, 0) / 100 as upper_bound_95 from {forecasts}""",
)
def r_interval(t):
    return scoring.prediction_interval(t.forecasts)


def _months_sql() -> str:
    rows = [f"('{p}', {m}, {v})" for p, vs in scoring.MONTH_INDEX.items() for m, v in enumerate(vs, start=1)]
    return "months(profile, month, month_index) as (values " + ", ".join(rows) + ")"


def _events_sql() -> str:
    rows = [f"({m}, {d}, {v})" for (m, d), v in scoring.EVENT_INDEX.items()]
    return "special(month, dom, event_index) as (values " + ", ".join(rows) + ")"


_PROFILE = """case product_id % 5 when 0 then 'electronics' when 1 then 'fashion' when 2 then 'food'
    when 3 then 'general' else 'other' end"""


@query(
    "r_seasonal_index",
    "i:sale_id r:seasonal_index",
    f"""with {_months_sql()}, {_events_sql()},
        s as (select sale_id, sale_date, {_PROFILE} as profile from {{part_sales}}),
        out as (select sale_id, month_index * coalesce(event_index, 1)
            * case when isodow(sale_date) >= 6 then 0.6 else 1 end as seasonal_index
          from s left join months m on m.month = month(sale_date)
               and m.profile = case when s.profile = 'other' then 'general' else s.profile end
          left join special e on e.month = month(sale_date) and e.dom = day(sale_date))""",
)
def r_seasonal_index(t):
    d = t.part_sales.withColumn("profile", F.expr(_PROFILE))
    return scoring.seasonal_index(d, "sale_date", "profile")


@query(
    "r_blackout_anti",
    "i:sale_id i:product_id d:sale_date",
    """select sale_id, product_id, sale_date from {part_sales} s where not exists (select 1 from {blackouts} b
       where b.product_id = s.product_id and s.sale_date between b.window_start and b.window_end)""",
)
def r_blackout_anti(t):
    return rel.outside_windows(t.part_sales, t.blackouts, "product_id", "sale_date", "window_start", "window_end")


@query(
    "r_price_band",
    "i:product_id band",
    """select product_id, case when unit_price < 20 then 'mass' when unit_price < 100 then 'mid'
       when unit_price < 500 then 'high' when unit_price >= 500 then 'luxury' end as band from {products}""",
)
def r_price_band(t):
    return t.products.withColumn("band", fn.price_band("unit_price"))


@query(
    "a_dataset_profile",
    "table metric r4:value",
    f"with {_SCORED}, {RISK}, out as ("
    + " union all ".join(
        [
            _profile(
                "products", "products",
                {"rows": "count(*)", "active_skus": "count(*) filter (where is_active)",
                 "price_min": "min(unit_price)", "price_max": "max(unit_price)"},
                "category",
            ),
            _profile(
                "suppliers", "suppliers",
                {"rows": "count(*)", "reliability_min": "min(reliability_score)",
                 "reliability_max": "max(reliability_score)", "countries": "count(distinct country)"},
            ),
            _profile(
                "sales", "sales",
                {"rows": "count(*)", "first_day": "date_diff('day', date '1970-01-01', min(sale_date))",
                 "last_day": "date_diff('day', date '1970-01-01', max(sale_date))",
                 "units_sold": "sum(quantity_sold)", "return_rate_pct": "avg(is_returned::int) * 100"},
                "channel",
            ),
            _profile(
                "inventory", "stock",
                {"rows": "count(*)", "stockout_records": "count(*) filter (where quantity_on_hand = 0)",
                 "stockout_pct": "avg((quantity_on_hand = 0)::int) * 100",
                 "reorder_triggers": "count(*) filter (where reorder_triggered)",
                 "avg_on_hand": "avg(quantity_on_hand)"},
            ),
            _profile(
                "forecasts", "accuracy",
                {"rows": "count(*)", "avg_mape": "avg(mape)", "avg_mae": "avg(mae)",
                 "avg_confidence": "avg(confidence_score)"},
            ),
            _profile(
                "risk_scores", "risk",
                {"rows": "count(*)", "avg_composite_score": "avg(composite_risk_score)",
                 "avg_delay_probability": "avg(delay_probability)"},
                "risk_tier",
            ),
        ]
    )
    + ")",
)
def a_dataset_profile(t):
    forecasts = scoring.forecast_accuracy(rel.forecast_with_actual(t.forecasts, t.sales))
    return rel.dataset_profile(
        {
            "products": t.products,
            "suppliers": t.suppliers,
            "sales": t.sales,
            "inventory": t.stock,
            "forecasts": forecasts,
            "risk_scores": scoring.supplier_risk_scores(t.deliveries),
        }
    )
