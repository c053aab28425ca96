"""Derived columns: business measures, calendar, tiers, cover ratios."""

from __future__ import annotations

from pyspark.sql import functions as F

from depotkit.catalog.registry import query
from depotkit.functions import scalar as fn
from depotkit.ml import score
from depotkit.operators import relational as rel
from depotkit.plans.features import transform_inventory, transform_sales

_REVENUE = "round_even(quantity_sold * unit_price * (1 - discount_pct / 100) * 100, 0) / 100"


@query("p_revenue", "i:sale_id i:quantity_sold r2:revenue", f"select sale_id, quantity_sold, {_REVENUE} as revenue from {{part_sales}}")
def p_revenue(t):
    return t.part_sales.select(
        "sale_id", "quantity_sold", fn.revenue("quantity_sold", "unit_price", "discount_pct").alias("revenue")
    )


@query(
    "p_net_quantity",
    "i:sale_id i:net_quantity",
    "select sale_id, case when is_returned then 0 else quantity_sold end as net_quantity from {part_sales}",
)
def p_net_quantity(t):
    return t.part_sales.select("sale_id", fn.net_quantity("quantity_sold", "is_returned").alias("net_quantity"))


_PARTS = "year({d}) as year, month({d}) as month, weekofyear({d}) as week, isodow({d}) - 1 as dow"


def _parts(d: str) -> str:
    return _PARTS.replace("{d}", d)


@query(
    "p_date_parts",
    "i:sale_id d:sale_date i:year i:month i:week i:dow",
    f"select sale_id, sale_date, {_parts('sale_date')} from {{part_sales}}",
)
def p_date_parts(t):
    d = F.col("sale_date")
    return t.part_sales.select(
        "sale_id",
        "sale_date",
        F.year(d).alias("year"),
        F.month(d).alias("month"),
        F.weekofyear(d).alias("week"),
        fn.weekday0(d).alias("dow"),
    )


@query(
    "p_transform_sales",
    "i:sale_id i:product_id r2:revenue i:net_quantity i:year i:month i:week i:dow",
    f"""select sale_id, product_id, {_REVENUE} as revenue, case when is_returned then 0 else quantity_sold end
        as net_quantity, {_parts('sale_date')} from {{sales}}""",
)
def p_transform_sales(t):
    return transform_sales(t.sales)


_STOCK = """select s.*, reorder_point, reorder_quantity, lead_time_days, unit_cost,
    greatest(0, quantity_on_hand - quantity_reserved) as quantity_available,
    coalesce(greatest(0, quantity_on_hand - quantity_reserved) <= reorder_point, false) as is_below_reorder
    from {stock} s left join {brands} b on s.product_id = b.product_id"""


def stock(t):
    """Clean inventory with reorder columns, availability and flag."""
    return transform_inventory(t.stock, t.brands)


@query("p_available", "i:inventory_id i:quantity_available", f"select * from ({_STOCK})")
def p_available(t):
    return t.stock.withColumn("quantity_available", fn.available("quantity_on_hand", "quantity_reserved"))


@query("p_below_reorder", "i:inventory_id is_below_reorder", f"select * from ({_STOCK})")
def p_below_reorder(t):
    return stock(t)


@query(
    "p_transform_inventory",
    "i:inventory_id i:product_id d:snapshot_date warehouse_id i:quantity_on_hand i:quantity_reserved "
    "i:reorder_point i:reorder_quantity i:quantity_available is_below_reorder",
    f"select * from ({_STOCK})",
)
def p_transform_inventory(t):
    return stock(t)


def calendar_sql(d: str) -> str:
    quarter_end = f"(month({d}) % 3 = 0 and last_day({d}) = {d})"
    return f"""isodow({d}) - 1 as dow, month({d}) as month, quarter({d}) as quarter, weekofyear({d}) as week_of_year,
      dayofyear({d}) as day_of_year, (isodow({d}) >= 6)::int as is_weekend, (day({d}) = 1)::int as is_month_start,
      (last_day({d}) = {d})::int as is_month_end, {quarter_end}::int as is_quarter_end,
      sin(2 * pi() * month({d}) / 12) as month_sin, cos(2 * pi() * month({d}) / 12) as month_cos,
      sin(2 * pi() * (isodow({d}) - 1) / 7) as dow_sin, cos(2 * pi() * (isodow({d}) - 1) / 7) as dow_cos,
      sin(2 * pi() * weekofyear({d}) / 52) as woy_sin, cos(2 * pi() * weekofyear({d}) / 52) as woy_cos,
      (strftime({d}, '%m%d') >= '1125' and strftime({d}, '%m%d') < '1201' or strftime({d}, '%m%d') >= '1215'
       or strftime({d}, '%m%d') <= '0107')::int as is_holiday_period,
      (strftime({d}, '%m%d') between '0801' and '0915')::int as is_back_to_school"""


CALENDAR_COLUMNS = (
    "i:dow i:month i:quarter i:week_of_year i:day_of_year i:is_weekend i:is_month_start i:is_month_end "
    "i:is_quarter_end r:month_sin r:month_cos r:dow_sin r:dow_cos r:woy_sin r:woy_cos i:is_holiday_period "
    "i:is_back_to_school"
)


def _calendar_of_sales(t):
    return t.part_sales.select("sale_id", "sale_date").withColumns(fn.calendar("sale_date"))


_CAL = f"select sale_id, sale_date, {calendar_sql('sale_date')} from {{part_sales}}"


@query(
    "p_calendar",
    "i:sale_id d:sale_date i:dow i:month i:quarter i:week_of_year i:day_of_year i:is_weekend i:is_month_start "
    "i:is_month_end i:is_quarter_end",
    _CAL,
)
def p_calendar(t):
    return _calendar_of_sales(t)


@query("p_cyclical", "i:sale_id r:month_sin r:month_cos r:dow_sin r:dow_cos r:woy_sin r:woy_cos", _CAL)
def p_cyclical(t):
    return _calendar_of_sales(t)


@query("p_season_flags", "i:sale_id i:is_holiday_period i:is_back_to_school", _CAL)
def p_season_flags(t):
    return _calendar_of_sales(t)


PRICE_TIER = """case when unit_price <= 0 then null when unit_price <= 20 then 1 when unit_price <= 100 then 2
    when unit_price <= 400 then 3 when unit_price > 400 then 4 end"""


@query("p_price_tier", "i:product_id e:unit_price i:price_tier", f"select product_id, unit_price, {PRICE_TIER} as price_tier from {{products}}")
def p_price_tier(t):
    return t.products.withColumn("price_tier", fn.price_tier("unit_price"))


_TYPES = ("ECONOMY", "LARGE", "MEDIUM", "PROMO", "SMALL", "STANDARD")


@query(
    "p_one_hot",
    "sku " + " ".join(f"i:cat_{v}" for v in _TYPES),
    "select sku, " + ", ".join(f"coalesce((category = '{v}')::int, 0) as cat_{v}" for v in _TYPES) + " from {products_raw}",
)
def p_one_hot(t):
    return rel.one_hot(t.products_raw, "category", "cat", rel.one_hot_domain(t.products_raw, "category"))


_RATIO_BASE = f"""with daily as (select product_id, sale_date, sum(case when is_returned then 0 else quantity_sold end) as y
      from {{sales}} group by product_id, sale_date),
    joined as (select s.*, coalesce(y, 0)::double as daily_demand from ({_STOCK}) s
      left join daily d on s.product_id = d.product_id and s.snapshot_date = d.sale_date),
    out as (select *,
      least(999, m30 * 30 / (a30 + 1e-9)) as turnover, least(365, quantity_available / (m7 + 1e-9)) as days_of_inventory,
      least(10, quantity_available / (m7 * lead_time_days + 1e-9)) as lead_time_coverage,
      least(10, m7 / (quantity_on_hand + 1e-9)) as demand_to_stock
      from (select *,
        avg(daily_demand) over (w rows between 7 preceding and 1 preceding) as m7,
        avg(daily_demand) over (w rows between 30 preceding and 1 preceding) as m30,
        avg(quantity_on_hand) over (w rows between 30 preceding and 1 preceding) as a30
        from joined window w as (partition by product_id order by snapshot_date, warehouse_id, inventory_id))
      where m7 is not null)"""


def _stockout(t):
    from depotkit.plans.features import stockout_features

    return stockout_features(stock(t), transform_sales(t.sales), t.brands)


@query("p_turnover", "i:inventory_id e4:inventory_turnover_30d", _RATIO_BASE.replace(" as turnover", " as inventory_turnover_30d"))
def p_turnover(t):
    return _stockout(t)


@query("p_days_of_inventory", "i:inventory_id e4:days_of_inventory", _RATIO_BASE)
def p_days_of_inventory(t):
    return _stockout(t)


@query("p_lead_coverage", "i:inventory_id e4:lead_time_coverage", _RATIO_BASE)
def p_lead_coverage(t):
    return _stockout(t)


@query("p_demand_to_stock", "i:inventory_id e4:demand_to_stock_ratio", _RATIO_BASE.replace(" as demand_to_stock\n", " as demand_to_stock_ratio\n"))
def p_demand_to_stock(t):
    return _stockout(t)


@query(
    "p_stock_flags",
    "i:inventory_id i:is_zero_stock i:is_low_stock",
    f"""select inventory_id, (quantity_on_hand = 0)::int as is_zero_stock,
        coalesce((quantity_available <= reorder_point)::int, 0) as is_low_stock from ({_STOCK})""",
)
def p_stock_flags(t):
    return stock(t).withColumns(
        {
            "is_zero_stock": fn.flag(F.col("quantity_on_hand") == 0),
            "is_low_stock": fn.flag(F.col("quantity_available") <= F.col("reorder_point")),
        }
    )


@query(
    "p_tenure",
    "i:supplier_id r2:years_active",
    """select supplier_id, round_even(date_diff('day', onboarded_at, date '2024-12-31') / 365.25 * 100, 0) / 100
       as years_active from {suppliers}""",
)
def p_tenure(t):
    return t.suppliers.withColumn("years_active", fn.tenure_years("onboarded_at"))


COUNTRY_TIER = """case when country in ('Bangladesh', 'Indonesia', 'Pakistan', 'Nigeria') then 3
    when country in ('India', 'Vietnam', 'China', 'Mexico', 'Brazil') then 2 else 1 end"""


@query("p_country_tier", "i:supplier_id country i:country_risk_tier", f"select supplier_id, country, {COUNTRY_TIER} as country_risk_tier from {{suppliers_raw}}")
def p_country_tier(t):
    return t.suppliers_raw.withColumn("country_risk_tier", fn.country_tier("country"))


TIER_CODE = "case risk_tier when 'low' then 0 when 'medium' then 1 when 'high' then 2 when 'critical' then 3 else 1 end"


@query("p_ordinal", "i:risk_id i:risk_tier_encoded", f"select risk_id, {TIER_CODE} as risk_tier_encoded from {{risk_raw}}")
def p_ordinal(t):
    return t.risk_raw.withColumn("risk_tier_encoded", fn.tier_code("risk_tier"))


@query(
    "p_month_trunc",
    "i:risk_id d:year_month",
    "select risk_id, date_trunc('month', cast(substr(scored_at, 1, 10) as date))::date as year_month from {risk_raw}",
)
def p_month_trunc(t):
    return t.risk_raw.select("risk_id", fn.month_of(fn.utc_timestamp("scored_at")).alias("year_month"))


@query(
    "p_bounded_prediction",
    "i:row_id r2:demand r4:probability label",
    """select row_id, round_even(greatest(0, predicted - 10) * 100, 0) / 100 as demand,
         round_even(greatest(0, least(1, predicted / 25)) * 10000, 0) / 10000 as probability,
         case tier when 0 then 'low' when 1 then 'medium' when 2 then 'high' else 'critical' end as label
       from {predictions}""",
)
def p_bounded_prediction(t):
    return t.predictions.select(
        "row_id",
        score.demand_value(F.col("predicted") - 10).alias("demand"),
        score.delay_value(F.col("predicted") / 25).alias("probability"),
        fn.tier_label("tier").alias("label"),
    )


@query(
    "i_stockout_values",
    "i:row_id r4:stockout_probability stockout_flag",
    """select row_id, round_even(score * 0.99996 * 10000, 0) / 10000 as stockout_probability,
         score * 0.99996 >= 0.5 as stockout_flag from {predictions}""",
)
def i_stockout_values(t):
    """Scores just below the threshold round up to it and stay unflagged."""
    return t.predictions.select("row_id", *score.stockout_values(F.col("score") * 0.99996))
