"""Window queries and the three feature tables."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from depotkit.catalog.columns import CALENDAR_COLUMNS, COUNTRY_TIER, PRICE_TIER, TIER_CODE, _STOCK, calendar_sql, stock
from depotkit.catalog.registry import _items, query
from depotkit.catalog.relations import DAILY_BRAND, SPINE, filled_days
from depotkit.ml import train
from depotkit.ml.features import STOCKOUT_FEATURES
from depotkit.operators import labels, scoring, windows as win
from depotkit.plans import features
from depotkit.plans.features import transform_sales

def by_day():
    return Window.partitionBy("product_id").orderBy("sale_date")


_W = "window w as (partition by product_id order by sale_date)"

# The gap-free daily series of every brand.
_SERIES = f"""with {SPINE}, {DAILY_BRAND},
  days as (select product_id, sale_date, coalesce(daily_demand, 0) as y, daily_revenue, avg_unit_price, avg_discount_pct,
                  coalesce(num_transactions, 0) as num_transactions, coalesce(return_count, 0) as return_count
           from spine left join daily using (product_id, sale_date))"""


def _days(t):
    return filled_days(t).withColumn("y", F.coalesce("daily_demand", F.lit(0.0)))


@query(
    "w_lag",
    "i:product_id d:sale_date " + " ".join(f"r:lag_{k}" for k in (7, 14, 21, 30)),
    f"{_SERIES}, out as (select product_id, sale_date, "
    + ", ".join(f"lag(y, {k}) over w as lag_{k}" for k in (7, 14, 21, 30))
    + f" from days {_W})",
)
def w_lag(t):
    return _days(t).withColumns({f"lag_{k}": win.lag("y", k, by_day()) for k in (7, 14, 21, 30)})


def _trail(fn: str, c: str, k: int) -> str:
    return f"{fn}({c}) over (w rows between {k} preceding and 1 preceding)"


@query(
    "w_trailing_mean",
    "i:product_id d:sale_date r:m7 r:m14 r:m30",
    f"{_SERIES}, out as (select product_id, sale_date, "
    + ", ".join(f"{_trail('avg', 'y', k)} as m{k}" for k in (7, 14, 30))
    + f" from days {_W})",
)
def w_trailing_mean(t):
    return _days(t).withColumns({f"m{k}": win.trailing_mean("y", k, by_day()) for k in (7, 14, 30)})


@query(
    "w_trailing_std",
    "i:product_id d:sale_date e:s7 e:s14 e:s30",
    f"{_SERIES}, out as (select product_id, sale_date, "
    + ", ".join(f"coalesce({_trail('stddev_samp', 'y', k)}, 0) as s{k}" for k in (7, 14, 30))
    + f" from days {_W})",
)
def w_trailing_std(t):
    return _days(t).withColumns({f"s{k}": win.trailing_std("y", k, by_day()) for k in (7, 14, 30)})


def _both_ways(c: str) -> str:
    return f"""coalesce(last_value({c} ignore nulls) over (w rows between unbounded preceding and current row),
        first_value({c} ignore nulls) over (w rows between current row and unbounded following))"""


_FILLED = f"""{_SERIES}, filled as (select * replace ({_both_ways('avg_unit_price')} as avg_unit_price,
    {_both_ways('avg_discount_pct')} as avg_discount_pct) from days {_W})"""


@query(
    "w_ffill_bfill",
    "i:product_id d:sale_date e4:avg_unit_price r:avg_discount_pct",
    f"{_FILLED}, out as (select * from filled)",
)
def w_ffill_bfill(t):
    return _days(t).withColumns({c: win.fill_both_ways(c, by_day()) for c in ("avg_unit_price", "avg_discount_pct")})


@query(
    "w_rolling_price",
    "i:product_id d:sale_date e4:roll_price_7d r:roll_discount_7d",
    f"""{_FILLED}, out as (select product_id, sale_date, {_trail('avg', 'avg_unit_price', 7)} as roll_price_7d,
        {_trail('avg', 'avg_discount_pct', 7)} as roll_discount_7d from filled {_W})""",
)
def w_rolling_price(t):
    d = _days(t).withColumns({c: win.fill_both_ways(c, by_day()) for c in ("avg_unit_price", "avg_discount_pct")})
    return d.withColumns(
        {
            "roll_price_7d": win.trailing_mean("avg_unit_price", 7, by_day()),
            "roll_discount_7d": win.trailing_mean("avg_discount_pct", 7, by_day()),
        }
    )


@query(
    "w_differences",
    "i:product_id d:sale_date r:delta_7 r:acceleration",
    f"""{_SERIES}, out as (select product_id, sale_date, y - lag(y, 7) over w as delta_7,
        y - 2 * lag(y) over w + lag(y, 2) over w as acceleration from days {_W})""",
)
def w_differences(t):
    return _days(t).withColumns(
        {"delta_7": win.difference("y", 7, by_day()), "acceleration": win.second_difference("y", by_day())}
    )


def by_warehouse():
    return Window.partitionBy("product_id", "warehouse_id").orderBy("snapshot_date")


_WH = "window w as (partition by product_id, warehouse_id order by snapshot_date)"


@query(
    "w_stockout_rate",
    "i:inventory_id r:avg_stock_30d r:stockout_rate_30d",
    f"""select inventory_id, {_trail('avg', 'quantity_on_hand', 30)} as avg_stock_30d,
        {_trail('avg', '(quantity_on_hand = 0)::int', 30)} as stockout_rate_30d from {{stock}} {_WH}""",
)
def w_stockout_rate(t):
    return t.stock.withColumns(
        {
            "avg_stock_30d": win.trailing_mean("quantity_on_hand", 30, by_warehouse()),
            "stockout_rate_30d": win.trailing_mean((F.col("quantity_on_hand") == 0).cast("int"), 30, by_warehouse()),
        }
    )


@query(
    "w_consecutive",
    "i:inventory_id r:low_days",
    f"""with f as (select inventory_id, product_id, warehouse_id, snapshot_date, (quantity_on_hand < 100)::int as low
                  from {{stock}}),
        g as (select *, sum(1 - low) over (w rows unbounded preceding) as island from f {_WH}),
        out as (select inventory_id, sum(low) over (partition by product_id, warehouse_id, island order by snapshot_date
                rows unbounded preceding)::double as low_days from g)""",
)
def w_consecutive(t):
    placed = t.stock.withColumn("_pos", F.row_number().over(by_warehouse()))
    return placed.withColumn("low_days", win.run_length(F.col("quantity_on_hand") < 100, "_pos", by_warehouse()))


# Scores of deliveries: the input of the slope, spike and supplier feature queries.
RISK = """stats as (select supplier_id, period, avg(delay_days) as m, var_samp(delay_days) as v,
      avg((delay_days <= 0.5)::int) as on_time, avg((delay_days > 2)::int) as late, max(max_delay) as max_delay,
      count(*) as orders_evaluated from {deliveries} group by supplier_id, period),
  prob as (select *, round_even(late * 10000, 0) / 10000 as delay_probability from stats),
  comp as (select *, round_even(greatest(0, least(100, delay_probability * 40 + m / max_delay * 40 + (1 - on_time) * 20))
      * 100, 0) / 100 as composite_risk_score from prob),
  risk as (select supplier_id, period, delay_probability, round_even(greatest(m, 0) * 100, 0) / 100 as avg_delay_days_pred,
      case when composite_risk_score < 25 then 'low' when composite_risk_score < 50 then 'medium'
           when composite_risk_score < 75 then 'high' else 'critical' end as risk_tier,
      composite_risk_score, round_even(m * 10000, 0) / 10000 as hist_mean_delay_days,
      round_even(v * 10000, 0) / 10000 as hist_delay_variance, round_even(on_time * 10000, 0) / 10000 as hist_on_time_rate,
      orders_evaluated, m, v, on_time,
      case when composite_risk_score < 25 then 'No action required; continue standard ordering.'
           when composite_risk_score < 50 then 'Monitor delivery windows; consider dual-sourcing.'
           when composite_risk_score < 75 then 'Increase safety stock; request SLA commitment.'
           else 'Escalate to procurement; initiate alternative sourcing.' end as recommended_action from comp)"""


def risk_scores(t):
    scored = scoring.supplier_risk_scores(t.deliveries)
    return scored.withColumns(
        {
            "scored_at": F.col("period").cast("timestamp"),
            "risk_id": F.col("supplier_id") * 1000000 + F.year("period") * 100 + F.month("period"),
        }
    )


def by_period():
    return Window.partitionBy("supplier_id").orderBy("period")


_WS = "window w as (partition by supplier_id order by period)"


@query(
    "w_slope",
    "i:supplier_id d:period r:slope",
    f"""with {RISK}, out as (select supplier_id, period, case row_number() over w when 1 then null
        when 2 then hist_mean_delay_days - lag(hist_mean_delay_days) over w
        else (hist_mean_delay_days - lag(hist_mean_delay_days, 2) over w) / 2 end as slope from risk {_WS})""",
)
def w_slope(t):
    return risk_scores(t).withColumn("slope", win.slope3("hist_mean_delay_days", by_period()))


_SPIKE = f"""(hist_mean_delay_days > {_trail('avg', 'hist_mean_delay_days', 3)}
    + 2 * coalesce({_trail('stddev_samp', 'hist_mean_delay_days', 3)}, 0))"""


@query(
    "p_spike_flag",
    "i:supplier_id d:period i:spike",
    f"with {RISK}, out as (select supplier_id, period, coalesce({_SPIKE}::int, 0) as spike from risk {_WS})",
)
def p_spike_flag(t):
    from depotkit.functions import scalar as fn

    d = "hist_mean_delay_days"
    return risk_scores(t).withColumn("spike", fn.spike(d, win.trailing_mean(d, 3, by_period()), win.trailing_std(d, 3, by_period())))


@query(
    "p_interactions",
    "i:supplier_id d:period e:reliability_x_ontime e:delay_var_x_mean",
    f"""with {RISK}, out as (select r.supplier_id, period, reliability_score * hist_on_time_rate as reliability_x_ontime,
        hist_delay_variance * hist_mean_delay_days as delay_var_x_mean
        from risk r left join {{suppliers}} s on r.supplier_id = s.supplier_id)""",
)
def p_interactions(t):
    joined = risk_scores(t).join(t.suppliers, "supplier_id", "left")
    return joined.withColumns(
        {
            "reliability_x_ontime": F.col("reliability_score") * F.col("hist_on_time_rate"),
            "delay_var_x_mean": F.col("hist_delay_variance") * F.col("hist_mean_delay_days"),
        }
    )


# Product x date grid, as the definition has it; the plan under test builds no grid.
_LABEL = """cells as (select product_id, snapshot_date, min(quantity_on_hand) as cell_min from {stock}
      group by product_id, snapshot_date),
  grid as (select p.product_id, d.snapshot_date, c.cell_min
      from (select distinct product_id from {stock}) p cross join (select distinct snapshot_date from {stock}) d
      left join cells c on c.product_id = p.product_id and c.snapshot_date = d.snapshot_date),
  ahead as (select *, min(cell_min) over w as low, count(cell_min) over w as n from grid
      window w as (partition by product_id order by snapshot_date rows between current row and 7 following)),
  label as (select product_id, snapshot_date, cell_min, case when n = 8 then low end as future_min_stock,
      case when n = 8 then (low = 0)::int else 1 end as stockout_in_horizon from ahead where cell_min is not null)"""


@query(
    "l_stockout_label",
    "i:product_id d:snapshot_date r:cell_min r:future_min_stock i:stockout_in_horizon",
    f"with {_LABEL}, out as (select * from label)",
)
def l_stockout_label(t):
    return labels.stockout_cells(t.stock)


@query(
    "l_stockout_label_null_edge",
    "i:inventory_id r:stockout_in_horizon",
    f"""with {_LABEL}, out as (select s.inventory_id, case when future_min_stock is not null then stockout_in_horizon end
        as stockout_in_horizon from {{stock}} s join label l
        on s.product_id = l.product_id and s.snapshot_date = l.snapshot_date)""",
)
def l_stockout_label_null_edge(t):
    return labels.stockout_label(t.stock, edge="null")


# The plain loop over the changes so far, apart from the closed form of the ``stock`` view.
_BALANCE = """select *, list_reduce(list_prepend(100::bigint, list(change::bigint) over (
        partition by product_id, warehouse_id order by snapshot_date rows between unbounded preceding and current row)),
        lambda have, moved: greatest(have + moved, 0)) as balance from {movements} m"""
_BALANCE_COLUMNS = "i:product_id warehouse_id d:snapshot_date i:change i:balance"


@query("r_floored_balance", _BALANCE_COLUMNS, _BALANCE)
def r_floored_balance(t):
    floor = win.floored_balance(F.lit(100), "change", ["product_id", "warehouse_id"], ["snapshot_date"])
    return t.movements.transform(floor)


@query("r_floored_balance_blocks", _BALANCE_COLUMNS, _BALANCE)
def r_floored_balance_blocks(t):
    """The path of very long series: blocks that begin and end inside of them."""
    floor = win.floored_balance(
        F.lit(100), "change", ["product_id", "warehouse_id"], ["snapshot_date"], max_rows=5, block_rows=4000
    )
    return t.movements.transform(floor)


# ---- feature tables ----------------------------------------------------------

_CATS = ("Apparel", "Electronics", "Food & Beverage", "Home & Garden")
DEMAND_COLUMNS = (
    "i:product_id d:sale_date r:daily_demand r2:daily_revenue e4:avg_unit_price r:avg_discount_pct i:num_transactions "
    "i:return_count "
    + " ".join(f"r:lag_{k}" for k in (7, 14, 21, 30))
    + " "
    + " ".join(f"r:rolling_mean_{k}d r:rolling_std_{k}d" for k in (7, 14, 30))
    + " e4:roll_price_7d r:roll_discount_7d r:demand_delta_7d r:demand_accel "
    + CALENDAR_COLUMNS
    + " r:unit_cost e4:unit_price i:lead_time_days i:reorder_point i:price_tier "
    + " ".join(f"i:cat_{c.replace(' ', '~')}" for c in _CATS)
)


@query(
    "f_demand",
    DEMAND_COLUMNS,
    f"""{_FILLED},
      feats as (select product_id, sale_date, y as daily_demand, daily_revenue, avg_unit_price, avg_discount_pct,
        num_transactions, return_count, {", ".join(f"lag(y, {k}) over w as lag_{k}" for k in (7, 14, 21, 30))},
        {", ".join(f"{_trail('avg', 'y', k)} as rolling_mean_{k}d, coalesce({_trail('stddev_samp', 'y', k)}, 0) as rolling_std_{k}d" for k in (7, 14, 30))},
        {_trail('avg', 'avg_unit_price', 7)} as roll_price_7d, {_trail('avg', 'avg_discount_pct', 7)} as roll_discount_7d,
        y - lag(y, 7) over w as demand_delta_7d, y - 2 * lag(y) over w + lag(y, 2) over w as demand_accel,
        {calendar_sql('sale_date')}, count(y) over (partition by product_id) as history from filled {_W}),
      out as (select f.*, unit_cost, unit_price, lead_time_days, reorder_point, {PRICE_TIER} as price_tier,
        {", ".join(f"(category = '{c}')::int as {chr(34)}cat_{c}{chr(34)}" for c in _CATS)}
        from feats f left join {{brands}} b on f.product_id = b.product_id where history >= 30)""",
)
def f_demand(t):
    return features.demand_features(transform_sales(t.sales), t.brands)


STOCKOUT_COLUMNS = (
    "i:inventory_id i:product_id d:snapshot_date warehouse_id i:quantity_on_hand i:quantity_reserved reorder_triggered "
    "e:unit_cost_snapshot i:reorder_point i:reorder_quantity i:quantity_available is_below_reorder r:daily_demand "
    + " ".join(f"r:demand_mean_{k}d r:demand_std_{k}d" for k in (7, 14, 30))
    + " r:avg_stock_30d e4:inventory_turnover_30d e4:days_of_inventory i:lead_time_days r:unit_cost e4:lead_time_coverage "
    "e4:demand_to_stock_ratio i:is_zero_stock r:stockout_rate_30d i:is_low_stock r:consec_low_stock_days r:demand_accel_7d "
    "r:future_min_stock i:stockout_in_horizon " + CALENDAR_COLUMNS
)


_STOCKOUT_SQL = f"""with {_LABEL},
      demand as (select product_id, sale_date, sum(case when is_returned then 0 else quantity_sold end) as y
        from {{sales}} group by product_id, sale_date),
      base as (select s.*, coalesce(y, 0)::double as daily_demand, (quantity_on_hand = 0)::int as is_zero_stock,
        coalesce((quantity_available <= reorder_point)::int, 0) as is_low_stock
        from ({_STOCK}) s left join demand d on s.product_id = d.product_id and s.snapshot_date = d.sale_date),
      rolled as (select *,
        {", ".join(f"{_trail('avg', 'daily_demand', k)} as demand_mean_{k}d, coalesce({_trail('stddev_samp', 'daily_demand', k)}, 0) as demand_std_{k}d" for k in (7, 14, 30))},
        {_trail('avg', 'quantity_on_hand', 30)} as avg_stock_30d, {_trail('avg', 'is_zero_stock', 30)} as stockout_rate_30d,
        daily_demand - lag(daily_demand, 7) over w as demand_accel_7d,
        sum(1 - is_low_stock) over (w rows unbounded preceding) as island
        from base window w as (partition by product_id order by snapshot_date, warehouse_id, inventory_id)),
      runs as (select *, sum(is_low_stock) over (partition by product_id, island order by snapshot_date, warehouse_id,
        inventory_id rows unbounded preceding)::double as consec_low_stock_days from rolled),
      out as (select r.*, least(999, demand_mean_30d * 30 / (avg_stock_30d + 1e-9)) as inventory_turnover_30d,
        least(365, quantity_available / (demand_mean_7d + 1e-9)) as days_of_inventory,
        least(10, quantity_available / (demand_mean_7d * lead_time_days + 1e-9)) as lead_time_coverage,
        least(10, demand_mean_7d / (quantity_on_hand + 1e-9)) as demand_to_stock_ratio,
        future_min_stock, stockout_in_horizon, {calendar_sql('r.snapshot_date')}
        from runs r left join label l on r.product_id = l.product_id and r.snapshot_date = l.snapshot_date
        where demand_mean_7d is not null)"""


@query("f_stockout", STOCKOUT_COLUMNS, _STOCKOUT_SQL)
def f_stockout(t):
    return features.stockout_features(stock(t), transform_sales(t.sales), t.brands)


@query("f_stockout_blocks", STOCKOUT_COLUMNS, _STOCKOUT_SQL)
def f_stockout_blocks(t):
    """The path of very long series: each product is cut into many blocks."""
    return features.stockout_features(stock(t), transform_sales(t.sales), t.brands, max_series_rows=40)


# The inputs of the stockout model: the listed features the table has, as doubles without NULLs. One is
# taken away first, which must not stop the rest; the look-ahead minimum is never among them.
_TAKEN = "demand_accel_7d"
_INPUTS = [c for c in STOCKOUT_FEATURES if c != _TAKEN]
_KINDS = {name: kind or "i" for kind, name in _items(STOCKOUT_COLUMNS)}
_MADE = "made as (".join(_STOCKOUT_SQL.rsplit("out as (", 1))


@query(
    "m_stockout_inputs",
    "i:inventory_id i:label " + " ".join(f"{_KINDS[c]}:{c}" for c in _INPUTS),
    f"""{_MADE}, out as (select inventory_id, stockout_in_horizon as label,
        {", ".join(f"coalesce(cast({c} as double), 0) as {c}" for c in _INPUTS)} from made)""",
)
def m_stockout_inputs(t):
    table = f_stockout(t).drop(_TAKEN)
    columns = train.inputs(table, STOCKOUT_FEATURES)
    return train.stockout_matrix(table, columns).select("inventory_id", "label", *columns)


_REGIONS = ("Africa", "Americas", "Asia", "Europe", "Middle East")
SUPPLIER_COLUMNS = (
    "i:supplier_id d:year_month r:delay_probability r:avg_delay_days_pred risk_tier r:composite_risk_score "
    "r:hist_mean_delay_days r:hist_delay_variance r:hist_on_time_rate i:orders_evaluated r:rolling_delay_mean_3m "
    "r:rolling_delay_std_3m r:rolling_on_time_rate_3m r:rolling_delay_prob_3m r:delay_trend_3m i:delay_spike_flag "
    "r:lag_1m_delay_mean r:lag_1m_delay_prob r:lag_2m_delay_mean r:reliability_score i:payment_terms_days "
    "i:country_risk_tier r2:years_active country region i:risk_tier_encoded e:reliability_x_ontime e:delay_var_x_mean "
    + " ".join(f"i:region_{r.replace(' ', '~')}" for r in _REGIONS)
)


_SUPPLIER_SQL = f"""with {RISK},
      rolled as (select *, period as year_month, {_trail('avg', 'hist_mean_delay_days', 3)} as rolling_delay_mean_3m,
        coalesce({_trail('stddev_samp', 'hist_mean_delay_days', 3)}, 0) as rolling_delay_std_3m,
        {_trail('avg', 'hist_on_time_rate', 3)} as rolling_on_time_rate_3m,
        {_trail('avg', 'delay_probability', 3)} as rolling_delay_prob_3m,
        case row_number() over w when 1 then null when 2 then hist_mean_delay_days - lag(hist_mean_delay_days) over w
          else (hist_mean_delay_days - lag(hist_mean_delay_days, 2) over w) / 2 end as delay_trend_3m,
        coalesce({_SPIKE}::int, 0) as delay_spike_flag,
        lag(hist_mean_delay_days) over w as lag_1m_delay_mean, lag(delay_probability) over w as lag_1m_delay_prob,
        lag(hist_mean_delay_days, 2) over w as lag_2m_delay_mean from risk {_WS}),
      out as (select r.*, reliability_score, payment_terms_days, {COUNTRY_TIER} as country_risk_tier,
        round_even(date_diff('day', onboarded_at, date '2024-12-31') / 365.25 * 100, 0) / 100 as years_active,
        country, region, {TIER_CODE} as risk_tier_encoded, reliability_score * hist_on_time_rate as reliability_x_ontime,
        hist_delay_variance * hist_mean_delay_days as delay_var_x_mean,
        {", ".join(f"(region = '{r}')::int as {chr(34)}region_{r}{chr(34)}" for r in _REGIONS)}
        from rolled r left join {{suppliers}} s on r.supplier_id = s.supplier_id)"""


@query("f_supplier_risk", SUPPLIER_COLUMNS, _SUPPLIER_SQL)
def f_supplier_risk(t):
    return features.supplier_risk_features(risk_scores(t), t.suppliers)


@query("f_supplier_risk_blocks", SUPPLIER_COLUMNS, _SUPPLIER_SQL)
def f_supplier_risk_blocks(t):
    return features.supplier_risk_features(risk_scores(t), t.suppliers, max_series_rows=4)
