"""Joins, aggregates, reshaping and top-k queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from depotkit.catalog.registry import query
from depotkit.functions import scalar as fn
from depotkit.operators import relational as rel, windows as win
from depotkit.operators.ordering import global_quantiles, group_quantiles
from depotkit.plans.features import transform_sales
from depotkit.schemas import RAW_COLUMNS


@query(
    "j_left_enrich",
    "i:sale_id i:product_id i:reorder_point i:lead_time_days r:unit_cost",
    """select s.sale_id, s.product_id, reorder_point, lead_time_days, unit_cost
       from {part_sales} s left join {products} p on s.product_id = p.product_id""",
)
def j_left_enrich(t):
    return rel.enrich(t.part_sales, t.products, "product_id", ["reorder_point", "lead_time_days", "unit_cost"])


_DAILY = """select product_id, sale_date, sum(case when is_returned then 0 else quantity_sold end)::double as daily_demand,
    sum(round_even(quantity_sold * unit_price * (1 - discount_pct / 100) * 100, 0) / 100) as daily_revenue,
    avg(unit_price) as avg_unit_price, avg(discount_pct) as avg_discount_pct, count(sale_id) as num_transactions,
    count(*) filter (where is_returned) as return_count"""

SPINE = """spine as (select product_id, unnest(generate_series(lo, hi, interval 1 day))::date as sale_date
    from (select distinct product_id from {sales}) p,
         (select min(sale_date) as lo, max(sale_date) as hi from {sales}) b)"""

DAILY_BRAND = f"daily as ({_DAILY} from {{sales}} group by product_id, sale_date)"


def filled_days(t):
    daily = rel.daily_demand(transform_sales(t.sales))
    return win.fill_days(daily, "product_id", "sale_date", win.day_bounds(t.sales, "sale_date"))


@query("j_spine", "i:product_id d:sale_date", f"with {SPINE}, out as (select * from spine)")
def j_spine(t):
    return filled_days(t)


@query(
    "j_spine_fill",
    "i:product_id d:sale_date r:daily_demand i:num_transactions i:return_count",
    f"""with {SPINE}, {DAILY_BRAND}, out as (select product_id, sale_date, coalesce(daily_demand, 0) as daily_demand,
        coalesce(num_transactions, 0) as num_transactions, coalesce(return_count, 0) as return_count
        from spine left join daily using (product_id, sale_date))""",
)
def j_spine_fill(t):
    return filled_days(t).fillna(0, subset=["daily_demand", "num_transactions", "return_count"])


@query(
    "j_semi_history",
    "i:sale_id i:product_id",
    """select sale_id, product_id from {part_sales} where product_id in
       (select product_id from {part_sales} group by product_id having count(quantity_sold) >= 30)""",
)
def j_semi_history(t):
    return rel.long_history(t.part_sales, "product_id", "quantity_sold", 30)


@query(
    "j_anti_fk",
    "i:sale_id r0:product_id",
    """select sale_id, product_id from {sales_raw} s
       where not exists (select 1 from {products_raw} p where p.product_id = s.product_id)""",
)
def j_anti_fk(t):
    return t.sales_raw.join(t.products_raw.select("product_id").distinct(), "product_id", "left_anti")


@query(
    "j_forecast_actual",
    "i:product_id d:forecast_date r:predicted_demand r2:actual_demand",
    """select f.product_id, f.forecast_date, f.predicted_demand, coalesce(a.units, 0) as actual_demand
       from {forecasts} f left join (select product_id, sale_date, sum(quantity_sold) as units from {sales}
       group by product_id, sale_date) a on a.product_id = f.product_id and a.sale_date = f.forecast_date""",
)
def j_forecast_actual(t):
    return rel.forecast_with_actual(t.forecasts, t.sales)


@query(
    "a_daily_demand",
    "i:product_id d:sale_date r:daily_demand r2:daily_revenue e4:avg_unit_price r:avg_discount_pct "
    "i:num_transactions i:return_count",
    f"{_DAILY} from {{part_sales}} group by product_id, sale_date",
)
def a_daily_demand(t):
    return rel.daily_demand(transform_sales(t.part_sales))


@query(
    "a_daily_sold",
    "i:product_id d:sale_date r:total_sold",
    "select product_id, sale_date, sum(quantity_sold) as total_sold from {part_sales} group by product_id, sale_date",
)
def a_daily_sold(t):
    return rel.daily_sum(t.part_sales, "quantity_sold", "total_sold")


@query(
    "a_cell_min",
    "i:product_id d:snapshot_date i:cell_min",
    "select product_id, snapshot_date, min(quantity_on_hand) as cell_min from {stock} group by product_id, snapshot_date",
)
def a_cell_min(t):
    return t.stock.groupBy("product_id", "snapshot_date").agg(F.min("quantity_on_hand").alias("cell_min"))


@query(
    "a_value_counts",
    "value i:rows",
    "select channel as value, count(*) as rows from {sales_raw} group by channel",
)
def a_value_counts(t):
    return rel.value_counts(t.sales_raw, "channel")


@query(
    "a_distinct",
    "i:products i:suppliers i:months",
    """select count(distinct product_id) as products, count(distinct supplier_id) as suppliers,
       count(distinct date_trunc('month', sale_date)) as months from {part_sales}""",
)
def a_distinct(t):
    return t.part_sales.agg(
        F.count_distinct("product_id").alias("products"),
        F.count_distinct("supplier_id").alias("suppliers"),
        F.count_distinct(fn.month_of("sale_date")).alias("months"),
    )


@query("a_day_bounds", "d:first_day d:last_day", "select min(sale_date) as first_day, max(sale_date) as last_day from {part_sales}")
def a_day_bounds(t):
    return t.part_sales.agg(F.min("sale_date").alias("first_day"), F.max("sale_date").alias("last_day"))


@query(
    "a_quantiles",
    "column_name r4:q25 r4:q50 r4:q75",
    " union all ".join(
        f"select '{c}' as column_name, quantile_cont({c}, 0.25) as q25, quantile_cont({c}, 0.5) as q50, "
        f"quantile_cont({c}, 0.75) as q75 from {{part_sales}}"
        for c in ("quantity_sold", "unit_price", "discount_pct")
    ),
)
def a_quantiles(t):
    found = global_quantiles(t.part_sales, ["quantity_sold", "unit_price", "discount_pct"], [0.25, 0.5, 0.75])
    rows = [(c, *q) for c, q in found.items()]
    return t.spark.createDataFrame(rows, "column_name string, q25 double, q50 double, q75 double")


@query(
    "a_group_quantiles",
    "i:supplier_id e4:median e4:q90",
    """select supplier_id, median(unit_price) as median, quantile_cont(unit_price, 0.9) as q90
       from {part_sales} group by supplier_id""",
)
def a_group_quantiles(t):
    q = group_quantiles(t.part_sales, ["unit_price"], [0.5, 0.9], ["supplier_id"])
    return q.withColumnsRenamed({"unit_price_q0": "median", "unit_price_q1": "q90"})


_SALES_RAW = RAW_COLUMNS["sales"]


@query(
    "a_feature_profile",
    "i:rows i:columns r4:null_pct r:target_mean r:target_std r:target_min r:target_max",
    f"""with q as (select * replace (try_cast(quantity_sold as double) as quantity_sold) from {{sales_raw}}),
       out as (select count(*) as rows, {len(_SALES_RAW)} as columns,
         ({" + ".join(f"(count(*) - count({c}))" for c in _SALES_RAW)}) * 100.0 / count(*) / {len(_SALES_RAW)} as null_pct,
         avg(quantity_sold) as target_mean, stddev_samp(quantity_sold) as target_std, min(quantity_sold) as target_min,
         max(quantity_sold) as target_max from q)""",
)
def a_feature_profile(t):
    return rel.feature_profile(t.sales_raw.withColumn("quantity_sold", fn.number("quantity_sold")), "quantity_sold")


def _profile(table, view, metrics, mix=None):
    rows = [f"select '{table}' as \"table\", '{m}' as metric, ({e})::double as value from {{{view}}}" for m, e in metrics.items()]
    if mix:
        rows.append(
            f"select '{table}', '{mix}:' || coalesce({mix}, ''), count(*)::double from {{{view}}} group by {mix}"
        )
    return " union all ".join(rows)


_SCORED = """scored as (select f.product_id, f.forecast_date, f.predicted_demand, coalesce(a.units, 0)::double as actual_demand
    from {forecasts} f left join (select product_id, sale_date, sum(quantity_sold) as units from {sales}
    group by product_id, sale_date) a on a.product_id = f.product_id and a.sale_date = f.forecast_date),
  accuracy as (select *, round_even(abs(predicted_demand - actual_demand) * 10000, 0) / 10000 as mae,
    round_even(least(100, abs(predicted_demand - actual_demand) / (actual_demand + 1) * 100) * 10000, 0) / 10000 as mape,
    round_even(greatest(0.5, least(0.99, 1 - abs(predicted_demand - actual_demand) / (actual_demand + 1e-9))) * 10000, 0)
      / 10000 as confidence_score from scored)"""


@query(
    "a_target_balance",
    "r:positive_share",
    "select avg(label) as positive_share from {predictions}",
)
def a_target_balance(t):
    return t.predictions.agg(F.avg("label").alias("positive_share"))


@query(
    "a_class_weights",
    "i:tier i:n r:weight",
    """select predicted_tier as tier, count(*) as n,
       (select count(*) from {predictions}) / ((select count(distinct predicted_tier) from {predictions}) * count(*)) as weight
       from {predictions} group by predicted_tier""",
)
def a_class_weights(t):
    return rel.class_weights(t.predictions, "predicted_tier").withColumnRenamed("predicted_tier", "tier")


_UNITS = "select product_id, sum(quantity_sold) as units from {part_sales} group by product_id"


def _units(t):
    return t.part_sales.groupBy("product_id").agg(F.sum("quantity_sold").alias("units"))


@query("h_top_k", "i:product_id i:units", f"{_UNITS} order by units desc, product_id limit 20")
def h_top_k(t):
    return rel.top_k(_units(t), F.col("units"), 20, ["product_id"])


@query(
    "h_top_magnitude",
    "i:product_id r:deviation",
    f"""with u as ({_UNITS}), v as (select product_id, units - m as deviation from u, (select avg(units) as m from u) a),
        out as (select * from v order by abs(deviation) desc, product_id limit 10)""",
)
def h_top_magnitude(t):
    units = _units(t)
    mean = units.agg(F.avg("units")).scalar()
    return rel.top_k(units.withColumn("deviation", F.col("units") - mean), F.abs("deviation"), 10, ["product_id"])


@query("h_argmax", "i:product_id i:units", f"{_UNITS} order by units desc, product_id limit 1")
def h_argmax(t):
    return rel.best_row(_units(t), "units", ["product_id"])


@query(
    "h_sort",
    "i:sale_id i:product_id d:sale_date i:quantity_sold",
    "select sale_id, product_id, sale_date, quantity_sold from {part_sales} order by product_id, sale_date, sale_id, quantity_sold",
)
def h_sort(t):
    return t.part_sales.orderBy("product_id", "sale_date", "sale_id", "quantity_sold")


@query(
    "h_pivot",
    "i:supplier_id i:A i:N i:R",
    """select supplier_id, sum(quantity_sold) filter (where l_returnflag = 'A') as A,
       sum(quantity_sold) filter (where l_returnflag = 'N') as N, sum(quantity_sold) filter (where l_returnflag = 'R') as R
       from {part_sales} group by supplier_id""",
)
def h_pivot(t):
    return rel.pivot(t.part_sales, ["supplier_id"], "l_returnflag", ["A", "N", "R"], F.sum("quantity_sold"))


@query(
    "h_unpivot",
    "i:product_id metric r:value",
    """select product_id, 'lead_time_days' as metric, lead_time_days::double as value from {products}
       union all select product_id, 'reorder_point', reorder_point::double from {products}
       union all select product_id, 'reorder_quantity', reorder_quantity::double from {products}""",
)
def h_unpivot(t):
    return rel.unpivot(t.products, ["product_id"], ["lead_time_days", "reorder_point", "reorder_quantity"], "metric", "value")


@query(
    "h_seeded_sample",
    "i:sale_id i:product_id i:quantity_sold",
    """select sale_id, product_id, quantity_sold from {part_sales} order by
       md5(concat_ws('|', sale_id::varchar, product_id::varchar, quantity_sold::varchar, '42')), sale_id, product_id,
       quantity_sold limit 300""",
)
def h_seeded_sample(t):
    return rel.seeded_sample(t.part_sales, 300, ["sale_id", "product_id", "quantity_sold"])
