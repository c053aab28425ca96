"""Domain tables derived from the driver tables.

Each view is one SQL text that both Spark and DuckDB run, so a query and its oracle start
from the same rows. ``{name}`` marks a driver table or another view. The ``*_raw`` views
carry deterministic dirt by key modulus; the others are clean.
DAYS(a, b) and ADD_DAYS(d, n) stand for the day arithmetic the two dialects spell differently.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

BASE = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events")

# Country names by nation key.
COUNTRIES = (
    "Bangladesh", "India", "USA", "Germany", "Vietnam", "Indonesia", "Mexico", "UK", "China", "Pakistan",
    "France", "Spain", "Nigeria", "Brazil", "Japan", "Canada", "Italy", "Poland", "Kenya", "Egypt", "Peru",
    "Chile", "Norway", "Turkey", "Ghana",
)
_COUNTRY_CASE = " ".join(f"when {i} then '{c}'" for i, c in enumerate(COUNTRIES))

VIEWS: dict[str, str] = {
    # ---- dirty raw tables ----
    "sales_raw": """
        select sid as sale_id,
               case when sid % 61 = 0 then -1 when sid % 67 = 0 then null else l_partkey end as product_id,
               case when sid % 43 = 0 then 'not-a-date'
                    else cast(cast(l_shipdate as date) as string) end as sale_date,
               case when sid % 37 = 0 then null when sid % 41 = 0 then 'n/a'
                    when sid % 47 = 0 then cast(-l_quantity as string)
                    when sid % 53 = 0 then cast(l_quantity * 100 as string)
                    else cast(l_quantity as string) end as quantity_sold,
               case when sid % 53 = 1 then cast(l_extendedprice / l_quantity * 100 as string)
                    when sid % 41 = 1 then 'n/a'
                    else cast(l_extendedprice / l_quantity as string) end as unit_price,
               case sid % 6 when 0 then ' Web ' when 1 then 'B2B' when 2 then 'Store'
                    when 3 then 'E-Commerce' when 4 then 'retail' else null end as channel,
               case l_suppkey % 5 when 0 then 'North' when 1 then 'South' when 2 then 'East'
                    when 3 then 'West' else 'Central' end as region,
               case when sid % 59 = 0 then '150' when sid % 31 = 0 then null
                    else cast(l_discount * 100 as string) end as discount_pct,
               case sid % 7 when 0 then 'YES' when 1 then '1' when 2 then '0' when 3 then ''
                    when 4 then null when 5 then 'True'
                    else (case when l_returnflag = 'R' then 'true' else 'False' end) end as is_returned,
               cast(cast(l_shipdate as date) as string) as created_at
        from (select *, l_orderkey * 10 + l_linenumber as sid from {lineitem}) x""",
    "products_raw": """
        select case when p_partkey % 71 = 70 then p_partkey - 1 else p_partkey end as product_id,
               concat('SKU-', lpad(cast(p_partkey as string), 8, '0')) as sku,
               p_name as product_name,
               case when p_partkey % 83 = 0 then null else p_type end as category,
               p_brand as sub_category,
               case when p_type = 'PROMO' or p_partkey % 37 = 0 then null when p_partkey % 41 = 0 then 'n/a'
                    when p_partkey % 47 = 0 then cast(-p_retailprice as string)
                    else cast((p_retailprice - 899) * 3 as string) end as unit_cost,
               case when p_type = 'PROMO' or p_partkey % 29 = 0 then null
                    else cast((p_retailprice - 899) * 5 as string) end as unit_price,
               case when p_partkey % 37 = 1 then null else cast(p_size as string) end as lead_time_days,
               case when p_partkey % 41 = 1 then 'n/a' else cast(5 * p_size as string) end as reorder_point,
               case when p_partkey % 47 = 1 then '-3' when p_partkey % 47 = 2 then null
                    else cast(15 * p_size as string) end as reorder_quantity,
               case when p_partkey % 5 = 0 then null when p_size % 2 = 0 then 'True' else 'False' end as is_active,
               case when p_partkey % 43 = 0 then 'soon' else '2023-01-01' end as created_at,
               '2024-01-01' as updated_at
        from {part}""",
    "suppliers_raw": """
        select case when s_suppkey % 31 = 30 then s_suppkey - 1 else s_suppkey end as supplier_id,
               s_name as supplier_name,
               concat('orders@', lower(n_name), '.example') as contact_email,
               case when s_suppkey % 19 = 0 then null else country end as country,
               region,
               case when s_suppkey % 13 = 0 then null when s_suppkey % 17 = 0 then 'n/a'
                    else cast(s_acctbal / 900 as string) end as reliability_score,
               case when s_suppkey % 11 = 0 then null when s_suppkey % 23 = 0 then '-5'
                    else cast(15 * (s_suppkey % 6 + 1) as string) end as payment_terms_days,
               case when s_suppkey % 4 = 0 then null when s_suppkey % 4 = 1 then 'False' else 'True' end as is_active,
               case when s_suppkey % 29 = 0 then 'unknown' else cast(onboarded_at as string) end as onboarded_at,
               '2022-06-01' as created_at,
               '2024-01-01' as updated_at
        from {supplier_geo}""",
    "inventory_raw": """
        select sid as inventory_id,
               case when sid % 61 = 0 then -1 when sid % 67 = 0 then null else l_partkey % 50 end as product_id,
               case when sid % 43 = 0 then 'not-a-date'
                    else cast(cast(l_shipdate as date) as string) end as snapshot_date,
               concat('WH-00', cast(l_suppkey % 3 + 1 as string)) as warehouse_id,
               case when sid % 37 = 0 then null when sid % 41 = 0 then 'n/a'
                    when sid % 47 = 0 then cast(-l_quantity as string)
                    else cast(l_quantity * 1.5 as string) end as quantity_on_hand,
               case when sid % 13 = 0 then cast(l_quantity * 2 as string) when sid % 29 = 0 then null
                    else cast(l_linenumber as string) end as quantity_reserved,
               case sid % 5 when 0 then 'YES' when 1 then '1' when 2 then '0' when 3 then '' else null end
                    as reorder_triggered,
               case when sid % 53 = 0 then cast(l_extendedprice as string) when sid % 41 = 1 then 'n/a'
                    else cast(l_extendedprice / l_quantity * 0.6 as string) end as unit_cost_snapshot,
               cast(cast(l_shipdate as date) as string) as created_at
        from (select *, l_orderkey * 10 + l_linenumber as sid from {lineitem}) x""",
    "forecasts_raw": """
        select case when o_orderkey % 71 = 70 then o_orderkey - 1 else o_orderkey end as forecast_id,
               case when o_orderkey % 61 = 0 then -1 when o_orderkey % 67 = 0 then null
                    else o_custkey % 200 end as product_id,
               case when o_orderkey % 43 = 0 then 'not-a-date'
                    else cast(cast(o_orderdate as date) as string) end as forecast_date,
               cast(cast(o_orderdate as date) as string) as generated_at,
               'naive_v1' as model_name,
               '1.0.0' as model_version,
               case when o_orderkey % 37 = 0 then null when o_orderkey % 41 = 0 then 'n/a'
                    when o_orderkey % 47 = 0 then cast(-o_totalprice / 1000 as string)
                    else cast(o_totalprice / 1000 as string) end as predicted_demand,
               case when o_orderkey % 29 = 0 then null when o_orderkey % 13 = 0 then cast(o_totalprice as string)
                    else cast(o_totalprice / 1250 as string) end as lower_bound_95,
               case when o_orderkey % 31 = 0 then null when o_orderkey % 17 = 0 then '1.0'
                    else cast(o_totalprice / 800 as string) end as upper_bound_95,
               cast(o_custkey % 300 as string) as actual_demand,
               '1.5' as mae,
               cast(o_custkey % 90 as string) as mape,
               cast((o_custkey % 130) / 100.0 as string) as confidence_score,
               7 as horizon_days
        from {orders}""",
    "risk_raw": """
        select case when o_orderkey % 71 = 70 then o_orderkey - 1 else o_orderkey end as risk_id,
               case when o_orderkey % 61 = 0 then -1 when o_orderkey % 67 = 0 then null
                    else o_custkey % 100 end as supplier_id,
               concat(cast(cast(o_orderdate as date) as string), 'T00:00:00Z') as scored_at,
               'supplier_risk_v1' as model_name,
               '1.0.0' as model_version,
               case when o_orderkey % 37 = 0 then null when o_orderkey % 41 = 0 then 'n/a'
                    else cast((o_custkey % 120) / 100.0 - 0.1 as string) end as delay_probability,
               cast((o_custkey % 50) / 10.0 - 1.0 as string) as avg_delay_days_pred,
               case when o_orderkey % 11 = 0 then 'unknown' when o_orderkey % 11 = 1 then null
                    when o_custkey % 4 = 0 then 'low' when o_custkey % 4 = 1 then 'medium'
                    when o_custkey % 4 = 2 then 'high' else 'critical' end as risk_tier,
               cast(o_custkey % 130 - 10 as string) as composite_risk_score,
               cast((o_custkey % 70) / 10.0 - 0.5 as string) as hist_mean_delay_days,
               cast((o_custkey % 90) / 10.0 - 0.5 as string) as hist_delay_variance,
               cast((o_custkey % 125) / 100.0 as string) as hist_on_time_rate,
               60 as orders_evaluated,
               'none' as recommended_action,
               concat(cast(cast(o_orderdate as date) as string), 'T00:00:00Z') as created_at
        from {orders}""",
    # ---- clean tables ----
    "supplier_geo": f"""
        select s.*, n_name,
               case n_nationkey {_COUNTRY_CASE} end as country,
               case r_name when 'AMERICA' then 'Americas' when 'ASIA' then 'Asia' when 'EUROPE' then 'Europe'
                    when 'AFRICA' then 'Africa' else 'Middle East' end as region,
               ADD_DAYS(date '2012-03-01', s_suppkey * 37 % 4000) as onboarded_at
        from {{supplier}} s join {{nation}} on s_nationkey = n_nationkey join {{region}} on n_regionkey = r_regionkey""",
    "suppliers": """
        select s_suppkey as supplier_id, s_name as supplier_name, country, region,
               case when s_acctbal < 0 then 0.0 else s_acctbal / 1000 end as reliability_score,
               15 * (s_suppkey % 6 + 1) as payment_terms_days, onboarded_at
        from {supplier_geo}""",
    "products": """
        select p_partkey as product_id, p_type as category, p_brand as sub_category,
               (p_retailprice - 899) * 3 as unit_cost, (p_retailprice - 899) * 5 as unit_price,
               cast(p_size as bigint) as lead_time_days, cast(5 * p_size as bigint) as reorder_point,
               cast(15 * p_size as bigint) as reorder_quantity, p_size % 2 = 0 as is_active
        from {part}""",
    "brands": """
        select product_id,
               case product_id % 4 when 0 then 'Electronics' when 1 then 'Apparel'
                    when 2 then 'Food & Beverage' else 'Home & Garden' end as category,
               top * factor as unit_price, top * factor * 0.6 as unit_cost,
               2 + parts % 20 as lead_time_days, 20 + parts % 60 as reorder_point, 3 * (20 + parts % 60) as reorder_quantity
        from (select cast(substr(p_brand, 7) as bigint) as product_id, max(p_retailprice) - 899 as top,
                     count(*) as parts,
                     case cast(substr(p_brand, 7) as bigint) % 5 when 0 then 0.1 when 1 then 0.5 when 2 then 1.5
                          when 3 then 3.0 else 5.0 end as factor
              from {part} group by p_brand) x""",
    "sales": """
        select l_orderkey * 10 + l_linenumber as sale_id, cast(substr(p_brand, 7) as bigint) as product_id,
               cast(l_shipdate as date) as sale_date, cast(l_quantity as bigint) as quantity_sold,
               l_extendedprice / l_quantity as unit_price, l_discount * 100 as discount_pct,
               l_returnflag = 'R' as is_returned,
               case l_linestatus when 'F' then 'online' else 'retail' end as channel
        from {lineitem} join {part} on l_partkey = p_partkey""",
    "part_sales": """
        select l_orderkey * 10 + l_linenumber as sale_id, l_partkey as product_id, l_suppkey as supplier_id,
               cast(l_shipdate as date) as sale_date, cast(l_quantity as bigint) as quantity_sold,
               l_extendedprice / l_quantity as unit_price, l_discount * 100 as discount_pct,
               l_returnflag = 'R' as is_returned, l_returnflag, l_linestatus
        from {lineitem}""",
    "deliveries": """
        select l_suppkey as supplier_id,
               make_date(year(l_shipdate), month(l_shipdate), 1) as period,
               greatest(0.0, late / 7.0 - 1.7) as delay_days,
               10.0 + l_suppkey % 30 as max_delay
        from (select l_suppkey, l_shipdate,
                     cast((DAYS(cast(l_shipdate as date), cast(o_orderdate as date)) % 40 + 40) % 40 as double) as late
              from {lineitem} join {orders} on l_orderkey = o_orderkey) x""",
    "movements": """
        select cast(substr(p_brand, 7) as bigint) as product_id,
               concat('WH-00', cast(l_suppkey % 3 + 1 as string)) as warehouse_id,
               cast(l_shipdate as date) as snapshot_date,
               cast(sum(case when l_returnflag = 'N' then 2 * l_quantity else -l_quantity end) as bigint) as change
        from {lineitem} join {part} on l_partkey = p_partkey
        group by p_brand, l_suppkey % 3, cast(l_shipdate as date)""",
    "stock": """
        select product_id * 1000000 + cast(substr(warehouse_id, 6) as bigint) * 100000
                 + DAYS(snapshot_date, date '1990-01-01') as inventory_id,
               product_id, snapshot_date, warehouse_id,
               cast(balance as bigint) as quantity_on_hand, cast(balance % 7 as bigint) as quantity_reserved,
               balance < 30 as reorder_triggered, 5.0 + product_id * 0.5 as unit_cost_snapshot
        from (select *, s - least(0, min(s) over (partition by product_id, warehouse_id order by snapshot_date
                          rows between unbounded preceding and current row)) as balance
              from (select *, 100 + sum(change) over (partition by product_id, warehouse_id order by snapshot_date
                          rows between unbounded preceding and current row) as s
                    from {movements}) m) b""",
    "forecasts": """
        select product_id, sale_date as forecast_date, predicted_demand
        from (select product_id, sale_date,
                     lag(units, 7) over (partition by product_id order by sale_date) as predicted_demand
              from (select product_id, sale_date, cast(sum(quantity_sold) as double) as units
                    from {sales} group by product_id, sale_date) d) f
        where predicted_demand is not null""",
    "predictions": """
        select l_orderkey * 10 + l_linenumber as row_id,
               case when l_partkey % 17 = 0 then 0.0 else l_quantity end as actual,
               l_extendedprice / 2100 as predicted,
               case when l_returnflag = 'R' then 1 else 0 end as label,
               ((l_quantity * 7 + l_partkey + case when l_returnflag = 'R' then 13 else 0 end) % 101) / 100.0 as score,
               cast(l_suppkey % 4 as int) as tier,
               cast(case when l_orderkey % 3 = 0 then l_partkey % 3
                    when l_suppkey % 4 = 3 then 0 else l_suppkey % 4 end as int) as predicted_tier
        from {lineitem}""",
    "blackouts": """
        select p_partkey as product_id,
               ADD_DAYS(date '1995-02-01', p_partkey * 13 % 2000) as window_start,
               ADD_DAYS(date '1995-02-01', p_partkey * 13 % 2000 + 30 + p_size * 10) as window_end
        from {part}
        union all
        select p_partkey, ADD_DAYS(date '1998-01-01', p_partkey * 7 % 900), ADD_DAYS(date '1998-01-01', p_partkey * 7 % 900 + 90)
        from {part} where p_size % 3 = 0""",
}


def _args(text: str, at: int) -> tuple[list[str], int]:
    """Arguments of the call whose opening parenthesis is at ``at``, and the end position."""
    depth, start, out = 0, at + 1, []
    for i in range(at, len(text)):
        if text[i] == "(":
            depth += 1
        elif text[i] == ")":
            depth -= 1
            if depth == 0:
                return [*out, text[start:i].strip()], i + 1
        elif text[i] == "," and depth == 1:
            out.append(text[start:i].strip())
            start = i + 1
    raise ValueError("unbalanced call")


def _dialect(text: str, duck: bool) -> str:
    forms = {
        "ADD_DAYS": "({0} + cast({1} as integer))" if duck else "date_add({0}, cast({1} as int))",
        "DAYS": "date_diff('day', {1}, {0})" if duck else "datediff({0}, {1})",
    }
    for name, form in forms.items():
        while (m := re.search(rf"\b{name}\(", text)) is not None:
            args, end = _args(text, m.end() - 1)
            call = form
            for i, a in enumerate(args):
                call = call.replace(f"{{{i}}}", a)
            text = text[: m.start()] + call + text[end:]
    return _doubles(text)


def _doubles(text: str) -> str:
    """Write 0.5 as 0.5e0 outside quotes: a double in both dialects, never a decimal."""
    parts = text.split("'")
    parts[::2] = [re.sub(r"(?<![\w.])(\d+\.\d+)(?![\w.])", r"\1e0", p) for p in parts[::2]]
    return "'".join(parts)


def needs(text: str) -> list[str]:
    return list(dict.fromkeys(re.findall(r"\{(\w+)\}", text)))


class Tables:
    """Driver tables and views of one folder as DataFrames: ``t.lineitem``, ``t.sales``."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder
        self._made: dict[str, DataFrame] = {}

    def __getattr__(self, name: str) -> DataFrame:
        if name.startswith("_") or (name not in BASE and name not in VIEWS):
            raise AttributeError(name)
        if name not in self._made:
            if name in BASE:
                self._made[name] = self.spark.read.parquet(f"{self.folder}/{name}.parquet")
            else:
                text = _dialect(VIEWS[name], duck=False)
                self._made[name] = self.spark.sql(text, **{n: getattr(self, n) for n in needs(text)})
        return self._made[name]


def duck(body: str) -> str:
    """The DuckDB query of ``body``, with every ``{view}`` it needs as a CTE."""
    ctes: dict[str, str] = {}

    def add(text: str) -> None:
        for n in needs(text):
            if n in VIEWS and n not in ctes:
                add(VIEWS[n])
                ctes[n] = VIEWS[n]

    add(body)
    parts = [f"{n} as ({v})" for n, v in ctes.items()]
    body = body.strip()
    if body.lower().startswith("with "):
        parts.append(body[5:])
        text = "with " + ",\n".join(parts)
    else:
        text = ("with " + ",\n".join(parts) + "\n" if parts else "") + body
    return re.sub(r"\{(\w+)\}", r"\1", _dialect(text, duck=True))
