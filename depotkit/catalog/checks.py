"""Quality and cleaning queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from depotkit.catalog.registry import query
from depotkit.functions import scalar as fn
from depotkit.operators import cleaning as cl, quality as qa
from depotkit.schemas import CONTRACTS

RAW_VIEW = {
    "products": "products_raw",
    "suppliers": "suppliers_raw",
    "sales": "sales_raw",
    "inventory": "inventory_raw",
    "forecasts": "forecasts_raw",
    "risk_scores": "risk_raw",
}
KEYED = {t: (v, CONTRACTS[t].primary_key) for t, v in RAW_VIEW.items()}


def _union(parts):
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def _raw(t, table):
    return getattr(t, RAW_VIEW[table])


# ---- quality ----------------------------------------------------------------


@query(
    "q_pk_unique",
    "table_name i:surplus",
    " union all ".join(
        f"select '{t}' as table_name, coalesce(sum(n - 1), 0) as surplus from "
        f"(select count(*) as n from {{{v}}} group by {k})"
        for t, (v, k) in KEYED.items()
    ),
)
def q_pk_unique(t):
    return _union([qa.surplus_keys(_raw(t, x), k).withColumn("table_name", F.lit(x)) for x, (_, k) in KEYED.items()])


def _counts(t, prefix, group):
    parts = []
    for table, c in CONTRACTS.items():
        wide = qa.scalar_counts(_raw(t, table), c)
        names = [x for x in wide.columns if x.startswith(prefix)]
        if names:
            parts.append(
                wide.unpivot(["n"], names, "column_name", group)
                .withColumns({"table_name": F.lit(table), "column_name": F.expr(f"substr(column_name, {len(prefix) + 1})")})
            )
    return _union(parts)


@query(
    "q_not_null",
    "table_name column_name i:nulls r4:pct",
    " union all ".join(
        f"select '{t}' as table_name, '{c}' as column_name, count(*) filter (where {c} is null) as nulls, "
        f"count(*) filter (where {c} is null) * 100.0 / count(*) as pct from {{{RAW_VIEW[t]}}}"
        for t, k in CONTRACTS.items()
        for c in k.not_null
    ),
)
def q_not_null(t):
    return _counts(t, "null_", "nulls").withColumn("pct", F.col("nulls") / F.col("n") * 100)


@query(
    "q_range",
    "table_name column_name i:outside",
    " union all ".join(
        f"select '{t}' as table_name, '{c}' as column_name, "
        f"count(*) filter (where try_cast({c} as double) < {lo} or try_cast({c} as double) > {hi}) as outside "
        f"from {{{RAW_VIEW[t]}}}"
        for t, k in CONTRACTS.items()
        for c, (lo, hi) in k.ranges.items()
    ),
)
def q_range(t):
    return _counts(t, "range_", "outside")


@query(
    "q_non_negative",
    "table_name column_name i:negatives",
    " union all ".join(
        f"select '{t}' as table_name, '{c}' as column_name, "
        f"count(*) filter (where try_cast({c} as double) < 0) as negatives from {{{RAW_VIEW[t]}}}"
        for t, k in CONTRACTS.items()
        for c in k.non_negative
    ),
)
def q_non_negative(t):
    return _counts(t, "neg_", "negatives")


_ORPHANS = {
    table: (fk, ref, f"""(select count(*) from {{{RAW_VIEW[table]}}} a where not exists (
        select 1 from {{{RAW_VIEW[ref]}}} b where b.{CONTRACTS[ref].primary_key} is not distinct from a.{fk}))""")
    for table, c in CONTRACTS.items()
    for fk, ref in c.foreign_keys.items()
}


@query(
    "q_fk_orphans",
    "table_name column_name i:orphans",
    " union all ".join(
        f"select '{t}' as table_name, '{fk}' as column_name, {s} as orphans" for t, (fk, _, s) in _ORPHANS.items()
    ),
)
def q_fk_orphans(t):
    return _union(
        [
            qa.orphan_rows(_raw(t, x), fk, _raw(t, ref), CONTRACTS[ref].primary_key).withColumns(
                {"table_name": F.lit(x), "column_name": F.lit(fk)}
            )
            for x, (fk, ref, _) in _ORPHANS.items()
        ]
    )


@query(
    "q_row_count",
    "table_name i:n status",
    " union all ".join(
        f"select '{t}' as table_name, count(*) as n, case when count(*) = 0 then 'FAIL' else 'PASS' end as status "
        f"from {{{v}}}"
        for t, v in RAW_VIEW.items()
    ),
)
def q_row_count(t):
    return _union(
        [
            _raw(t, x).agg(F.count("*").alias("n")).select(
                F.lit(x).alias("table_name"), "n", F.when(F.col("n") == 0, "FAIL").otherwise("PASS").alias("status")
            )
            for x in RAW_VIEW
        ]
    )


@query(
    "q_required_columns",
    "table_name column_name i:filled",
    " union all ".join(
        f"select '{t}' as table_name, '{c}' as column_name, count({c}) as filled from {{{RAW_VIEW[t]}}}"
        for t, k in CONTRACTS.items()
        for c in k.required
    ),
)
def q_required_columns(t):
    """How many rows fill each required column; a missing column raises."""
    parts = []
    for table, c in CONTRACTS.items():
        df = _raw(t, table)
        if qa.missing_columns(df, c.required):
            raise ValueError(f"{table}: {qa.missing_columns(df, c.required)}")
        counts = df.agg(*[F.count(x).alias(x) for x in c.required])
        parts.append(
            counts.unpivot([], counts.columns, "column_name", "filled").withColumn("table_name", F.lit(table))
        )
    return _union(parts)


def _audit_sql(table: str) -> str:
    c, v = CONTRACTS[table], RAW_VIEW[table]
    pk = c.primary_key
    rows = []

    def add(check, status, n_out, detail):
        seq = len(rows)
        rows.append(
            f"select {seq} as seq, '{table}' as \"table\", 'validate' as stage, '{check}' as \"check\", "
            f"{status} as status, n as rows_in, {n_out} as rows_out, {detail} as detail from f"
        )

    def warn(x):
        return f"case when {x} > 0 then 'WARN' else 'PASS' end"

    facts = [
        "count(*) as n",
        f"(select coalesce(sum(k - 1), 0)::bigint from (select count(*) as k from {{{v}}} group by {pk})) as dup",
    ]
    add("required_cols", "'PASS'", "n", "'All required columns present'")
    add("pk_unique", warn("dup"), "n", f"format('{{:,}}', dup) || ' duplicate PKs in ''{pk}'''")
    for x in c.not_null:
        facts.append(f"count(*) filter (where {x} is null) as null_{x}")
        pct = f"(null_{x} * 100.0 / n)"
        add(
            f"not_null:{x}",
            f"case when {pct} > 10 then 'FAIL' when null_{x} > 0 then 'WARN' else 'PASS' end",
            "0",
            f"format('{{:,}}', null_{x}) || ' nulls (' || printf('%.1f', round_even({pct}, 1)) || '%)'",
        )
    for x, (lo, hi) in c.ranges.items():
        facts.append(
            f"count(*) filter (where try_cast({x} as double) < {lo} or try_cast({x} as double) > {hi}) as range_{x}"
        )
        add(f"range:{x}", warn(f"range_{x}"), "0", f"format('{{:,}}', range_{x}) || ' values outside [{lo},{hi}]'")
    for x in c.non_negative:
        facts.append(f"count(*) filter (where try_cast({x} as double) < 0) as neg_{x}")
        add(f"non_neg:{x}", warn(f"neg_{x}"), "0", f"format('{{:,}}', neg_{x}) || ' negative values'")
    for x in c.foreign_keys:
        facts.append(f"{_ORPHANS[table][2]} as fk_{x}")
        add(f"fk:{x}", warn(f"fk_{x}"), "0", f"format('{{:,}}', fk_{x}) || ' orphaned FK values'")
    add("row_count", "case when n = 0 then 'FAIL' else 'PASS' end", "n", "format('{:,}', n) || ' rows'")
    return f"with f as (select {', '.join(facts)} from {{{v}}}) " + " union all ".join(rows)


_AUDIT = " union all ".join(f"select * from ({_audit_sql(t)})" for t in CONTRACTS)


def _audit(t):
    raw = {x: _raw(t, x) for x in CONTRACTS}
    return qa.validate_all(raw, raw)


@query("q_audit_table", "table stage check status i:rows_in i:rows_out detail", _AUDIT)
def q_audit_table(t):
    return _audit(t)


@query("q_audit_summary", "status i:entries", f"select status, count(*) as entries from ({_AUDIT}) group by status")
def q_audit_summary(t):
    return qa.audit_summary(_audit(t))


# ---- cleaning: single operators ---------------------------------------------


@query(
    "c_coerce_numeric",
    "i:sale_id r:quantity e4:price r:discount",
    """select sale_id, try_cast(quantity_sold as double) as quantity, try_cast(unit_price as double) as price,
              try_cast(discount_pct as double) as discount from {sales_raw}""",
)
def c_coerce_numeric(t):
    return t.sales_raw.select(
        "sale_id",
        fn.number("quantity_sold").alias("quantity"),
        fn.number("unit_price").alias("price"),
        fn.number("discount_pct").alias("discount"),
    )


@query("c_coerce_date", "i:sale_id d:sold_on", "select sale_id, try_cast(sale_date as date) as sold_on from {sales_raw}")
def c_coerce_date(t):
    return t.sales_raw.select("sale_id", fn.day("sale_date").alias("sold_on"))


@query(
    "c_bool_token",
    "i:sale_id returned",
    "select sale_id, coalesce(lower(is_returned) in ('true', '1', 'yes'), false) as returned from {sales_raw}",
)
def c_bool_token(t):
    return t.sales_raw.select("sale_id", fn.truth_token("is_returned").alias("returned"))


@query(
    "c_bool_default",
    "sku active",
    "select sku, case when is_active is null then true else lower(is_active) = 'true' end as active from {products_raw}",
)
def c_bool_default(t):
    return t.products_raw.select("sku", fn.truth_or_true("is_active").alias("active"))


_TYPED_SALES = """select sale_id, product_id, try_cast(sale_date as date) as sold_on,
    try_cast(quantity_sold as double) as quantity, try_cast(unit_price as double) as price from {sales_raw}"""


def _typed_sales(t):
    return t.sales_raw.select(
        "sale_id",
        "product_id",
        fn.day("sale_date").alias("sold_on"),
        fn.number("quantity_sold").alias("quantity"),
        fn.number("unit_price").alias("price"),
    )


_DEDUP_COLUMNS = "i:sale_id r0:product_id d:sold_on r:quantity e4:price"
_ORDER = "product_id, sold_on, quantity, price"


@query(
    "c_dedup_first",
    _DEDUP_COLUMNS,
    f"""select * from (select *, row_number() over (partition by sale_id order by
        {", ".join(c.strip() + " asc nulls first" for c in _ORDER.split(","))}) as rn from ({_TYPED_SALES})) where rn = 1""",
)
def c_dedup_first(t):
    return cl.keep_one(_typed_sales(t), ["sale_id"])


@query(
    "c_dedup_first_few",
    _DEDUP_COLUMNS,
    f"""select * from (select *, row_number() over (partition by sale_id order by
        {", ".join(c.strip() + " asc nulls first" for c in _ORDER.split(","))}) as rn from ({_TYPED_SALES})) where rn = 1""",
)
def c_dedup_first_few(t):
    """The path of wide tables: lone keys stream past a filter of repeated ones."""
    return cl.keep_one(_typed_sales(t), ["sale_id"], few_copies=True)


@query(
    "c_dedup_last",
    "r0:product_id d:sold_on i:sale_id r:quantity e4:price",
    f"""select * from (select *, row_number() over (partition by product_id, sold_on order by
        {", ".join(c.strip() + " desc nulls last" for c in "sale_id, quantity, price".split(","))}) as rn
        from ({_TYPED_SALES})) where rn = 1""",
)
def c_dedup_last(t):
    return cl.keep_one(_typed_sales(t), ["product_id", "sold_on"], ["sale_id"], last=True)


@query(
    "c_drop_null",
    _DEDUP_COLUMNS,
    f"select * from ({_TYPED_SALES}) where sold_on is not null and product_id is not null and quantity is not null",
)
def c_drop_null(t):
    return _typed_sales(t).dropna(subset=["sold_on", "product_id", "quantity"])


@query("c_row_predicate", _DEDUP_COLUMNS, f"select * from ({_TYPED_SALES}) where quantity > 0")
def c_row_predicate(t):
    return _typed_sales(t).filter("quantity > 0")


@query(
    "c_impute_const",
    "sku r:lead_time_days r:reorder_point r:reorder_quantity",
    """select sku, coalesce(try_cast(lead_time_days as double), 7) as lead_time_days,
              coalesce(try_cast(reorder_point as double), 50) as reorder_point,
              coalesce(try_cast(reorder_quantity as double), 100) as reorder_quantity from {products_raw}""",
)
def c_impute_const(t):
    defaults = {"lead_time_days": 7.0, "reorder_point": 50.0, "reorder_quantity": 100.0}
    return t.products_raw.select("sku", *[fn.number(c).alias(c) for c in defaults]).fillna(defaults)


_MEDIANS = """
  typed as (select sku, category, try_cast(unit_cost as double) as unit_cost,
                   try_cast(unit_price as double) as unit_price from {products_raw}),
  meds as (select category, median(unit_cost) as mc, median(unit_price) as mp from typed
           where category is not null group by category),
  g as (select sku, t.category, coalesce(unit_cost, mc) as unit_cost, coalesce(unit_price, mp) as unit_price
        from typed t left join meds m on t.category = m.category)"""


@query(
    "c_impute_group_median",
    "sku category r:unit_cost e4:unit_price",
    f"""with {_MEDIANS}, out as (select sku, category,
          coalesce(unit_cost, (select median(unit_cost) from g)) as unit_cost,
          coalesce(unit_price, (select median(unit_price) from g)) as unit_price from g)""",
)
def c_impute_group_median(t):
    typed = t.products_raw.select(
        "sku", "category", fn.number("unit_cost").alias("unit_cost"), fn.number("unit_price").alias("unit_price")
    )
    return cl.group_median_impute(typed, ["unit_cost", "unit_price"], "category")


_CAP = """greatest({c}_1 - 3 * ({c}_3 - {c}_1), least({c}_3 + 3 * ({c}_3 - {c}_1), {c}))"""


def _cap(c: str) -> str:
    return f"case when {c} is null then null else " + _CAP.replace("{c}", c) + " end"


def _quartiles(source: str, *columns: str) -> str:
    return "select " + ", ".join(
        f"quantile_cont({c}, 0.25) as {c}_1, quantile_cont({c}, 0.75) as {c}_3" for c in columns
    ) + f" from {source}"


@query(
    "c_iqr_cap",
    _DEDUP_COLUMNS,
    f"""with typed as ({_TYPED_SALES}), q as ({_quartiles('typed', 'quantity', 'price')}),
        out as (select sale_id, product_id, sold_on, {_cap('quantity')} as quantity, {_cap('price')} as price
                from typed, q)""",
)
def c_iqr_cap(t):
    return cl.iqr_cap(_typed_sales(t), cl.iqr_bounds(_typed_sales(t), ["quantity", "price"]))


@query(
    "c_clip",
    "i:sale_id r:discount r:quantity",
    """select sale_id,
         case when try_cast(discount_pct as double) is null then null
              else greatest(0, least(100, try_cast(discount_pct as double))) end as discount,
         case when try_cast(quantity_sold as double) is null then null
              else greatest(0, try_cast(quantity_sold as double)) end as quantity from {sales_raw}""",
)
def c_clip(t):
    return t.sales_raw.select(
        "sale_id",
        fn.clip(fn.number("discount_pct"), 0, 100).alias("discount"),
        fn.clip(fn.number("quantity_sold"), lo=0).alias("quantity"),
    )


@query(
    "c_row_min_max",
    "i:forecast_id e:low e:high",
    """select forecast_id, least(try_cast(lower_bound_95 as double), try_cast(predicted_demand as double)) as low,
              greatest(try_cast(upper_bound_95 as double), try_cast(predicted_demand as double)) as high
       from {forecasts_raw}""",
)
def c_row_min_max(t):
    p = fn.number("predicted_demand")
    return t.forecasts_raw.select(
        "forecast_id",
        F.least(fn.number("lower_bound_95"), p).alias("low"),
        F.greatest(fn.number("upper_bound_95"), p).alias("high"),
    )


@query(
    "c_round_half_even",
    "i:inventory_id r0:units r2:cost",
    """select inventory_id, round_even(try_cast(quantity_on_hand as double), 0) as units,
              round_even(try_cast(unit_cost_snapshot as double) * 100, 0) / 100 as cost from {inventory_raw}""",
)
def c_round_half_even(t):
    return t.inventory_raw.select(
        "inventory_id",
        fn.whole(fn.number("quantity_on_hand")).alias("units"),
        fn.round_even(fn.number("unit_cost_snapshot"), 2).alias("cost"),
    )


@query("c_normalise_text", "i:sale_id channel", "select sale_id, lower(trim(channel)) as channel from {sales_raw}")
def c_normalise_text(t):
    return t.sales_raw.select("sale_id", fn.normalised_text("channel").alias("channel"))


_CHANNEL = """case lower(trim(channel)) when 'e-commerce' then 'online' when 'web' then 'online'
    when 'store' then 'retail' when 'b2b' then 'wholesale' else lower(trim(channel)) end"""


@query("c_remap", "i:sale_id channel", f"select sale_id, {_CHANNEL} as channel from {{sales_raw}}")
def c_remap(t):
    return t.sales_raw.select(
        "sale_id", fn.remapped(fn.normalised_text("channel"), fn.CHANNEL_ALIASES).alias("channel")
    )


_TIER = "case when risk_tier in ('low', 'medium', 'high', 'critical') then risk_tier else 'medium' end"


@query("c_whitelist", "i:risk_id r0:supplier_id risk_tier", f"select risk_id, supplier_id, {_TIER} as risk_tier from {{risk_raw}}")
def c_whitelist(t):
    return t.risk_raw.select(
        "risk_id", "supplier_id", fn.whitelisted("risk_tier", fn.RISK_TIERS, "medium").alias("risk_tier")
    )


# ---- cleaning: whole tables --------------------------------------------------


@query(
    "c_clean_products",
    "i:product_id sku product_name category sub_category r:unit_cost e4:unit_price r:lead_time_days "
    "r:reorder_point r:reorder_quantity is_active d:created_at d:updated_at",
    """with first as (select * from (select *, row_number() over (partition by product_id order by sku) as rn
                     from {products_raw}) where rn = 1),
       typed as (select * replace (try_cast(unit_cost as double) as unit_cost,
                     try_cast(unit_price as double) as unit_price) from first),
       meds as (select category, median(unit_cost) as mc, median(unit_price) as mp from typed
                where category is not null group by category),
       g as (select t.* replace (coalesce(unit_cost, mc) as unit_cost, coalesce(unit_price, mp) as unit_price)
             from typed t left join meds m on t.category = m.category),
       out as (select * replace (
            greatest(0, coalesce(unit_cost, (select median(unit_cost) from g))) as unit_cost,
            greatest(0, coalesce(unit_price, (select median(unit_price) from g))) as unit_price,
            greatest(0, coalesce(try_cast(lead_time_days as double), 7)) as lead_time_days,
            greatest(0, coalesce(try_cast(reorder_point as double), 50)) as reorder_point,
            greatest(1, coalesce(try_cast(reorder_quantity as double), 100)) as reorder_quantity,
            case when is_active is null then true else lower(is_active) = 'true' end as is_active,
            try_cast(created_at as date) as created_at, try_cast(updated_at as date) as updated_at) from g)""",
)
def c_clean_products(t):
    return cl.clean_products(t.products_raw, ["sku"])


@query(
    "c_clean_suppliers",
    "i:supplier_id supplier_name contact_email country region r:reliability_score r:payment_terms_days is_active "
    "d:onboarded_at d:created_at d:updated_at",
    """select * replace (
            greatest(0, least(10, coalesce(try_cast(reliability_score as double), 5))) as reliability_score,
            greatest(0, coalesce(try_cast(payment_terms_days as double), 30)) as payment_terms_days,
            case when is_active is null then true else lower(is_active) = 'true' end as is_active,
            try_cast(onboarded_at as date) as onboarded_at, try_cast(created_at as date) as created_at,
            try_cast(updated_at as date) as updated_at)
       from (select *, row_number() over (partition by supplier_id order by supplier_name) as rn
             from {suppliers_raw}) where rn = 1""",
)
def c_clean_suppliers(t):
    return cl.clean_suppliers(t.suppliers_raw, ["supplier_name"])


@query(
    "c_clean_sales",
    "i:sale_id i:product_id d:sale_date i:quantity_sold e4:unit_price channel region r:discount_pct is_returned created_at",
    f"""with typed as (select sale_id, product_id, try_cast(sale_date as date) as sale_date,
              try_cast(quantity_sold as double) as quantity, try_cast(unit_price as double) as price,
              channel as raw_channel, {_CHANNEL} as channel, region,
              coalesce(try_cast(discount_pct as double), 0) as discount_pct,
              coalesce(lower(is_returned) in ('true', '1', 'yes'), false) as is_returned, created_at
            from {{sales_raw}}),
        kept as (select * from typed where sale_date is not null and product_id is not null and quantity > 0),
        q as ({_quartiles('kept', 'quantity', 'price')}),
        one as (select * from (select *, row_number() over (partition by sale_id order by
              product_id, sale_date, quantity, price asc nulls first, raw_channel asc nulls first, region,
              discount_pct, is_returned, created_at) as rn from kept) where rn = 1),
        out as (select sale_id, product_id, sale_date,
              round_even(greatest(1, {_cap('quantity')}), 0) as quantity_sold,
              case when price is null then null else greatest(0, {_cap('price')}) end as unit_price,
              channel, region, greatest(0, least(100, discount_pct)) as discount_pct, is_returned, created_at
              from one, q)""",
)
def c_clean_sales(t):
    return cl.clean_sales(t.sales_raw)


@query(
    "c_clean_inventory",
    "i:inventory_id i:product_id d:snapshot_date warehouse_id i:quantity_on_hand i:quantity_reserved "
    "reorder_triggered e:unit_cost_snapshot created_at",
    f"""with typed as (select inventory_id, product_id, try_cast(snapshot_date as date) as snapshot_date, warehouse_id,
              try_cast(quantity_on_hand as double) as on_hand,
              coalesce(try_cast(quantity_reserved as double), 0) as reserved,
              coalesce(lower(reorder_triggered) in ('true', '1', 'yes'), false) as reorder_triggered,
              try_cast(unit_cost_snapshot as double) as cost, created_at from {{inventory_raw}}),
        kept as (select * from typed where snapshot_date is not null and product_id is not null and on_hand is not null),
        q as ({_quartiles('kept', 'cost')}),
        one as (select * from (select *, row_number() over (partition by product_id, warehouse_id, snapshot_date
              order by inventory_id desc, on_hand desc, reserved desc, reorder_triggered desc, cost desc nulls last)
              as rn from kept) where rn = 1),
        out as (select inventory_id, product_id, snapshot_date, warehouse_id,
              round_even(greatest(0, on_hand), 0) as quantity_on_hand,
              least(round_even(greatest(0, on_hand), 0), round_even(greatest(0, reserved), 0)) as quantity_reserved,
              reorder_triggered, {_cap('cost')} as unit_cost_snapshot, created_at from one, q)""",
)
def c_clean_inventory(t):
    return cl.clean_inventory(t.inventory_raw)


@query(
    "c_clean_forecasts",
    "i:forecast_id i:product_id d:forecast_date d:generated_at r:predicted_demand r:lower_bound_95 e:upper_bound_95 "
    "r:actual_demand r:mae r:mape r:confidence_score model_name model_version i:horizon_days",
    """with typed as (select forecast_id, product_id, model_name, model_version, horizon_days, try_cast(forecast_date as date) as forecast_date,
             try_cast(generated_at as date) as generated_at,
             greatest(0, try_cast(predicted_demand as double)) as p, try_cast(predicted_demand as double) as raw_p,
             try_cast(lower_bound_95 as double) as lo, try_cast(upper_bound_95 as double) as hi,
             try_cast(actual_demand as double) as actual_demand, try_cast(mae as double) as mae,
             try_cast(mape as double) as mape,
             greatest(0, least(1, try_cast(confidence_score as double))) as confidence_score from {forecasts_raw}),
       kept as (select forecast_id, product_id, model_name, model_version, horizon_days, forecast_date, generated_at, p as predicted_demand,
             least(lo, p) as lower_bound_95, greatest(hi, p) as upper_bound_95, actual_demand, mae, mape,
             confidence_score from typed
             where forecast_date is not null and product_id is not null and raw_p is not null),
       out as (select * from (select *, row_number() over (partition by forecast_id order by product_id,
             forecast_date, generated_at, predicted_demand, lower_bound_95, upper_bound_95) as rn from kept) where rn = 1)""",
)
def c_clean_forecasts(t):
    return cl.clean_forecasts(t.forecasts_raw)


def _between(c: str, hi: int | None) -> str:
    top = f"least({hi}, try_cast({c} as double))" if hi is not None else f"try_cast({c} as double)"
    return f"case when try_cast({c} as double) is null then null else greatest(0, {top}) end as {c}"


@query(
    "c_clean_risk",
    "i:risk_id i:supplier_id d:scored_on r:delay_probability r:avg_delay_days_pred risk_tier r:composite_risk_score "
    "r:hist_mean_delay_days r:hist_delay_variance r:hist_on_time_rate i:orders_evaluated "
    "model_name model_version recommended_action created_at",
    f"""with typed as (select risk_id, supplier_id, model_name, model_version, recommended_action, created_at, cast(substr(scored_at, 1, 10) as date) as scored_on,
             {_between('delay_probability', 1)}, {_between('avg_delay_days_pred', None)}, {_TIER} as risk_tier,
             {_between('composite_risk_score', 100)}, {_between('hist_mean_delay_days', None)},
             {_between('hist_delay_variance', None)}, {_between('hist_on_time_rate', 1)}, orders_evaluated from {{risk_raw}}),
        out as (select * from (select *, row_number() over (partition by risk_id order by
             supplier_id asc nulls first, scored_on, delay_probability asc nulls first, avg_delay_days_pred) as rn
             from typed) where rn = 1 and supplier_id is not null and delay_probability is not null)""",
)
def c_clean_risk(t):
    order = ["supplier_id", "scored_at", "delay_probability", "avg_delay_days_pred"]
    return cl.clean_risk_scores(t.risk_raw, order).withColumn("scored_on", F.col("scored_at").cast("date"))


@query(
    "c_text_ids",
    "sale_id i:product_id",
    """select case when sale_id % 3 = 0 then concat('S-', cast(sale_id as varchar))
              else cast(sale_id + 9007199254740992 as varchar) end as sale_id, min(product_id) as product_id
       from {sales_raw}
       where try_cast(sale_date as date) is not null and product_id is not null and try_cast(quantity_sold as double) > 0
       group by sale_id""",
)
def c_text_ids(t):
    """Ids that are not all numbers stay text, and those beyond 2^53 stay apart."""
    beyond = (F.col("sale_id") + F.lit(9007199254740992)).cast("string")
    named = F.when(F.col("sale_id") % 3 == 0, F.concat(F.lit("S-"), F.col("sale_id").cast("string"))).otherwise(beyond)
    return cl.clean_all({"sales": t.sales_raw.withColumn("sale_id", named)})["sales"]
