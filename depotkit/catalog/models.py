"""Model queries: presets and all folds over the whole feature table of the folder.

Fits of many rounds are not expressible in SQL; what SQL can state of them (a histogram's best split,
two rounds and their contributions) is held against it here, the rest by tests. A model that several
queries read is fitted once a session and folder.
"""

from __future__ import annotations

from pyspark import StorageLevel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from depotkit.catalog import series
from depotkit.catalog.registry import query
from depotkit.ml import boosting, importance as imp, score, train as tr
from depotkit.plans import features
from depotkit.session import shared_folder

_FITTED: dict[tuple, tr.Trained] = {}
_SCORES: dict[tuple, DataFrame] = {}


def _fitted(t, name: str, make) -> tr.Trained:
    """The model ``name`` of this session and folder; its matrix is released once it is fitted."""
    key = (t.spark.sparkContext.applicationId, t.folder, name)
    if key not in _FITTED:
        _FITTED[key] = make()
        _FITTED[key].extra["data"].unpersist()
    return _FITTED[key]


def _final(t, name: str, make) -> tr.Trained:
    """The final model, which is the same with and without the folds of its evaluation."""
    evaluated = (t.spark.sparkContext.applicationId, t.folder, name)
    return _FITTED[evaluated] if evaluated in _FITTED else _fitted(t, f"{name} alone", lambda: make(0))


def _fit_demand(t):
    return lambda folds: tr.train_demand(series.f_demand(t), n_splits=folds)


def _fit_stockout(t):
    return lambda folds: tr.train_stockout(series.f_stockout(t), n_splits=folds)


def _demand(t, evaluated: bool = False):
    return _fitted(t, "demand", lambda: _fit_demand(t)(5)) if evaluated else _final(t, "demand", _fit_demand(t))


def _stockout(t, evaluated: bool = False):
    return _fitted(t, "stockout", lambda: _fit_stockout(t)(5)) if evaluated else _final(t, "stockout", _fit_stockout(t))


def _supplier_risk(t):
    """The features of f_supplier_risk. The scores they are made from, a row a supplier and month, are kept: the
    longest series, the days of the split and the features each read them, and so does who scores them."""
    key = (t.spark.sparkContext.applicationId, t.folder)
    if key not in _SCORES:
        _SCORES[key] = series.risk_scores(t).persist(StorageLevel.MEMORY_AND_DISK)
    return features.supplier_risk_features(_SCORES[key], t.suppliers)


def _suppliers(t, *models: str) -> list[tr.Trained]:
    """The named supplier models; those that are not fitted yet grow together."""
    keys = {m: (t.spark.sparkContext.applicationId, t.folder, m) for m in models}
    if missing := [m for m in models if keys[m] not in _FITTED]:
        for name, trained in tr.train_suppliers(_supplier_risk(t), models=missing).items():
            _FITTED[keys[name]] = trained
            trained.extra["data"].unpersist()
    return [_FITTED[keys[m]] for m in models]


def _metrics(t, trained):
    rows = sorted(trained.metrics.items())
    return t.spark.createDataFrame([(trained.name, k, None if v is None else float(v)) for k, v in rows], "model string, metric string, value double")


def _probability():
    return vector_to_array(F.col("probability"))[1]


@query("m_train_demand")
def m_train_demand(t):
    return _metrics(t, _demand(t, evaluated=True))


@query("m_train_stockout")
def m_train_stockout(t):
    return _metrics(t, _stockout(t, evaluated=True))


@query("m_train_delay")
def m_train_delay(t):
    return _metrics(t, *_suppliers(t, "delay"))


@query("m_train_tier")
def m_train_tier(t):
    return _metrics(t, *_suppliers(t, "tier"))


@query("m_permutation")
def m_permutation(t):
    m = _demand(t)
    return imp.permutation_importance(
        m.model, m.test, m.features, ["product_id", "sale_date"], "label", imp.mae_loss("label"), swaps=imp.boosted_swaps(m.model))


@query("m_permutation_delay")
def m_permutation_delay(t):
    [m] = _suppliers(t, "delay")
    return imp.permutation_importance(
        m.model, m.test, m.features, ["supplier_id", "year_month", "risk_id"], "delay_probability", imp.mae_loss("delay_probability", 0, 1),
        swaps=imp.boosted_swaps(m.model))


@query("m_permutation_auc")
def m_permutation_auc(t):
    m = _stockout(t)
    swaps = imp.forest_swaps(imp.forest_nodes(m.model, shared_folder(t.spark)), m.features)
    return imp.permutation_importance(
        m.model, m.test, m.features, ["inventory_id"], "label", imp.auc_loss("label", lambda: F.col("score")), swaps=swaps)


@query("m_native_importance")
def m_native_importance(t):
    m = _stockout(t)
    return imp.native_importance(m.model, m.features)


@query("m_explain")
def m_explain(t):
    m = _stockout(t)
    nodes = imp.forest_nodes(m.model, shared_folder(t.spark))
    out = imp.explain(m.test, *imp.forest_contributions(nodes, m.features), m.features)
    return out.select("inventory_id", _probability().alias("probability"), "base_value", "explained", "top_features")


@query("m_explain_demand")
def m_explain_demand(t):
    m = _demand(t)
    out = imp.explain(m.test, *boosting.contributions(m.model), m.features)
    return out.select("product_id", "sale_date", "prediction", "base_value", "explained", "top_features")


@query("i_score_demand")
def i_score_demand(t):
    return score.score_demand(series.f_demand(t), _demand(t).model)


@query("i_score_stockout")
def i_score_stockout(t):
    m = _stockout(t)
    return score.score_stockout(series.f_stockout(t), m.model, m.features)


@query("i_score_supplier")
def i_score_supplier(t):
    delay, tier = _suppliers(t, "delay", "tier")
    return score.score_supplier(_supplier_risk(t), delay.model, tier.model)


@query("m_report")
def m_report(t):
    return tr.report([_demand(t, evaluated=True), _stockout(t, evaluated=True), *_suppliers(t, "delay", "tier")])


# Two rounds of stumps, which SQL can grow as well. Rows of sales are the training table: few distinct
# values a feature, so that bins are the values themselves, and some missing.
_STUMP = boosting.Spec(rounds=2, rate=0.3, depth=1, min_leaf=30, l2=0.05)
_STUMP_FEATURES = ["price_band", "discount", "month", "weekday"]
_STUMP_ROWS = """select sale_id, cast(quantity_sold as double) * unit_price / 100 as y,
    case when sale_id % 7 = 0 then null else cast(least(floor(unit_price / 25), 200) as double) end as price_band,
    case when sale_id % 5 = 0 or discount_pct > 8 then null else cast(round(discount_pct) as double) end as discount,
    cast(month(sale_date) as double) as month, cast(day(sale_date) % 7 as double) as weekday from {sales}"""


def _stump_sql(r: int) -> str:
    """Round ``r``: the best split of the residuals g<r>, and the residuals that are left."""
    return f"""
h{r} as (select f, v, sum(g) as g, count(*) as n from long join g{r} using (id) group by f, v),
t{r} as (select sum(g) as g, count(*) as n from g{r}),
z{r} as (select f, coalesce(sum(g) filter (where v is null), 0) as g, coalesce(sum(n) filter (where v is null), 0) as n from h{r} group by f),
u{r} as (select f, v, sum(g) over (partition by f order by v) as g, sum(n) over (partition by f order by v) as n,
    lead(v) over (partition by f order by v) as after from h{r} where v is not null),
c{r} as (select u.f, u.v, u.after, m.ml, z.n as missing, u.g + m.ml * z.g as gl, u.n + m.ml * z.n as nl, t.g as g, t.n as n
    from u{r} u join z{r} z using (f) cross join t{r} t cross join (values (0), (1)) m(ml) where m.ml = 0 or z.n > 0),
b{r} as (select *, gl * gl / (nl + 0.05) + (g - gl) * (g - gl) / (n - nl + 0.05) - g * g / (n + 0.05) as gain,
    -0.3 * gl / (nl + 0.05) as lv, -0.3 * (g - gl) / (n - nl + 0.05) as rv,
    case when missing > 0 then ml = 1 else nl > n - nl end as missing_left
    from c{r} where nl >= 30 and n - nl >= 30 order by gain desc, f, v, ml limit 1),
p{r} as (select id, b.f, case when coalesce(long.v <= b.v, b.missing_left) then b.lv else b.rv end as step,
    (b.lv * b.nl + b.rv * (b.n - b.nl)) / b.n as mean from long join b{r} b using (f)),
g{r + 1} as (select id, g{r}.g + p{r}.step as g from g{r} join p{r} using (id))"""


_STUMPS = f"""with m as (select row_number() over () as id, * from ({_STUMP_ROWS}) x),
long as (select id, unnest([0, 1, 2, 3]) as f, unnest([price_band, discount, month, weekday]) as v from m),
g1 as (select id, (select avg(y) from m) - y as g from m),{_stump_sql(1)},{_stump_sql(2)}"""


def _stumps(t):
    rows = t.spark.sql(_STUMP_ROWS, sales=t.sales)
    return rows, boosting.fit(rows, _STUMP_FEATURES, "y", ["sale_id"], _STUMP)


@query(
    "m_boost_nodes",
    "i:round i:node feature r:threshold missing_left r:value i:n",
    _STUMPS + """, out as (select * from (
      select r - 1 as round, 0 as node, ['price_band', 'discount', 'month', 'weekday'][f + 1] as feature, (v + after) / 2 as threshold,
        missing_left, (lv * nl + rv * (n - nl)) / n as value, n from (select 1 as r, * from b1 union all select 2, * from b2)
      union all select r - 1, 1, null, null, null, lv, nl from (select 1 as r, * from b1 union all select 2, * from b2)
      union all select r - 1, 2, null, null, null, rv, n - nl from (select 1 as r, * from b1 union all select 2, * from b2)))""",
)
def m_boost_nodes(t):
    return _stumps(t)[1].nodes(t.spark)


@query(
    "m_boost_contributions",
    "i:sale_id r:prediction r:base_value r:explained " + " ".join(f"r:c_{c}" for c in _STUMP_FEATURES),
    _STUMPS + """, out as (select sale_id, start + p1.step + p2.step as prediction, start + p1.mean + p2.mean as base_value,
      start + p1.step + p2.step as explained, """
    + ", ".join(f"case when p1.f = {i} then p1.step - p1.mean else 0 end + case when p2.f = {i} then p2.step - p2.mean else 0 end as {c}"
                for i, c in enumerate(f"c_{c}" for c in _STUMP_FEATURES))
    + """ from m join p1 using (id) join p2 using (id) cross join (select avg(y) as start from m) s)""",
)
def m_boost_contributions(t):
    rows, model = _stumps(t)
    base, parts = boosting.contributions(model)
    out = imp.explain(model.transform(rows), base, parts, _STUMP_FEATURES, len(_STUMP_FEATURES))
    of = lambda c: F.filter("top_features", lambda p: p["feature"] == c)[0]["contribution"]
    return out.select("sale_id", "prediction", "base_value", "explained", *[of(c).alias(f"c_{c}") for c in _STUMP_FEATURES])
