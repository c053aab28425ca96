"""Reusable cleaning operators and the per-table cleaning plans."""

from __future__ import annotations

from collections.abc import Callable, Collection, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from depotkit.functions import scalar as fn
from depotkit.operators.ordering import global_quantiles, group_quantiles


#: Words of 64 bits in the filter of repeated keys: 16 MB of numbers at most, whatever the table.
FILTER_WORDS = 2**20


def _split_repeated(df: DataFrame, keys: Sequence[str], words: int) -> tuple[DataFrame, DataFrame]:
    """(rows whose key stands alone, rows whose key may be repeated).

    A pass over the key columns counts their 64-bit hashes; each repeated hash sets a bit of a
    filter of ``words`` words, whose size does not grow with the table. Rows that meet an unset bit
    have a key of their own. Hashes that collide, or share a bit, only add rows to the second part.
    """
    own = F.xxhash64(*[F.col(f"`{k}`") for k in keys])
    word = lambda h: F.pmod(h, F.lit(words))
    bit = lambda h: F.shiftrightunsigned(h, 58).cast("int")
    seen = df.select(own.alias("_h")).groupBy("_h").agg(F.count("*").alias("_n")).filter("_n > 1")
    one = F.call_function("shiftleft", F.lit(1).cast("long"), bit(F.col("_h")))
    marks = seen.groupBy(word(F.col("_h")).alias("_word")).agg(F.bit_or(one).alias("_bits"))
    rows = df.withColumn("_h", own).withColumn("_word", word(F.col("_h")))
    rows = rows.join(F.broadcast(marks), "_word", "left")
    again = F.call_function("shiftright", F.col("_bits"), bit(F.col("_h"))).bitwiseAND(F.lit(1)) == 1
    again = F.coalesce(again, F.lit(False))
    plain = [F.col(f"`{c}`") for c in df.columns]
    return rows.filter(~again).select(plain), rows.filter(again).select(plain)


def keep_one(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str | Column] = (),
    last: bool = False,
    few_copies: bool = False,
    words: int = FILTER_WORDS,
) -> DataFrame:
    """One row per key: the first (or last) in ``order``, then in all remaining columns.

    Written as an aggregate over a struct, so copies of a hot key are folded on the map
    side instead of being sorted in one window task. NULL keys form one group, and NULLs
    order before values. A map orders as its sorted entries.

    Rows are sorted into groups, and a sort sees 64 bits of its first key before it has to fetch and
    compare rows: texts that begin alike, or a first key of few values, cost such a comparison each time.
    So the hash of the keys leads, except where one key of fixed width says it all.

    ``few_copies`` is for wide tables whose keys rarely repeat: only rows of a key that may be
    repeated are sorted and shuffled, the others stream through. It gives the same rows, but reads
    the table three times, once for its keys alone, so its rows must not change between reads.
    """
    rest = [c for c in df.columns if c not in keys]
    maps = {c for c, t in df.dtypes if t.startswith("map<")}
    lead = [fn.col(o).alias(f"_o{i}") for i, o in enumerate(order)]
    held = [F.array_sort(F.map_entries(f"`{c}`")).alias(c) if c in maps else F.col(f"`{c}`") for c in rest]
    pick = (F.max if last else F.min)(F.struct(*lead, *held)).alias("_row")
    back = {c: F.map_from_entries(f"_row.`{c}`") if c in maps else F.col(f"_row.`{c}`") for c in rest}

    types = dict(df.dtypes)
    alone = len(keys) == 1 and types[keys[0]] in (*fn.WHOLE_TYPES, "date", "timestamp")
    lead_key = [] if alone else [F.xxhash64(*[F.col(f"`{k}`") for k in keys]).alias("_h")]

    def folded(rows: DataFrame) -> DataFrame:
        kept = rows.groupBy(*lead_key, *keys).agg(pick)
        return kept.select(*[back.get(c, F.col(f"`{c}`")).alias(c) for c in df.columns])

    if not few_copies:
        return folded(df)
    single, repeated = _split_repeated(df, keys, words)
    return single.unionAll(folded(repeated))


def group_median_impute(df: DataFrame, columns: Sequence[str], group: str) -> DataFrame:
    """Fill NULLs with the group median, then with the global median of the filled column."""
    per_group = group_quantiles(df, columns, [0.5], by=[group])
    filled = df.join(per_group, group, "left").select(
        *[
            (F.coalesce(F.col(c), F.col(f"{c}_q0")) if c in columns else F.col(c)).alias(c)
            for c in df.columns
        ]
    )
    overall = global_quantiles(filled, columns, [0.5])
    return filled.fillna({c: q[0] for c, q in overall.items() if q[0] is not None})


def iqr_bounds(df: DataFrame, columns: Sequence[str], factor: float = 3.0) -> dict[str, tuple]:
    """Per column the pair (q1 - factor * iqr, q3 + factor * iqr); (None, None) without values."""
    out: dict[str, tuple] = {}
    for c, (q1, q3) in global_quantiles(df, columns, [0.25, 0.75]).items():
        out[c] = (None, None) if q1 is None else (q1 - factor * (q3 - q1), q3 + factor * (q3 - q1))
    return out


def iqr_cap(df: DataFrame, bounds: dict[str, tuple]) -> DataFrame:
    """Clip to the bounds of :func:`iqr_bounds`, which may come from another set of rows."""
    return df.withColumns({c: fn.clip(F.col(c).cast("double"), *b) for c, b in bounds.items()})


def _parsed(df: DataFrame, parse: Callable[[str], Column], columns: Sequence[str]) -> DataFrame:
    present = [c for c in columns if c in df.columns]
    return df.withColumns({c: parse(c) for c in present}) if present else df


#: Id columns of each table. Names are shared between tables that refer to each other.
IDS = {
    "products": ("product_id",),
    "suppliers": ("supplier_id",),
    "sales": ("sale_id", "product_id"),
    "inventory": ("inventory_id", "product_id"),
    "forecasts": ("forecast_id", "product_id"),
    "risk_scores": ("risk_id", "supplier_id"),
}


def text_ids(tables: Mapping[str, DataFrame]) -> set[str]:
    """Id columns that hold anything but whole numbers in any of the tables: these must stay text
    in all of them, as distinct ids would fold into one NULL. One aggregate per table, over the columns
    whose type does not say so already."""
    found: set[str] = set()
    for name, df in tables.items():
        columns = [c for c in IDS.get(name, ()) if dict(df.dtypes).get(c, "bigint") not in fn.WHOLE_TYPES]
        if columns:
            odd = lambda c: F.nullif(F.trim(F.col(c).cast("string")), F.lit("")).isNotNull() & fn.whole_number(c).isNull()
            counts = df.agg(*[F.count_if(odd(c)).alias(c) for c in columns]).first()
            found |= {c for c in columns if counts[c]}
    return found


def _ids(df: DataFrame, table: str, as_text: Collection[str]) -> DataFrame:
    present = [c for c in IDS[table] if c in df.columns]
    return df.withColumns({c: (fn.text_id if c in as_text else fn.integer)(c) for c in present}) if present else df


def clean_products(df: DataFrame, order: Sequence[str | Column] = (), as_text: Collection[str] = ()) -> DataFrame:
    d = _ids(keep_one(df, ["product_id"], order), "products", as_text)
    d = _parsed(
        d, fn.number, ("unit_cost", "unit_price", "lead_time_days", "reorder_point", "reorder_quantity")
    )
    d = group_median_impute(d, ["unit_cost", "unit_price"], "category")
    defaults = {"lead_time_days": (7, 0), "reorder_point": (50, 0), "reorder_quantity": (100, 1)}
    d = d.withColumns(
        {
            **{c: fn.clip(c, lo=0) for c in ("unit_cost", "unit_price")},
            **{c: fn.clip(F.coalesce(F.col(c), F.lit(float(v))), lo=lo) for c, (v, lo) in defaults.items()},
            "is_active": fn.truth_or_true("is_active"),
        }
    )
    return _parsed(d, fn.day, ("created_at", "updated_at"))


def clean_suppliers(df: DataFrame, order: Sequence[str | Column] = (), as_text: Collection[str] = ()) -> DataFrame:
    d = _ids(keep_one(df, ["supplier_id"], order), "suppliers", as_text)
    d = d.withColumns(
        {
            "reliability_score": fn.clip(F.coalesce(fn.number("reliability_score"), F.lit(5.0)), 0, 10),
            "payment_terms_days": fn.clip(F.coalesce(fn.number("payment_terms_days"), F.lit(30.0)), lo=0),
            "is_active": fn.truth_or_true("is_active"),
        }
    )
    return _parsed(d, fn.day, ("onboarded_at", "created_at", "updated_at"))


def clean_sales(df: DataFrame, order: Sequence[str | Column] = (), as_text: Collection[str] = ()) -> DataFrame:
    """Caps use the rows before de-duplication, and the lower bound of 1 follows the cap.

    The caps themselves are applied behind the shuffle of the de-duplication: fewer rows,
    and two small generated stages instead of one too large to be compiled.
    """
    d = _ids(df, "sales", as_text).withColumns(
        {
            "sale_date": fn.day("sale_date"),
            "quantity_sold": fn.number("quantity_sold"),
            "unit_price": fn.number("unit_price"),
            "discount_pct": F.coalesce(fn.number("discount_pct"), F.lit(0.0)),
            "is_returned": fn.truth_token("is_returned"),
        }
    )
    # Parsed numbers are never NaN; each column is parsed once more for each time a filter names it.
    d = d.filter("product_id is not null and sale_date is not null and quantity_sold > 0")
    bounds = iqr_bounds(d, ["quantity_sold", "unit_price"])
    d = iqr_cap(keep_one(d, ["sale_id"], order), bounds)
    return d.withColumns(
        {
            "quantity_sold": fn.whole(fn.clip("quantity_sold", lo=1)),
            "unit_price": fn.clip("unit_price", lo=0),
            "discount_pct": fn.clip("discount_pct", 0, 100),
            "channel": fn.remapped(fn.normalised_text("channel"), fn.CHANNEL_ALIASES),
        }
    )


def clean_inventory(df: DataFrame, order: Sequence[str | Column] = (), as_text: Collection[str] = ()) -> DataFrame:
    d = _ids(df, "inventory", as_text).withColumns(
        {
            "snapshot_date": fn.day("snapshot_date"),
            "quantity_on_hand": fn.number("quantity_on_hand"),
            "quantity_reserved": F.coalesce(fn.number("quantity_reserved"), F.lit(0.0)),
            "reorder_triggered": fn.truth_token("reorder_triggered"),
            "unit_cost_snapshot": fn.number("unit_cost_snapshot"),
        }
    ).dropna(subset=["snapshot_date", "product_id", "quantity_on_hand"])
    bounds = iqr_bounds(d, ["unit_cost_snapshot"])
    d = keep_one(d, ["product_id", "warehouse_id", "snapshot_date"], order or ["inventory_id"], last=True)
    return iqr_cap(d, bounds).withColumns(
        {c: fn.whole(fn.clip(c, lo=0)) for c in ("quantity_on_hand", "quantity_reserved")}
    ).withColumn("quantity_reserved", F.least("quantity_on_hand", "quantity_reserved"))


def clean_forecasts(df: DataFrame, order: Sequence[str | Column] = (), as_text: Collection[str] = ()) -> DataFrame:
    d = _parsed(_ids(df, "forecasts", as_text), fn.integer, ("horizon_days",))
    d = _parsed(d, fn.day, ("forecast_date", "generated_at"))
    d = _parsed(
        d,
        fn.number,
        ("predicted_demand", "actual_demand", "confidence_score", "lower_bound_95", "upper_bound_95", "mape", "mae"),
    )
    d = d.dropna(subset=["forecast_date", "product_id", "predicted_demand"]).withColumns(
        {"predicted_demand": fn.clip("predicted_demand", lo=0), "confidence_score": fn.clip("confidence_score", 0, 1)}
    )
    for bound, extreme in (("lower_bound_95", F.least), ("upper_bound_95", F.greatest)):
        if bound in d.columns:
            d = d.withColumn(bound, extreme(bound, "predicted_demand"))
    return keep_one(d, ["forecast_id"], order)


def clean_risk_scores(df: DataFrame, order: Sequence[str | Column] = (), as_text: Collection[str] = ()) -> DataFrame:
    bounds = {
        "delay_probability": (0, 1),
        "composite_risk_score": (0, 100),
        "hist_on_time_rate": (0, 1),
        "hist_mean_delay_days": (0, None),
        "hist_delay_variance": (0, None),
        "avg_delay_days_pred": (0, None),
    }
    d = _parsed(_ids(df, "risk_scores", as_text), fn.integer, ("orders_evaluated",))
    d = _parsed(d, fn.utc_timestamp, ("scored_at",))
    d = _parsed(d, lambda c: fn.clip(fn.number(c), *bounds[c]), tuple(bounds))
    d = d.withColumn("risk_tier", fn.whitelisted("risk_tier", fn.RISK_TIERS, "medium"))
    return keep_one(d, ["risk_id"], order).dropna(subset=["supplier_id", "delay_probability"])


CLEANERS: dict[str, Callable[..., DataFrame]] = {
    "products": clean_products,
    "suppliers": clean_suppliers,
    "sales": clean_sales,
    "inventory": clean_inventory,
    "forecasts": clean_forecasts,
    "risk_scores": clean_risk_scores,
}


def clean_all(raw: dict[str, DataFrame], order: Sequence[str | Column] = ()) -> dict[str, DataFrame]:
    """Clean every known table; other tables pass through. Ids that are not all whole numbers stay text."""
    as_text = text_ids(raw)
    return {t: CLEANERS[t](df, order, as_text) if t in CLEANERS else df for t, df in raw.items()}
