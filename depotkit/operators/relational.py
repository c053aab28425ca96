"""Joins, aggregates, reshaping and top-k.

No join is forced to broadcast: the planner does so only where the measured or estimated
size of a side is below ``spark.sql.autoBroadcastJoinThreshold``, and sorts or splits
skewed partitions otherwise.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from depotkit.functions import scalar as fn


#: Days in one row of blocked days; with one more bit free, the bits of a row are never negative.
BLOCK_DAYS = 62


def present(df: DataFrame, columns: Sequence[str]) -> list[str]:
    return [c for c in columns if c in df.columns]


def enrich(df: DataFrame, dimension: DataFrame, key: str, columns: Sequence[str]) -> DataFrame:
    """Left join of the dimension columns that ``df`` does not have yet."""
    new = [c for c in columns if c != key and c not in df.columns and c in dimension.columns]
    return df.join(dimension.select(key, *new), key, "left")


def one_hot_domain(df: DataFrame, column: str, most: int = 1000) -> list[str]:
    """The distinct values, sorted. Each becomes a column, so more than ``most`` is an error: the
    caller should name a domain instead."""
    found = df.select(column).dropna().distinct().limit(most + 1).collect()
    if len(found) > most:
        raise ValueError(f"{column} has more than {most} values; name the domain to encode")
    return sorted(r[0] for r in found)


def one_hot(df: DataFrame, column: str, prefix: str, domain: Sequence[str]) -> DataFrame:
    return df.withColumns({f"{prefix}_{v}": fn.indicator(column, v) for v in domain})


def daily_demand(sales: DataFrame) -> DataFrame:
    """The sales of a product and day; rows without product or day are left out."""
    return (
        sales.dropna(subset=["product_id", "sale_date"])
        .groupBy("product_id", "sale_date")
        .agg(
            F.coalesce(F.sum("net_quantity"), F.lit(0)).cast("double").alias("daily_demand"),
            F.coalesce(F.sum("revenue"), F.lit(0.0)).alias("daily_revenue"),
            F.avg("unit_price").alias("avg_unit_price"),
            F.avg("discount_pct").alias("avg_discount_pct"),
            F.count("sale_id").alias("num_transactions"),
            F.count_if(F.col("is_returned")).alias("return_count"),
        )
    )


def daily_sum(sales: DataFrame, measure: str, out: str) -> DataFrame:
    return (
        sales.dropna(subset=["product_id", "sale_date"])
        .groupBy("product_id", "sale_date")
        .agg(F.coalesce(F.sum(measure), F.lit(0)).cast("double").alias(out))
    )


def value_counts(df: DataFrame, column: str) -> DataFrame:
    return df.groupBy(F.col(column).alias("value")).agg(F.count("*").alias("rows"))


def long_history(df: DataFrame, entity: str, measure: str, minimum: int) -> DataFrame:
    """Rows of entities with at least ``minimum`` non-null measures."""
    keep = df.groupBy(entity).agg(F.count(measure).alias("_n")).filter(F.col("_n") >= minimum)
    return df.join(keep, entity, "left_semi")


def forecast_with_actual(forecasts: DataFrame, sales: DataFrame) -> DataFrame:
    """Forecast rows with the units sold on their day; a day without sales counts 0."""
    actual = daily_sum(sales, "quantity_sold", "actual_demand").withColumnRenamed("sale_date", "forecast_date")
    joined = forecasts.drop("actual_demand").join(actual, ["product_id", "forecast_date"], "left")
    return joined.withColumn("actual_demand", fn.round_even(F.coalesce("actual_demand", F.lit(0.0)), 2))


def outside_windows(df: DataFrame, windows: DataFrame, key: str, day: str, start: str, end: str) -> DataFrame:
    """Rows whose day lies in none of the closed windows of their key; all three are dates.

    The windows of a key become one row per ``BLOCK_DAYS`` days, which holds a bit for each blocked
    day: overlapping and nested windows fold into the same bits before they are shuffled, and a row
    meets at most one of them, whatever the number of windows. Windows reach no further than the
    days of ``df`` (a subquery of its one column), which bounds the rows they become.
    Rows without key or day stay; windows without key, start or end, or that end before they start,
    block nothing.
    """
    types = {**dict(df.select(day).dtypes), **{f"window {c}": t for c, t in windows.select(start, end).dtypes}}
    if odd := {c: t for c, t in types.items() if t != "date"}:
        raise TypeError(f"dates expected, found {odd}")
    first, last = df.agg(F.min(day)).scalar(), df.agg(F.max(day)).scalar()
    number = lambda c: F.unix_date(c)
    block = lambda n: F.floor(n / BLOCK_DAYS).cast("int")
    spans = windows.select(
        F.col(key).alias("_k"),
        F.greatest(number(F.col(start)), number(first)).alias("_s"),
        F.least(number(F.col(end)), number(last)).alias("_e"),
        (F.col(key).isNotNull() & (F.col(start) <= F.col(end)) & first.isNotNull()).alias("_ok"),
    ).filter(F.col("_ok") & (F.col("_s") <= F.col("_e")))
    # Dealt out before they grow: a small file of windows is one task, whose map would hold all their blocks.
    spans = spans.repartition(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), "_k", "_s")
    pieces = spans.select("_k", "_s", "_e", F.explode(F.sequence(block(F.col("_s")), block(F.col("_e")))).alias("_b"))
    low = F.greatest(F.col("_s") - F.col("_b") * BLOCK_DAYS, F.lit(0))
    high = F.least(F.col("_e") - F.col("_b") * BLOCK_DAYS, F.lit(BLOCK_DAYS - 1))
    # ones at the bits from low to high
    run = lambda n: F.call_function("shiftleft", F.lit(1).cast("long"), n)
    pieces = pieces.select("_k", "_b", (run((high + 1).cast("int")) - run(low.cast("int"))).alias("_bits"))
    blocked = pieces.groupBy("_k", "_b").agg(F.bit_or("_bits").alias("_bits"))
    here = number(F.col(day))
    # The planner takes the blocks for as few as the windows, and would send all of them to every task.
    met = df.join(blocked.hint("merge"), (F.col(key) == F.col("_k")) & (block(here) == F.col("_b")), "left")
    bit = F.call_function("shiftright", F.col("_bits"), F.pmod(here, F.lit(BLOCK_DAYS)).cast("int")).bitwiseAND(F.lit(1))
    return met.filter(F.coalesce(bit, F.lit(0)) == 0).select(*[F.col(f"`{c}`") for c in df.columns])


def feature_profile(df: DataFrame, target: str) -> DataFrame:
    """Rows, columns, mean NULL share in percent, and the target's moments, in one pass."""
    nulls = sum((F.avg(F.col(f"`{c}`").isNull().cast("int")) for c in df.columns), F.lit(0.0))
    return df.agg(
        F.count("*").alias("rows"),
        F.lit(len(df.columns)).cast("long").alias("columns"),
        (nulls / len(df.columns) * 100).alias("null_pct"),
        F.avg(target).alias("target_mean"),
        F.stddev_samp(target).alias("target_std"),
        F.min(target).cast("double").alias("target_min"),
        F.max(target).cast("double").alias("target_max"),
    )


# Fixed selection: the figures of the dataset profile report, per table.
def dataset_profile(tables: dict[str, DataFrame]) -> DataFrame:
    """Long report (table, metric, value); one aggregate per table present."""
    share = lambda c: F.avg(c.cast("int")) * 100
    epoch = F.lit("1970-01-01").cast("date")
    metrics: dict[str, dict[str, Column]] = {
        "products": {
            "active_skus": F.count_if(F.col("is_active")),
            "price_min": F.min("unit_price"),
            "price_max": F.max("unit_price"),
        },
        "suppliers": {
            "reliability_min": F.min("reliability_score"),
            "reliability_max": F.max("reliability_score"),
            "countries": F.count_distinct("country"),
        },
        "sales": {
            "first_day": F.datediff(F.min("sale_date"), epoch),
            "last_day": F.datediff(F.max("sale_date"), epoch),
            "units_sold": F.sum("quantity_sold"),
            "return_rate_pct": share(F.col("is_returned")),
        },
        "inventory": {
            "stockout_records": F.count_if(F.col("quantity_on_hand") == 0),
            "stockout_pct": share(F.col("quantity_on_hand") == 0),
            "reorder_triggers": F.count_if(F.col("reorder_triggered")),
            "avg_on_hand": F.avg("quantity_on_hand"),
        },
        "forecasts": {
            "avg_mape": F.avg("mape"),
            "avg_mae": F.avg("mae"),
            "avg_confidence": F.avg("confidence_score"),
        },
        "risk_scores": {
            "avg_composite_score": F.avg("composite_risk_score"),
            "avg_delay_probability": F.avg("delay_probability"),
        },
    }
    mixes = {"products": "category", "sales": "channel", "risk_scores": "risk_tier"}
    out = None
    for name, df in tables.items():
        exprs = {"rows": F.count("*"), **metrics.get(name, {})}
        wide = df.agg(*[e.cast("double").alias(m) for m, e in exprs.items()])
        part = wide.unpivot([], list(exprs), "metric", "value")
        if name in mixes:
            counted = value_counts(df, mixes[name])
            part = part.unionByName(
                counted.select(
                    F.concat(F.lit(f"{mixes[name]}:"), F.coalesce("value", F.lit(""))).alias("metric"),
                    F.col("rows").cast("double").alias("value"),
                )
            )
        part = part.select(F.lit(name).alias("table"), "metric", "value")
        out = part if out is None else out.unionByName(part)
    return out


def class_weights(df: DataFrame, label: str) -> DataFrame:
    """Balanced weights n / (k * n_c) per class."""
    counts = df.groupBy(label).agg(F.count("*").alias("n"))
    total = counts.agg(F.struct(F.sum("n").alias("n"), F.count("*").alias("k"))).scalar()
    return counts.withColumn("weight", total.getField("n") / (total.getField("k") * F.col("n")))


def top_k(df: DataFrame, by: Column, k: int, tiebreak: Sequence[str] = ()) -> DataFrame:
    return df.orderBy(by.desc_nulls_last(), *tiebreak).limit(k)


def best_row(df: DataFrame, by: str, tiebreak: Sequence[str] = ()) -> DataFrame:
    """The row with the largest value."""
    return top_k(df, F.col(by), 1, tiebreak)


def seeded_sample(df: DataFrame, n: int, keys: Sequence[str], seed: int = 42) -> DataFrame:
    """min(n, rows) rows in the order of a seeded hash of their key; the same rows every run."""
    text = F.concat_ws("|", *[F.col(k).cast("string") for k in keys], F.lit(str(seed)))
    return df.orderBy(F.md5(text), *keys).limit(n)


def pivot(df: DataFrame, rows: Sequence[str], column: str, values: Sequence, agg: Column) -> DataFrame:
    return df.groupBy(*rows).pivot(column, list(values)).agg(agg)


def unpivot(df: DataFrame, keys: Sequence[str], columns: Sequence[str], name: str, value: str) -> DataFrame:
    return df.unpivot(list(keys), list(columns), name, value)
