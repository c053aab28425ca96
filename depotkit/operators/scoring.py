"""Supplier risk from deliveries, forecast accuracy and seasonal indices."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from depotkit.functions import scalar as fn

# Upper bound, tier and advice, from the lowest score up.
TIER_RULES = (
    (25.0, "low", "No action required; continue standard ordering."),
    (50.0, "medium", "Monitor delivery windows; consider dual-sourcing."),
    (75.0, "high", "Increase safety stock; request SLA commitment."),
    (None, "critical", "Escalate to procurement; initiate alternative sourcing."),
)

# January to December per demand profile.
MONTH_INDEX = {
    "electronics": (0.80, 0.75, 0.85, 0.85, 0.90, 0.90, 0.95, 1.20, 1.10, 1.10, 1.40, 1.60),
    "fashion": (0.70, 0.80, 1.20, 1.30, 1.10, 0.90, 0.85, 1.00, 1.30, 1.20, 1.00, 0.90),
    "food": (0.90, 0.85, 0.95, 1.00, 1.05, 1.20, 1.30, 1.25, 1.10, 1.00, 0.95, 1.00),
    "general": (0.85, 0.85, 0.90, 0.95, 1.00, 0.95, 0.95, 1.00, 1.00, 1.00, 1.10, 1.20),
}
# Fixed values: (month, day) -> multiplier.
EVENT_INDEX = {
    (1, 1): 0.40, (2, 14): 1.30, (7, 4): 1.25, (11, 29): 2.50, (11, 30): 2.20,
    (12, 1): 1.80, (12, 24): 1.90, (12, 25): 0.30, (12, 31): 1.20,
}
WEEKEND_FACTOR = 0.60


def supplier_risk_scores(deliveries: DataFrame, period: str = "period") -> DataFrame:
    """One score per supplier and period from (supplier_id, period, delay_days, max_delay)."""
    stats = deliveries.groupBy("supplier_id", period).agg(
        F.avg("delay_days").alias("_mean"),
        F.var_samp("delay_days").alias("_var"),
        F.avg((F.col("delay_days") <= 0.5).cast("int")).alias("_on_time"),
        F.avg((F.col("delay_days") > 2).cast("int")).alias("_late"),
        F.max("max_delay").alias("_max_delay"),
        F.count("*").alias("orders_evaluated"),
    )
    probability = fn.round_even("_late", 4)
    score = fn.round_even(
        fn.clip(
            F.col("delay_probability") * 40
            + F.try_divide(F.col("_mean"), F.col("_max_delay")) * 40
            + (1 - F.col("_on_time")) * 20,
            0,
            100,
        ),
        2,
    )
    tier = action = None
    for bound, name, advice in TIER_RULES:
        if bound is None:
            tier, action = tier.otherwise(name), action.otherwise(advice)
        else:
            hit = F.col("composite_risk_score") < bound
            tier = F.when(hit, name) if tier is None else tier.when(hit, name)
            action = F.when(hit, advice) if action is None else action.when(hit, advice)
    return (
        stats.withColumn("delay_probability", probability)
        .withColumn("composite_risk_score", score)
        .select(
            "supplier_id",
            period,
            "delay_probability",
            fn.round_even(F.greatest("_mean", F.lit(0.0)), 2).alias("avg_delay_days_pred"),
            tier.alias("risk_tier"),
            "composite_risk_score",
            fn.round_even("_mean", 4).alias("hist_mean_delay_days"),
            fn.round_even("_var", 4).alias("hist_delay_variance"),
            fn.round_even("_on_time", 4).alias("hist_on_time_rate"),
            "orders_evaluated",
            F.to_json(
                F.struct(
                    fn.round_even("_mean", 3).alias("hist_mean_delay"),
                    fn.round_even("_on_time", 3).alias("on_time_rate"),
                    fn.round_even("_var", 3).alias("hist_delay_var"),
                    F.col("orders_evaluated").alias("order_frequency"),
                )
            ).alias("shap_top_features"),
            action.alias("recommended_action"),
        )
    )


def parse_top_features(text: fn.ColumnLike):
    """The feature text of a risk score, JSON or single-quoted, as map<string,double>."""
    return F.from_json(fn.col(text), "map<string,double>", {"allowSingleQuotes": "true"})


def forecast_accuracy(df: DataFrame) -> DataFrame:
    """Absolute error, capped percentage error and confidence of predicted against actual demand."""
    p, a = F.col("predicted_demand"), F.col("actual_demand")
    error = F.abs(p - a)
    return df.withColumns(
        {
            "mae": fn.round_even(error, 4),
            "mape": fn.round_even(fn.clip(error / (a + 1.0) * 100, hi=100), 4),
            "confidence_score": fn.round_even(fn.clip(1 - error / (a + 1e-9), 0.50, 0.99), 4),
        }
    )


def prediction_interval(df: DataFrame, predicted: str = "predicted_demand") -> DataFrame:
    low, high = fn.interval_around(predicted)
    return df.withColumns({"lower_bound_95": low, "upper_bound_95": high})


def _lookup(values: dict[str, float]) -> Column:
    """A literal map, which the planner folds into the expression that reads it."""
    return F.create_map(*[F.lit(x) for pair in values.items() for x in pair])


def seasonal_index(df: DataFrame, day: str, profile: str) -> DataFrame:
    """Month index x event multiplier x weekend factor; unknown profiles use 'general'.

    The tables are literals: the rows are neither joined nor shuffled.
    """
    months = _lookup({f"{p} {m}": v for p, vs in MONTH_INDEX.items() for m, v in enumerate(vs, start=1)})
    events = _lookup({f"{m}-{d}": v for (m, d), v in EVENT_INDEX.items()})
    d = F.col(day)
    known = F.when(F.col(profile).isin(*MONTH_INDEX), F.col(profile)).otherwise("general")
    month, dom = F.month(d).cast("string"), F.dayofmonth(d).cast("string")
    return df.withColumns(
        {
            "month_index": F.element_at(months, F.concat_ws(" ", known, month)),
            "event_index": F.coalesce(F.element_at(events, F.concat_ws("-", month, dom)), F.lit(1.0)),
            "weekend_factor": F.when(fn.weekday0(d) >= 5, WEEKEND_FACTOR).otherwise(1.0),
        }
    ).withColumn("seasonal_index", F.col("month_index") * F.col("event_index") * F.col("weekend_factor"))
