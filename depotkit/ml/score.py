"""Batch scoring of feature tables with fitted pipelines."""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from depotkit.functions import scalar as fn
from depotkit.functions.scalar import ColumnLike
from depotkit.ml import train as tr
from depotkit.ml.boosting import Boosted, predictions


def demand_value(prediction: ColumnLike) -> Column:
    return fn.round_even(fn.clip(prediction, lo=0), 2)


def stockout_values(probability: Column, threshold: float = 0.5) -> tuple[Column, Column]:
    """The rounded probability and the flag, which compares the unrounded one."""
    return fn.round_even(probability, 4).alias("stockout_probability"), (probability >= threshold).alias("stockout_flag")


def delay_value(prediction: ColumnLike) -> Column:
    return fn.round_even(fn.clip(prediction, 0, 1), 4)


def score_demand(df: DataFrame, model: Boosted, name: str = "demand_forecasting_v1") -> DataFrame:
    return model.transform(df).select(
        "product_id",
        "sale_date",
        demand_value("prediction").alias("predicted_demand"),
        F.lit(name).alias("model"),
    )


def score_stockout(
    df: DataFrame, model: PipelineModel, features: list[str], threshold: float = 0.5, name: str = "stockout_prediction_v1"
) -> DataFrame:
    return model.transform(tr.numeric(df, features, 0.0)).select(
        "inventory_id",
        "product_id",
        *stockout_values(vector_to_array("probability")[1], threshold),
        F.lit(name).alias("model"),
    )


def score_supplier(
    df: DataFrame,
    delay_model: Boosted,
    tier_model: Boosted,
    delay_name: str = "supplier_risk_regression_v1",
    tier_name: str = "supplier_risk_classifier_v1",
) -> DataFrame:
    """Both models read the rows in one pass; no join."""
    delay, tier = predictions([delay_model, tier_model])
    both = df.select("supplier_id", "year_month", delay.alias("_delay"), tier.cast("int").alias("_tier"))
    return both.select(
        "supplier_id",
        "year_month",
        delay_value("_delay").alias("delay_probability"),
        F.col("_tier").alias("risk_tier_encoded"),
        fn.tier_label(F.col("_tier")).alias("risk_tier_label"),
        F.lit(delay_name).alias("model_reg"),
        F.lit(tier_name).alias("model_cls"),
    )
