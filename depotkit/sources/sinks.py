"""Table, audit, report and model writers."""

from __future__ import annotations

from typing import Any

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from depotkit.ml.boosting import Boosted
from depotkit.schemas import LOAD_ORDER
from depotkit.sources import readers

# Day column that partitions each large table, by month.
PARTITION_DAY = {
    "sales": "sale_date",
    "inventory": "snapshot_date",
    "features_demand": "sale_date",
    "features_stockout": "snapshot_date",
    "features_supplier_risk": "year_month",
}
MONTH_COLUMN = "part_month"


def write_table(df: DataFrame, name: str, folder: str, fmt: str = "parquet") -> tuple[str, int]:
    """Overwrite ``<folder>/<name>``; returns the path and the rows written.

    Rows are counted on the written copy; for parquet that reads the footers only. Large
    tables are partitioned by month; the rebalance hint lets adaptive execution split a
    month that is too large for one task.
    """
    path = f"{folder.rstrip('/')}/{name}"
    day = PARTITION_DAY.get(name)
    if dict(df.dtypes).get(day) in ("date", "timestamp", "timestamp_ntz") and fmt == "parquet":
        monthly = df.withColumn(MONTH_COLUMN, F.date_format(day, "yyyy-MM")).hint("rebalance", MONTH_COLUMN)
        writer = monthly.write.partitionBy(MONTH_COLUMN)
    else:
        writer = df.write
    if fmt == "csv":
        writer = writer.option("header", True)
        # text files carry no types: readers find them beside the table
        types = df.sparkSession.createDataFrame([(df.schema.json(),)], "value string")
        types.write.mode("overwrite").text(readers.types_path(folder, name))
    writer.mode("overwrite").format(fmt).save(path)
    reader = df.sparkSession.read.format(fmt)
    if fmt == "csv":
        reader = reader.option("header", True).schema(df.schema)
    return path, reader.load(path).count()


def size_kb(spark: SparkSession, path: str) -> float:
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark._jsc.hadoopConfiguration())
    return fs.getContentSummary(p).getLength() / 1024


def write_audit(audit: DataFrame, folder: str, run_ts: str) -> str:
    """Append the audit rows of one run, marked by its start time."""
    path = f"{folder.rstrip('/')}/etl_audit"
    audit.withColumn("run_ts", F.lit(run_ts)).coalesce(1).write.mode("append").option("header", True).csv(path)
    return path


def jdbc_options(table: str, url: str, properties: dict[str, str] | None = None) -> dict[str, str]:
    """Options of an overwriting load that empties the table and its dependants, keeping its definition."""
    return {
        "url": url,
        "dbtable": table,
        "truncate": "true",
        "cascadeTruncate": "true",
        "batchsize": "5000",
        **(properties or {}),
    }


def load_sequence(tables: dict[str, Any]) -> list[str]:
    """Tables at hand, parents before children."""
    return [t for t in LOAD_ORDER if t in tables]


def load_jdbc(
    tables: dict[str, DataFrame], url: str, properties: dict[str, str] | None = None, connections: int | None = None
) -> list[str]:
    """Empty every table, children first, then append parents first.

    ``connections`` bounds how many tasks write at once, not how many rows; without it every
    partition writes.
    """
    order = load_sequence(tables)
    for t in reversed(order):
        tables[t].limit(0).write.format("jdbc").options(**jdbc_options(t, url, properties)).mode("overwrite").save()
    for t in order:
        out = tables[t].coalesce(connections) if connections else tables[t]
        out.write.format("jdbc").options(**jdbc_options(t, url, properties)).mode("append").save()
    return order


def write_summary(
    spark: SparkSession, folder: str, name: str, metrics: dict[str, float], params: dict[str, Any], features: list[str]
) -> str:
    """One JSON row {model, metrics, params, features}."""
    path = f"{folder.rstrip('/')}/{name}_summary"
    row = (name, {k: None if v is None else float(v) for k, v in metrics.items()}, {k: str(v) for k, v in params.items()}, list(features))
    ddl = "model string, metrics map<string,double>, params map<string,string>, features array<string>"
    spark.createDataFrame([row], ddl).coalesce(1).write.mode("overwrite").json(path)
    return path


def write_importance(df: DataFrame, folder: str, name: str) -> str:
    path = f"{folder.rstrip('/')}/{name}_importance"
    df.coalesce(1).write.mode("overwrite").option("header", True).csv(path)
    return path


def log_run(
    spark: SparkSession,
    folder: str,
    run_id: str,
    experiment: str,
    params: dict[str, Any],
    metrics: dict[str, float],
    artefacts: list[str],
) -> str:
    """Append one run to the tracking table (run_id, experiment, kind, key, value, ts)."""
    path = f"{folder.rstrip('/')}/runs"
    rows = [(run_id, experiment, "param", k, str(v)) for k, v in params.items()]
    rows += [(run_id, experiment, "metric", k, None if v is None else str(float(v))) for k, v in metrics.items()]
    rows += [(run_id, experiment, "artefact", a, a) for a in artefacts]
    df = spark.createDataFrame(rows, "run_id string, experiment string, kind string, key string, value string")
    df.withColumn("ts", F.current_timestamp()).coalesce(1).write.mode("append").parquet(path)
    return path


def save_model(spark: SparkSession, model: PipelineModel | Boosted, folder: str, name: str) -> str:
    path = f"{folder.rstrip('/')}/{name}"
    if isinstance(model, Boosted):
        model.save(spark, path)
    else:
        model.write().overwrite().save(path)
    return path


def load_model(spark: SparkSession, folder: str, name: str, boosted: bool) -> PipelineModel | Boosted:
    path = f"{folder.rstrip('/')}/{name}"
    return Boosted.load(spark, path) if boosted else PipelineModel.load(path)
