"""Documents to packed token sequences, a stage at a time; each stage reads the table of the one before."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from depotkit.llm.common import written
from depotkit.llm.line_dedup import drop_lines
from depotkit.llm.mixing import mix_sources
from depotkit.llm.packing import pack_documents
from depotkit.llm.quality import drop_rejected
from depotkit.llm.simhash import drop_near_copies


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the quality rules."""
    return drop_rejected(docs)


def line_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without their source's boilerplate lines."""
    return drop_lines(docs)


def simhash_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies."""
    return drop_near_copies(docs)


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Nine tenths of the tokens, shared out by weight; each document once at most."""
    return mix_sources(docs)


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Where each piece of each document stands in the packed sequences."""
    return pack_documents(docs)


STAGES = [
    ("quality rules", quality_stage),
    ("line dedup", line_stage),
    ("simhash near-dedup", simhash_stage),
    ("mixing", mixing_stage),
    ("packing", packing_stage),
]

#: XXH64 and the vocabulary are not in SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on the documents of ``sf_dir``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
