"""Token counts: an exact histogram of encoded lengths, and what its suffix sums answer."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from depotkit.llm.common import written
from depotkit.llm.tokens import encoder

#: Lengths whose suffix sums are taken together; sums of whole ranges are taken first.
RANGE = 1024


def encoded_lengths(docs: DataFrame, vocabulary: str = "byte_bpe_50k", text: str = "text") -> DataFrame:
    """(length) of every text in tokens; null and empty texts have 0."""

    def run(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, 512):
                texts = batch.column(0).slice(at, 512).to_pylist()
                sizes = np.array([len(ids) for ids in encoder(vocabulary).encode(texts)], np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(sizes)], ["length"])

    return docs.select(F.col(text).alias("text")).mapInArrow(run, "length long")


def length_histogram(docs: DataFrame, **settings) -> DataFrame:
    """One row per occurring length L: n_docs, n_tokens; docs_at_least and tokens_at_least, the
    sums over lengths from L on; docs_below and tokens_below; truncated_tokens, all tokens when
    every text is cut to L.

    Suffix sums run inside ranges of lengths and, once, over the ranges, so no task sees more than
    RANGE lengths or the sums of the ranges. Repeated rows count each; empty in, empty out.
    """
    counts = encoded_lengths(docs, **settings).groupBy("length").agg(F.count("*").alias("n_docs"))
    counts = written(counts.select("length", "n_docs", (F.col("length") * F.col("n_docs")).alias("n_tokens"), F.expr(f"length div {RANGE}").alias("of")), "lengths")
    ranges = counts.groupBy("of").agg(F.sum("n_docs").alias("docs"), F.sum("n_tokens").alias("tokens"))
    later, every = W.orderBy(F.desc("of")).rowsBetween(W.unboundedPreceding, -1), W.orderBy(F.desc("of")).rowsBetween(W.unboundedPreceding, W.unboundedFollowing)
    ranges = ranges.select("of", *[F.coalesce(F.sum(c).over(later), F.lit(0)).alias(f"later_{c}") for c in ("docs", "tokens")],
                           *[F.sum(c).over(every).alias(f"all_{c}") for c in ("docs", "tokens")])
    on = W.partitionBy("of").orderBy(F.desc("length")).rowsBetween(W.unboundedPreceding, 0)
    out = counts.join(ranges, "of").select(
        "length", "n_docs", "n_tokens",
        (F.sum("n_docs").over(on) + F.col("later_docs")).alias("docs_at_least"),
        (F.sum("n_tokens").over(on) + F.col("later_tokens")).alias("tokens_at_least"),
        "all_docs", "all_tokens")
    return out.select(
        "length", "n_docs", "n_tokens", "docs_at_least", "tokens_at_least",
        (F.col("all_docs") - F.col("docs_at_least")).alias("docs_below"), (F.col("all_tokens") - F.col("tokens_at_least")).alias("tokens_below"),
        (F.col("all_tokens") - F.col("tokens_at_least") + F.col("length") * F.col("docs_at_least")).alias("truncated_tokens"))


def truncated_total(histogram: DataFrame, limit: int) -> DataFrame:
    """One row (limit, docs, tokens, truncated): totals, and tokens when texts are cut to any limit."""
    return histogram.agg(
        F.lit(limit).cast("long").alias("limit"), F.coalesce(F.sum("n_docs"), F.lit(0)).alias("docs"),
        F.coalesce(F.sum("n_tokens"), F.lit(0)).alias("tokens"),
        F.coalesce(F.sum(F.least(F.col("length"), F.lit(limit)) * F.col("n_docs")), F.lit(0)).alias("truncated"))


def quantiles(histogram: DataFrame, shares: list[float]) -> DataFrame:
    """(share, length): the least length that at least that share of the texts does not exceed."""
    asked = F.explode(F.array(*[F.lit(float(s)) for s in shares])).alias("share")
    upto = (F.col("docs_below") + F.col("n_docs")) / (F.col("docs_below") + F.col("docs_at_least"))
    return histogram.select("length", upto.alias("upto"), asked).filter("upto >= share").groupBy("share").agg(F.min("length").alias("length"))


def op4_query(spark, sf_dir: str) -> DataFrame:
    """The histogram of all documents."""
    return length_histogram(spark.read.parquet(f"{sf_dir}/documents.parquet"))
