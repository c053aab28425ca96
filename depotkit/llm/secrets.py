"""Secret scans with a ledger of blobs: each distinct text is scanned once per version of the rules."""

from __future__ import annotations

import re

import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from depotkit.llm.common import folder_for, written

RULES = "base-1"
# The patterns, and the least length of a match (for assign, of its second group).
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE | re.ASCII)
ACCESS = re.compile("AKIA[A-Z0-9]+")
HEX = re.compile("[0-9a-f]{16,}")
LEAST_ASSIGN, LEAST_ACCESS = 12, 18
KINDS = ("assign", "access", "hex")

FINDINGS = "blob string, spans array<struct<kind:string,start:long,end:long>>"
LEDGER = "blob string, rules string, spans array<struct<kind:string,start:long,end:long>>"


def find_secrets(text: str) -> list[tuple[str, int, int]]:
    """(kind, start, end) in code points, by start, then kind as listed. Runs of hex digits end where
    others begin, so a run too short to count never hides another."""
    found = [("assign", *m.span()) for m in ASSIGN.finditer(text) if len(m[2]) >= LEAST_ASSIGN]
    if "AKIA" in text:
        found += [("access", *m.span()) for m in ACCESS.finditer(text) if m.end() - m.start() >= LEAST_ACCESS]
    found += [("hex", *m.span()) for m in HEX.finditer(text)]
    return sorted(found, key=lambda s: (s[1], KINDS.index(s[0])))


def scan_blobs(blobs: DataFrame, find=find_secrets) -> DataFrame:
    """(blob, spans) from (blob, text)."""
    span = pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())])

    def run(batches):
        for batch in batches:
            spans = [[dict(zip(("kind", "start", "end"), s, strict=True)) for s in find(t.as_py())] for t in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(spans, pa.list_(span))], ["blob", "spans"])

    return blobs.select("blob", "text").mapInArrow(run, FINDINGS)


class Ledger:
    """A table of (blob, rules, spans) that scans add to; one at ``path`` from earlier runs is gone on
    with. A lost or repeated run of a scan leaves no half-written part; a blob that two runs scanned
    gives the same spans, so either row will do."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path
        try:
            spark.read.schema(LEDGER).parquet(path)
            self.empty = False
        except AnalysisException as problem:
            if problem.getCondition() != "PATH_NOT_FOUND":
                raise
            self.empty = True

    def rows(self, rules: str) -> DataFrame:
        if self.empty:
            return self.spark.createDataFrame([], FINDINGS)
        return self.spark.read.schema(LEDGER).parquet(self.path).filter(F.col("rules") == rules).select("blob", "spans")

    def add(self, found: DataFrame, rules: str) -> None:
        found.select("blob", F.lit(rules).alias("rules"), "spans").write.mode("append").parquet(self.path)
        self.empty = False


def scan_versions(versions: DataFrame, ledger: Ledger, rules: str = RULES, find=find_secrets, text: str = "text", path: str = "doc_id") -> DataFrame:
    """(path, blob, spans) for every version, a row of (path, text): each version's text is addressed
    by its SHA-256, and texts whose blob the ledger has under ``rules`` are not scanned again.

    Of versions with the same text, that with the smallest path is scanned; rows that repeat its
    path too may be scanned twice, and the findings of a blob are folded before they are joined
    back. Texts move only to those rows: the others are struck out by (path, blob). Versions of one
    text are dealt by a salt too, so a blob with many of them is met by many tasks. Null texts are
    the empty text; null paths are kept. An empty table adds nothing and gives no rows.
    """
    spark = versions.sparkSession
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    body = F.coalesce(F.col(text), F.lit(""))
    named = versions.select(F.col(path).alias("path"), F.sha2(body, 256).alias("blob"), body.alias("text"))
    # the salt is drawn once and written, so every later reader sees the same one
    light = written(named.select("path", "blob", (F.rand(17) * tasks).cast("int").alias("salt")), "versions")
    blobs = written(light.groupBy("blob").agg(F.min("path").alias("first"), F.collect_set("salt").alias("salts")), "blobs")
    spread = lambda df: df.withColumn("salt", F.explode("salts")).drop("salts")
    new = blobs if ledger.empty else blobs.join(ledger.rows(rules).select("blob").distinct(), "blob", "left_anti")
    placed = light.join(spread(new.withColumn("unseen", F.lit(True))), ["blob", "salt"], "left")
    others = placed.filter(~F.coalesce(F.col("unseen") & F.col("path").eqNullSafe(F.col("first")), F.lit(False)))
    struck = written(others.select(F.col("path").alias("p"), F.col("blob").alias("b")).distinct(), "not-scanned")
    # what is struck out grows with the input: always shuffle, building on the side without texts
    unseen = named.join(struck.hint("shuffle_hash"), F.col("path").eqNullSafe(F.col("p")) & (F.col("blob") == F.col("b")), "left_anti")
    ledger.add(scan_blobs(unseen, find), rules)
    found = ledger.rows(rules).filter(F.size("spans") > 0).groupBy("blob").agg(F.first("spans").alias("spans"))
    none = F.array().cast("array<struct<kind:string,start:long,end:long>>")
    found = written(found.join(blobs.select("blob", "salts"), "blob"), "findings")
    return light.join(spread(found), ["blob", "salt"], "left").select("path", "blob", F.coalesce("spans", none).alias("spans"))


def joined(spans):
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def op6_query(spark, sf_dir: str) -> DataFrame:
    """Findings of all documents, through a new ledger."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    found = scan_versions(docs, Ledger(spark, folder_for(docs, "ledger")))
    n = lambda kind: F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")
    return found.select(F.col("path").alias("doc_id"), *[n(k) for k in KINDS], F.sha2(joined("spans"), 256).alias("base_sha256"),
                        joined("spans").alias("spans"), "blob")
