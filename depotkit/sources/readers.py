"""Table scans."""

from __future__ import annotations

import json
from bisect import bisect_left
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from depotkit.schemas import CONTRACTS
from depotkit.session import cut_lineage
from depotkit.sources import layers

# Where a raw row stood: file, split, and running number inside the split.
ARRIVAL = ("_file", "_offset", "_line")
#: Lines a record may take; a quote that is not closed within them is taken for a stray one.
MAX_LINES = 10_000


def exists(spark: SparkSession, path: str) -> bool:
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()).exists(p)


@dataclass(frozen=True)
class RawScan:
    """The rows of a raw table, and the records that are no rows of it: (_file, _offset, _line, _reason,
    _record), with reason "surplus fields" or "unclosed quote"."""

    rows: DataFrame
    rejected: DataFrame


def split_scan(parsed: DataFrame) -> RawScan:
    """The two parts of what :func:`parse_raw` gives, or of a table written from it."""
    good = F.col("_reason").isNull()
    return RawScan(parsed.filter(good).drop("_reason", "_record"), parsed.filter(~good).select(*ARRIVAL, "_reason", "_record"))


def _marked(lines: DataFrame) -> DataFrame:
    """Each line with ``inside``, whether it begins within a quoted field, ``open``, whether it ends
    within one, and ``header``. Lines are read by many tasks: a first pass counts quotes per split,
    and the splits with an odd count tell how every split begins."""
    odd = lines.groupBy("_file", "_offset").agg((F.sum(F.regexp_count("value", F.lit('"'))) % 2).alias("odd")).filter("odd = 1")
    turns: dict[str, list[int]] = {}
    for row in odd.select("_file", "_offset").collect():  # a row a split at most
        turns.setdefault(row["_file"], []).append(row["_offset"])
    turns = {file: sorted(offsets) for file, offsets in turns.items()}
    shared = lines.sparkSession.sparkContext.broadcast(turns)

    def run(batches):
        split, inside = None, 0
        for batch in batches:
            file, offset = batch.column("_file").to_pylist(), batch.column("_offset").to_numpy()
            quotes = pc.count_substring(batch.column("value"), '"').to_numpy(zero_copy_only=False)
            ends = np.empty(batch.num_rows, np.int64)
            header = np.zeros(batch.num_rows, bool)
            turned = (np.diff(offset) != 0) | np.array([a != b for a, b in zip(file[1:], file)], bool)
            starts = [0, *(np.flatnonzero(turned) + 1).tolist()]
            for a, b in zip(starts, [*starts[1:], batch.num_rows]):
                if split != (file[a], offset[a]):
                    split = (file[a], offset[a])
                    inside = bisect_left(shared.value.get(split[0], []), split[1]) % 2
                    header[a] = split[1] == 0
                ends[a:b] = (inside + np.cumsum(quotes[a:b])) % 2
                inside = int(ends[b - 1])
            begins = (ends - quotes) % 2
            columns = [*batch.columns, pa.array(begins == 1), pa.array(ends == 1), pa.array(header)]
            yield pa.RecordBatch.from_arrays(columns, [*batch.schema.names, "inside", "open", "header"])

    schema = "value string, _file string, _offset long, _line long, inside boolean, open boolean, header boolean"
    return lines.mapInArrow(run, schema).filter("not header").drop("header")


def _joined(pieces: DataFrame) -> DataFrame:
    """(_file, _offset, _line, record, reason) of records that take several lines. A line belongs to the
    last one before it that opens a quoted field: one of its split, else the last of an earlier split."""
    head = F.when(~F.col("inside"), F.struct("_offset", "_line"))
    within = W.partitionBy("_file", "_offset").orderBy("_line")
    own = F.last(head, ignorenulls=True).over(within)
    last = pieces.groupBy("_file", "_offset").agg(F.max(head).alias("last"))
    earlier = W.partitionBy("_file").orderBy("_offset").rowsBetween(W.unboundedPreceding, -1)  # a row a split
    last = last.select("_file", "_offset", F.last("last", ignorenulls=True).over(earlier).alias("before"))
    owned = pieces.withColumn("own", own).join(last, ["_file", "_offset"]).withColumn("own", F.coalesce("own", "before"))
    owned = owned.select("_file", "own", "_offset", "_line", "value", "open")
    sizes = owned.groupBy("_file", "own").agg(F.count("*").alias("lines"), F.max_by("open", F.struct("_offset", "_line")).alias("unclosed"))
    owned = owned.join(sizes, ["_file", "own"])
    closed = (F.col("lines") <= MAX_LINES) & ~F.col("unclosed")
    whole = owned.filter(closed).groupBy("_file", "own").agg(F.array_sort(F.collect_list(F.struct("_offset", "_line", "value"))).alias("parts"))
    whole = whole.select("_file", "own._offset", "own._line", F.array_join(F.col("parts.value"), "\n").alias("record"), F.lit(None).cast("string").alias("reason"))
    return whole.unionByName(owned.filter(~closed).select("_file", "_offset", "_line", F.col("value").alias("record"), F.lit("unclosed quote").alias("reason")))


def scan_raw(spark: SparkSession, table: str, folder: str) -> RawScan:
    """The rows and the rejected records of :func:`parse_raw`."""
    return split_scan(parse_raw(spark, table, folder))


def parse_raw(spark: SparkSession, table: str, folder: str) -> DataFrame:
    """CSV scan of ``<folder>/<table>.csv`` (a file or a folder of parts), whose rows carry their ARRIVAL,
    ``_reason`` and ``_record``; these two are null unless a record is rejected.

    Columns are taken from the header, so extra ones pass through. Quoted fields may hold line breaks
    and doubled quotes, and a file is still read by many tasks. Blank lines are skipped and missing
    fields at the end of a row are null. Rows with more fields than the header, and lines after a
    quote that is not closed within MAX_LINES lines or at all, are rejected. "First" and "last" mean
    file order; files count in the order of their names.
    """
    path = f"{folder.rstrip('/')}/{table}.csv"
    if not exists(spark, path):
        raise FileNotFoundError(path)
    columns = spark.read.options(header=True, escape='"').csv(path).columns
    lines = spark.read.option("lineSep", "\n").text(path).select(
        "value", F.col("_metadata.file_path").alias("_file"), F.col("_metadata.file_block_start").alias("_offset"), F.monotonically_increasing_id().alias("_line"))
    marked = _marked(lines)
    several = F.col("inside") | F.col("open")
    single = marked.filter(~several).select(*ARRIVAL, F.col("value").alias("record"), F.lit(None).cast("string").alias("reason"))
    records = single.unionByName(_joined(cut_lineage(marked.filter(several))).select(*single.columns))
    records = records.withColumn("record", F.regexp_replace("record", r"\r\z", "")).filter("record <> ''")
    names = [f"c{i}" for i in range(len(columns))]
    ddl = ", ".join(f"{c} string" for c in [*names, "surplus"])
    parsed = records.withColumn("row", F.when(F.col("reason").isNull(), F.from_csv("record", ddl, {"escape": '"', "mode": "PERMISSIVE", "maxCharsPerColumn": "-1"})))
    reason = F.when(F.col("row.surplus").isNotNull(), "surplus fields").otherwise(F.col("reason"))
    parsed = parsed.withColumn("reason", reason)
    fields = [F.when(F.col("reason").isNull(), F.col(f"row.{c}")).alias(name) for c, name in zip(names, columns)]
    return parsed.select(*fields, *ARRIVAL, F.col("reason").alias("_reason"), F.when(F.col("reason").isNotNull(), F.col("record")).alias("_record"))


def read_raw(spark: SparkSession, table: str, folder: str, arrival: bool = False) -> DataFrame:
    """The rows of :func:`scan_raw`, with or without their arrival."""
    rows = scan_raw(spark, table, folder).rows
    return rows if arrival else rows.drop(*ARRIVAL)


def arrival_order() -> list[Column]:
    return [F.col(c) for c in ARRIVAL]


def read_all_raw(
    spark: SparkSession, folder: str, tables: list[str] | None = None, arrival: bool = False
) -> dict[str, DataFrame]:
    """The contract tables, or the named ones; nothing is read until an action."""
    return {t: read_raw(spark, t, folder, arrival) for t in (tables or list(CONTRACTS))}


def types_path(folder: str, name: str) -> str:
    """Where the types of a table without own types are kept."""
    return f"{folder.rstrip('/')}/_types/{name}"


def read_layer(spark: SparkSession, name: str, folder: str, made_by: str, fmt: str = "parquet") -> DataFrame:
    """A published table of the clean or feature layer; a missing one names the step that writes it."""
    folder = layers.folder_of(spark, folder, name)
    path = f"{folder}/{name}"
    if not exists(spark, path):
        raise FileNotFoundError(f"{path} not found. Run {made_by} first.")
    return load(spark, name, folder, fmt)


def load(spark: SparkSession, name: str, folder: str, fmt: str = "parquet") -> DataFrame:
    """The table written to ``<folder>/<name>``."""
    reader = spark.read.format(fmt)
    if fmt == "csv":
        types = spark.read.text(types_path(folder, name)).first()
        reader = reader.option("header", True).schema(T.StructType.fromJson(json.loads(types["value"])))
    return reader.load(f"{folder}/{name}")


def read_clean(spark: SparkSession, table: str, folder: str, fmt: str = "parquet") -> DataFrame:
    return read_layer(spark, table, folder, "run_etl", fmt)


def read_features(spark: SparkSession, name: str, folder: str) -> DataFrame:
    return read_layer(spark, f"features_{name}", folder, "run_features")
