"""Layers of tables that change all at once: a run writes a folder of its own, and one small file
names the tables readers see.

``<layer>/runs/<run>/<table>`` holds data, ``<layer>/published/<number>.json`` the folder of every
table since that publication; the largest number counts. A run that stops before it publishes
changes nothing for readers, who also keep the tables they opened while the next run publishes.
"""

from __future__ import annotations

import json
import uuid
from dataclasses import dataclass, field
from datetime import datetime, timezone

from py4j.java_gateway import JavaObject
from pyspark.sql import DataFrame, SparkSession

#: Publications whose data stays; runs that only older ones name are removed.
KEPT = 2


def _path(spark: SparkSession, path: str) -> tuple[JavaObject, JavaObject]:
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


def _numbers(spark: SparkSession, layer: str) -> list[int]:
    fs, p = _path(spark, f"{layer}/published")
    if not fs.exists(p):
        return []
    names = [status.getPath().getName() for status in fs.listStatus(p)]
    return sorted(int(n.removesuffix(".json")) for n in names if n.removesuffix(".json").isdigit())


def _manifest(spark: SparkSession, layer: str, number: int) -> dict[str, str]:
    return json.loads(spark.read.text(f"{layer}/published/{number:010d}.json", wholetext=True).first()["value"])


def published(spark: SparkSession, layer: str) -> dict[str, str]:
    """The folder, inside the layer, that holds each published table; empty before the first publication."""
    numbers = _numbers(spark, layer.rstrip("/"))
    return _manifest(spark, layer.rstrip("/"), numbers[-1]) if numbers else {}


def folder_of(spark: SparkSession, layer: str, table: str) -> str:
    """The folder ``table`` is read from: that of its run, or the layer itself for a table laid there by hand."""
    layer = layer.rstrip("/")
    inside = published(spark, layer).get(table)
    return f"{layer}/{inside}" if inside else layer


@dataclass
class Run:
    """One run's tables of a layer, not seen by readers until :meth:`publish`."""

    spark: SparkSession
    layer: str
    name: str = field(default_factory=lambda: f"{datetime.now(timezone.utc):%Y%m%dT%H%M%S}-{uuid.uuid4().hex[:8]}")
    tables: list[str] = field(default_factory=list)

    def __post_init__(self):
        self.layer = self.layer.rstrip("/")

    @property
    def folder(self) -> str:
        return f"{self.layer}/runs/{self.name}"

    def write(self, df: DataFrame, table: str, fmt: str = "parquet") -> tuple[str, int]:
        """Path and rows of the table in this run's folder."""
        from depotkit.sources import sinks

        out = sinks.write_table(df, table, self.folder, fmt)
        self.tables.append(table)
        return out

    def publish(self) -> int:
        """Show this run's tables to readers, beside those of earlier runs that it did not write.

        The file is written under another name and renamed, so readers never see a part of it.
        A number that another run took meanwhile is left to it, and this run takes the next.
        """
        while True:
            numbers = _numbers(self.spark, self.layer)
            number = numbers[-1] + 1 if numbers else 1
            tables = _manifest(self.spark, self.layer, numbers[-1]) if numbers else {}
            tables |= dict.fromkeys(self.tables, f"runs/{self.name}")
            fs, draft = _path(self.spark, f"{self.layer}/published/_{self.name}.json")
            stream = fs.create(draft, True)
            stream.write(bytearray(json.dumps(tables, sort_keys=True).encode()))
            stream.close()
            target = _path(self.spark, f"{self.layer}/published/{number:010d}.json")[1]
            if not fs.exists(target) and fs.rename(draft, target):
                break
        self._expire([*numbers, number])
        return number

    def _expire(self, numbers: list[int]) -> None:
        """Remove publications before the last ``KEPT``, and the runs that only they name. Runs that
        were never published are left alone: they may still be at work."""
        old, kept = numbers[:-KEPT], numbers[-KEPT:]
        used = {f for n in kept for f in _manifest(self.spark, self.layer, n).values()}
        for n in old:
            for unused in sorted(set(_manifest(self.spark, self.layer, n).values()) - used):
                fs, p = _path(self.spark, f"{self.layer}/{unused}")
                fs.delete(p, True)
            fs, p = _path(self.spark, f"{self.layer}/published/{n:010d}.json")
            fs.delete(p, False)
