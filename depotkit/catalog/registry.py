"""Named queries with their oracle SQL."""

from __future__ import annotations

import re
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from depotkit.catalog.views import Tables, duck

QUERIES: dict[str, "Query"] = {}
EDGE = 0.0917


@dataclass(frozen=True)
class Query:
    build: Callable[[Tables], DataFrame]
    columns: str | None
    sql: str | None

    def run(self, spark: SparkSession, folder: str) -> DataFrame:
        df = self.build(Tables(spark, folder))
        return shown(df, self.columns) if self.columns else df


def _items(columns: str) -> list[tuple[str, str]]:
    """'a d:b r2:c' -> [('', 'a'), ('d', 'b'), ('r2', 'c')]; '~' in a name stands for a space."""
    out = []
    for item in columns.split():
        kind, _, name = item.rpartition(":") if re.match(r"^(d|i|[re]\d*):", item) else ("", "", item)
        out.append((kind, name.replace("~", " ")))
    return out


def _digits(kind: str) -> int:
    return int(kind[1:] or 6)


def _edge(kind: str) -> float:
    return EDGE if kind.startswith("e") else 0.0


def shown(df: DataFrame, columns: str) -> DataFrame:
    """The compared columns: d: day as text, i: bigint, r<n>: rounded to n places (6), e<n>: the
    same with the rounding edge moved by EDGE.

    Two engines round a value that ends in an exact half apart after one last-bit difference, so
    only columns in which such values occur (means of cents, ratios of whole numbers) are marked e.
    """
    out = []
    for kind, name in _items(columns):
        c = F.col(f"`{name}`")
        if kind == "d":
            c = c.cast("string")
        elif kind == "i":
            c = c.cast("long")
        elif kind:
            scale = float(10 ** _digits(kind))
            c = F.rint(c.cast("double") * scale + _edge(kind)) / scale + F.lit(0.0)
        out.append(c.alias(name))
    return df.select(*out)


def shown_sql(columns: str) -> str:
    out = []
    for kind, name in _items(columns):
        c = f'"{name}"'
        if kind == "d":
            c = f"cast({c} as varchar)"
        elif kind == "i":
            c = f"cast({c} as bigint)"
        elif kind:
            scale = f"1e{_digits(kind)}"
            c = f"round_even(cast({c} as double) * {scale} + {_edge(kind)}e0, 0) / {scale} + 0.0"
        out.append(f'{c} as "{name}"')
    return ", ".join(out)


def query(name: str, columns: str | None = None, sql: str | None = None):
    """Register a query. ``sql`` is the oracle: a query text, or CTEs ending in one named ``out``."""

    def register(build: Callable[[Tables], DataFrame]):
        text = None
        if sql is not None:
            body = sql.strip()
            text = duck(body if not columns else _wrap(body, columns))
        if name in QUERIES:
            raise ValueError(f"duplicate query {name}")
        QUERIES[name] = Query(build, columns, text)
        return build

    return register


def _wrap(body: str, columns: str) -> str:
    if body.lower().startswith("with "):
        return f"{body} select {shown_sql(columns)} from out"
    return f"with out as ({body}) select {shown_sql(columns)} from out"
