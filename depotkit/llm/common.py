"""Helpers of this package: written tables, words, line keys, local bindings."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from depotkit.session import shared_folder

#: The white space that separates words: U+0020 and U+0009 to U+000D.
SPACE = " \t\n\x0b\x0c\r"
SPACE_RUN = r"[\x20\x09-\x0D]+"


def folder_for(df: DataFrame, name: str) -> str:
    """A new path in the folder all executors share."""
    return f"{shared_folder(df.sparkSession).rstrip('/')}/llm/{name}-{uuid.uuid4().hex}"


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` from a table in the shared folder.

    Work is done once and lost executors cost nothing that is already written. The planner knows
    the size of the files, so a join broadcasts this side only below the session's threshold.
    """
    path = folder_for(df, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def let(value: Column, use) -> Column:
    """``use(value)`` with the value computed once, also where ``use`` reads it inside lambdas."""
    return F.transform(F.array(value), use)[0]


def words(text: Column) -> Column:
    """The words of a text; null and blank texts have none."""
    body = F.btrim(F.coalesce(text, F.lit("")), F.lit(SPACE))
    return F.when(body == "", F.array().cast("array<string>")).otherwise(F.split(body, SPACE_RUN))


def key128(text: Column) -> Column:
    """Two hashes of different seeds, 128 bits together."""
    return F.struct(F.xxhash64(text).alias("a"), F.xxhash64(F.lit(1), text).alias("b"))
