"""Hold-out and walk-forward splits.

``rank`` is a row's place in time or in row order. ``mode="time"`` ranks a row by the
number of rows on earlier days, so a day is never split; ``mode="rows"`` ranks by
(entity, day), which separates entities rather than time.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from depotkit.operators.ordering import row_index


def ranked(df: DataFrame, entity: str, day: str, mode: str = "time", tiebreak: tuple[str, ...] = ()) -> DataFrame:
    """Add ``rank`` and ``total``."""
    if mode == "rows":
        d = row_index(df, [F.col(c).asc() for c in (entity, day, *tiebreak)], "rank")
        return d.withColumn("total", F.lit(d.count()).cast("long"))
    if mode != "time":
        raise ValueError(f"unknown split mode {mode}")
    # One row per calendar day.
    per_day = df.groupBy(day).agg(F.count("*").alias("_n"))
    earlier = Window.orderBy(day).rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.orderBy(day).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    place = per_day.select(
        day, F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("rank"), F.sum("_n").over(whole).alias("total")
    )
    return df.join(place, day)


def holdout(share: float = 0.8) -> Column:
    """True for rows behind the first ``share`` of the order."""
    return F.col("rank") >= F.floor(F.col("total") * share)


def fold(k: int = 5) -> Column:
    """The fold a row is tested in, -1 for rows only ever trained on.

    Each fold tests total // (k + 1) rows; fold f trains on everything before it, i.e.
    on rows with a smaller fold id.
    """
    size = F.floor(F.col("total") / (k + 1))
    first = F.col("total") - k * size
    inside = F.least(F.floor((F.col("rank") - first) / size), F.lit(k - 1))
    return F.when((size == 0) | (F.col("rank") < first), -1).otherwise(inside).cast("int")


def validation_share(keys: list[str], share: float = 0.1, seed: int = 42) -> Column:
    """A fixed pseudo-random share of rows, by hash of their key."""
    return F.pmod(F.xxhash64(*keys, F.lit(seed)), F.lit(10_000)) < int(share * 10_000)
