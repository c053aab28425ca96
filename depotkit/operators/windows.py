"""Row-based windows over entity series.

A series that holds one row per calendar day is bounded by the calendar, so a plain
window per entity is safe. A series that holds any number of rows per entity goes
through :func:`series`, which measures the longest one first and, beyond a limit, cuts
it into blocks of rows with copies of the few rows a trailing frame looks back on.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from depotkit.functions.scalar import ColumnLike, col
from depotkit.operators.ordering import row_index
from depotkit.session import cut_lineage

UNB, NEXT = Window.unboundedPreceding, Window.unboundedFollowing


# ---- expressions over a window spec -----------------------------------------


def lag(c: ColumnLike, k: int, w: WindowSpec) -> Column:
    return F.lag(col(c), k).over(w)


def trailing_mean(c: ColumnLike, k: int, w: WindowSpec) -> Column:
    """Mean of up to k rows before the current one."""
    return F.avg(col(c)).over(w.rowsBetween(-k, -1))


def trailing_std(c: ColumnLike, k: int, w: WindowSpec) -> Column:
    """Sample deviation of up to k rows before the current one; fewer than two give 0."""
    return F.coalesce(F.stddev_samp(col(c)).over(w.rowsBetween(-k, -1)), F.lit(0.0))


def fill_both_ways(c: ColumnLike, w: WindowSpec) -> Column:
    """Last known value; rows before the first known value take that one.

    Only leading rows need a later value, and for them the next known value is the first
    of the series: one whole-series frame instead of a frame per row.
    """
    x = col(c)
    return F.coalesce(
        F.last(x, ignorenulls=True).over(w.rowsBetween(UNB, 0)),
        F.first(x, ignorenulls=True).over(w.rowsBetween(UNB, NEXT)),
    )


def difference(c: ColumnLike, k: int, w: WindowSpec) -> Column:
    return col(c) - F.lag(col(c), k).over(w)


def second_difference(c: ColumnLike, w: WindowSpec) -> Column:
    x = col(c)
    return x - 2 * F.lag(x, 1).over(w) + F.lag(x, 2).over(w)


def slope3(c: ColumnLike, w: WindowSpec) -> Column:
    """Least-squares slope of the last three rows (two on the second row), NULL on any gap.

    With x = 0,1,2 the slope is (y2 - y0) / 2 whatever the middle value, which must exist.
    """
    y, y1, y2 = col(c), F.lag(col(c), 1).over(w), F.lag(col(c), 2).over(w)
    seen = F.count(F.lit(1)).over(w.rowsBetween(-2, 0))
    return F.when(seen == 2, y - y1).when((seen == 3) & y1.isNotNull(), (y - y2) / 2)


def run_length(is_one: Column, position: ColumnLike, w: WindowSpec, carry: Column | None = None) -> Column:
    """Consecutive ones up to and including this row: the distance to the last other row."""
    last_break = F.max(F.when(~is_one, col(position))).over(w.rowsBetween(UNB, 0))
    start = F.coalesce(last_break, *([carry] if carry is not None else []), F.lit(0))
    return (col(position) - start).cast("double")


def floored_balance(
    opening: ColumnLike,
    change: ColumnLike,
    entity: Sequence[str],
    order: Sequence[str],
    max_rows: int = 2_000_000,
    block_rows: int | None = None,
):
    """Running balance that never falls below zero, for ``DataFrame.transform``.

    With S the unfloored balance the result is S - min(0, lowest S so far). A stretch of rows is
    summed up by its total and its lowest S, and neighbouring stretches add up: so an entity of more
    than ``max_rows`` rows is cut by a range partitioning into blocks of about ``block_rows`` rows
    (``max_rows`` unless given), and each block goes on from the total and the lowest S of the
    blocks before it. ``order`` must tell an entity's rows apart.
    A NULL change is none. NULL entities are entities of their own.
    """

    def apply(df: DataFrame, out: str = "balance") -> DataFrame:
        moved = F.coalesce(col(change), F.lit(0))
        longest, rows = df.groupBy(*entity).count().agg(F.max("count"), F.sum("count")).first()
        if (longest or 0) <= max_rows:
            w = Window.partitionBy(*entity).orderBy(*order).rowsBetween(UNB, 0)
            d = df.withColumn("_s", col(opening) + F.sum(moved).over(w))
            return d.withColumn(out, F.col("_s") - F.least(F.lit(0), F.min("_s").over(w))).drop("_s")
        ranged = df.repartitionByRange(-(-rows // (block_rows or max_rows)), *entity, *order).withColumn("_block", F.spark_partition_id())
        # Written once: block numbers must not change between the sums and the rows.
        ranged = cut_lineage(ranged)
        w = Window.partitionBy(*entity, "_block").orderBy(*order).rowsBetween(UNB, 0)
        local = ranged.withColumn("_s", F.sum(moved).over(w))
        # One row per entity and block.
        sums = local.groupBy(*entity, "_block").agg(
            F.sum(moved).alias("_total"), F.min(col(opening) + F.col("_s")).alias("_low")
        )
        blocks = Window.partitionBy(*entity).orderBy("_block").rowsBetween(UNB, -1)
        sums = sums.withColumn("_before", F.coalesce(F.sum("_total").over(blocks), F.lit(0)))
        carry = sums.select(
            *[F.col(e).alias(f"_e{i}") for i, e in enumerate(entity)],
            F.col("_block").alias("_b"),
            "_before",
            F.min(F.col("_before") + F.col("_low")).over(blocks).alias("_lowest"),
        )
        same = [F.col(e).eqNullSafe(F.col(f"_e{i}")) for i, e in enumerate(entity)]
        d = local.join(carry, [*same, F.col("_block") == F.col("_b")])
        d = d.withColumn("_s", col(opening) + F.col("_before") + F.col("_s"))
        d = d.withColumn(out, F.col("_s") - F.least(F.lit(0), F.col("_lowest"), F.min("_s").over(w)))
        return d.select(*df.columns, out)

    return apply


# ---- gap-free daily series --------------------------------------------------


def day_bounds(df: DataFrame, day: str) -> tuple:
    """First and last day of the table (one row to the driver)."""
    return tuple(df.agg(F.min(day), F.max(day)).first())


def fill_days(df: DataFrame, entity: str, day: str, bounds: tuple) -> DataFrame:
    """One row per entity and day between the bounds; measures of added days are NULL.

    ``df`` holds at most one row per entity and day. Each row emits itself and the empty
    days up to its successor, so no entity x day product is joined back to the facts.
    """
    first, last = (F.lit(b).cast("date") for b in bounds)
    w = Window.partitionBy(entity).orderBy(day)
    measures = [c for c in df.columns if c not in (entity, day)]
    ranged = df.withColumns(
        {
            "_from": F.when(F.lag(day).over(w).isNull(), first).otherwise(F.col(day)),
            "_to": F.coalesce(F.date_sub(F.lead(day).over(w), 1), last),
        }
    )
    spread = ranged.select("*", F.explode(F.sequence("_from", "_to")).alias("_day"))
    return spread.select(
        entity,
        F.col("_day").alias(day),
        *[F.when(F.col("_day") == F.col(day), F.col(c)).alias(c) for c in measures],
    )


# ---- series of unbounded length ---------------------------------------------


@dataclass
class Series:
    """A table with row positions inside each entity, and the window to run frames over."""

    frame: DataFrame
    window: WindowSpec
    entity: str
    blocked: bool

    def finish(self, df: DataFrame) -> DataFrame:
        return df.filter(~F.col("_halo")).drop("_pos", "_block", "_halo")

    def run_length(self, df: DataFrame, is_one: Column, out: str) -> DataFrame:
        if not self.blocked:
            return df.withColumn(out, run_length(is_one, "_pos", self.window))
        # The last break before each block; one row per entity and block.
        breaks = (
            df.filter(~F.col("_halo"))
            .groupBy(self.entity, "_block")
            .agg(F.max(F.when(~is_one, F.col("_pos"))).alias("_last"))
        )
        w = Window.partitionBy(self.entity).orderBy("_block").rowsBetween(UNB, -1)
        carry = breaks.select(self.entity, "_block", F.max("_last").over(w).alias("_carry"))
        joined = df.join(carry, [self.entity, "_block"], "left")
        return joined.withColumn(out, run_length(is_one, "_pos", self.window, F.col("_carry"))).drop("_carry")


def longest_series(df: DataFrame, entity: str) -> int:
    return df.groupBy(entity).count().agg(F.max("count")).first()[0] or 0


def series(
    df: DataFrame,
    entity: str,
    cell: str,
    tiebreak: Sequence[str],
    lookback: int,
    max_rows: int = 2_000_000,
    measured: DataFrame | None = None,
) -> Series:
    """Prepare row frames that look back ``lookback`` rows, ordered by cell, then tiebreak.

    Up to ``max_rows`` rows per entity one window task per entity is fine. Beyond that,
    positions come from a range partitioning by (entity, cell, tiebreak), which splits a hot
    entity or cell like any other rows, and the entity is cut into blocks of ``max_rows``
    rows; each block also receives the ``lookback`` rows before it, marked ``_halo``.
    ``measured`` may name a cheaper table with the same entities, row for row, to count on.
    """
    longest = longest_series(df if measured is None else measured, entity)
    if longest <= max_rows:
        w = Window.partitionBy(entity).orderBy(F.col(cell).asc_nulls_last(), *tiebreak)
        frame = df.withColumns(
            {"_pos": F.row_number().over(w).cast("long"), "_block": F.lit(0).cast("long"), "_halo": F.lit(False)}
        )
        return Series(frame, w, entity, False)
    size = max(max_rows, lookback)
    ordered = row_index(df, [F.col(entity).asc(), F.col(cell).asc_nulls_last(), *[F.col(c).asc() for c in tiebreak]], "_row")
    firsts = ordered.groupBy(F.col(entity).alias("_e")).agg(F.min("_row").alias("_first"))
    placed = ordered.join(firsts, F.col(entity).eqNullSafe(F.col("_e")))
    placed = placed.withColumn("_pos", F.col("_row") - F.col("_first") + 1).drop("_row", "_first", "_e")
    block = F.floor((F.col("_pos") - 1) / size)
    near_end = (F.col("_pos") - 1) % size >= size - lookback
    copies = F.array_compact(
        F.array(
            F.struct(block.alias("_block"), F.lit(False).alias("_halo")),
            F.when(near_end, F.struct((block + 1).alias("_block"), F.lit(True).alias("_halo"))),
        )
    )
    frame = placed.select("*", F.inline(copies))
    # Written once: the break summary of run_length reads the same rows again.
    frame = cut_lineage(frame)
    return Series(frame, Window.partitionBy(entity, "_block").orderBy("_pos"), entity, True)
