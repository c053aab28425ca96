"""Exact order statistics, running totals and row positions without a one-task sort.

A window without PARTITION BY moves a whole table into one task. The operators here
reach the same answers from partial aggregates and range partitions, so their largest
task stays a small share of the rows whatever the key distribution.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, Row, Window
from pyspark.sql import functions as F

from depotkit.session import cut_lineage


#: Bits of the sort key that are still open after each pass of a selection. Values of up to thirty leading
#: digits (bits) are told apart by two passes; a bucket of the last pass holds 2^22 keys at most.
SHIFTS = (44, 22, 0)


def sort_key(x: Column) -> Column:
    """A double as a whole number of the same order: its bits, negative for negative values.

    -0.0 counts as 0.0. NULL and NaN have none. The call is evaluated for each row once, where it stands;
    arithmetic that finds the bits makes a method too large to be compiled.
    """
    size = F.coalesce(F.abs(x), F.lit(0.0))
    bits = F.java_method(F.lit("java.lang.Double"), F.lit("doubleToLongBits"), size).cast("long")
    sign = F.when(x.isNotNull() & ~F.isnan(x), F.when(x < 0, F.lit(-1).cast("long")).otherwise(F.lit(1).cast("long")))
    return bits * sign


def key_value(key: Column) -> Column:
    """The double of a :func:`sort_key`."""
    size = F.abs(key)
    field, part = F.shiftright(size, 52), size.bitwiseAND(F.lit(2**52 - 1)).cast("double")
    small = part * 2.0**-537 * 2.0**-537
    value = F.when(field == 0, small).when(field == 2047, F.lit(float("inf"))).otherwise((part / float(2**52) + 1) * F.pow(F.lit(2.0), (field - 1023).cast("double")))
    return F.when(key < 0, -value).otherwise(value)


def _selected(df: DataFrame, columns: Sequence[str], probs: Sequence[float], by: Sequence[str]) -> DataFrame:
    """(by, _c, _i, _t, _low, _high): of the i-th probability of the c-th column, the keys of the two
    neighbouring ranks and the share of the way from the first to the second.

    Radix selection: a pass counts rows per group, column and leading bits of the sort key, which
    names the bucket of each wanted rank; the next pass looks only inside those buckets. A bucket
    of one value ends the search for its ranks, so there are at most ``len(SHIFTS)`` passes. Counts
    fold before they are shuffled, whatever the groups and values.

    Without groups the targets are a few rows, which come back as literals: later passes compare rows with
    them, where they stand, and read only the columns still open. If no open bucket has more rows than the
    last pass may meet keys, the next pass is the last.
    """
    def keyed(cs: Sequence[int]) -> DataFrame:
        values = [F.struct(F.lit(c).alias("_c"), F.col(f"`{columns[c]}`").cast("double").alias("_x")) for c in cs]
        rows = df.select(*[F.col(f"`{g}`") for g in by], F.explode(F.array(*values)).alias("_r"))
        rows = rows.select(*by, "_r._c", "_r._x").filter("_x is not null and not isnan(_x)")
        return rows.select(*by, "_c", sort_key(F.col("_x")).alias("_k"))

    names, found, open_, targets, shifts = [*by, "_c"], None, None, [], list(SHIFTS)
    while shifts:
        shift = shifts.pop(0)
        was = [] if open_ is None else ["_was"]
        inside = keyed(range(len(columns)))
        if was and by:
            buckets = open_.select(*names, F.col("_prefix").alias("_was")).distinct()
            inside = inside.withColumn("_was", F.shiftright("_k", last)).join(buckets, [*names, "_was"])
        elif was:
            buckets = {c: sorted({r["_prefix"] for r in targets if r["_c"] == c}) for c in sorted({r["_c"] for r in targets})}
            inside = keyed(list(buckets)).withColumn("_was", F.shiftright("_k", last))
            inside = inside.filter(reduce(or_, [(F.col("_c") == c) & F.col("_was").isin(b) for c, b in buckets.items()]))
        counts = inside.groupBy(*names, *was, F.shiftright("_k", shift).alias("_prefix")).agg(
            F.count("*").alias("_n"), F.min("_k").alias("_least"), F.max("_k").alias("_most"))
        part = Window.partitionBy(*names, *was)
        counts = counts.withColumn("_upto", F.sum("_n").over(part.orderBy("_prefix").rowsBetween(Window.unboundedPreceding, 0)))
        if was:
            hits = counts.join(open_.withColumnRenamed("_prefix", "_was"), [*names, "_was"])
        else:
            hits = counts.withColumn("_last", F.sum("_n").over(part) - 1)
            hits = hits.withColumn("_x", F.explode(_wanted(F.col("_last"), probs))).select("*", "_x.*")
        hits = hits.filter((F.col("_rank") < F.col("_upto")) & (F.col("_rank") >= F.col("_upto") - F.col("_n")))
        rank = F.col("_rank") - F.col("_upto") + F.col("_n")
        hits, last = hits.select(*names, "_i", "_side", "_t", "_prefix", rank.alias("_rank"), "_least", "_most", "_n"), shift
        if by:
            hits = cut_lineage(hits)
        else:
            met = hits.collect()
            targets, hits = [r for r in met if r["_least"] < r["_most"]], _literals(hits, met)
            if all(r["_n"] <= 2 ** (SHIFTS[-2] - SHIFTS[-1]) for r in targets):
                shifts = shifts[-1:]
        done = hits.filter("_least = _most").select(*names, "_i", "_side", "_t", F.col("_least").alias("_key"))
        found = done if found is None else found.unionByName(done)
        open_ = hits.filter("_least < _most").drop("_least", "_most", "_n")
        if open_.isEmpty() if by else not targets:
            break
    side = lambda s: F.max(F.when(F.col("_side") == s, F.col("_key")))
    return found.groupBy(*names, "_i").agg(F.max("_t").alias("_t"), side(0).alias("_low"), side(1).alias("_high"))


def _literals(df: DataFrame, rows: Sequence[Row]) -> DataFrame:
    """A few collected rows of ``df`` as literals, whose size the planner knows."""
    if not rows:
        return df.sparkSession.createDataFrame([], df.schema)
    made = [F.struct(*[F.lit(r[f.name]).cast(f.dataType).alias(f.name) for f in df.schema]) for r in rows]
    return df.sparkSession.range(1).select(F.inline(F.array(*made)))


def _wanted(last: Column, probs: Sequence[float]) -> Column:
    """The ranks around each probability's place among ``last`` + 1 values."""
    out = []
    for i, p in enumerate(probs):
        place = last * float(p)
        for side, rank in enumerate((F.floor(place), F.ceil(place))):
            out.append(F.struct(F.lit(i).alias("_i"), F.lit(side).alias("_side"), rank.cast("long").alias("_rank"), (place - F.floor(place)).alias("_t")))
    return F.array(*out)


def group_quantiles(df: DataFrame, columns: Sequence[str], probs: Sequence[float], by: Sequence[str]) -> DataFrame:
    """Linear-interpolated quantiles, one row per ``by`` group, columns ``<column>_q<i>``.

    Exact, by :func:`_selected`. NULL and NaN values are ignored, as are rows with a NULL group key and
    groups without values.
    """
    picked = _selected(df.dropna(subset=list(by)) if by else df, columns, probs, by)
    low, high = key_value(F.col("_low")), key_value(F.col("_high"))
    picked = picked.withColumn("_v", F.when(F.col("_low") == F.col("_high"), low).otherwise(low + (high - low) * F.col("_t")))
    mine = lambda c, i: F.max(F.when((F.col("_c") == c) & (F.col("_i") == i), F.col("_v")))
    return picked.groupBy(*by).agg(*[mine(c, i).alias(f"{name}_q{i}") for c, name in enumerate(columns) for i in range(len(probs))])


def global_quantiles(df: DataFrame, columns: Sequence[str], probs: Sequence[float]) -> dict[str, list[float | None]]:
    """Linear-interpolated quantiles of whole columns; a column without values has None for each.

    Every pass returns a row a column, probability and side to the driver.
    """
    row = group_quantiles(df, columns, probs, []).first()
    return {c: [row[f"{c}_q{i}"] if row else None for i in range(len(probs))] for c in columns}


def running_totals(df: DataFrame, order: Sequence[Column], totals: dict[str, str]) -> DataFrame:
    """Global running sums (inclusive) of the named columns over rows with distinct keys.

    Rows are range partitioned, written once, and each partition adds the total of the
    partitions before it. Duplicated order keys should be pre-aggregated by the caller.
    """
    ranged = df.repartitionByRange(*order).withColumn("_part", F.spark_partition_id())
    ranged = cut_lineage(ranged)
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    # One row per partition: the unpartitioned window below sees partitions, not rows.
    carry = (
        ranged.groupBy("_part")
        .agg(*[F.sum(src).alias(f"_{out}") for out, src in totals.items()])
        .select("_part", *[F.coalesce(F.sum(f"_{o}").over(before), F.lit(0)).alias(f"_c_{o}") for o in totals])
    )
    inside = Window.partitionBy("_part").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    return (
        ranged.join(carry, "_part")
        .select(
            *df.columns,
            *[(F.sum(src).over(inside) + F.col(f"_c_{out}")).alias(out) for out, src in totals.items()],
        )
    )


def row_index(df: DataFrame, order: Sequence[Column], name: str = "row_index") -> DataFrame:
    """0-based position of each row in the total order ``order`` (which must have no ties)."""
    return (
        running_totals(df.withColumn("_one", F.lit(1).cast("long")), order, {name: "_one"})
        .withColumn(name, F.col(name) - 1)
        .drop("_one")
    )
