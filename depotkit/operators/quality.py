"""Contract checks as audit rows.

The audit reads each table once: all checks are counts of tagged entries of its rows, one for the scalar
checks it violates, one for its key and one a reference. They fold per key first, so a hot key or a pile of
NULL keys is folded before the one shuffle.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from depotkit.functions import scalar as fn
from depotkit.schemas import AUDIT_COLUMNS, AUDIT_DDL, CONTRACTS, Contract


def missing_columns(df: DataFrame, required: tuple[str, ...]) -> list[str]:
    return [c for c in required if c not in df.columns]


def surplus_keys(df: DataFrame, key: str) -> DataFrame:
    """Rows beyond the first of their key; NULL keys equal each other."""
    return df.groupBy(key).count().agg(F.coalesce(F.sum(F.col("count") - 1), F.lit(0)).alias("surplus"))


def orphan_rows(df: DataFrame, key: str, reference: DataFrame, reference_key: str) -> DataFrame:
    """Rows whose key is not among the reference keys; a NULL key is an orphan unless NULL is one."""
    per_key = df.groupBy(F.col(key).alias("_fk")).agg(F.count("*").alias("_n"))
    known = reference.select(F.col(reference_key).alias("_pk")).distinct()
    return (
        per_key.join(known, F.col("_fk").eqNullSafe(F.col("_pk")), "left_anti")
        .agg(F.coalesce(F.sum("_n"), F.lit(0)).alias("orphans"))
    )


def scalar_counts(df: DataFrame, contract: Contract) -> DataFrame:
    """One row: n and the NULL, range and sign violations of every contracted column."""
    have = set(df.columns)
    outs: list[Column] = [F.count("*").alias("n")]
    outs += [F.count_if(F.col(c).isNull()).alias(f"null_{c}") for c in contract.not_null if c in have]
    for c, (lo, hi) in contract.ranges.items():
        if c in have:
            x = fn.number(c)
            outs.append(F.count_if((x < lo) | (x > hi)).alias(f"range_{c}"))
    outs += [F.count_if(fn.number(c) < 0).alias(f"neg_{c}") for c in contract.non_negative if c in have]
    return df.agg(*outs)


def _thousands(c: Column) -> Column:
    return F.format_number(c, 0)


def _expected(table: str, have: set[str], references: Mapping[str, DataFrame]) -> list[tuple[str, str, str, str]]:
    """(check, kind, name among the counts, text behind the count) of a table's audit rows, in contract order."""
    c = CONTRACTS[table]
    rows = [("required_cols", "all", "", "All required columns present")]
    if c.primary_key in have:
        rows.append(("pk_unique", "key", "pk", f" duplicate PKs in '{c.primary_key}'"))
    rows += [(f"not_null:{x}", "null", f"null:{x}", " nulls (") for x in c.not_null if x in have]
    rows += [(f"range:{x}", "count", f"range:{x}", f" values outside [{lo},{hi}]") for x, (lo, hi) in c.ranges.items() if x in have]
    rows += [(f"non_neg:{x}", "count", f"neg:{x}", " negative values") for x in c.non_negative if x in have]
    rows += [(f"fk:{x}", "count", f"fk:{x}", " orphaned FK values") for x, ref in c.foreign_keys.items() if x in have and ref in references]
    return [*rows, ("row_count", "rows", "rows", " rows")]


def _flags(table: str, have: set[str]) -> dict[str, Column]:
    """Whether a row violates a scalar check, by name."""
    c = CONTRACTS[table]
    flags = {f"null:{x}": F.col(x).isNull() for x in c.not_null if x in have}
    flags |= {f"range:{x}": (fn.number(x) < lo) | (fn.number(x) > hi) for x, (lo, hi) in c.ranges.items() if x in have}
    return flags | {f"neg:{x}": fn.number(x) < 0 for x in c.non_negative if x in have}


def _places(tables: Mapping[str, DataFrame], references: Mapping[str, DataFrame]) -> dict[str, tuple[int, int]]:
    """(pool, slot) of each count by name. A table's keys, at slot 0, and the references to them, from 1,
    share the pool of its place among the contracts; its rows, at slot 0, and its scalar checks have a pool below 0."""
    pool = {t: i for i, t in enumerate(CONTRACTS)}
    places = {f"{t}|pk": (i, 0) for t, i in pool.items()}
    referred = dict.fromkeys(pool, 0)
    for t, df in tables.items():
        have = set(df.columns)
        places[f"{t}|rows"] = (-1 - pool[t], 0)
        places |= {f"{t}|{name}": (-1 - pool[t], i) for i, name in enumerate(_flags(t, have), 1)}
        for x, ref in CONTRACTS[t].foreign_keys.items():
            if x in have and ref in references:
                referred[ref] += 1
                places[f"{t}|fk:{x}"] = (pool[ref], referred[ref])
    return places


def _tagged(df: DataFrame, table: str, audited: bool, references: Mapping[str, DataFrame], places: Mapping[str, tuple[int, int]]) -> DataFrame:
    """(pool, key, slot) entries of every row: its key in the pool of its table, its references in the pools
    of theirs, and, as a key of a pool of their own, a 0 or 1 for each scalar check of the table."""
    c, have = CONTRACTS[table], set(df.columns)

    def entry(name: str, key: Column) -> Column:
        pool, slot = places[f"{table}|{name}"]
        return F.struct(F.lit(pool).alias("pool"), key.cast("string").alias("key"), F.lit(slot).alias("slot"))

    entries = [entry("pk", F.col(c.primary_key))] if c.primary_key in have else []
    if audited:
        marks = [F.when(bad, "1").otherwise("0") for bad in _flags(table, have).values()]
        entries.append(entry("rows", F.concat(*marks) if marks else F.lit("")))
        entries += [entry(f"fk:{x}", F.col(x)) for x, ref in c.foreign_keys.items() if x in have and ref in references]
    return df.select(F.inline(F.array(*entries)))


def validate_all(tables: Mapping[str, DataFrame], references: Mapping[str, DataFrame] | None = None) -> DataFrame:
    """The audit rows of all tables, in their order and that of their contracts, from one read of each.

    All checks are counts of tagged entries by (pool, key), so that a table's keys meet the references to
    them in one shuffle, with a count for each slot. Copies of a key, NULL keys and rows that violate the
    same scalar checks fold before it. Keys are compared as text. Missing required columns raise.
    """
    references = references or {}
    for table, df in tables.items():
        missing = missing_columns(df, CONTRACTS[table].required)
        if missing:
            raise ValueError(f"[{table}] Missing columns: {missing}")
    needed = {ref for t, df in tables.items() for x, ref in CONTRACTS[t].foreign_keys.items() if x in df.columns and ref in references}
    same = {t for t in tables if t in needed and references[t] is tables[t]}
    places = _places(tables, references)
    reads = [_tagged(df, t, True, references, places) for t, df in tables.items()]
    reads += [_tagged(references[t].select(CONTRACTS[t].primary_key), t, False, references, places) for t in sorted(needed - same)]
    tagged = reads[0]
    for more in reads[1:]:
        tagged = tagged.unionByName(more)
    slots = range(1, 1 + max((slot for pool, slot in places.values() if pool >= 0), default=0))
    per_key = tagged.groupBy("pool", "key").agg(
        F.count_if(F.col("slot") == 0).alias("own"), *[F.count_if(F.col("slot") == i).alias(f"from{i}") for i in slots])
    # A row a pool of keys, and one for each set of scalar checks that rows violate.
    sums = per_key.groupBy("pool", F.when(F.col("pool") < 0, F.col("key")).alias("marks")).agg(
        F.sum("own").alias("rows"), F.sum(F.when(F.col("own") > 0, F.col("own") - 1).otherwise(0)).alias("bad0"),
        *[F.sum(F.when(F.col("own") == 0, F.col(f"from{i}")).otherwise(0)).alias(f"bad{i}") for i in slots])
    count = lambda slot, n: F.struct(slot.cast("int").alias("slot"), n.cast("long").alias("bad"))
    marked = F.transform(F.split("marks", ""), lambda m, i: count(i + 1, F.when(m == "1", F.col("rows")).otherwise(0)))
    by_slot = F.when(F.col("pool") >= 0, F.array(*[count(F.lit(i), F.col(f"bad{i}")) for i in (0, *slots)])).otherwise(
        F.concat(F.array(count(F.lit(0), F.col("rows"))), marked))
    found = sums.select("pool", F.inline(by_slot)).groupBy("pool", "slot").agg(F.sum("bad").alias("bad"))

    # A dozen rows a table, from the contracts.
    rows = [(i, t, *row[:2], *places.get(f"{t}|{row[2]}", (None, None)), row[3]) for i, (t, row) in enumerate(
        (t, row) for t, df in tables.items() for row in _expected(t, set(df.columns), references))]
    spark = next(iter(tables.values())).sparkSession
    out = spark.createDataFrame(rows, "ord int, table string, check string, kind string, pool int, slot int, text string").join(found, ["pool", "slot"], "left")
    out = out.withColumn("bad", F.coalesce("bad", F.lit(0)).cast("long"))
    n = F.coalesce(F.max(F.when(F.col("kind") == "rows", F.col("bad"))).over(Window.partitionBy("table")), F.lit(0))
    out = out.withColumn("n", n)
    kind, pct = F.col("kind"), F.try_divide(F.col("bad"), F.col("n")) * 100  # NULL on an empty table
    share = F.format_string("%.1f", F.rint(F.coalesce(pct, F.lit(0.0)) * 10) / 10)
    status = (
        F.when(kind == "all", "PASS").when(kind == "rows", F.when(F.col("n") == 0, "FAIL").otherwise("PASS"))
        .when((kind == "null") & (pct > 10), "FAIL").when(F.col("bad") > 0, "WARN").otherwise("PASS")
    )
    detail = F.when(kind == "all", F.col("text")).when(kind == "null", F.concat(_thousands("bad"), "text", share, F.lit("%)"))).otherwise(
        F.concat(_thousands("bad"), "text"))
    kept = F.when(kind.isin("all", "key", "rows"), F.col("n")).otherwise(0).cast("long")
    return out.orderBy("ord").select(
        "table", F.lit("validate").alias("stage"), "check", status.alias("status"), F.col("n").alias("rows_in"), kept.alias("rows_out"), detail.alias("detail"))


def validate(table: str, df: DataFrame, references: Mapping[str, DataFrame] | None = None) -> DataFrame:
    """The audit rows of one table, in contract order."""
    return validate_all({table: df}, references)


def audit_row(spark, table: str, stage: str, check: str, status: str, rows_in: int, rows_out: int, detail: str):
    """A single reconciliation row, for figures the driver already holds."""
    return spark.createDataFrame([(table, stage, check, status, rows_in, rows_out, detail)], AUDIT_DDL)


def combine(parts: list[DataFrame]) -> DataFrame:
    out = parts[0].select(*AUDIT_COLUMNS)
    for p in parts[1:]:
        out = out.unionByName(p.select(*AUDIT_COLUMNS))
    return out


def audit_summary(audit: DataFrame) -> DataFrame:
    return audit.groupBy("status").agg(F.count("*").alias("entries"))
