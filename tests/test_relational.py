"""Blackout windows against a plain loop."""

import datetime as dt
import random
import re

import pytest

from depotkit.operators import relational as rel
from pyspark.sql import functions as F

START = dt.date(1969, 11, 1)  # both sides of day zero


def day(n):
    return None if n is None else START + dt.timedelta(days=n)


def outside(spark, rows, windows):
    df = spark.createDataFrame([(i, k, day(n)) for i, (k, n) in enumerate(rows)], "id int, k string, d date")
    w = spark.createDataFrame([(k, day(a), day(b)) for k, a, b in windows], "k string, s date, e date")
    return rel.outside_windows(df, w, "k", "d", "s", "e")


def test_windows_that_overlap_nest_and_touch(spark):
    rng = random.Random(7)
    keys = ["a", "b", "c", None]
    rows = [(rng.choice(keys), rng.choice([None, *range(400)])) for _ in range(2000)] * 2
    windows = [("a", 10, 80), ("a", 20, 30), ("a", 80, 141), ("a", 142, 142), ("b", 61, 62), ("b", 300, 100000), ("b", 310, 290),
               ("c", -100000, 0), ("c", 123, 124), ("c", None, 50), ("c", 50, None), (None, 0, 400), ("z", 0, 400)]
    windows += [(rng.choice("abc"), a, a + rng.choice([0, 1, 5])) for a in rng.sample(range(400), 30)]
    blocked = lambda k, n: k and n is not None and any(w == k and a is not None and b is not None and a <= n <= b for w, a, b in windows)
    got = sorted(r.id for r in outside(spark, rows, windows).collect())
    assert got == [i for i, (k, n) in enumerate(rows) if not blocked(k, n)]


def test_no_rows_no_windows(spark):
    assert outside(spark, [], [("a", 1, 2)]).collect() == []
    assert outside(spark, [("a", 1), ("a", None)], []).count() == 2
    assert outside(spark, [("a", None)], [("a", 1, 2)]).count() == 1


def test_many_windows_of_one_key_are_a_row_a_block(spark):
    """A row meets at most one partner: 2,000 windows that all hold the same days are one row."""
    windows = spark.range(2000).select(F.lit("a").alias("k"), F.lit(day(0)).alias("s"), F.lit(day(40)).alias("e"))
    df = spark.range(3000).select("id", F.lit("a").alias("k"), F.date_add(F.lit(day(0)), F.pmod("id", F.lit(60)).cast("int")).alias("d"))
    got = rel.outside_windows(df, windows, "k", "d", "s", "e")
    assert got.count() == 3000 * 19 // 60
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    assert "LeftOuter" in plan and "LeftAnti" not in plan


def test_only_dates(spark):
    df = spark.sql("select 'a' k, timestamp'2024-01-01' d")
    w = spark.sql("select 'a' k, date'2024-01-01' s, date'2024-01-02' e")
    with pytest.raises(TypeError, match="timestamp"):
        rel.outside_windows(df, w, "k", "d", "s", "e")


def test_blocks_of_windows_grow_in_many_tasks_and_are_not_sent_to_all(spark):
    got = outside(spark, [("a", 5), ("a", 500), ("b", 5)], [("a", 0, 400)] * 50)
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "BroadcastHashJoin" not in plan
    assert re.search(r"Generate explode.*?Exchange hashpartitioning\(_k#\d+, _s#\d+", plan, re.S)
    assert sorted(r.id for r in got.collect()) == [1, 2]
