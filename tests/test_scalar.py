import datetime as dt
import math

import pytest
from pyspark.sql import functions as F

from depotkit.functions import scalar as fn


def one(spark, expr, **cols):
    ddl = ", ".join(f"{c} {t}" for c, (t, _) in cols.items())
    df = spark.createDataFrame([tuple(v for _, v in cols.values())], ddl) if cols else spark.range(1)
    return df.select(expr.alias("x")).first().x


def test_rounding_is_half_even_on_the_scaled_value(spark):
    got = [one(spark, fn.round_even("v"), v=("double", v)) for v in (0.5, 1.5, 2.5)]
    assert got == [0.0, 2.0, 2.0]
    assert one(spark, fn.round_even("v", 2), v=("double", 1.005)) == 1.0
    assert one(spark, fn.round_even("v", 2), v=("double", 2.675)) == 2.68


def test_clip_keeps_null(spark):
    assert one(spark, fn.clip("v", 0, 1), v=("double", None)) is None
    assert [one(spark, fn.clip("v", 0, 1), v=("double", x)) for x in (-3.0, 0.4, 7.0)] == [0.0, 0.4, 1.0]


def test_number_and_day_coerce_to_null(spark):
    got = [one(spark, fn.number("v"), v=("string", x)) for x in ("12.5", "n/a", "nan", "", None)]
    assert got == [12.5, None, None, None, None]
    assert one(spark, fn.day("v"), v=("string", "2024-02-30")) is None
    assert one(spark, fn.day("v"), v=("string", "2024-02-29")) == dt.date(2024, 2, 29)


def test_boolean_tokens(spark):
    got = [one(spark, fn.truth_token("v"), v=("string", x)) for x in ("YES", "1", "True", "1.0", "", None, "no")]
    assert got == [True, True, True, False, False, False, False]
    assert one(spark, fn.truth_token("v"), v=("boolean", True)) is True
    got = [one(spark, fn.truth_or_true("v"), v=("string", x)) for x in (None, "False", "true")]
    assert got == [True, False, True]


def test_price_tiers_are_right_closed_and_bands_left_closed(spark):
    got = [one(spark, fn.price_tier("v"), v=("double", x)) for x in (20.0, 20.01, 100.0, 400.0, 400.01, 0.0, None)]
    assert got == [1, 2, 2, 3, 4, None, None]
    got = [one(spark, fn.price_band("v"), v=("double", x)) for x in (19.99, 20.0, 100.0, 500.0, None)]
    assert got == ["mass", "mid", "high", "luxury", None]


def test_text_remap_and_whitelist(spark):
    channel = fn.remapped(fn.normalised_text("v"), fn.CHANNEL_ALIASES)
    got = [one(spark, channel, v=("string", x)) for x in (" Web ", "B2B", "Store", "E-Commerce", "retail", None)]
    assert got == ["online", "wholesale", "retail", "online", "retail", None]
    got = [one(spark, fn.whitelisted("v", fn.RISK_TIERS, "medium"), v=("string", x)) for x in ("high", "odd", None)]
    assert got == ["high", "medium", "medium"]
    assert [one(spark, fn.tier_code("v"), v=("string", x)) for x in ("low", "critical", "odd", None)] == [0, 3, 1, 1]
    assert [one(spark, fn.tier_label("v"), v=("int", x)) for x in (0, 3, 9, None)] == ["low", "critical", "medium", "medium"]


@pytest.mark.parametrize("start", [dt.date(2023, 12, 20), dt.date(2020, 2, 25), dt.date(2021, 8, 28)])
def test_calendar_against_the_standard_library(spark, start):
    days = [start + dt.timedelta(days=i) for i in range(25)]
    df = spark.createDataFrame([(d,) for d in days], "d date").withColumns(fn.calendar("d")).orderBy("d")
    for r in df.collect():
        d = r.d
        last = (d + dt.timedelta(days=1)).day == 1
        assert (r.dow, r.month, r.quarter) == (d.weekday(), d.month, (d.month + 2) // 3)
        assert (r.week_of_year, r.day_of_year) == (d.isocalendar().week, d.timetuple().tm_yday)
        assert (r.is_weekend, r.is_month_start, r.is_month_end) == (int(d.weekday() > 4), int(d.day == 1), int(last))
        assert r.is_quarter_end == int(last and d.month in (3, 6, 9, 12))
        assert math.isclose(r.woy_sin, math.sin(2 * math.pi * d.isocalendar().week / 52), abs_tol=1e-12)
        assert math.isclose(r.dow_cos, math.cos(2 * math.pi * d.weekday() / 7), abs_tol=1e-12)
        holiday = (d.month == 11 and d.day >= 25) or (d.month == 12 and d.day >= 15) or (d.month == 1 and d.day <= 7)
        assert r.is_holiday_period == int(holiday)
        assert r.is_back_to_school == int(d.month == 8 or (d.month == 9 and d.day <= 15))


def test_business_columns(spark):
    assert one(spark, fn.revenue(F.lit(3), F.lit(9.99), F.lit(10.0))) == 26.97
    assert one(spark, fn.net_quantity("q", "r"), q=("long", 5), r=("boolean", True)) == 0
    assert one(spark, fn.available("a", "b"), a=("long", 3), b=("long", 5)) == 0
    assert one(spark, fn.below("a", "b"), a=("long", 3), b=("long", None)) is False
    assert one(spark, fn.turnover("m", "s"), m=("double", 5.0), s=("double", 0.0)) == 999.0
    assert one(spark, fn.spike("v", "m", "s"), v=("double", 9.0), m=("double", None), s=("double", 0.0)) == 0
    assert one(spark, fn.tenure_years("d"), d=("date", dt.date(2022, 6, 1))) == 2.58
    low, high = fn.interval_around("p")
    assert (one(spark, low, p=("double", 10.0)), one(spark, high, p=("double", 10.0))) == (8.0, 12.0)


def test_integer_keeps_large_ids_apart(spark):
    rows = [("9007199254740992",), ("9007199254740993",), ("12.7",), ("1e30",), ("S-001",), (" 7 ",), (None,)]
    got = spark.createDataFrame(rows, "x string").select(fn.integer("x").alias("x")).collect()
    assert [r.x for r in got] == [9007199254740992, 9007199254740993, 12, None, None, 7, None]


def test_ids_of_odd_spelling(spark):
    text = {"+7": (7, 7, "7"), "07": (7, 7, "7"), "7.9": (7, None, "7.9"), "1e3": (1000, 1000, "1000"), "-7": (-7, -7, "-7"), " S-1 ": (None, None, "S-1"),
            "S-1": (None, None, "S-1"), "e5": (None, None, "e5"), "_7": (None, None, "_7"), "~": (None, None, "~"), "٣": (3, 3, "3"), "é1": (None, None, "é1"),
            "7\x7f": (None, None, "7\x7f"), "9223372036854775808": (None, None, "9223372036854775808")}
    df = spark.createDataFrame([(t,) for t in text], "i string")
    assert [tuple(r) for r in df.select(fn.integer("i"), fn.whole_number("i"), fn.text_id("i")).collect()] == list(text.values())
    for kind, values, want in (("double", [7.5, 7.0, None], [(7, None, "7.5"), (7, 7, "7"), (None,) * 3]), ("boolean", [True, None], [(1, 1, "1"), (None,) * 3]),
                               ("bigint", [2**63 - 1, None], [(2**63 - 1, 2**63 - 1, str(2**63 - 1)), (None,) * 3])):
        typed = spark.createDataFrame([(v,) for v in values], f"i {kind}")
        assert [tuple(r) for r in typed.select(fn.integer("i"), fn.whole_number("i"), fn.text_id("i")).collect()] == want
