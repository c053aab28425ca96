"""Null-safe scalar building blocks shared by all plans."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

ColumnLike = Column | str

# Fixed values.
TRUE_TOKENS = ("true", "1", "yes")
CHANNEL_ALIASES = {"e-commerce": "online", "web": "online", "store": "retail", "b2b": "wholesale"}
RISK_TIERS = ("low", "medium", "high", "critical")
COUNTRY_TIER_3 = ("Bangladesh", "Indonesia", "Pakistan", "Nigeria")
COUNTRY_TIER_2 = ("India", "Vietnam", "China", "Mexico", "Brazil")
TENURE_REFERENCE_DAY = "2024-12-31"
EPS = 1e-9
WHOLE_TYPES = ("tinyint", "smallint", "int", "bigint")


def col(c: ColumnLike) -> Column:
    return F.col(c) if isinstance(c, str) else c


def clip(c: ColumnLike, lo: float | Column | None = None, hi: float | Column | None = None) -> Column:
    """Bound a value; NULL stays NULL (``least``/``greatest`` alone would skip it)."""
    x = col(c)
    out = x
    if hi is not None:
        out = F.least(out, hi if isinstance(hi, Column) else F.lit(float(hi)))
    if lo is not None:
        out = F.greatest(out, lo if isinstance(lo, Column) else F.lit(float(lo)))
    return F.when(x.isNotNull(), out)


def round_even(c: ColumnLike, digits: int = 0) -> Column:
    """Round half to even on the scaled binary value."""
    scale = float(10**digits)
    return F.rint(col(c) * scale) / scale if digits else F.rint(col(c))


def whole(c: ColumnLike) -> Column:
    return F.rint(col(c)).cast("long")


def number(c: ColumnLike) -> Column:
    """Text or number to double; unparsable text and NaN become NULL."""
    return F.nanvl(col(c).try_cast("double"), F.lit(None).cast("double"))


def integer(c: ColumnLike) -> Column:
    """Text or number to long without a double in between, so ids beyond 2^53 stay apart; a fraction
    is cut off, and what is no number or too large becomes NULL."""
    x = col(c)
    return _plainly(x, lambda plain: plain, _decimal(x).try_cast("long"))


def whole_number(c: ColumnLike) -> Column:
    """Text or number to long if it is a whole number that fits, else NULL."""
    x = col(c)
    return _plainly(x, lambda plain: plain, _whole_decimal(x))


def text_id(c: ColumnLike) -> Column:
    """An id kept as text; whole numbers are written alike, blanks are NULL."""
    x = col(c)
    text = F.trim(x.cast("string"))
    return _plainly(x, lambda plain: plain.cast("string"), F.coalesce(_whole_decimal(x).cast("string"), F.nullif(text, F.lit(""))))


def _named(x: Column) -> Column:
    """Whether text begins with an ASCII letter or the like, so that it writes no number: parsing it would cost
    an exception each time."""
    return F.coalesce((F.typeof(x) == "string") & x.cast("string").between("A", "~"), F.lit(False))


def _decimal(x: Column) -> Column:
    return F.when(~_named(x), x.try_cast("decimal(38,9)"))


def _whole_decimal(x: Column) -> Column:
    exact = _decimal(x)
    return F.when(exact == F.floor(exact), exact.try_cast("long"))


def _plainly(x: Column, made: Callable[[Column], Column], otherwise: Column) -> Column:
    """``made`` of the long that ``x`` holds as a long or writes in its plain digits, else ``otherwise``.

    Most ids are such, and decimals cost several times as much. The type is known before any row is read.
    """
    plain = F.when(~_named(x), x.try_cast("long"))
    digits = F.when(plain.cast("string") == x.cast("string"), made(plain)).otherwise(otherwise)
    whole_type, text_type = F.typeof(x).isin(*WHOLE_TYPES), F.typeof(x) == "string"
    return F.when(whole_type, made(plain)).when(text_type, digits).otherwise(otherwise)


def day(c: ColumnLike) -> Column:
    return col(c).try_cast("date")


def utc_timestamp(c: ColumnLike) -> Column:
    """Text or timestamp to timestamp; text without a zone is read as UTC, whatever the session's zone."""
    x = col(c)
    text = x.cast("string")
    as_utc = [F.concat(text, F.lit(zone)).try_cast("timestamp") for zone in ("Z", " 00:00:00Z")]
    return F.when(F.typeof(x) == "string", F.coalesce(*as_utc, x.try_cast("timestamp"))).otherwise(x.try_cast("timestamp"))


def utc_day(c: ColumnLike) -> Column:
    """The day of a timestamp in UTC, whatever the session's zone; a day stays as it is."""
    x = col(c)
    seconds = F.unix_seconds(x.cast("timestamp"))
    in_utc = F.date_from_unix_date(F.floor(seconds / 86400).cast("int"))
    return F.when(F.typeof(x) == "timestamp", in_utc).otherwise(x.cast("date"))


def truth_token(c: ColumnLike) -> Column:
    return F.coalesce(F.lower(col(c).cast("string")).isin(*TRUE_TOKENS), F.lit(False))


def truth_or_true(c: ColumnLike) -> Column:
    return F.coalesce(col(c).try_cast("boolean"), F.lit(True))


def flag(condition: Column) -> Column:
    """Condition as 0/1, where an unknown condition counts as 0."""
    return F.coalesce(condition.cast("int"), F.lit(0))


def normalised_text(c: ColumnLike) -> Column:
    return F.lower(F.trim(col(c)))


def remapped(c: ColumnLike, mapping: dict[str, str]) -> Column:
    pairs = F.create_map(*[F.lit(x) for kv in mapping.items() for x in kv])
    return F.coalesce(F.try_element_at(pairs, col(c)), col(c))


def whitelisted(c: ColumnLike, allowed: tuple[str, ...], default: str) -> Column:
    return F.when(col(c).isin(*allowed), col(c)).otherwise(F.lit(default))


# ---- business columns -------------------------------------------------------


def revenue(quantity: ColumnLike, price: ColumnLike, discount_pct: ColumnLike) -> Column:
    return round_even(col(quantity) * col(price) * (1 - col(discount_pct) / 100), 2)


def net_quantity(quantity: ColumnLike, returned: ColumnLike) -> Column:
    return F.when(col(returned), F.lit(0).cast("long")).otherwise(col(quantity))


def available(on_hand: ColumnLike, reserved: ColumnLike) -> Column:
    left = col(on_hand) - col(reserved)
    return F.when(left.isNotNull(), F.greatest(left, F.lit(0).cast("long")))


def below(level: ColumnLike, threshold: ColumnLike) -> Column:
    return F.coalesce(col(level) <= col(threshold), F.lit(False))


def weekday0(d: ColumnLike) -> Column:
    """Monday is 0."""
    return F.weekday(col(d))


def month_of(ts: ColumnLike) -> Column:
    """First day of the month of a day or timestamp, the latter in UTC."""
    return F.trunc(utc_day(ts), "MM")


def calendar(d: ColumnLike) -> dict[str, Column]:
    """The 17 calendar columns of a day."""
    x = col(d)
    month, dom, dow, week = F.month(x), F.dayofmonth(x), F.weekday(x), F.weekofyear(x)
    month_end = F.last_day(x) == x
    circle = {"month": (month, 12), "dow": (dow, 7), "woy": (week, 52)}
    out = {
        "dow": dow,
        "month": month,
        "quarter": F.quarter(x),
        "week_of_year": week,
        "day_of_year": F.dayofyear(x),
        "is_weekend": flag(dow >= 5),
        "is_month_start": flag(dom == 1),
        "is_month_end": flag(month_end),
        "is_quarter_end": flag(month_end & (month % 3 == 0)),
    }
    for name, (value, period) in circle.items():
        angle = value * (2 * F.pi() / period)
        out[f"{name}_sin"] = F.sin(angle)
        out[f"{name}_cos"] = F.cos(angle)
    out["is_holiday_period"] = flag(
        ((month == 11) & (dom >= 25)) | ((month == 12) & (dom >= 15)) | ((month == 1) & (dom <= 7))
    )
    out["is_back_to_school"] = flag((month == 8) | ((month == 9) & (dom <= 15)))
    return out


def price_tier(price: ColumnLike) -> Column:
    """Right-closed tiers (0,20] (20,100] (100,400] (400,inf); NULL outside."""
    p = col(price)
    return (
        F.when(p <= 0, None).when(p <= 20, 1).when(p <= 100, 2).when(p <= 400, 3).when(p > 400, 4).cast("int")
    )


def price_band(price: ColumnLike) -> Column:
    """Left-closed demand bands <20, <100, <500, else; NULL stays NULL."""
    p = col(price)
    return F.when(p < 20, "mass").when(p < 100, "mid").when(p < 500, "high").when(p.isNotNull(), "luxury")


def indicator(c: ColumnLike, value: str) -> Column:
    return flag(col(c) == F.lit(value))


def turnover(mean_30d: ColumnLike, avg_stock_30d: ColumnLike) -> Column:
    return clip(col(mean_30d) * 30 / (col(avg_stock_30d) + EPS), hi=999)


def days_of_cover(available_qty: ColumnLike, mean_7d: ColumnLike) -> Column:
    return clip(col(available_qty) / (col(mean_7d) + EPS), hi=365)


def lead_time_cover(available_qty: ColumnLike, mean_7d: ColumnLike, lead_days: ColumnLike) -> Column:
    return clip(col(available_qty) / (col(mean_7d) * col(lead_days) + EPS), hi=10)


def demand_to_stock(mean_7d: ColumnLike, on_hand: ColumnLike) -> Column:
    return clip(col(mean_7d) / (col(on_hand) + EPS), hi=10)


def spike(value: ColumnLike, mean: ColumnLike, std: ColumnLike) -> Column:
    return flag(col(value) > col(mean) + 2 * col(std))


def tenure_years(since: ColumnLike) -> Column:
    return round_even(F.datediff(F.lit(TENURE_REFERENCE_DAY).cast("date"), col(since)) / 365.25, 2)


def country_tier(country: ColumnLike) -> Column:
    c = col(country)
    return F.when(c.isin(*COUNTRY_TIER_3), 3).when(c.isin(*COUNTRY_TIER_2), 2).otherwise(1)


def tier_code(tier: ColumnLike) -> Column:
    t = col(tier)
    out = F.when(t == RISK_TIERS[0], 0)
    for code, name in enumerate(RISK_TIERS[1:], start=1):
        out = out.when(t == name, code)
    return out.otherwise(1)


def tier_label(code: ColumnLike) -> Column:
    names = F.array(*[F.lit(t) for t in RISK_TIERS])
    return F.coalesce(F.get(names, col(code).cast("int")), F.lit("medium"))


def interval_around(predicted: ColumnLike, share: float = 0.20) -> tuple[Column, Column]:
    """Lower (never negative) and upper bound at +-share."""
    p = col(predicted)
    margin = p * share
    low = F.when(p.isNotNull(), F.greatest(F.lit(0.0), round_even(p - margin, 2)))
    return low, round_even(p + margin, 2)
