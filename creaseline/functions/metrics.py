"""The shared metrics as Column builders, and other scalar rules that several tables use."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Dismissals credited to the bowler.
BOWLER_KINDS = ("caught", "bowled", "lbw", "stumped", "caught and bowled", "hit wicket")
T20_TYPES, ODI_TYPES = ("T20", "IT20", "T20B"), ("ODI", "ODM")


def _c(x: Column | str) -> Column:
    return F.col(x) if isinstance(x, str) else x


def total(condition: Column) -> Column:
    """How many rows hold it, as a long; null conditions don't count; 0 needs at least one row."""
    return F.sum(F.when(condition, 1).otherwise(0)).cast("long")


def rounded(x: Column, digits: int = 2) -> Column:
    """Half away from zero on the scaled double, which any engine computes alike (decimal rounding of doubles differs between engines)."""
    scale = float(10**digits)
    # adding 0.0 turns a negative zero into zero
    return F.signum(x) * F.floor(F.abs(x) * F.lit(scale) + F.lit(0.5)).cast("double") / F.lit(scale) + F.lit(0.0)


def ratio(top: Column | str, bottom: Column | str, factor: float = 1.0, digits: int = 2) -> Column:
    """factor * top / bottom in doubles, rounded; null if bottom is 0."""
    low = _c(bottom).cast("double")
    return rounded(_c(top).cast("double") * F.lit(float(factor)) / F.when(low != 0, low), digits)


def strike_rate(runs, balls) -> Column:
    return ratio(runs, balls, 100)


def economy(runs, balls, per_over: int = 6) -> Column:
    return ratio(runs, balls, per_over)


run_rate = economy


def average(runs, outs) -> Column:
    return ratio(runs, outs)


def percentage(part, whole, digits: int = 2) -> Column:
    return ratio(part, whole, 100, digits)


def overs(balls, per_over: int = 6) -> Column:
    return rounded(_c(balls).cast("double") / F.lit(float(per_over)), 1)


def phase(match_type: Column, over: Column) -> Column:
    """Powerplay, middle or death by format and zero-based over; null for formats without phases."""
    ladder = lambda first, second: F.when(over < first, "powerplay").when(over < second, "middle").otherwise("death")
    return F.when(match_type.isin(*T20_TYPES), ladder(6, 15)).when(match_type.isin(*ODI_TYPES), ladder(10, 40))


def season_year(season: Column) -> Column:
    """The first year of seasons such as 2002/03."""
    year = F.regexp_extract(season, r"^(\d{4})", 1)
    return F.when(year != "", year.cast("int"))


def row_hash(*columns: Column) -> Column:
    """sha256 of the values joined by |, nulls as __NULL__."""
    return F.sha2(F.concat_ws("|", *[F.coalesce(c.cast("string"), F.lit("__NULL__")) for c in columns]), 256)


def date_parts(day: Column) -> dict[str, Column]:
    """Attributes of a calendar day. Weeks start on Monday and count from 0; days of the week from Sunday = 0."""
    sunday0 = F.dayofweek(day) - 1
    return {
        "date_id": F.date_format(day, "yyyyMMdd").cast("int"),
        "date": day,
        "year": F.year(day),
        "month": F.month(day),
        "day": F.dayofmonth(day),
        "day_of_year": F.dayofyear(day),
        "quarter": F.quarter(day),
        "week_of_year": F.floor((F.dayofyear(day) - 1 + 7 - F.weekday(day)) / 7).cast("int"),
        "day_of_week": sunday0,
        "day_name": F.date_format(day, "EEEE"),
        "month_name": F.date_format(day, "MMMM"),
        "year_month": F.date_format(day, "yyyy-MM"),
        "is_weekend": sunday0.isin(0, 6),
    }
