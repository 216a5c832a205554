"""Column expressions shared by the operators. All are built-in Spark expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def stable_id(*columns: Column) -> Column:
    """64-bit id from the text of the columns; NULL counts as empty text.

    The first 60 bits of an md5 digest, so any engine can compute the same id.
    """
    text = F.concat_ws("|", *[F.coalesce(c.cast("string"), F.lit("")) for c in columns])
    return F.conv(F.substring(F.md5(text), 1, 15), 16, 10).cast("bigint")


def ratio(numerator: Column, denominator: Column) -> Column:
    """Division that is NULL on a zero or NULL denominator."""
    return F.try_divide(numerator.cast("double"), denominator.cast("double"))


def round_double(value: Column, digits: int) -> Column:
    """Rounds half away from zero after scaling in double arithmetic, as SQL engines do.

    ``F.round`` looks at the exact decimal digits instead, and so takes 3.325, which is held as
    3.3249999999999997, to 3.32.
    """
    scale = float(10**digits)
    return F.round(value * scale) / scale


def sunday_week(day: Column) -> Column:
    """Week of the year counted from Sundays; days before the first Sunday are week 0."""
    return F.floor((F.dayofyear(day) + 7 - F.dayofweek(day)) / 7).cast("int")


def week_label(day: Column, iso_year: bool = False) -> Column:
    """``2018-W07``. The year is the calendar year unless ``iso_year`` asks for the week's own."""
    if iso_year:
        year = F.extract(F.lit("YEAROFWEEK"), day)
    else:
        year = F.year(day)
    return F.concat(
        year.cast("string"), F.lit("-W"), F.lpad(F.weekofyear(day).cast("string"), 2, "0")
    )


def event_param(key: str, slot: str, params: str = "event_params") -> Column:
    """Value of the first parameter named ``key``, from its typed slot; NULL when absent."""
    hits = F.filter(F.col(params), lambda p: p["key"] == key)
    return F.get(hits, F.lit(0))["value"][slot]


def risk_tier(probability: Column) -> Column:
    """Right-closed bins of width 0.2 over (0, 1]; outside of them there is no tier."""
    return (
        F.when(probability <= 0, F.lit(None))
        .when(probability <= 0.2, "very_low")
        .when(probability <= 0.4, "low")
        .when(probability <= 0.6, "medium")
        .when(probability <= 0.8, "high")
        .when(probability <= 1.0, "very_high")
    )
