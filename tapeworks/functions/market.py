"""Measures, time attributes and keys."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: stands for NULL inside a surrogate key.
NULL_KEY_PART = "_dbt_utils_surrogate_key_null_"


def fill_missing(value: Column, default: float | int) -> Column:
    """Replace NULL and, in a floating-point column (float default), NaN."""
    if isinstance(default, float):
        value = F.nanvl(value, F.lit(None).cast("double"))
    return F.coalesce(value, F.lit(default))


def mean(value: Column | str) -> Column:
    """Average without the last bits that depend on the order of summation.

    Bands are read off averages; noise of 1e-16 around zero must not flip a label.
    """
    return F.round(F.avg(value), 9) + F.lit(0.0)


def range_volatility(low: Column, high: Column, average: Column) -> Column:
    """Spread of prices in percent of their average."""
    return F.try_divide(high - low, average) * 100


def dollar_volume(rules: str, price: Column, volume: Column,
                  previous_close: Column | None = None) -> Column:
    """``batch``: price times volume. ``warehouse``: volume weighted by the relative change."""
    if rules == "batch":
        return price * volume
    if rules == "warehouse" and previous_close is not None:
        weighted = (price - previous_close) / previous_close * volume
        return F.when(previous_close > 0, weighted).otherwise(F.lit(0.0))
    raise ValueError(f"unknown dollar volume rules: {rules}")


def time_dims(time: Column) -> dict[str, Column]:
    """Date, hour, day of week (0 = Sunday) and Weekend/Weekday of a quote."""
    day = F.dayofweek(time) - 1
    return {
        "quote_date": F.to_date(time),
        "quote_hour": F.hour(time),
        "day_of_week": day,
        "day_type": F.when(day.isin(0, 6), "Weekend").otherwise("Weekday"),
    }


def surrogate_key(*parts: Column) -> Column:
    texts = [F.coalesce(part.cast("string"), F.lit(NULL_KEY_PART)) for part in parts]
    return F.md5(F.concat_ws("-", *texts))


def safe_ratio(part: Column, whole: Column) -> Column:
    """part / whole, and 0 where the whole is not positive or unknown."""
    return F.when(whole > 0, part / whole).otherwise(F.lit(0.0))


def safe_pct(part: Column, whole: Column) -> Column:
    return F.when(whole > 0, part / whole * 100).otherwise(F.lit(0.0))


def signed_pct(value: Column) -> Column:
    """For display only ("+1.50%"); sort by the number."""
    return F.format_string("%+.2f%%", value)


def market_hours(time: Column, opens: int = 9, closes: int = 16) -> Column:
    """Monday to Friday, from the opening hour to just before the closing hour."""
    return (F.weekday(time) < 5) & (F.hour(time) >= opens) & (F.hour(time) < closes)


def gainers(change: Column) -> Column:
    return F.count_if(change > 0)


def losers(change: Column) -> Column:
    return F.count_if(change < 0)


def unchanged(change: Column) -> Column:
    return F.count_if(change == 0)
