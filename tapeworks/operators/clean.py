"""Cleaning and filtering. Stateless: the same code serves batches and streams."""

from __future__ import annotations

import datetime as dt
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from tapeworks.functions import bands, market
from tapeworks.functions.text import clean_symbol, clean_text, parse_number, word_count

# The numeric attributes of a quote that may arrive as formatted text.
NUMERIC_FIELDS = ["price", "previous_close", "open", "high", "low", "volume", "market_cap",
                  "pe_ratio", "dividend_yield", "change", "change_percent"]


def fill_missing(df: DataFrame, defaults: dict[str, float | int]) -> DataFrame:
    """Defaults for NULL and NaN in the named columns."""
    return df.withColumns({c: market.fill_missing(F.col(c), v) for c, v in defaults.items()})


def clean_symbols(df: DataFrame) -> DataFrame:
    """Symbol trimmed and in capitals, name trimmed."""
    changes = {"symbol": clean_symbol(F.col("symbol"))}
    if "name" in df.columns:
        changes["name"] = F.trim("name")
    return df.withColumns(changes)


def clean_numbers(df: DataFrame) -> DataFrame:
    """Quotes with all numeric attributes as numbers; unreadable ones are NULL."""
    texts = [c for c in NUMERIC_FIELDS if c in df.columns]
    return clean_symbols(df).withColumns({
        **{c: parse_number(F.col(c)) if isinstance(df.schema[c].dataType, StringType)
           else F.col(c).cast("double") for c in texts},
        "currency": F.coalesce("currency", F.lit("USD")) if "currency" in df.columns
        else F.lit("USD"),
    })


def clean_stocks(df: DataFrame) -> DataFrame:
    """Stocks with clean symbol, name, market cap and currency.

    ``present_fields`` counts the attributes a record carried, currency included; an unreadable
    market cap counts as carried. The quality score is measured against it.
    """
    carried = [F.col(c).isNotNull().cast("int") for c in df.columns if c != "currency"]
    changes = {
        "present_fields": reduce(lambda a, b: a + b, carried) + 1,
        "currency": F.coalesce("currency", F.lit("USD")) if "currency" in df.columns
        else F.lit("USD"),
    }
    if "market_cap" in df.columns and isinstance(df.schema["market_cap"].dataType, StringType):
        changes["market_cap"] = parse_number(F.col("market_cap"), ",")
    return clean_symbols(df.withColumns(changes))


def clean_quote_stream(quotes: DataFrame) -> DataFrame:
    """Parsed quote messages with gaps filled by 0, size class and trend."""
    return fill_missing(quotes, {"price": 0.0, "volume": 0, "change_percent": 0.0}).withColumns({
        "market_cap_category": bands.band(F.col("market_cap"), bands.MARKET_CAP),
        "price_trend": bands.band(F.col("change_percent"), bands.TREND_STREAM),
    })


def clean_screener_stream(screeners: DataFrame) -> DataFrame:
    """Parsed screener messages with gaps filled by 0 and the performance class."""
    filled = fill_missing(screeners, {"price": 0.0, "change_percent": 0.0, "volume": 0})
    return filled.withColumn(
        "performance_category", bands.band(F.col("change_percent"), bands.PERFORMANCE))


def clean_news_stream(news: DataFrame, unicode: bool = False) -> DataFrame:
    """Parsed news messages without punctuation, with word count and category."""
    stripped = news.withColumns({
        "title": clean_text(F.col("title"), unicode),
        "text": clean_text(F.col("text"), unicode),
    })
    return stripped.withColumns({
        "word_count": word_count(F.col("title"), F.col("text"), rules="stream"),
        "news_category": bands.classify(F.col("title"), bands.NEWS_CATEGORY),
    })


def conjunction(filters: list[tuple]) -> Column:
    """One condition from ``(column, operator, value)`` triples, all of which must hold."""
    tests = {
        "==": lambda c, v: c == v,
        ">": lambda c, v: c > v,
        "<": lambda c, v: c < v,
        ">=": lambda c, v: c >= v,
        "<=": lambda c, v: c <= v,
        "in": lambda c, v: c.isin(list(v)),
    }
    unknown = [op for _, op, _ in filters if op not in tests]
    if unknown:
        raise ValueError(f"unknown filter operators: {unknown}")
    return reduce(lambda a, b: a & b, [tests[op](F.col(c), v) for c, op, v in filters],
                  F.lit(True))


def date_range(df: DataFrame, start: str | dt.date | None = None,
               end: str | dt.date | None = None, column: str = "date") -> DataFrame:
    """Rows from ``start`` to ``end``, both inclusive; without the column nothing is filtered."""
    if column not in df.columns:
        return df
    if start is not None:
        df = df.where(F.col(column) >= F.lit(start).cast("date"))
    if end is not None:
        df = df.where(F.col(column) <= F.lit(end).cast("date"))
    return df


def threshold_filter(df: DataFrame, min_volume: int = 1000, max_change: float = 50.0,
                     start: str | dt.date | None = None, end: str | dt.date | None = None,
                     column: str = "date") -> DataFrame:
    """Rows traded enough, not jumping beyond ``max_change`` percent, inside the dates."""
    kept = df.where((F.col("volume") >= min_volume)
                    & (F.abs("change_percent") <= max_change))
    return date_range(kept, start, end, column)


def in_market_hours(df: DataFrame, time: str) -> DataFrame:
    return df.where(market.market_hours(F.col(time)))
