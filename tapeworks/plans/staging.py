"""Staging views over the raw tables. Stateless: they run on streams as well."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tapeworks.functions import bands
from tapeworks.functions.text import word_count

QUOTE_COLUMNS = [
    "symbol", "name", "price", "previous_close", "open", "high", "low", "volume", "market_cap",
    "pe_ratio", "dividend_yield", "change", "change_percent", "currency", "exchange",
    "quote_type", "quote_timestamp", "message_timestamp", "job_id", "source",
]
SCREENER_COLUMNS = [
    "symbol", "name", "price", "change", "change_percent", "volume", "market_cap",
    "screener_type", "rank", "message_timestamp", "job_id", "source",
]
NEWS_COLUMNS = [
    "symbol", "title", "url", "text", "news_source", "news_type", "published_time", "image_url",
    "message_timestamp", "job_id", "data_source",
]


def stg_quotes(raw: DataFrame) -> DataFrame:
    """Priced quotes with trend, size class, volatility and a validity flag."""
    if "quote_timestamp" not in raw.columns:
        raw = raw.withColumnRenamed("timestamp", "quote_timestamp")
    change, price, volume = F.col("change_percent"), F.col("price"), F.col("volume")
    return (
        raw.where(F.col("symbol").isNotNull() & (price > 0))
        .select(*QUOTE_COLUMNS)
        .withColumns({
            "price_trend": bands.band(change, bands.TREND_WAREHOUSE),
            "market_cap_category": bands.band(F.col("market_cap"), bands.MARKET_CAP),
            "volatility": F.abs(change),
            "is_valid_quote": F.coalesce((price > 0) & (volume >= 0), F.lit(False)),
        })
    )


def stg_screeners(raw: DataFrame) -> DataFrame:
    """Screener rows with performance class, size class and a validity flag."""
    change, price = F.col("change_percent"), F.col("price")
    return (
        raw.where(F.col("symbol").isNotNull() & F.col("screener_type").isNotNull())
        .select(*SCREENER_COLUMNS)
        .withColumns({
            "performance_category": bands.band(change, bands.PERFORMANCE),
            "market_cap_category": bands.band(F.col("market_cap"), bands.MARKET_CAP),
            "is_valid_screener":
                F.coalesce(price > 0, F.lit(False)) & change.isNotNull(),
        })
    )


def stg_news(raw: DataFrame) -> DataFrame:
    """News with word count, category, sentiment and a validity flag.

    ``source`` of a raw table feeds both ``news_source`` and ``data_source``; parsed messages
    carry the two apart already.
    """
    if "news_source" not in raw.columns:
        raw = raw.withColumns({"news_source": F.col("source"), "data_source": F.col("source")})
    title = F.col("title")
    return (
        raw.where(F.col("symbol").isNotNull() & title.isNotNull())
        .select(*NEWS_COLUMNS)
        .withColumns({
            "word_count": word_count(title, F.col("text")),
            "news_category": bands.classify(title, bands.NEWS_CATEGORY),
            "sentiment_score": bands.sentiment_score(title),
            "is_valid_news": (F.length(title) >= 10) & F.col("url").isNotNull(),
        })
    )
