"""Dimension, facts and marts.

One symbol or one day may hold a large part of all rows. So every per-symbol or per-day result
comes out of aggregates with a map-side part, never out of a window over the whole group; daily
marts go through one row per (day, symbol) first.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tapeworks.functions import bands, market
from tapeworks.operators.latest import at_last, last_times, newest_rows

# Columns of the fact table.
FACT_COLUMNS = [
    "quote_id", "stock_id", "symbol", "quote_timestamp", "quote_date", "quote_hour",
    "day_of_week", "day_type", "price", "previous_close", "open", "high", "low", "change",
    "change_percent", "volume", "dollar_volume", "market_cap", "pe_ratio", "dividend_yield",
    "price_trend", "volatility", "market_cap_category", "quote_market_cap_category", "sector",
    "industry", "is_valid_quote", "message_timestamp", "job_id", "data_source",
]


def _now(as_of: dt.datetime | None) -> Column:
    return F.current_timestamp() if as_of is None else F.lit(as_of)


def _labelled(rows: DataFrame, name: str) -> DataFrame:
    """One struct per symbol, of the greatest of the few rows it has left."""
    rest = [c for c in rows.columns if c != "symbol"]
    return rows.groupBy("symbol").agg(F.max(F.struct(*rest)).alias(name))


def dim_stocks(quotes: DataFrame, screeners: DataFrame, news: DataFrame,
               as_of: dt.datetime | None = None, active_days: int = 7) -> DataFrame:
    """One row per symbol seen in any valid quote, screener or news row.

    Each input shrinks to one row per symbol before the full joins. A stock is active when any
    staged quote, valid or not, is at most ``active_days`` old on the day of ``as_of``.
    Of several rows with the newest time the greatest values win.
    """
    first_day = F.date_sub(F.to_date(_now(as_of)), active_days)
    valid = F.col("is_valid_quote")
    last = last_times(quotes, ["symbol"], {
        "last_valid": F.when(valid, F.col("quote_timestamp")), "last_quote": F.col("quote_timestamp"),
        "any_valid": F.when(valid, F.lit(1))})
    listing = at_last(quotes.where(valid).select("symbol", "quote_timestamp", "name", "exchange", "currency"),
                      ["symbol"], "quote_timestamp", last, "last_valid")
    q = last.select("symbol", "last_quote", F.col("any_valid").isNotNull().alias("q_valid")).join(
        _labelled(listing, "q"), "symbol", "left")
    s = _labelled(newest_rows(screeners.where("is_valid_screener").select(
        "symbol", "message_timestamp", "market_cap_category"), ["symbol"], "message_timestamp"), "s")
    n = _labelled(newest_rows(news.where("is_valid_news").select(
        "symbol", "message_timestamp", "news_category"), ["symbol"], "message_timestamp"), "n")
    joined = (
        q.join(s, "symbol", "full").join(n, "symbol", "full")
        .where("q_valid or s is not null or n is not null")
    )
    named = joined.select(
        "symbol",
        F.coalesce("q.name", F.lit("Unknown")).alias("name"),
        F.coalesce("q.exchange", F.lit("Unknown")).alias("exchange"),
        F.coalesce("q.currency", F.lit("USD")).alias("currency"),
        F.coalesce("s.market_cap_category", F.lit("Unknown")).alias("market_cap_category"),
        F.coalesce("n.news_category", F.lit("General")).alias("primary_news_category"),
        F.coalesce(F.col("last_quote") >= first_day, F.lit(False)).alias("is_active"),
    )
    return named.withColumns({
        "stock_id": market.surrogate_key(F.col("symbol")),
        "sector": bands.classify(F.col("name"), bands.SECTOR_BY_NAME),
        "industry": bands.classify(F.col("name"), bands.INDUSTRY_BY_NAME),
        "created_at": _now(as_of),
        "updated_at": _now(as_of),
    })


def quote_measures(quotes: DataFrame) -> DataFrame:
    """Valid quotes with time attributes and measures, without the stock attributes.

    Enough for the daily marts that read none of those: they save the join.
    """
    return (
        quotes.where("is_valid_quote")
        .withColumnsRenamed({"market_cap_category": "quote_market_cap_category",
                             "source": "data_source"})
        .withColumns({
            "quote_id": market.surrogate_key(F.col("symbol"), F.col("quote_timestamp")),
            "dollar_volume": market.dollar_volume(
                "warehouse", F.col("price"), F.col("volume"), F.col("previous_close")),
            **market.time_dims(F.col("quote_timestamp")),
        })
    )


def fact_quotes(quotes: DataFrame, dim: DataFrame, as_of: dt.datetime | None = None) -> DataFrame:
    """Valid quotes with stock attributes, time attributes and measures.

    ``market_cap_category`` is the one of the stock, ``quote_market_cap_category`` that of the
    quote. ``dim`` is a stored table (``materialize``): a small one is broadcast, and beyond that the adaptive
    skew join splits a hot symbol, which it cannot when the other side comes out of an aggregate. Where both
    are bucketed by symbol, neither is shuffled.
    """
    stock = dim.select("symbol", "stock_id", "sector", "industry", F.col("market_cap_category").alias("_stock_cap"))
    # Keys and measures are computed after the join, which may shuffle the quotes: hashes do not compress.
    joined = quotes.where("is_valid_quote").join(stock, "symbol", "left")
    return (quote_measures(joined).withColumnRenamed("_stock_cap", "market_cap_category")
            .select(*FACT_COLUMNS, _now(as_of).alias("created_at")))


def symbol_days(fact: DataFrame) -> DataFrame:
    """Additive measures per (day, symbol): the common first step of the daily marts."""
    change = F.col("change_percent")
    return fact.groupBy("quote_date", "symbol").agg(
        F.count("*").alias("quotes"),
        F.sum("price").alias("price_sum"),
        F.sum("volume").alias("volume"),
        F.max("volume").alias("max_volume"),
        F.sum("dollar_volume").alias("dollar_volume"),
        F.sum(change).alias("change_sum"),
        F.count(change).alias("changes"),
        F.max(change).alias("max_change"),
        F.min(change).alias("min_change"),
        F.sum("volatility").alias("volatility_sum"),
        market.gainers(change).alias("gainers"),
        market.losers(change).alias("losers"),
        market.unchanged(change).alias("unchanged"),
    )


def _ratio(total: str, count: str) -> Column:
    return F.round(F.try_divide(F.sum(total), F.sum(count)), 9) + F.lit(0.0)


def _first_by(value: str, descending: bool) -> Column:
    """Symbol and value at one end of the day; ties go to the lower symbol, NULL never wins."""
    key = -F.col(value) if descending else F.col(value)
    pick = F.struct(key.alias("key"), F.col("symbol"), F.col(value).alias("value"))
    return F.min(F.when(F.col(value).isNotNull(), pick))


def _day_totals(days: DataFrame, *extra: Column) -> DataFrame:
    return days.groupBy("quote_date").agg(
        F.count("*").alias("total_stocks"),
        F.sum("quotes").alias("total_quotes"),
        _ratio("price_sum", "quotes").alias("avg_price"),
        F.sum("volume").alias("total_volume"),
        F.sum("dollar_volume").alias("total_dollar_volume"),
        _ratio("change_sum", "changes").alias("avg_change_percent"),
        F.sum("gainers").alias("gainers"),
        F.sum("losers").alias("losers"),
        F.sum("unchanged").alias("unchanged"),
        F.max("max_change").alias("max_gain"),
        F.min("min_change").alias("max_loss"),
        _ratio("volatility_sum", "changes").alias("avg_volatility"),
        *extra,
    )


def daily_news(news: DataFrame) -> DataFrame:
    """Valid news per day of publication."""
    score = F.col("sentiment_score")
    return (
        news.where("is_valid_news and published_time is not null")
        .groupBy(F.to_date("published_time").alias("date"))
        .agg(
            F.count("*").alias("news_count"),
            F.countDistinct("symbol").alias("stocks_with_news"),
            F.avg(score).alias("avg_sentiment"),
            F.count_if(score > 0).alias("positive_news"),
            F.count_if(score < 0).alias("negative_news"),
            F.count_if(score == 0).alias("neutral_news"),
        )
    )


def daily_summary(fact: DataFrame, news: DataFrame, as_of: dt.datetime | None = None) -> DataFrame:
    """One row per trading day: totals, news, top movers, sentiment and ratios."""
    day = _day_totals(
        symbol_days(fact),
        _first_by("max_change", True).alias("gain"),
        _first_by("min_change", False).alias("loss"),
        _first_by("max_volume", True).alias("active"),
    ).withColumnRenamed("quote_date", "date")
    news_columns = ["news_count", "stocks_with_news", "positive_news", "negative_news",
                    "neutral_news"]
    return (
        day.join(daily_news(news), "date", "left")
        .withColumns({c: F.coalesce(c, F.lit(0)) for c in news_columns})
        .withColumns({
            "avg_sentiment": F.coalesce("avg_sentiment", F.lit(0.0)),
            "top_gainer": F.col("gain.symbol"),
            "top_gainer_percent": F.col("gain.value"),
            "top_loser": F.col("loss.symbol"),
            "top_loser_percent": F.col("loss.value"),
            "most_active": F.col("active.symbol"),
            "most_active_volume": F.col("active.value"),
            "market_sentiment":
                bands.market_sentiment(F.col("gainers"), F.col("losers"), strong_factor=1.5),
            "market_trend": bands.band(F.col("avg_change_percent"), bands.TREND_STREAM),
            "gainer_percentage": market.safe_pct(F.col("gainers"), F.col("total_stocks")),
            "loser_percentage": market.safe_pct(F.col("losers"), F.col("total_stocks")),
            "estimated_shares_traded":
                market.safe_ratio(F.col("total_dollar_volume"), F.col("avg_price")),
            "created_at": _now(as_of),
        })
        .drop("gain", "loss", "active")
    )


def market_performance(fact: DataFrame) -> DataFrame:
    """Daily market performance with a key and the three-way sentiment."""
    day = _day_totals(symbol_days(fact)).withColumnRenamed("quote_date", "date")
    return day.select(
        market.surrogate_key(F.col("date")).alias("performance_id"),
        "date", "total_stocks", "gainers", "losers", "avg_change_percent", "total_volume",
        bands.market_sentiment(F.col("gainers"), F.col("losers")).alias("market_sentiment"),
    )


def news_sentiment_fact(news: DataFrame, dim: DataFrame) -> DataFrame:
    """Valid, dated news with their stock and a key over symbol, url and time; ``dim`` as in ``fact_quotes``."""
    dated = news.where("is_valid_news and published_time is not null")
    return (
        dated.join(dim.select("symbol", "stock_id"), "symbol", "left")
        .select(
            market.surrogate_key(
                F.col("symbol"), F.col("url"), F.col("published_time")).alias("news_id"),
            "stock_id", "symbol", "published_time", "sentiment_score", "news_category",
            "word_count",
        )
    )


def sector_performance(measures: DataFrame, dim: DataFrame) -> DataFrame:
    """Stocks, average change and volume per day and sector.

    The sector is joined to one row per (day, symbol), so no quote is joined and nothing is distinct.
    """
    sectors = dim.where("sector is not null").select("symbol", "sector")
    return (
        symbol_days(measures).join(sectors, "symbol")
        .groupBy("quote_date", "sector")
        .agg(
            F.count("*").alias("stocks_in_sector"),
            _ratio("change_sum", "changes").alias("sector_avg_change"),
            F.sum("volume").alias("sector_volume"),
        )
    )
