"""Queries behind dashboards: filters, latest values, pivot, charts and tables."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tapeworks.functions import market
from tapeworks.operators.clean import date_range
from tapeworks.operators.latest import newest_values

LATEST_COLUMNS = ["price", "change_percent", "volume", "market_cap"]
NEWS_COLUMNS = ["symbol", "title", "published_time", "sentiment_score", "news_category"]


def select_view(df: DataFrame, symbols: list[str] | None = None,
                start: str | dt.date | None = None, end: str | dt.date | None = None) -> DataFrame:
    """Rows of the chosen symbols (none chosen: all) between two dates, both inclusive."""
    if symbols:
        df = df.where(F.col("symbol").isin(symbols))
    return date_range(df, start, end)


def bounds(df: DataFrame) -> DataFrame:
    """First and last date."""
    return df.agg(F.min("date").alias("min_date"), F.max("date").alias("max_date"))


def symbols(df: DataFrame) -> DataFrame:
    return df.select("symbol").distinct()


def series(df: DataFrame, value: str = "price") -> DataFrame:
    """Points of a chart, ordered by symbol and date."""
    return df.select("symbol", "date", value).orderBy("symbol", "date")


def latest_prices(df: DataFrame, time: str = "date", place: str | None = None) -> DataFrame:
    """Last known value of each column per symbol, column by column; ties as in ``newest_values``."""
    return newest_values(df, ["symbol"], time, LATEST_COLUMNS, place)


def with_signed_change(df: DataFrame) -> DataFrame:
    return df.withColumn("change_text", market.signed_pct(F.col("change_percent")))


def top_movers(df: DataFrame, k: int = 5) -> DataFrame:
    """The ``k`` highest changes, compared as numbers."""
    return df.orderBy(F.col("change_percent").desc_nulls_last(), "symbol").limit(k)


def latest_day_summary(df: DataFrame) -> DataFrame:
    """Totals of the last date with data.

    The last date is a subquery: on a table partitioned by date it prunes the scan to one partition.
    """
    change = F.col("change_percent")
    last = df.where(F.col("date") == df.agg(F.max("date")).scalar())
    return last.groupBy("date").agg(
        F.count("*").alias("total_stocks"),
        market.gainers(change).alias("gainers"),
        market.losers(change).alias("losers"),
        market.mean(change).alias("avg_change"),
        F.sum("volume").alias("total_volume"),
    )


def pivot_change(df: DataFrame, column: str, values: list | None = None, most: int = 1000) -> DataFrame:
    """Average change per symbol, one column per value of ``column`` (a date or period), in order.

    Without given values a job looks for those of the data; more than ``most`` of them are an error, since
    each is a column.
    """
    if values is None:
        found = df.where(F.col(column).isNotNull()).select(column).distinct().limit(most + 1).collect()
        if len(found) > most:
            raise ValueError(f"more than {most} values of {column}; choose a shorter range")
        values = sorted(row[0] for row in found)
    return df.groupBy("symbol").pivot(column, values).agg(market.mean("change_percent"))


def avg_sentiment(news: DataFrame) -> DataFrame:
    return news.groupBy("symbol").agg(F.avg("sentiment_score").alias("avg_sentiment"))


def recent_news(news: DataFrame, k: int = 10) -> DataFrame:
    """The ``k`` newest news, newest first."""
    return (news.select(*NEWS_COLUMNS)
            .orderBy(F.col("published_time").desc_nulls_last(), "symbol", "title").limit(k))
