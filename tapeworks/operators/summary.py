"""Aggregates over quotes: sectors, market, symbols, rankings."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tapeworks.functions import bands, market
from tapeworks.operators.latest import newest_rows
from tapeworks.operators.median import exact_median


def _long_total(column: str) -> Column:
    """Sum of a LONG that may pass 2^63 over a whole history."""
    return F.sum(F.col(column).cast("decimal(20,0)"))


def sector_stats(df: DataFrame) -> DataFrame | None:
    """Price, change, volume and cap statistics per sector, to two decimals (half to even).

    Quotes without a sector do not count. Without a sector column there is nothing to report.
    """
    if "sector" not in df.columns:
        return None
    price, change = F.col("price"), F.col("change_percent")
    stats = [
        F.avg(price).alias("price_mean"),
        F.stddev_samp(price).alias("price_std"),
        F.count(price).alias("price_count"),
        F.avg(change).alias("change_percent_mean"),
        F.stddev_samp(change).alias("change_percent_std"),
        _long_total("volume").cast("double").alias("volume_sum"),
        F.avg("volume").alias("volume_mean"),
        F.sum("market_cap").alias("market_cap_sum"),
        F.avg("market_cap").alias("market_cap_mean"),
    ]
    joined = exact_median(df, "sector", ["price", "change_percent"], stats).withColumnsRenamed(
        {"median_price": "price_median", "median_change_percent": "change_percent_median"})
    doubles = [c for c in joined.columns if c not in ("sector", "price_count")]
    return joined.withColumns({c: F.bround(c, 2) + F.lit(0.0) for c in doubles})


def market_summary(df: DataFrame, by: str | Column | None = None) -> DataFrame:
    """Counts, averages and totals over all quotes or per ``by``.

    ``total_stocks`` counts quotes, not distinct stocks. Measures whose column is missing are
    left out.
    """
    measures = [F.count("*").alias("total_stocks")]
    if "price" in df.columns:
        measures.append(market.mean("price").alias("avg_price"))
    if "change_percent" in df.columns:
        change = F.col("change_percent")
        measures += [
            market.mean(change).alias("avg_change_percent"),
            market.gainers(change).alias("gainers"),
            market.losers(change).alias("losers"),
            market.unchanged(change).alias("unchanged"),
        ]
    if "volume" in df.columns:
        measures.append((F.sum("volume") if by is not None else _long_total("volume"))
                        .alias("total_volume"))
    if "market_cap" in df.columns:
        measures.append(F.sum("market_cap").alias("total_market_cap"))
    return (df.groupBy(by) if by is not None else df.groupBy()).agg(*measures)


def batch_quotes(df: DataFrame, time: str = "timestamp") -> DataFrame:
    """Quotes with dollar volume, trend, hour and date, by the rules of the batch job."""
    return df.withColumns({
        "dollar_volume": market.dollar_volume("batch", F.col("price"), F.col("volume")),
        "price_trend": bands.band(F.col("change_percent"), bands.TREND_BATCH),
        "hour": F.hour(time),
        "date": F.date_format(time, "yyyy-MM-dd"),
    })


def daily_by_symbol(df: DataFrame) -> DataFrame:
    """Prices, volume and volatility per symbol and date."""
    return df.groupBy("symbol", "date").agg(
        market.mean("price").alias("avg_price"),
        F.max("price").alias("max_price"),
        F.min("price").alias("min_price"),
        F.sum("volume").alias("total_volume"),
        market.mean("change_percent").alias("avg_change_percent"),
        F.count("*").alias("record_count"),
    ).withColumn("price_volatility", market.range_volatility(
        F.col("min_price"), F.col("max_price"), F.col("avg_price")))


def daily_market(df: DataFrame) -> DataFrame:
    """Market summary per date with sentiment. ``total_stocks`` counts quotes."""
    change = F.col("change_percent")
    return df.groupBy("date").agg(
        F.count("symbol").alias("total_stocks"),
        market.mean("price").alias("avg_price"),
        market.mean(change).alias("avg_change_percent"),
        F.sum("volume").alias("total_volume"),
        market.gainers(change).alias("gainers"),
        market.losers(change).alias("losers"),
    ).withColumn("market_sentiment",
                 bands.market_sentiment(F.col("gainers"), F.col("losers")))


def top_performers(df: DataFrame, k: int = 10, by: str = "avg_change_percent") -> DataFrame:
    """The ``k`` symbols with the highest average change or total volume."""
    return df.groupBy("symbol").agg(
        market.mean("change_percent").alias("avg_change_percent"),
        F.sum("volume").alias("total_volume"),
        market.mean("price").alias("avg_price"),
    ).orderBy(F.col(by).desc_nulls_last(), "symbol").limit(k)


def screener_lists(quotes: DataFrame, k: int = 25, time: str = "quote_timestamp") -> DataFrame:
    """Ranked day_gainers, day_losers and most_actives of each date, ``k`` symbols each.

    A symbol stands with its last quote of the day. All three lists come out of one ranking;
    ``row_number() <= k`` cuts each list before it is shuffled.
    """
    days = quotes.select(F.to_date(time).alias("date"), "symbol", time, "price", "change_percent", "volume")
    last = newest_rows(days, ["date", "symbol"], time).drop(time)
    scores = F.array(*[
        F.struct(F.lit(name).alias("screener_type"), score.cast("double").alias("score"))
        for name, score in [("day_gainers", F.col("change_percent")),
                            ("day_losers", -F.col("change_percent")),
                            ("most_actives", F.col("volume"))]])
    rank = F.row_number().over(
        Window.partitionBy("date", "screener_type").orderBy(F.desc("score"), "symbol"))
    return (
        last.withColumn("s", F.explode(scores)).select(*last.columns, "s.*")
        .where("score is not null")
        .withColumn("rank", rank).where(F.col("rank") <= k).drop("score")
    )
