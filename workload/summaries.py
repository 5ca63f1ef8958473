"""Aggregates, rankings and dashboard queries."""

from __future__ import annotations

import datetime as dt
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tapeworks.functions import bands
from tapeworks.operators import clean, readmodel, summary
from tapeworks.plans import dashboard, staging
from workload.marts import rounded
from workload.registry import cte, query
from workload.rules import banded, sentiment
from workload.views import view

cte("priced", "select * from stg_quotes where is_valid_quote")
cte("dated", "select *, cast(quote_timestamp as date) as date from stg_quotes")


def quotes(spark, sf_dir, *columns):
    return view(spark, sf_dir, "quotes", list(columns) or None)


def dated(spark, sf_dir):
    return (staging.stg_quotes(quotes(spark, sf_dir))
            .withColumn("date", F.to_date("quote_timestamp")))


def news(spark, sf_dir):
    return staging.stg_news(view(spark, sf_dir, "news"))


@query("""
select sector, round_even(avg(price), 2) + 0.0 as price_mean,
  round_even(stddev_samp(price), 2) + 0.0 as price_std, count(price) as price_count,
  round_even(avg(change_percent), 2) + 0.0 as change_percent_mean,
  round_even(stddev_samp(change_percent), 2) + 0.0 as change_percent_std,
  cast(sum(volume) as double) as volume_sum, round_even(avg(volume), 2) + 0.0 as volume_mean,
  sum(market_cap) as market_cap_sum, round_even(avg(market_cap), 2) + 0.0 as market_cap_mean,
  round_even(median(price), 2) + 0.0 as price_median,
  round_even(median(change_percent), 2) + 0.0 as change_percent_median
from (select *, case when name like '%gear%' then 'Industrials'
    when name like '%gizmo%' then 'Technology' when name like '%plate%' then 'Financial Services'
    when name like '%rod%' or name like '%bolt%' then 'Energy'
    when name like '%ring%' then 'Consumer Discretionary'
    when name like '%widget%' then 'Healthcare' else 'Other' end as sector from quotes)
group by sector""")
def sector_stats(spark, sf_dir):
    df = quotes(spark, sf_dir, "name", "price", "change_percent", "volume", "market_cap")
    sector = bands.classify(F.col("name"), bands.SECTOR_BY_NAME)
    return summary.sector_stats(df.withColumn("sector", sector).drop("name"))


@query("""
select count(*) as total_stocks, round(round(avg(price), 9), 6) + 0.0 as avg_price,
  round(avg(change_percent), 9) + 0.0 as avg_change_percent,
  count(*) filter (change_percent > 0) as gainers,
  count(*) filter (change_percent < 0) as losers,
  count(*) filter (change_percent = 0) as unchanged,
  cast(sum(volume) as bigint) as total_volume,
  round(sum(market_cap), -6) + 0.0 as total_market_cap
from quotes""")
def market_summary(spark, sf_dir):
    df = quotes(spark, sf_dir, "price", "change_percent", "volume", "market_cap")
    total = summary.market_summary(df).withColumn("total_volume", F.col("total_volume").cast("bigint"))
    return rounded(total, avg_price=6, total_market_cap=-6)


BATCH = ("symbol", "price", "volume", "change_percent", "quote_timestamp")


def batch(spark, sf_dir):
    return summary.batch_quotes(quotes(spark, sf_dir, *BATCH), "quote_timestamp")


@query(f"""
select symbol, price, volume, change_percent, quote_timestamp, price * volume as dollar_volume,
  {banded("trend_batch", "change_percent")} as price_trend,
  cast(extract(hour from quote_timestamp) as integer) as hour,
  strftime(quote_timestamp, '%Y-%m-%d') as date
from quotes""")
def batch_enrich(spark, sf_dir):
    return batch(spark, sf_dir)


@query("""
select symbol, strftime(quote_timestamp, '%Y-%m-%d') as date,
  round(avg(price), 9) + 0.0 as avg_price, max(price) as max_price, min(price) as min_price,
  cast(sum(volume) as bigint) as total_volume,
  round(avg(change_percent), 9) + 0.0 as avg_change_percent, count(*) as record_count,
  (max(price) - min(price)) / (round(avg(price), 9) + 0.0) * 100 as price_volatility
from quotes group by 1, 2""")
def daily_symbol_agg(spark, sf_dir):
    return summary.daily_by_symbol(batch(spark, sf_dir))


@query(f"""
select strftime(quote_timestamp, '%Y-%m-%d') as date, count(symbol) as total_stocks,
  round(round(avg(price), 9), 7) + 0.0 as avg_price,
  round(avg(change_percent), 9) + 0.0 as avg_change_percent,
  cast(sum(volume) as bigint) as total_volume,
  count(*) filter (change_percent > 0) as gainers,
  count(*) filter (change_percent < 0) as losers,
  {sentiment('count(*) filter (change_percent > 0)', 'count(*) filter (change_percent < 0)')}
    as market_sentiment
from quotes group by 1""")
def daily_market_summary(spark, sf_dir):
    return rounded(summary.daily_market(batch(spark, sf_dir)), avg_price=7)


PERFORMERS = """
select symbol, round(avg(change_percent), 9) + 0.0 as avg_change_percent,
  cast(sum(volume) as bigint) as total_volume, round(round(avg(price), 9), 7) + 0.0 as avg_price
from quotes group by symbol"""


@query(f"select * from ({PERFORMERS}) order by avg_change_percent desc nulls last, symbol limit 10")
def top_performers(spark, sf_dir):
    return rounded(summary.top_performers(batch(spark, sf_dir)), avg_price=7)


@query(f"select * from ({PERFORMERS}) order by total_volume desc nulls last, symbol limit 10")
def top_volume(spark, sf_dir):
    return rounded(summary.top_performers(batch(spark, sf_dir), by="total_volume"), avg_price=7)


@query("""
with last as (
  select cast(quote_timestamp as date) as date, symbol, price, change_percent, volume
  from priced qualify row_number() over (
    partition by cast(quote_timestamp as date), symbol order by quote_timestamp desc) = 1),
scored as (
  select *, 'day_gainers' as screener_type, change_percent as score from last
  union all select *, 'day_losers', -change_percent from last
  union all select *, 'most_actives', cast(volume as double) from last)
select date, symbol, price, change_percent, volume, screener_type,
  cast(row_number() over (partition by date, screener_type order by score desc, symbol) as integer)
    as rank
from scored where score is not null
qualify row_number() over (partition by date, screener_type order by score desc, symbol) <= 5""")
def screener_lists(spark, sf_dir):
    return summary.screener_lists(
        staging.stg_quotes(quotes(spark, sf_dir)).where("is_valid_quote"), k=5)


def latest_by_place(spark, sf_dir):
    """Latest values; at the same time the row that comes first in the table counts, as for ``arg_max``."""
    columns = ["symbol", "price", "change_percent", "volume", "market_cap", "quote_timestamp"]
    return readmodel.latest_prices(view(spark, sf_dir, "quotes", columns, "place"), "quote_timestamp", "place")


@query("""
select symbol, arg_max(price, quote_timestamp) filter (where price is not null) as price,
  arg_max(change_percent, quote_timestamp) filter (where change_percent is not null)
    as change_percent,
  arg_max(volume, quote_timestamp) filter (where volume is not null) as volume,
  arg_max(market_cap, quote_timestamp) filter (where market_cap is not null) as market_cap,
  printf('%+.2f%%', arg_max(change_percent, quote_timestamp)
    filter (where change_percent is not null)) as change_text
from quotes group by symbol""")
def latest_prices(spark, sf_dir):
    return readmodel.with_signed_change(latest_by_place(spark, sf_dir))


@query("""
select symbol, arg_max(price, quote_timestamp) filter (where price is not null) as price,
  arg_max(change_percent, quote_timestamp) as change_percent,
  arg_max(volume, quote_timestamp) filter (where volume is not null) as volume,
  arg_max(market_cap, quote_timestamp) as market_cap
from quotes group by symbol order by 3 desc nulls last, 1 limit 5""")
def top_movers(spark, sf_dir):
    return readmodel.top_movers(latest_by_place(spark, sf_dir))


@query("""
select date, count(*) as total_stocks, count(*) filter (change_percent > 0) as gainers,
  count(*) filter (change_percent < 0) as losers,
  round(avg(change_percent), 9) + 0.0 as avg_change, cast(sum(volume) as bigint) as total_volume
from dated where date = (select max(date) from dated) group by date""")
def latest_day_summary(spark, sf_dir):
    return readmodel.latest_day_summary(dated(spark, sf_dir))


@query("select symbol, " + ", ".join(
    f'round(avg(change_percent) filter (where year(quote_timestamp) = {y}), 9) + 0.0 as "{y}"'
    for y in range(1995, 2002)) + " from quotes group by symbol")
def performance_pivot(spark, sf_dir):
    """Symbols by years; the years are those of the data."""
    df = quotes(spark, sf_dir, "symbol", "change_percent", "quote_timestamp")
    return readmodel.pivot_change(df.withColumn("year", F.year("quote_timestamp")), "year")


@query("""
select symbol, """ + ", ".join(f"round(avg(change_percent) filter (day = {k}), 9) + 0.0 as day_{k}" for k in range(1, 6)) + """
from (select symbol, change_percent, dense_rank() over (order by date) as day from dated
  where date > (select max(date) from (select distinct date from dated) d
    where (select count(distinct date) from dated e where e.date > d.date) = 5))
group by symbol""")
def daily_change_pivot(spark, sf_dir):
    """Symbols by the last five dates of the data, as a dashboard's range would choose them."""
    df = dated(spark, sf_dir)
    last = [r.date for r in df.select("date").distinct().orderBy(F.desc("date")).limit(5).collect()]
    pivot = readmodel.pivot_change(readmodel.select_view(df, start=min(last)), "date")
    return pivot.toDF("symbol", *[f"day_{k}" for k in range(1, 6)])


@query("select symbol, avg(sentiment_score) as avg_sentiment from stg_news group by symbol")
def news_sentiment(spark, sf_dir):
    return readmodel.avg_sentiment(news(spark, sf_dir))


@query("""
select symbol, title, published_time, sentiment_score, news_category from stg_news
order by published_time desc nulls last, symbol, title limit 10""")
def recent_news(spark, sf_dir):
    return readmodel.recent_news(news(spark, sf_dir))


@query("select min(date) as min_date, max(date) as max_date from dated")
def date_bounds(spark, sf_dir):
    return readmodel.bounds(dated(spark, sf_dir))


@query("select distinct symbol from quotes")
def symbol_universe(spark, sf_dir):
    return readmodel.symbols(quotes(spark, sf_dir, "symbol"))


@query("select symbol, date, price from dated")
def price_series(spark, sf_dir):
    return readmodel.series(readmodel.select_view(dated(spark, sf_dir)))


@query("""
select symbol, date, price from dated
where symbol in ('P1', 'P7', 'P42') and date >= date '1995-01-01' and date <= date '1998-12-31'""")
def chosen_series(spark, sf_dir):
    """A dashboard's chart of chosen symbols between two dates."""
    return readmodel.series(readmodel.select_view(dated(spark, sf_dir), ["P1", "P7", "P42"], "1995-01-01", "1998-12-31"))


@query("""
with chosen as (select * from dated where symbol in (select 'P' || k from range(1, 100) t(k)))
select 'bounds' as part, 1::bigint as rows union all select 'symbols', count(distinct symbol) from dated
union all select 'summary', count(distinct date) from chosen where date = (select max(date) from chosen)
union all select 'prices', count(*) from chosen union all select 'volumes', count(*) from chosen
union all select 'sentiment', count(distinct symbol) from stg_news
union all select 'latest_prices', count(distinct symbol) from chosen
union all select 'top_movers', least(5, count(distinct symbol)) from chosen
union all select 'news', least(10, count(*)) from stg_news
union all select 'heat_map', count(distinct symbol) from chosen""")
def dashboard_page(spark, sf_dir):
    """All results behind a page, each computed; their contents are compared by queries of their own."""
    parts = dashboard.page(dated(spark, sf_dir), news(spark, sf_dir), [f"P{k}" for k in range(1, 100)],
                           pivot_dates=[dt.date(1996, 1, 2), dt.date(1997, 1, 2)])
    counts = [df.agg(F.count("*").alias("rows")).select(F.lit(name).alias("part"), "rows") for name, df in parts.items()]
    return reduce(DataFrame.unionByName, counts)


@query("""
select symbol, price, volume, change_percent, exchange from quotes
where price > 500 and volume <= 40000000 and exchange = 'EXF' and change_percent >= -5
  and change_percent < 8 and currency in ('USD', 'EUR')""")
def filter_list(spark, sf_dir):
    df = quotes(spark, sf_dir, "symbol", "price", "volume", "change_percent", "exchange", "currency")
    kept = df.where(clean.conjunction([
        ("price", ">", 500), ("volume", "<=", 40_000_000), ("exchange", "==", "EXF"),
        ("change_percent", ">=", -5), ("change_percent", "<", 8), ("currency", "in", ["USD", "EUR"])]))
    return kept.drop("currency")


@query("""
select symbol, date, close, volume, bar_interval from history
where date >= date '1997-03-01' and date <= date '1998-02-28'""")
def date_range_read(spark, sf_dir):
    return clean.date_range(
        view(spark, sf_dir, "history"), "1997-03-01", "1998-02-28").drop("row_id")


@query("""
select symbol, quote_timestamp, price from quotes
where extract(isodow from quote_timestamp) < 6 and extract(hour from quote_timestamp) >= 9
  and extract(hour from quote_timestamp) < 16""")
def market_hours(spark, sf_dir):
    df = quotes(spark, sf_dir, "symbol", "quote_timestamp", "price")
    return clean.in_market_hours(df, "quote_timestamp")


@query("""
select symbol, quote_timestamp, volume, change_percent from dated
where volume >= 5000000 and abs(change_percent) <= 6
  and date >= date '1996-01-01' and date <= date '2000-12-31'""")
def threshold_filter(spark, sf_dir):
    kept = clean.threshold_filter(dated(spark, sf_dir), 5_000_000, 6.0, "1996-01-01", "2000-12-31")
    return kept.select("symbol", "quote_timestamp", "volume", "change_percent")
