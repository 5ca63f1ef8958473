"""Cleaning, enrichment and quality checks."""

from __future__ import annotations

import datetime as dt
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tapeworks import session
from tapeworks.functions.market import surrogate_key
from tapeworks.operators import clean, enrich, quality
from tapeworks.plans import marts, staging
from tapeworks.plans.transform import transform
from tapeworks.session import shared_dir
from tapeworks.sources.sinks import save_failures, write_table
from workload.marts import AS_OF, dimension, fact
from workload.registry import cte, query
from workload.rules import banded
from workload.views import view

STAMP = int(AS_OF.replace(tzinfo=dt.timezone.utc).timestamp())

cte("clean_stocks", """
select upper(trim(symbol)) as symbol, trim(name) as name, exchange, sector, industry,
  try_cast(replace(market_cap, ',', '') as double) as market_cap,
  coalesce(currency, 'USD') as currency,
  cast(symbol is not null as int) + cast(name is not null as int)
    + cast(exchange is not null as int) + cast(sector is not null as int)
    + cast(industry is not null as int) + cast(market_cap is not null as int) + 1
    as present_fields
from stocks""")
cte("scored_stocks", """
select *, cast(symbol <> '' as int) + cast(name <> '' as int)
  + cast(coalesce(exchange, '') <> '' as int) + cast(coalesce(sector, '') <> '' as int)
  + cast(coalesce(industry, '') <> '' as int) + cast(market_cap is not null as int)
  + cast(currency <> '' as int) as filled from clean_stocks""")
ENRICHED = f"""
select symbol, name, exchange, sector, industry, market_cap, currency,
  cast(filled as double) / present_fields as data_quality_score,
  case when market_cap <> 0 then {banded("market_cap", "market_cap", "<=")} end as market_cap_category,
  case when coalesce(sector, '') = '' then null
    when sector in ('Technology', 'Communication Services') then 'Growth'
    when sector in ('Healthcare', 'Consumer Staples', 'Real Estate', 'Utilities')
      then 'Defensive'
    when sector in ('Financial Services', 'Consumer Discretionary', 'Energy', 'Industrials',
      'Materials') then 'Cyclical' else 'Other' end as sector_category
from scored_stocks"""


@query("""
select upper(trim(id)) as symbol,
  try_cast(nullif(trim(replace(replace(replace(price, ',', ''), '$', ''), '%', '')), '') as double)
    as price,
  cast(stock_quantity as double) as change_percent, 'USD' as currency
from products""")
def clean_numeric(spark, sf_dir):
    df = view(spark, sf_dir, "products").select(
        F.concat(F.lit(" "), "id").alias("symbol"), "price",
        F.concat(F.col("stock_quantity").cast("string"), F.lit("% ")).alias("change_percent"))
    return clean.clean_numbers(df)


@query("select upper(trim(symbol)) as symbol, trim(name) as name from stocks")
def clean_symbols(spark, sf_dir):
    return clean.clean_symbols(view(spark, sf_dir, "stocks", ["symbol", "name"]))


@query(ENRICHED)
def enrich_sector_style(spark, sf_dir):
    df = clean.clean_stocks(view(spark, sf_dir, "stocks"))
    return enrich.enrich_stocks(df, AS_OF).drop("enriched_at")


@query("select symbol, filled / 7.0e0 as data_quality_score from scored_stocks")
def quality_score(spark, sf_dir):
    df = clean.clean_stocks(view(spark, sf_dir, "stocks"))
    return enrich.enrich_stocks(df, AS_OF, "schema").select("symbol", "data_quality_score")


@query(ENRICHED)
def transform_stocks(spark, sf_dir):
    table = f"{shared_dir(spark, 'transform')}/stocks"
    result = transform(view(spark, sf_dir, "stocks"), "market_tickers", AS_OF, table)
    return result.data.drop("enriched_at")


def check_sql(kind, check, percent, limits, message, source):
    return f"""
select '{check}_{kind}_{STAMP}' as check_id, '{kind}' as data_source, '{check}' as check_type,
  case when p > {limits[0]} then 'error' when p > {limits[1]} then 'warning' else 'valid' end
    as status, printf('{message}', p) as message
from (select {percent} as p from {source})"""


COMPLETENESS = check_sql(
    "stock_news", "completeness",
    "(count(case when symbol is null then 1 end) + count(case when title is null then 1 end) "
    "+ count(case when url is null then 1 end)) * 100.0e0 / (count(*) * 3)",
    (20, 10), "Missing %.1f%% of required fields", "news")
VALIDITY = check_sql(
    "stock_quotes", "validity",
    "(count(case when price is null or price <= 0 then 1 end) "
    "+ count(case when volume < 0 then 1 end)) * 100.0e0 / count(*)",
    (10, 5), "%.1f%% of records have invalid values", "quotes")
CONSISTENCY = f"""
select 'consistency_market_screeners_{STAMP}' as check_id, 'market_screeners' as data_source,
  'consistency' as check_type, case when d > 0 then 'warning' else 'valid' end as status,
  case when d > 0 then printf('Found %d duplicate symbols', d)
    else 'No duplicate symbols found' end as message
from (select count(symbol) - count(distinct symbol) as d from screeners)"""
CHECK_COLUMNS = ["check_id", "data_source", "check_type", "status", "message"]


@query(COMPLETENESS)
def quality_completeness(spark, sf_dir):
    df = view(spark, sf_dir, "news", ["symbol", "title", "url"])
    return quality.completeness(df, "stock_news", as_of=AS_OF).select(*CHECK_COLUMNS)


@query(VALIDITY)
def quality_validity(spark, sf_dir):
    df = view(spark, sf_dir, "quotes", ["symbol", "price", "volume"])
    return quality.validity(df, "stock_quotes", as_of=AS_OF).select(*CHECK_COLUMNS)


@query(CONSISTENCY)
def quality_consistency(spark, sf_dir):
    df = view(spark, sf_dir, "screeners", ["symbol", "screener_type"])
    return quality.consistency(df, "market_screeners", as_of=AS_OF).select(*CHECK_COLUMNS)


@query("""
with c as (
  select 'completeness' as check_type, 'Missing' as m, count(case when symbol is null then 1 end)
    + count(case when price is null then 1 end) as bad, count(*) * 2 as total from quotes
  union all
  select 'validity', '', count(case when price is null or price <= 0 then 1 end), count(*)
  from quotes)
select 'warning' as alert_type, 'medium' as severity,
  'Data Quality Warning: stock_quotes' as title,
  'consistency: ' || printf('Found %d duplicate symbols', count(symbol) - count(distinct symbol))
    as message, 'stock_quotes' as data_source from quotes
union all
select case when bad * 100.0 / total > case m when '' then 10 else 20 end then 'error' else 'warning' end,
  case when bad * 100.0 / total > case m when '' then 10 else 20 end then 'high' else 'medium' end,
  'Data Quality ' || case when bad * 100.0 / total > case m when '' then 10 else 20 end
    then 'Error' else 'Warning' end || ': stock_quotes', check_type || ': '
    || case m when '' then printf('%.1f%% of records have invalid values', bad * 100.0e0 / total)
      else printf('Missing %.1f%% of required fields', bad * 100.0e0 / total) end, 'stock_quotes'
from c where bad * 100.0 / total > case m when '' then 5 else 10 end
union all
select 'warning', 'medium', 'Low Data Quality Score',
  printf('Average data quality score is %.1f%%', s * 100), null
from (select (sum(case when bad * 100.0 / total > case m when '' then 10 else 20 end then 0.3
    when bad * 100.0 / total > case m when '' then 5 else 10 end then 0.7 else 1.0 end) + 0.7) / 3
  as s from c) where s < 0.8""")
def quality_alerts(spark, sf_dir):
    df = view(spark, sf_dir, "quotes", ["symbol", "price", "volume"])
    checks = session.stored(quality.run_checks(df, "stock_quotes", AS_OF), "checks")
    return quality.quality_alerts(checks, AS_OF).drop("created_at")


@query("""
select 'symbol' as column_name, count(case when symbol is null then 1 end) as failing_rows
from news
union all select 'title', count(case when title is null then 1 end) from news""")
def test_not_null(spark, sf_dir):
    return quality.not_null_report("stock_news", view(spark, sf_dir, "news", ["symbol", "title"]))


@query("select symbol, count(*) as n_records from screeners group by symbol having count(*) > 1")
def test_unique(spark, sf_dir):
    return quality.failing_unique(view(spark, sf_dir, "screeners", ["symbol"]), "symbol")


@query("""
select symbol, screener_type, rank, job_id from screeners
where screener_type not in ('day_gainers', 'day_losers', 'most_actives')""")
def test_accepted_values(spark, sf_dir):
    df = view(spark, sf_dir, "screeners", ["symbol", "screener_type", "rank", "job_id"])
    return quality.failing_accepted(
        df, "screener_type", quality.ACCEPTED["market_screeners"]["screener_type"])


@query("""
select symbol, date, row_id from history
where symbol is not null and symbol not in (select symbol from screeners)""")
def test_relationships(spark, sf_dir):
    return quality.failing_relationship(
        view(spark, sf_dir, "history", ["symbol", "date", "row_id"]), "symbol",
        view(spark, sf_dir, "screeners", ["symbol"]))


def stored(df, path):
    return df.sparkSession.read.schema(df.schema).parquet(write_table(df, path))


@query("""
select 'accepted_values_dim_stocks_is_active' as test, 0::bigint as failing_rows
union all select 'not_null_dim_stocks_stock_id', 0 union all select 'not_null_dim_stocks_symbol', 0
union all select 'unique_dim_stocks_stock_id', 0 union all select 'unique_dim_stocks_symbol', 0
union all select 'not_null_fact_news_sentiment_news_id', 0
union all select 'not_null_fact_news_sentiment_stock_id', count(*)
  from stg_news where is_valid_news and published_time is not null
    and symbol not in (select symbol from dim)
union all select 'not_null_fact_news_sentiment_published_time', 0
union all select 'unique_fact_news_sentiment_news_id', 0
union all select 'relationships_fact_news_sentiment_stock_id', 0""")
def stored_test_failures(spark, sf_dir):
    # The tables are written first, as a warehouse would have them, so no test computes them anew.
    root = shared_dir(spark, "warehouse")
    dim = stored(dimension(spark, sf_dir), f"{root}/dim_stocks")
    facts = stored(marts.news_sentiment_fact(staging.stg_news(view(spark, sf_dir, "news")), dim),
                   f"{root}/fact_news_sentiment")
    tests = quality.table_tests("dim_stocks", dim)
    tests |= quality.table_tests("fact_news_sentiment", facts, {"dim_stocks": dim})
    return save_failures(tests, shared_dir(spark, "failures"))


@query("""
select symbol, quote_id, stock_id from fact
where stock_id not in (select md5(symbol) from screeners)""")
def fact_without_screener(spark, sf_dir):
    screened = view(spark, sf_dir, "screeners", ["symbol"]).select(
        surrogate_key(F.col("symbol")).alias("stock_id"))
    facts = fact(spark, sf_dir).select("symbol", "quote_id", "stock_id")
    return quality.failing_relationship(facts, "stock_id", screened)


# Table of the SQL for each table that tests are declared on, with the columns that are named otherwise there.
TESTED = {
    "stock_quotes": ("quotes", {"timestamp": "quote_timestamp"}),
    "market_screeners": ("screeners", {}),
    "stock_news": ("news", {}),
    "stock_history": ("history", {}),
    "dim_stocks": ("dim", {}),
    "fact_stock_quotes": ("fact", {}),
    "fact_market_performance": ("(select md5(cast(date as varchar)) as performance_id, * from day_totals)", {}),
    "fact_news_sentiment": ("dated_news", {}),
    "mart_daily_summary": ("day_totals", {}),
}
cte("dated_news", """
select stg_news.*, stock_id, md5(symbol || '-' || url || '-' || cast(published_time as varchar)) as news_id
from stg_news left join dim using (symbol) where is_valid_news and published_time is not null""")


def declared_sql():
    """Every declared test as a count of its failing rows or values."""
    for kind, declared in (("not_null", quality.NOT_NULL), ("unique", quality.UNIQUE), ("accepted_values", quality.ACCEPTED),
                           ("relationships", quality.RELATIONSHIPS)):
        for name, columns in declared.items():
            source, names = TESTED[name]
            for column in columns:
                c = names.get(column, column)
                failing = {
                    "not_null": f"(select * from {source} where {c} is null)",
                    "unique": f"(select {c} from {source} where {c} is not null group by {c} having count(*) > 1)",
                    "relationships": f"(select * from {source} where {c} not in (select {c} from dim))",
                }.get(kind) or (f"(select * from {source} where {c} not in "
                                f"({', '.join(repr(v) for v in columns[column])}))")
                yield f"select '{kind}_{name}_{column}' as test, count(*) as failing_rows from {failing} t"


# Columns on which the keys, times, prices and flags hang that tests are declared on, or that models are joined by.
TESTED_COLUMNS = {"quotes": ["symbol", "price", "volume", "quote_timestamp"], "dim_stocks": ["stock_id", "symbol", "is_active"]}


def kept(df, name):
    """Store the tested columns of a table, and only them. The others are NULL: nothing is read that hangs on them."""
    columns = TESTED_COLUMNS[name]
    rows = session.stored(df.select(*columns), name.replace("_", "-"))
    return rows.select(*[(F.col(f.name) if f.name in columns else F.lit(None).cast(f.dataType)).alias(f.name)
                         for f in df.schema])


def tested_tables(quotes, screeners, news, history, keep=kept):
    """Raw tables and models with the columns that tests are declared on.

    The dimension has one row per symbol, so facts hash it in partitions instead of sorting all quotes.
    """
    quotes = keep(quotes, "quotes")
    staged, stories = staging.stg_quotes(quotes), staging.stg_news(news)
    dim = keep(marts.dim_stocks(staged, staging.stg_screeners(screeners), stories, AS_OF), "dim_stocks")
    days = marts.quote_measures(staged)
    raw = {"stock_quotes": quotes.withColumnRenamed("quote_timestamp", "timestamp"), "market_screeners": screeners,
           "stock_news": news, "stock_history": history}
    models = {
        "dim_stocks": dim, "fact_stock_quotes": marts.fact_quotes(staged, dim.hint("shuffle_hash")),
        "fact_market_performance": marts.market_performance(days),
        "fact_news_sentiment": marts.news_sentiment_fact(stories, dim), "mart_daily_summary": marts.daily_summary(days, stories),
    }
    return {name: df.select(*quality.tested_columns(name)) for name, df in (raw | models).items()}


@query("\nunion all ".join(declared_sql()))
def declared_tests(spark, sf_dir):
    """All tests that are declared on raw tables and models. Models are stored first, raw tables are read as they are.

    The quotes are joined to their parts once; the dimension, facts and marts read the stored columns.
    """
    tables = tested_tables(*[view(spark, sf_dir, name) for name in ("quotes", "screeners", "news", "history")])
    for name in ("fact_stock_quotes", "fact_market_performance", "fact_news_sentiment", "mart_daily_summary"):
        tables[name] = session.stored(tables[name], name.replace("_", "-"))
    counts = [quality.failing_counts(name, df, tables) for name, df in tables.items()]
    return session.stored(reduce(DataFrame.unionByName, counts), "declared-tests")
