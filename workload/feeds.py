"""JSON feeds built from the test tables and parsed again."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tapeworks.operators import catalogue, feeds
from tapeworks.plans.catalogue import extract
from tapeworks.session import shared_dir
from tapeworks.sources.messages import read_messages, save_messages
from workload.registry import query
from workload.views import table, view


def responses(df: DataFrame, item: Column, *tags: str, under: str = "body") -> DataFrame:
    """One response per row, with the item in an array."""
    return df.select(*tags, F.to_json(F.struct(F.array(item).alias(under))).alias("value"))


# A topic or feed has so many partitions, by key.
PARTITIONS = 16


def landed(df: DataFrame, name: str) -> DataFrame:
    """The ``value`` texts as users have them: in files, one per line, written before they are parsed."""
    path = save_messages(df, f"{shared_dir(df.sparkSession, name)}/{name}")
    return read_messages(df.sparkSession, "files", stream=False, path=path)


def epoch(time: str) -> Column:
    return F.expr(f"timestampdiff(second, timestamp_ntz '1970-01-01 00:00:00', {time})")


def ntz(df: DataFrame, *times: str) -> DataFrame:
    return df.withColumns({t: F.col(t).cast("timestamp_ntz") for t in times})


# Every 13th quote has a price that is no number, every 17th order no symbol: both are rejected.
QUOTE_SQL = """
select symbol, coalesce(nullif(long_name, ''), short_name) as name, price, previous_close,
  cast(null as double) as open, cast(null as double) as high, cast(null as double) as low, volume,
  market_cap, cast(null as double) as pe_ratio, cast(null as double) as dividend_yield,
  cast(null as double) as change, change_percent, currency, exchange, quote_type,
  date_trunc('minute', quote_timestamp) as timestamp
from (select *, case when volume % 3 = 0 then '' else name end as long_name,
    concat(symbol, ' short') as short_name from quotes)
where coalesce(volume, 0) % 13 <> 6 and cast(substr(job_id, 5) as bigint) % 17 <> 0"""


def quote_responses(spark, sf_dir):
    df = view(spark, sf_dir, "quotes").repartition(PARTITIONS, "symbol")
    item = F.struct(
        F.expr("case when cast(substr(job_id, 5) as bigint) % 17 <> 0 then symbol end").alias("symbol"),
        F.expr("case when volume % 3 = 0 then '' else name end").alias("longName"),
        F.concat("symbol", F.lit(" short")).alias("shortName"),
        F.expr("case when coalesce(volume, 0) % 13 <> 6 then price end").alias("regularMarketPrice"),
        F.col("previous_close").alias("regularMarketPreviousClose"),
        F.col("volume").alias("regularMarketVolume"),
        F.col("market_cap").alias("marketCap"),
        F.col("change_percent").alias("regularMarketChangePercent"),
        F.col("exchange").alias("fullExchangeName"),
        F.col("quote_type").alias("quoteType"),
        epoch("quote_timestamp").alias("regularMarketTime"),
    )
    unreadable = F.lit('"regularMarketPreviousClose":'), F.lit(
        '"regularMarketPrice":"no price","regularMarketPreviousClose":')
    value = F.when(F.expr("coalesce(volume, 0) % 13 = 6"), F.replace("value", *unreadable))
    tagged = df.select("volume", F.to_json(F.struct(F.array(item).alias("body"))).alias("value"))
    return landed(tagged.select(value.otherwise(F.col("value")).alias("value")), "quote-responses")


@query(QUOTE_SQL)
def normalize_quotes_json(spark, sf_dir):
    return ntz(feeds.normalize_quotes(quote_responses(spark, sf_dir)).good, "timestamp")


@query("""
select case when cast(substr(job_id, 5) as bigint) % 17 = 0 then 'missing required field'
    else 'value of wrong type' end as reason, count(*) as rejects
from quotes
where coalesce(volume, 0) % 13 = 6 or cast(substr(job_id, 5) as bigint) % 17 = 0 group by 1""")
def rejected_quotes(spark, sf_dir):
    rejects = feeds.normalize_quotes(quote_responses(spark, sf_dir)).rejects
    return rejects.groupBy("reason").agg(F.count("*").alias("rejects"))


@query("""
select trim(symbol) as symbol, name, exchange, sector, industry,
  try_cast(replace(market_cap, ',', '') as double) as market_cap,
  coalesce(currency, 'USD') as currency, 'US' as country, cast(null as varchar) as website,
  cast(null as varchar) as description from stocks""")
def normalize_tickers(spark, sf_dir):
    df = view(spark, sf_dir, "stocks")
    item = F.struct(F.trim("symbol").alias("symbol"), "name", "exchange", "sector", "industry",
                    F.col("market_cap").alias("marketCap"), "currency", F.lit("US").alias("country"))
    return feeds.normalize_tickers(responses(df, item)).good


@query("""
select trim(symbol) as symbol, name, exchange, coalesce(nullif(sector, ''), 'Spare sector') as sector,
  coalesce(nullif(industry, ''), 'Spare industry') as industry, cast(null as double) as market_cap,
  'USD' as currency, 'US' as country, cast(null as varchar) as website,
  cast(null as varchar) as description from stocks""")
def normalize_search(spark, sf_dir):
    df = view(spark, sf_dir, "stocks")
    item = F.struct(F.trim("symbol").alias("symbol"), F.lit("").alias("longname"),
                    F.col("name").alias("shortname"), F.col("exchange").alias("exchDisp"),
                    F.col("sector").alias("sectorDisp"), F.lit("Spare sector").alias("sector"),
                    F.col("industry").alias("industryDisp"),
                    F.lit("Spare industry").alias("industry"))
    return feeds.normalize_search(responses(df, item)).good


@query("""
select symbol, date, cast(null as double) as open, cast(null as double) as high,
  cast(null as double) as low, close, volume, cast(null as double) as adjusted_close,
  bar_interval as interval from history""")
def normalize_history(spark, sf_dir):
    df = view(spark, sf_dir, "history").withColumnRenamed("bar_interval", "interval")
    item = F.struct(epoch("date").alias("timestamp_unix"), "close", "volume")
    return ntz(feeds.normalize_history(responses(df, item, "symbol", "interval")).good, "date")


@query("""
select concat(symbol, suffix) as symbol, cast(null as varchar) as name, price,
  cast(null as double) as change, change_percent, cast(null as bigint) as volume, market_cap,
  screener_type, position as rank
from screeners, (values ('a', 1), ('b', 2), ('c', 3)) v(suffix, position)
where screener_type is not null""")
def normalize_screener_rank(spark, sf_dir):
    df = view(spark, sf_dir, "screeners")
    items = F.array(*[
        F.struct(F.concat("symbol", F.lit(s)).alias("symbol"), F.col("price").alias("regularMarketPrice"),
                 F.col("change_percent").alias("regularMarketChangePercent"),
                 F.col("market_cap").alias("marketCap")) for s in "abc"])
    pages = df.select("screener_type", F.to_json(F.struct(items.alias("body"))).alias("value"))
    return feeds.normalize_screeners(pages).good


@query("""
select symbol, title, url, text, source, news_type, cast(null as timestamp) as published_time,
  image_url from news where title is not null and url is not null""")
def normalize_news(spark, sf_dir):
    df = view(spark, sf_dir, "news")
    item = F.struct("title", "url", "text", "source", F.col("news_type").alias("type"),
                    F.col("image_url").alias("img"))
    return ntz(feeds.normalize_news(responses(df, item, "symbol")).good, "published_time")


@query("""
select trim(symbol) as symbol, 'asset-profile' as module_type, sector,
  coalesce(currency, 'none') as currency
from stocks""")
def normalize_modules(spark, sf_dir):
    df = view(spark, sf_dir, "stocks").select(
        F.trim("symbol").alias("symbol"), F.lit("asset-profile").alias("module_type"),
        F.to_json(F.struct(F.struct("sector", "currency").alias("body"))).alias("value"))
    return feeds.normalize_modules(df).good.select(
        "symbol", "module_type", F.get_json_object("data", "$.sector").alias("sector"),
        F.coalesce(F.get_json_object("data", "$.currency"), F.lit("none")).alias("currency"))


@query("""
select symbol, name, price, previous_close, volume, market_cap, change_percent, currency, exchange,
  quote_type, quote_timestamp, message_timestamp, job_id, source, 'stock_quote' as data_type
from quotes""")
def envelope_roundtrip(spark, sf_dir):
    df = view(spark, sf_dir, "quotes").withColumnRenamed("quote_timestamp", "timestamp")
    messages = landed(feeds.to_envelope(df.repartition(PARTITIONS, "symbol"), "stock_quote", F.col("job_id"),
                                        "market_feed", F.col("message_timestamp")), "stock-quotes")
    good = feeds.parse_envelope(messages, "stock_quote").good
    return ntz(good.drop("open", "high", "low", "pe_ratio", "dividend_yield", "change"),
               "quote_timestamp", "message_timestamp")


@query("""
select symbol as key, count(*) as messages, sum(length(title)) as title_chars
from news where title is not null and url is not null group by symbol""")
def keyed_news_messages(spark, sf_dir):
    messages = feeds.to_envelope(view(spark, sf_dir, "news").drop("published_time"), "stock_news",
                                 "job-1", "market_feed")
    keyed = messages.groupBy("key").agg(F.count("*").alias("n"))
    good = feeds.parse_envelope(messages, "stock_news").good
    parsed = good.groupBy(F.col("symbol").alias("key")).agg(
        F.count("*").alias("messages"),
        F.sum(F.length("title")).cast("decimal(38,0)").alias("title_chars"))
    return parsed.join(keyed, "key", "left_semi")


# Products: every 13th has a stock quantity that is no number.
PRODUCT_SQL = """
select id as product_id, title as name, brand,
  try_cast(nullif(trim(replace(replace(price, '$', ''), ',', '')), '') as double) as price,
  'USD' as currency, category, stock_quantity
from products where cast(id as bigint) % 13 <> 0"""


def product_item() -> Column:
    return F.struct(
        "id", F.lit("").alias("name"), "title", "brand", "price", "category",
        F.expr("case when cast(id as bigint) % 13 = 0 then 'many' "
               "else cast(stock_quantity as string) end").alias("stock_quantity"))  # as text


PRODUCT_COLUMNS = ["product_id", "name", "brand", "price", "currency", "category", "stock_quantity"]


def category_responses(spark, sf_dir):
    df = view(spark, sf_dir, "products")
    return df.select(F.to_json(F.struct(
        F.col("category").alias("category_name"), F.concat(F.lit("/c/"), "category").alias("category_url"),
        F.lit(1).alias("total_products"), F.array(product_item()).alias("products"))).alias("value"))


@query(PRODUCT_SQL)
def normalize_products(spark, sf_dir):
    df = view(spark, sf_dir, "products")
    pages = responses(df, product_item(), under="products")
    return catalogue.normalize_products(pages).good.select(*PRODUCT_COLUMNS)


@query(f"""
select p.*, case when part = 1 then p.category end as category_name
from ({PRODUCT_SQL}) p, (values (1), (2)) v(part)""")
def category_union(spark, sf_dir):
    _, tagged = catalogue.flatten_categories(category_responses(spark, sf_dir))
    plain = catalogue.normalize_products(
        responses(view(spark, sf_dir, "products"), product_item(), under="products"))
    return catalogue.union_categories([
        tagged.good.select(*PRODUCT_COLUMNS, "category_name"),
        plain.good.select(*PRODUCT_COLUMNS)])


@query("""
select count(*) as total_categories, count(case when cast(id as bigint) % 13 <> 0 then 1 end)
    as total_products, count(case when cast(id as bigint) % 13 <> 0 then 1 end) as processed_items,
  count(case when cast(id as bigint) % 13 = 0 then 1 end) as failed_items from products""")
def catalogue_extraction(spark, sf_dir):
    return extract(category_responses(spark, sf_dir), shared_dir(spark, "catalogue"))["summary"]


@query("""
select category as query, cast(case when stock_quantity % 2 = 0 then 77
    when cast(id as bigint) % 13 = 0 then 0 else 1 end as integer) as total_results, 1 as page,
  cast(case when cast(id as bigint) % 13 = 0 then 0 else 1 end as integer) as page_size,
  cast(null as double) as search_time
from products""")
def flatten_search(spark, sf_dir):
    df = view(spark, sf_dir, "products")
    pages = df.select(
        F.col("category").alias("query"),
        F.to_json(F.struct(
            F.expr("case when stock_quantity % 2 = 0 then 77 end").alias("total_results"),
            F.array(product_item()).alias("products"))).alias("value"))
    return catalogue.flatten_search(pages)[0]


@query("""
select doc_id, cast(length(text) - length(replace(text, ' ', '')) + 1 as integer) as words,
  regexp_replace(text, '[^\\w\\s]', '', 'g') as cleaned from documents""")
def clean_text(spark, sf_dir):
    from tapeworks.functions import text

    df = table(spark, sf_dir, "documents")
    return df.select("doc_id", text.word_count(F.col("text"), rules="stream").alias("words"),
                     text.clean_text(F.col("text")).alias("cleaned"))
