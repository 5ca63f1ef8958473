"""Dimension and marts on small inputs: gaps, ties, late symbols."""

from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from tapeworks import schemas
from tapeworks.operators import latest, quality, readmodel, summary
from tapeworks.plans import marts, staging
from tapeworks.session import stored
from tapeworks.sources import sinks
from tapeworks.sources.lake import rows

AS_OF = dt.datetime(2024, 1, 10)
EXTRA = ", message_timestamp TIMESTAMP, job_id STRING"


@pytest.fixture(scope="module")
def staged(spark):
    quotes = rows(spark, [
        {"symbol": "A", "name": "Old Tech", "price": 1.0, "volume": 1, "change_percent": 1.0, "timestamp": "2024-01-01 09:00:00"},
        {"symbol": "A", "name": "New Bank", "price": 2.0, "previous_close": 1.0, "volume": 9, "change_percent": 2.0,
         "exchange": "X", "timestamp": "2024-01-02 09:00:00"},
        {"symbol": "B", "name": "Bee", "price": 3.0, "volume": 9, "change_percent": 2.0, "timestamp": "2024-01-02 09:00:00"},
        {"symbol": "B", "name": "Bee", "price": 3.0, "volume": 2, "change_percent": None, "timestamp": "2024-01-02 10:00:00"},
        {"symbol": "C", "name": "See", "price": 3.0, "volume": -1, "change_percent": 99.0, "timestamp": "2024-01-09 09:00:00"},
        {"symbol": "D", "name": "Dee", "price": 0.0, "volume": 1, "change_percent": 99.0, "timestamp": "2024-01-09 09:00:00"},
    ], schemas.QUOTE + EXTRA + ", source STRING")
    screeners = rows(spark, [
        {"symbol": "C", "screener_type": "x", "price": 1.0, "change_percent": 1.0, "market_cap": 5e9, "message_timestamp": "2024-01-01"},
        {"symbol": "A", "screener_type": None, "price": 1.0, "change_percent": 1.0, "message_timestamp": "2024-01-01"},
        {"symbol": "A", "screener_type": "x", "price": 1.0, "change_percent": None, "message_timestamp": "2024-01-01"},
    ], schemas.SCREENER + EXTRA + ", source STRING")
    news = rows(spark, [
        {"symbol": "N", "title": "Merger growth story", "url": "u", "published_time": "2024-01-02 05:00:00", "message_timestamp": "2024-01-02"},
        {"symbol": "N", "title": "short", "url": "u", "published_time": "2024-01-02 05:00:00", "message_timestamp": "2024-01-03"},
        {"symbol": "A", "title": "Profit decline seen", "url": "v", "published_time": None, "message_timestamp": "2024-01-02"},
    ], schemas.NEWS + EXTRA)
    return staging.stg_quotes(quotes), staging.stg_screeners(screeners), staging.stg_news(news)


def test_staging_flags(staged):
    quotes, screeners, news = staged
    assert {(r.symbol, r.is_valid_quote) for r in quotes.collect()} == {("A", True), ("B", True), ("C", False)}
    assert {(r.symbol, r.is_valid_screener) for r in screeners.collect()} == {("C", True), ("A", False)}
    assert sorted((r.title, r.is_valid_news, r.word_count) for r in news.collect()) == [
        ("Merger growth story", True, 3), ("Profit decline seen", True, 3), ("short", False, 1)]


def test_dimension(staged):
    dim = {r.symbol: r for r in marts.dim_stocks(*staged, as_of=AS_OF).collect()}
    assert sorted(dim) == ["A", "B", "C", "N"]
    a, c, n = dim["A"], dim["C"], dim["N"]
    assert (a.name, a.exchange, a.currency, a.sector, a.industry, a.market_cap_category,
            a.primary_news_category, a.is_active) == (
        "New Bank", "X", "USD", "Financial Services", "Banking", "Unknown", "Financial", False)
    # C has only an invalid quote: unknown name, but active through it.
    assert (c.name, c.market_cap_category, c.is_active) == ("Unknown", "Mid Cap", True)
    assert (n.primary_news_category, n.is_active, n.name) == ("M&A", False, "Unknown")
    assert dim["B"].exchange == "Unknown"


def test_daily_summary(staged):
    quotes, _, news = staged
    fact = marts.fact_quotes(quotes, marts.dim_stocks(*staged, as_of=AS_OF), AS_OF)
    assert fact.columns == [*marts.FACT_COLUMNS, "created_at"]
    days = {str(r.date): r for r in marts.daily_summary(fact, news, AS_OF).collect()}
    assert sorted(days) == ["2024-01-01", "2024-01-02"]
    day = days["2024-01-02"]
    assert (day.total_stocks, day.total_quotes, day.gainers, day.losers, day.avg_change_percent) == (2, 3, 2, 0, 2.0)
    # Ties go to the lower symbol and an unknown change never wins.
    assert (day.top_gainer, day.top_loser, day.most_active, day.most_active_volume) == ("A", "A", "A", 9)
    assert (day.total_dollar_volume, day.news_count, day.stocks_with_news, day.avg_sentiment) == (9.0, 1, 1, 1.0)
    assert (day.market_sentiment, day.market_trend, day.gainer_percentage) == ("Very Bullish", "Up", 100.0)
    assert days["2024-01-01"].news_count == 0
    lean = marts.daily_summary(marts.quote_measures(quotes), news, AS_OF)
    assert sorted(lean.collect(), key=str) == sorted(
        marts.daily_summary(fact, news, AS_OF).select(*lean.columns).collect(), key=str)


def test_performance_sector_and_news_facts(staged):
    quotes, _, news = staged
    dim = marts.dim_stocks(*staged, as_of=AS_OF)
    fact = marts.fact_quotes(quotes, dim, AS_OF)
    assert {(str(r.date), r.market_sentiment) for r in marts.market_performance(fact).collect()} == {
        ("2024-01-01", "Bullish"), ("2024-01-02", "Bullish")}
    sectors = {(str(r.quote_date), r.sector): (r.stocks_in_sector, r.sector_volume)
               for r in marts.sector_performance(fact, dim).collect()}
    assert sectors[("2024-01-02", "Other")] == (1, 11)
    facts = marts.news_sentiment_fact(news, dim).collect()
    assert [(r.symbol, r.sentiment_score) for r in facts] == [("N", 1)]
    assert facts[0].stock_id == dim.where("symbol = 'N'").first().stock_id


def test_top_picks_need_no_window(staged):
    quotes, _, news = staged
    plan = marts.daily_summary(marts.quote_measures(quotes), news, AS_OF)._jdf.queryExecution()
    assert "Window" not in plan.executedPlan().toString()


def sorted_inputs(df):
    """Of the executed plan: for each sort aggregate, whether it stands on rows that a semi-join has left."""
    lines = df._jdf.queryExecution().executedPlan().toString().split("\n")
    depth = [len(x) - len(x.lstrip(" :+-*(0123456789)")) for x in lines]
    for k, line in enumerate(lines):
        if "SortAggregate" in line:
            below = [x for x, d in zip(lines[k + 1:], depth[k + 1:]) if d > depth[k]]
            yield any("LeftSemi" in x for x in below)


def test_newest_rows_need_no_sort_of_the_input(staged):
    quotes, screeners, news = staged
    times = quotes.withColumn("date", F.to_date("quote_timestamp"))
    for df, sorts in ((marts.dim_stocks(quotes, screeners, news, as_of=AS_OF), True),
                      (readmodel.latest_prices(times, "quote_timestamp"), False),
                      (summary.screener_lists(quotes), True), (latest.dedupe(quotes), True)):
        found = list(sorted_inputs(df))
        assert all(found) and bool(found) == sorts


def test_last_day_reads_one_partition(spark, tmp_path):
    rows = [("A", dt.date(2024, 1, d), 1.0 * d, d) for d in range(1, 9)]
    df = spark.createDataFrame(rows, "symbol string, date date, change_percent double, volume bigint")
    df.write.partitionBy("date").parquet(str(tmp_path / "days"))
    got = readmodel.latest_day_summary(spark.read.parquet(str(tmp_path / "days")))
    assert [(str(r.date), r.total_stocks, r.total_volume) for r in got.collect()] == [("2024-01-08", 1, 8)]
    scans = [x for x in got._jdf.queryExecution().executedPlan().toString().split("\n") if "FileScan" in x]
    assert "(date#" in scans[0] and "Subquery" in scans[0].split("PartitionFilters")[1].split("PushedFilters")[0]


@pytest.fixture
def no_broadcast(spark):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_facts_read_quotes_once_and_shuffle_nothing(spark, staged):
    quotes, screeners, news = staged
    dim = stored(marts.dim_stocks(quotes, screeners, news, as_of=AS_OF), "dim")
    facts = marts.fact_quotes(stored(quotes, "quotes"), dim, AS_OF)
    plan = facts._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 2 and "Exchange hashpartitioning" not in plan


def test_bucketed_facts_shuffle_nothing(spark, staged, no_broadcast):
    quotes, screeners, news = staged
    sinks.materialize(quotes, "stg_quotes_b", "table", bucket_by="symbol", buckets=4)
    sinks.materialize(marts.dim_stocks(quotes, screeners, news, as_of=AS_OF), "dim_b", "table", bucket_by="symbol", buckets=4)
    facts = marts.fact_quotes(spark.table("analytics.stg_quotes_b"), spark.table("analytics.dim_b"), AS_OF)
    plan = facts._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "SortMergeJoin" in plan
    dim = stored(marts.dim_stocks(quotes, screeners, news, as_of=AS_OF), "dim")
    assert sorted(facts.collect()) == sorted(marts.fact_quotes(quotes, dim, AS_OF).collect())


def test_hot_keys_are_dealt_over_tasks(spark, tmp_path, no_broadcast):
    """A million child rows are equal, some keys are NULL, a column holds maps. Sizes are those of compressed rows."""
    small = {"spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20k",
             "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20k", "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2"}
    before = {k: spark.conf.get(k) for k in small}
    child = spark.range(0, 1_010_000, numPartitions=20).select(
        F.when(F.col("id") % 101 != 0, "hot").when(F.col("id") % 50 == 1, None).otherwise((F.col("id") % 5000).cast("string")).alias("k"),
        F.struct(F.create_map(F.lit("a"), F.lit(1)).alias("m")).alias("s"))
    child.write.parquet(str(tmp_path / "child"))
    child = spark.read.parquet(str(tmp_path / "child"))
    parents = spark.range(0, 4000).select(F.col("id").cast("string").alias("k"))
    for name, value in small.items():
        spark.conf.set(name, value)
    try:
        orphans = quality.failing_relationship(child, "k", parents).withColumn("task", F.spark_partition_id())
        sizes = {r.task: r["count"] for r in orphans.where("k = 'hot'").groupBy("task").count().collect()}
    finally:
        for name, value in before.items():
            spark.conf.set(name, value)
    assert sum(sizes.values()) == 1_000_000 and len(sizes) > 3 and max(sizes.values()) < 300_000


def test_fact_shuffles_no_hashes(spark):
    """The join with the dimension comes before keys and measures, so a shuffle carries neither."""
    quotes = spark.createDataFrame(
        [], "symbol string, quote_timestamp timestamp, price double, previous_close double, open double, high double, "
        "low double, change double, change_percent double, volume long, market_cap double, pe_ratio double, "
        "dividend_yield double, price_trend string, volatility double, market_cap_category string, "
        "is_valid_quote boolean, message_timestamp timestamp, job_id string, source string")
    dim = spark.createDataFrame(
        [], "symbol string, stock_id string, sector string, industry string, market_cap_category string")
    plan = marts.fact_quotes(quotes, dim)._jdf.queryExecution().analyzed().toString()
    above, below = plan.split("Join LeftOuter")
    assert "md5" in above and "md5" not in below
