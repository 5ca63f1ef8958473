"""Summaries and the read model on small hand-computed inputs; exact median by brute force."""

from __future__ import annotations

import datetime as dt
import random
import statistics

import duckdb
import pytest
from pyspark.sql import functions as F

from tapeworks.operators import latest, readmodel, summary
from tapeworks.operators.median import exact_median
from tapeworks.plans import batch, dashboard
from tapeworks.sources.lake import rows
from workload import summaries  # noqa: F401
from workload.check import compare
from workload.registry import ORACLE, QUERIES

QUOTES = [
    ("AAPL", 150.25, 50_000_000, 1.5, "2024-01-01 10:00:00"),
    ("MSFT", 300.50, 30_000_000, -0.5, "2024-01-01 10:00:00"),
    ("GOOGL", 250.75, 20_000_000, 2.1, "2024-01-01 10:00:00"),
    ("AAPL", 151.00, 45_000_000, 0.5, "2024-01-01 11:00:00"),
    ("MSFT", 301.25, 35_000_000, 0.25, "2024-01-01 11:00:00"),
    ("GOOGL", 252.00, 25_000_000, 0.5, "2024-01-01 11:00:00"),
]


@pytest.fixture(scope="module")
def quotes(spark):
    names = ["symbol", "price", "volume", "change_percent", "timestamp"]
    return rows(spark, [dict(zip(names, q)) for q in QUOTES],
                "symbol STRING, price DOUBLE, volume BIGINT, change_percent DOUBLE, timestamp TIMESTAMP")


def test_batch_job(quotes, tmp_path):
    stored = batch.run(quotes, str(tmp_path))
    market = stored["market_summary"].first()
    assert (market.date, market.total_stocks, market.gainers, market.losers, market.total_volume,
            market.market_sentiment) == ("2024-01-01", 6, 5, 1, 205_000_000, "Bullish")
    assert market.avg_price == pytest.approx(234.2916666666) and market.avg_change_percent == 0.725
    top = stored["top_performers"].orderBy(F.desc("avg_change_percent")).collect()
    assert [(r.symbol, r.avg_change_percent) for r in top] == [
        ("GOOGL", 1.3), ("AAPL", 1.0), ("MSFT", -0.125)]
    daily = {r.symbol: r for r in stored["daily_aggregations"].collect()}
    assert daily["AAPL"].record_count == 2
    assert daily["AAPL"].price_volatility == pytest.approx(0.75 / 150.625 * 100)
    assert quotes.sparkSession.read.json(str(tmp_path / "top_performers.json")).count() == 3
    trends = summary.batch_quotes(quotes).where("price_trend = 'Strong Up'").collect()
    assert [(r.symbol, r.hour) for r in trends] == [("GOOGL", 10)]


def test_batch_job_compresses_its_json(spark, tmp_path):
    """The JSON copy is smaller than half its text, in files of few rows, and holds the same rows."""
    quotes = spark.range(2000).selectExpr(
        "concat('S', id) as symbol", "id + 0.25D as price", "id * 1000 as volume", "id % 7 - 3.5D as change_percent",
        "timestamp'2024-01-02 10:00:00' as timestamp")
    stored = batch.run(quotes, str(tmp_path), per_file=300)["daily_aggregations"]
    files = list((tmp_path / "daily_aggregations.json").glob("part-*"))
    text = stored.agg(F.sum(F.length(F.to_json(F.struct("*"))))).first()[0]
    assert len(files) >= 7 and sum(f.stat().st_size for f in files) < text / 2
    back = spark.read.schema(stored.schema).json(str(tmp_path / "daily_aggregations.json"))
    assert sorted(back.collect()) == sorted(stored.collect()) and back.count() == 2000


def test_market_summary_leaves_out_missing_measures(spark, quotes):
    assert summary.market_summary(quotes.select("symbol")).columns == ["total_stocks"]
    empty = summary.market_summary(quotes.limit(0)).first()
    assert (empty.total_stocks, empty.gainers, empty.avg_price) == (0, 0, None)


def test_sector_stats(spark):
    df = spark.createDataFrame(
        [("T", 10.0, 1.0, 5, 100.0), ("T", 20.0, 2.0, 7, None), ("T", 40.0, None, None, 50.0),
         ("E", 5.0, 0.5, 1, 1.0), (None, 9.0, 9.0, 9, 9.0)],
        "sector string, price double, change_percent double, volume bigint, market_cap double")
    got = {r.sector: r for r in summary.sector_stats(df).collect()}
    assert sorted(got) == ["E", "T"]
    t, e = got["T"], got["E"]
    assert (t.price_mean, t.price_median, t.price_std, t.price_count) == (23.33, 20.0, 15.28, 3)
    assert (t.change_percent_median, t.volume_sum, t.volume_mean, t.market_cap_sum) == (1.5, 12.0, 6.0, 150.0)
    assert (e.price_std, e.price_median) == (None, 5.0)
    assert summary.sector_stats(df.drop("sector")) is None


@pytest.mark.parametrize("shape", ["spread", "few values", "outliers", "one value"])
def test_exact_median(spark, shape):
    rng = random.Random(shape)
    draw = {"spread": lambda: rng.uniform(-1e3, 1e3), "few values": lambda: float(rng.randrange(5)),
            "outliers": lambda: rng.choice([rng.gauss(0, 1), 1e15, -1e300]), "one value": lambda: 7.0}[shape]
    data = [(g, draw() if rng.random() > 0.05 else rng.choice([None, float("nan")]))
            for g, size in [("a", 2001), ("b", 2000), ("c", 1), ("d", 2)] for _ in range(size)]
    df = spark.createDataFrame(data, "g string, v double")
    got = {r.g: r.median_v for r in exact_median(df, "g", ["v"]).collect()}
    groups = {}
    for g, v in data:
        if v is not None and v == v:
            groups.setdefault(g, []).append(v)
    assert got == {g: statistics.median(v) for g, v in groups.items()}


def test_screener_lists_use_the_last_quote_and_break_ties_by_symbol(spark):
    t = [dt.datetime(2024, 1, 1, h) for h in range(24)]
    df = spark.createDataFrame(
        [("A", t[1], 1.0, 9.0, 5), ("A", t[2], 1.0, 1.0, 5), ("B", t[1], 1.0, 1.0, None), ("C", t[1], 1.0, -2.0, 8)],
        "symbol string, quote_timestamp timestamp_ntz, price double, change_percent double, volume bigint")
    got = {}
    for r in summary.screener_lists(df, k=2).orderBy("screener_type", "rank").collect():
        got.setdefault(r.screener_type, []).append(r.symbol)
    assert got == {"day_gainers": ["A", "B"], "day_losers": ["C", "A"], "most_actives": ["C", "A"]}


def test_dedupe_and_newest(spark):
    df = spark.createDataFrame([("A", 1, 5), ("A", 1, 7), ("A", 2, 1)], "symbol string, t int, v int")
    assert sorted(latest.dedupe(df, ("symbol", "t")).collect()) == [("A", 1, 7), ("A", 2, 1)]
    assert latest.newest_rows(df, ["symbol"], "t").collect() == [("A", 2, 1)]
    odd = spark.createDataFrame(
        [(None, None, {"a": 1}), (None, None, {"b": 2}), ("A", None, {"c": 1}), ("A", 3, None), ("A", 3, None)],
        "symbol string, t int, m map<string, int>")
    assert sorted(map(repr, latest.dedupe(odd, ("symbol", "t")).collect())) == sorted(map(repr, [
        odd.collect()[1], odd.collect()[2], odd.collect()[3]]))
    assert sorted(repr(tuple(r)) for r in latest.newest_rows(odd, ["symbol"], "t").collect()) == sorted(
        [repr((None, None, {"b": 2})), repr(("A", 3, None))])


@pytest.fixture(scope="module")
def page(spark):
    d = [dt.date(2024, 1, i) for i in range(1, 5)]
    df = spark.createDataFrame(
        [("A", d[0], 10.0, 1.0, 5, 1e9), ("A", d[1], None, 9.5, 6, None), ("B", d[1], 20.0, 10.0, 7, 2e9),
         ("C", d[2], 30.0, -1.0, 8, 3e9)],
        "symbol string, date date, price double, change_percent double, volume bigint, market_cap double")
    news = spark.createDataFrame(
        [("A", "t1", dt.datetime(2024, 1, 1), 1, "General"), ("A", "t2", None, 0, "General")],
        "symbol string, title string, published_time timestamp, sentiment_score int, news_category string")
    return dashboard.page(df, news, start="2024-01-01", end="2024-01-02", pivot_dates=d[:2])


def test_dashboard_page(page):
    latest_prices = {r.symbol: r for r in page["latest_prices"].collect()}
    assert sorted(latest_prices) == ["A", "B"]
    a = latest_prices["A"]
    assert (a.price, a.change_percent, a.volume, a.market_cap, a.change_text) == (10.0, 9.5, 6, 1e9, "+9.50%")
    assert [r.symbol for r in page["top_movers"].collect()] == ["B", "A"]
    day = page["summary"].first()
    assert (str(day.date), day.total_stocks, day.gainers, day.total_volume) == ("2024-01-02", 2, 2, 13)
    assert tuple(page["bounds"].first()) == (dt.date(2024, 1, 1), dt.date(2024, 1, 3))
    assert [r.symbol for r in page["news"].collect()] == ["A", "A"]
    assert page["news"].first().title == "t1"
    heat = {r.symbol: (r["2024-01-01"], r["2024-01-02"]) for r in page["heat_map"].collect()}
    assert heat == {"A": (1.0, 9.5), "B": (None, 10.0)}
    assert page["sentiment"].first().avg_sentiment == 0.5
    assert [r.symbol for r in page["prices"].collect()] == ["A", "A", "B"]


def test_select_view_without_choice_keeps_all(quotes):
    assert readmodel.select_view(quotes).count() == 6
    assert readmodel.select_view(quotes, ["MSFT"]).count() == 2


def test_latest_prices_by_place_take_the_first_row_of_a_tie(spark):
    """A missing value of the first row leaves it to the next; a symbol without any value stays."""
    day = dt.datetime(2024, 1, 2, 10)
    data = [("A", 1, 5.0, None, day), ("A", 2, 9.0, 3, day), ("A", 0, 99.0, 8, day - dt.timedelta(hours=1)),
            ("B", 4, None, 7, day), ("B", 3, None, 6, day), ("C", 5, None, None, day)]
    df = spark.createDataFrame(data, "symbol string, place int, price double, volume long, at timestamp")
    got = latest.newest_values(df, ["symbol"], "at", ["price", "volume"], "place").orderBy("symbol").collect()
    assert [tuple(r) for r in got] == [("A", 5.0, 3), ("B", None, 6), ("C", None, None)]
    got = latest.newest_values(df, ["symbol"], "at", ["price", "volume"]).orderBy("symbol").collect()
    assert [tuple(r) for r in got] == [("A", 9.0, 3), ("B", None, 7), ("C", None, None)]


def test_latest_prices_equal_their_sql_on_ties(spark, tmp_path):
    """The first of two line items at the newest time is the lesser one for odd parts."""
    items = [(24 * n, part, 1, quantity, 100.0 * quantity, 0.01 * quantity, 0.02, "A", "O", dt.datetime(1996, 1, 2))
             for part in range(20) for n, quantity in enumerate([3.0, 5.0] if part % 2 else [5.0, 3.0])]
    spark.createDataFrame(items, """l_orderkey long, l_partkey long, l_linenumber int, l_quantity double, l_extendedprice double,
        l_discount double, l_tax double, l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz""") \
        .coalesce(1).write.parquet(str(tmp_path / "lineitem.parquet"))
    spark.range(20).selectExpr("id as p_partkey", "'rod' as p_name", "1.0D as p_retailprice") \
        .coalesce(1).write.parquet(str(tmp_path / "part.parquet"))
    con = duckdb.connect()
    for name in ("lineitem", "part"):
        con.execute(f"create view {name} as select * from '{tmp_path}/{name}.parquet/*.parquet'")
    for name in ("latest_prices", "top_movers"):
        assert compare(QUERIES[name](spark, str(tmp_path)), con, ORACLE[name]) == []
