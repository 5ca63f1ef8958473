"""Band boundaries, keyword classes, text and number clean-up, measures."""

from __future__ import annotations

import datetime as dt
import hashlib
import math

import pytest
from pyspark.sql import functions as F

from tapeworks.functions import bands, market, text


def values(spark, ddl, data, *columns):
    df = spark.createDataFrame([(d,) for d in data], f"x {ddl}")
    return [tuple(r) if len(columns) > 1 else r[0] for r in df.select(*columns).collect()]


CHANGES = [10.01, 10.0, 5.01, 5.0, 2.01, 2.0, 0.01, 0.0, -0.01, -2.0, -2.01, -5.0, -5.01, -10.0, None]


@pytest.mark.parametrize("rules, expected", [
    (bands.TREND_STREAM, ["Strong Up"] * 5 + ["Up"] * 2 + ["Sideways"] * 2 + ["Down"] * 2
     + ["Strong Down"] * 4),
    (bands.TREND_WAREHOUSE, ["Strong Up"] * 3 + ["Up"] * 4 + ["Sideways"] * 4 + ["Down"] * 2
     + ["Strong Down"] * 2),
    (bands.TREND_BATCH, ["Strong Up"] * 5 + ["Up"] * 2 + ["Sideways"] * 2 + ["Down"] * 6),
    (bands.PERFORMANCE, ["Outstanding"] + ["Excellent"] * 2 + ["Good"] * 4 + ["Poor"] * 4
     + ["Terrible"] * 4),
])
def test_change_bands(spark, rules, expected):
    assert values(spark, "double", CHANGES, bands.band(F.col("x"), rules)) == expected


def test_market_cap_bands(spark):
    caps = [200e9, 200e9 - 1, 10e9, 10e9 - 1, 2e9, 2e9 - 1, 300e6, 300e6 - 1, None]
    expected = ["Mega Cap", "Large Cap", "Large Cap", "Mid Cap", "Mid Cap", "Small Cap",
                "Small Cap", "Micro Cap", "Micro Cap"]
    assert values(spark, "double", caps, bands.band(F.col("x"), bands.MARKET_CAP)) == expected
    unlabelled = bands.band(F.col("x"), bands.MARKET_CAP, null_label=None)
    assert values(spark, "double", [None, 1.0], unlabelled) == [None, "Micro Cap"]
    assert values(spark, "double", [None], bands.band(
        F.col("x"), bands.MARKET_CAP, null_label="Unknown")) == ["Unknown"]


def test_first_keyword_class_wins(spark):
    titles = ["Profit after merger", "DEAL on product", "Launch by CEO", "New management", "Rain", None]
    assert values(spark, "string", titles, bands.classify(F.col("x"), bands.NEWS_CATEGORY)) == [
        "Financial", "M&A", "Product", "Leadership", "General", "General"]
    titles = ["Growth despite loss", "Heavy LOSS", "A gain", "flat", None]
    assert values(spark, "string", titles, bands.sentiment_score(F.col("x"))) == [1, -1, 1, 0, 0]
    names = ["Fintech Bank", "Medical Oil", "First Bank", "Gas Retail", "Big Retail", "City Utility",
             "Industrial Co", "Raw Material", "Real Estate Co", "Ship"]
    assert values(spark, "string", names, bands.classify(F.col("x"), bands.SECTOR_BY_NAME)) == [
        "Technology", "Healthcare", "Financial Services", "Energy", "Consumer Discretionary",
        "Utilities", "Industrials", "Materials", "Real Estate", "Other"]


def test_style_and_sentiment(spark):
    assert values(spark, "string", ["Technology", "Energy", "Utilities", "Shipping", "", None],
                  bands.style_of(F.col("x"))) == ["Growth", "Cyclical", "Defensive", "Other", None, None]
    df = spark.createDataFrame([(4, 2), (3, 2), (2, 2), (2, 3), (2, 4)], "g int, l int")
    got = df.select(bands.market_sentiment(F.col("g"), F.col("l")).alias("three"),
                    bands.market_sentiment(F.col("g"), F.col("l"), 1.5).alias("five")).collect()
    assert [r.three for r in got] == ["Bullish", "Bullish", "Neutral", "Bearish", "Bearish"]
    assert [r.five for r in got] == ["Very Bullish", "Bullish", "Neutral", "Bearish", "Very Bearish"]


def test_numbers_and_text(spark):
    assert values(spark, "string", ["$1,234.50", " 12.5% ", "", "n/a", None, "-3"],
                  text.parse_number(F.col("x"))) == [1234.5, 12.5, None, None, None, -3.0]
    assert values(spark, "string", [" aapl ", None], text.clean_symbol(F.col("x"))) == ["AAPL", None]
    assert values(spark, "string", ["Société: up!"], text.clean_text(F.col("x")),
                  text.clean_text(F.col("x"), unicode=True)) == [("Socit up", "Société up")]
    counts = values(spark, "string", ["a b  c", "", None],
                    text.word_count(F.col("x"), rules="stream"), text.word_count(F.col("x")))
    assert counts == [(4, 4), (1, 0), (None, 0)]
    with pytest.raises(ValueError):
        text.word_count(F.col("x"), rules="other")


def test_times_and_longs(spark):
    times = values(spark, "string", ["1700000000", "2024-01-01 10:00:00", "2024-01-01T10:00:00.5",
                                     "99999999999999999999", "soon", None], text.to_time(F.col("x")))
    assert times == [dt.datetime(2023, 11, 14, 22, 13, 20), dt.datetime(2024, 1, 1, 10),
                     dt.datetime(2024, 1, 1, 10, 0, 0, 500000), None, None, None]
    assert values(spark, "string", ["3000000000", "5.0E7", "1.9", "x", None],
                  text.to_long(F.col("x"))) == [3_000_000_000, 50_000_000, 1, None, None]


def test_measures(spark):
    assert values(spark, "double", [None, float("nan"), 2.0],
                  market.fill_missing(F.col("x"), 0.0)) == [0.0, 0.0, 2.0]
    assert values(spark, "bigint", [None, 3], market.fill_missing(F.col("x"), 0)) == [0, 3]
    df = spark.createDataFrame([(1.0, 3.0, 2.0), (1.0, 1.0, 0.0)], "lo double, hi double, av double")
    assert [r[0] for r in df.select(market.range_volatility(
        F.col("lo"), F.col("hi"), F.col("av"))).collect()] == [100.0, None]
    df = spark.createDataFrame([(11.0, 10.0, 100), (11.0, 0.0, 100), (11.0, None, 100)],
                               "p double, prev double, v bigint")
    got = [r[0] for r in df.select(market.dollar_volume(
        "warehouse", F.col("p"), F.col("v"), F.col("prev"))).collect()]
    assert got == [pytest.approx(10.0), 0.0, 0.0]
    assert df.select(market.dollar_volume("batch", F.col("p"), F.col("v"))).first()[0] == 1100.0
    with pytest.raises(ValueError):
        market.dollar_volume("other", F.col("p"), F.col("v"))
    assert values(spark, "double", [1.5, -0.25, 0.0], market.signed_pct(F.col("x"))) == [
        "+1.50%", "-0.25%", "+0.00%"]
    df = spark.createDataFrame([(1, 4), (1, 0)], "a int, b int")
    assert [tuple(r) for r in df.select(
        market.safe_pct(F.col("a"), F.col("b")), market.safe_ratio(F.col("a"), F.col("b"))).collect()
    ] == [(25.0, 0.25), (0.0, 0.0)]


def test_time_dims_and_keys(spark):
    df = spark.createDataFrame([("A", dt.datetime(2024, 1, 7, 9, 59)), (None, dt.datetime(2024, 1, 8, 16))],
                               "s string, t timestamp_ntz")
    got = df.select(*market.time_dims(F.col("t")).values(), market.market_hours(F.col("t")),
                    market.surrogate_key(F.col("s"), F.col("t"))).collect()
    key = [hashlib.md5(k.encode()).hexdigest() for k in (
        "A-2024-01-07 09:59:00", "_dbt_utils_surrogate_key_null_-2024-01-08 16:00:00")]
    assert [tuple(r) for r in got] == [
        (dt.date(2024, 1, 7), 9, 0, "Weekend", False, key[0]),
        (dt.date(2024, 1, 8), 16, 1, "Weekday", False, key[1])]
    times = [dt.datetime(2024, 1, 8, 8, 59), dt.datetime(2024, 1, 8, 9), dt.datetime(2024, 1, 12, 15, 59)]
    assert values(spark, "timestamp_ntz", times, market.market_hours(F.col("x"))) == [False, True, True]


def test_mean_drops_summation_noise(spark):
    noisy = [0.1, 0.2, -0.3]
    assert sum(noisy) != 0 and math.isclose(sum(noisy), 0, abs_tol=1e-15)
    assert values(spark, "double", noisy, market.mean("x")) == [0.0]
