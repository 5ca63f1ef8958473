"""Windows over chunks with halos against plain windows, with hot and sparse symbols."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from tapeworks.operators import series


@pytest.fixture(scope="module")
def history(spark):
    rng = random.Random(3)
    rows = []
    for i in range(600):  # one symbol holds most rows, some days have many, some months none
        symbol = "HOT" if i % 3 else f"S{i % 40}"
        day = rng.choice([rng.randrange(0, 40), rng.randrange(300, 330), rng.randrange(0, 1500)])
        rows.append((i, symbol, day, float(rng.randrange(1, 1000))))
    df = spark.createDataFrame(rows, "row_id INT, symbol STRING, day INT, close DOUBLE")
    return df.withColumn("date", F.date_add(F.lit("2020-01-01"), F.col("day")).cast("timestamp")).cache()


def collected(df):
    return {r.row_id: tuple(r) for r in df.orderBy("row_id").collect()}


@pytest.mark.parametrize("limit", [9, 100, 10_000])
@pytest.mark.parametrize("n", [2, 30])
def test_rolling_avg(history, n, limit):
    w = Window.partitionBy("symbol").orderBy("date", "row_id").rowsBetween(1 - n, 0)
    expected = history.withColumn(f"rolling_avg_{n}", F.avg("close").over(w))
    got = series.rolling_avg(history, n, ties=("row_id",), rows_per_task=limit)
    assert got.columns == expected.columns
    assert collected(got) == collected(expected)


@pytest.mark.parametrize("limit", [12, 10_000])
def test_daily_return_and_scd2(history, limit):
    w = Window.partitionBy("symbol").orderBy("date", "row_id")
    expected = history.withColumn("daily_return", F.col("close") / F.lag("close").over(w) - 1)
    got = series.daily_return(history, ties=("row_id",), rows_per_task=limit)
    assert collected(got) == collected(expected)

    expected = history.withColumn("valid_to", F.lead("date").over(w))
    got = series.scd2(history, "symbol", "date", ties=("row_id",), rows_per_task=limit)
    assert collected(got.select(*expected.columns)) == collected(expected)
    assert got.where("is_current").count() == history.select("symbol").distinct().count()


@pytest.mark.parametrize("limit", [25])
def test_crowded_times_and_missing_keys(spark, limit):
    """One over-full minute, NULL keys and NULL times are cut by position like others."""
    rows = [(i, None if i % 4 == 0 else "A" if i % 4 < 3 else f"S{i}", None if i % 7 == 0 else 0 if i % 7 < 5 else i, float(i * 37 % 101))
            for i in range(900)]
    df = spark.createDataFrame(rows, "row_id INT, symbol STRING, minute INT, close DOUBLE").withColumn(
        "date", F.timestamp_seconds(F.col("minute") * 60))
    hot = series.hot_keys(df, ["symbol"], limit)
    assert sorted(r.symbol or "" for r in hot.collect()) == ["", "A"]
    some = df.where("symbol is null or symbol = 'A'")
    parts = series.chunks(some, [F.col(c) for c in ("symbol", "date", "row_id")], -(-2 * some.count() // limit))
    assert max(r["count"] for r in parts.groupBy(series.CHUNK).count().collect()) <= limit
    w = Window.partitionBy("symbol").orderBy("date", "row_id")
    plain = df.withColumns({"rolling_avg_9": F.avg("close").over(w.rowsBetween(-8, 0)), "valid_to": F.lead("date").over(w),
                            "daily_return": F.try_divide(F.col("close"), F.lag("close").over(w)) - 1})
    want = {r.row_id: (r.rolling_avg_9, r.valid_to, r.daily_return) for r in plain.collect()}
    rolled = series.rolling_avg(df, 9, ties=("row_id",), rows_per_task=limit)
    assert {r.row_id: r.rolling_avg_9 for r in rolled.collect()} == {k: v[0] for k, v in want.items()}
    versions = series.scd2(df, "symbol", "date", ties=("row_id",), rows_per_task=limit)
    assert {r.row_id: r.valid_to for r in versions.collect()} == {k: v[1] for k, v in want.items()}
    back = series.daily_return(df, ties=("row_id",), rows_per_task=limit)
    assert {r.row_id: r.daily_return for r in back.collect()} == {k: v[2] for k, v in want.items()}


@pytest.mark.parametrize("salts", [1, 7])
def test_row_limits(history, salts):
    df = history.withColumn("interval", F.when(F.col("row_id") % 2 == 0, "1d").otherwise("1h"))
    got = series.row_limits(df, {"1d": 4}, default=2, ties=("row_id",), salts=salts)
    rank = F.row_number().over(
        Window.partitionBy("symbol", "interval").orderBy(F.desc("date"), F.desc("row_id")))
    expected = df.withColumn("r", rank).where(
        F.col("r") <= F.when(F.col("interval") == "1d", 4).otherwise(2)).drop("r")
    assert collected(got) == collected(expected)


@pytest.mark.parametrize("limit", [1, 3, 50])
def test_chunks_with_null_times_and_symbols(history, limit):
    gaps = history.withColumns({
        "date": F.when(F.col("row_id") % 7 != 0, F.col("date")),
        "symbol": F.when(F.col("row_id") % 11 != 0, F.col("symbol"))})
    for compute in (lambda rows: series.rolling_avg(gaps, 5, ties=("row_id",), rows_per_task=rows),
                    lambda rows: series.daily_return(gaps, ties=("row_id",), rows_per_task=rows),
                    lambda rows: series.scd2(gaps, "symbol", "date", ties=("row_id",), rows_per_task=rows)):
        assert collected(compute(limit)) == collected(compute(10_000))


def test_small_chunks_cost_no_tasks(history):
    """Chunks are cut out of few ranges, in order, and are never larger than asked for."""
    order = ["symbol", "date", "row_id"]
    hot = history.where("symbol = 'HOT'")
    data = series.chunks(hot, [F.col(c) for c in order], series.ranges(hot.count(), 10, 4), 5)
    assert len(data.inputFiles()) <= 4
    sizes = [r["count"] for r in data.groupBy(series.CHUNK).count().collect()]
    assert max(sizes) <= 5 and len(sizes) >= hot.count() / 5
    numbers = [r[series.CHUNK] for r in data.orderBy(*order).collect()]
    assert numbers == sorted(numbers)
    assert series.ranges(10**12, 1000, 200) == 2 * 10**12 // series.ROWS_PER_TASK and series.ranges(100, 50, 200) == 4


@pytest.mark.parametrize("limit", [10, 40])
def test_whole_window_over_cut_chunks(history, limit):
    w = Window.partitionBy("symbol").orderBy("date", "row_id").rowsBetween(-29, 0)
    got = series.rolling_avg(history, 30, ties=("row_id",), rows_per_task=limit)
    assert collected(got) == collected(history.withColumn("rolling_avg_30", F.avg("close").over(w)))
