"""Time series per symbol."""

from __future__ import annotations

from pyspark.sql import functions as F

from tapeworks.operators import latest, series
from workload.marts import rounded
from workload.registry import cte, query
from workload.views import view

ROLLING = 20
LIMITS = {"1d": 5, "1h": 3, "1m": 2}


@query(f"""
select symbol, date, close, row_id,
  round(avg(close) over (partition by symbol order by date, row_id
    rows between {ROLLING - 1} preceding and current row), 7) + 0.0 as rolling_avg_{ROLLING}
from history""")
def rolling_avg(spark, sf_dir):
    df = view(spark, sf_dir, "history", ["symbol", "date", "close", "row_id"])
    return rounded(series.rolling_avg(df, ROLLING, ties=("row_id",)), **{f"rolling_avg_{ROLLING}": 7})


@query("""
select symbol, date, close, row_id,
  close / lag(close) over (partition by symbol order by date, row_id) - 1 as daily_return
from history""")
def daily_return(spark, sf_dir):
    df = view(spark, sf_dir, "history", ["symbol", "date", "close", "row_id"])
    return series.daily_return(df, ties=("row_id",))


@query("""
select symbol, message_timestamp, job_id, market_cap,
  lead(message_timestamp) over w as valid_to, message_timestamp as valid_from,
  lead(message_timestamp) over w is null as is_current
from screeners window w as (partition by symbol order by message_timestamp, job_id)""")
def scd2_history(spark, sf_dir):
    df = view(spark, sf_dir, "screeners", ["symbol", "message_timestamp", "job_id", "market_cap"])
    return series.scd2(df, "symbol", "message_timestamp", ties=("job_id",))


@query("""
select symbol, date, close, volume, bar_interval, row_id from history
qualify row_number() over (partition by symbol, bar_interval order by date desc, row_id desc)
  <= case bar_interval when '1d' then 5 when '1h' then 3 else 2 end""")
def history_row_limit(spark, sf_dir):
    df = view(spark, sf_dir, "history")
    return series.row_limits(df, LIMITS, default=2, interval="bar_interval", ties=("row_id",))


@query("""
select symbol, date, close, volume, bar_interval, row_id from history
qualify row_number() over (partition by symbol, date
  order by close desc, volume desc, bar_interval desc, row_id desc) = 1""")
def dedupe_quotes(spark, sf_dir):
    return latest.dedupe(view(spark, sf_dir, "history"), ("symbol", "date"))


@query("""
select symbol, message_timestamp, job_id, price from screeners
qualify row_number() over (partition by symbol
  order by message_timestamp desc, job_id desc, price desc) = 1""")
def latest_screener_rows(spark, sf_dir):
    df = view(spark, sf_dir, "screeners", ["symbol", "message_timestamp", "job_id", "price"])
    return latest.newest_rows(df, ["symbol"], "message_timestamp")


# A third of all rows under one symbol, some without a symbol or a time, and many in one minute.
cte("crowded", """
select row_id, close, case when row_id % 3 = 0 then 'HOT' when row_id % 11 = 1 then null else symbol end as symbol,
  case when row_id % 13 = 0 then null when row_id % 4 < 2 then timestamp '1996-02-02 10:00:00' else date end as date
from history""")
ROWS_PER_TASK = 1_000


def crowded(spark, sf_dir):
    return view(spark, sf_dir, "history", ["row_id", "close", "symbol", "date"]).withColumns({
        "symbol": F.expr("case when row_id % 3 = 0 then 'HOT' when row_id % 11 = 1 then null else symbol end"),
        "date": F.expr("case when row_id % 13 = 0 then null "
                       "when row_id % 4 < 2 then timestamp_ntz'1996-02-02 10:00:00' else date end")})


@query("""
select row_id, symbol, date, close, round(avg(close) over (
  partition by symbol order by date nulls first, row_id, close rows between 6 preceding and current row), 7) + 0.0 as rolling_avg_7
from crowded""")
def rolling_avg_in_chunks(spark, sf_dir):
    """Hot, missing and crowded keys are cut by position; results are those of plain windows."""
    out = series.rolling_avg(crowded(spark, sf_dir), 7, ties=("row_id", "close"), rows_per_task=ROWS_PER_TASK)
    return out.withColumn("rolling_avg_7", F.round("rolling_avg_7", 7) + F.lit(0.0))


@query("""
select row_id, symbol, date, close, round(close / nullif(lag(close) over s, 0) - 1, 9) + 0.0 as daily_return
from crowded window s as (partition by symbol order by date nulls first, row_id, close)""")
def daily_return_in_chunks(spark, sf_dir):
    out = series.daily_return(crowded(spark, sf_dir), ties=("row_id", "close"), rows_per_task=ROWS_PER_TASK)
    return out.withColumn("daily_return", F.round("daily_return", 9) + F.lit(0.0))


@query("""
select row_id, symbol, date as valid_from, lead(date) over s as valid_to, lead(date) over s is null as is_current
from crowded window s as (partition by symbol order by date nulls first, row_id, close)""")
def scd2_in_chunks(spark, sf_dir):
    out = series.scd2(crowded(spark, sf_dir), "symbol", "date", ties=("row_id", "close"), rows_per_task=ROWS_PER_TASK)
    return out.select("row_id", "symbol", "valid_from", "valid_to", "is_current")
