"""Market-data views over the test tables.

Every view is one list of column expressions that means the same in Spark and in DuckDB, so the
library and its SQL oracle start from equal rows. Prices are whole cents and sizes whole
dollars: sums of them do not hang on the order of summation at the test scales.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

NULL_DOUBLE = "cast(null as double)"
NULL_TEXT = "cast(null as string)"

QUOTE = {
    "symbol": "concat('P', cast(l_partkey as string))",
    "name": """case
        when p_name like '%gear' then concat(p_name, ' Industrial')
        when p_name like '%gizmo' then concat(p_name, ' Software Technology')
        when p_name like '%plate' then concat(p_name, ' Bank')
        when p_name like '%rod' then concat(p_name, ' Oil')
        when p_name like '%ring' then concat(p_name, ' Retail')
        when p_name like '%bolt' then concat(p_name, ' Energy')
        when p_name like '%widget' then concat(p_name, ' Pharmaceutical Health')
        else p_name end""",
    "price": """case when l_linenumber = 7 and l_returnflag = 'R' then null
        else floor(round(l_extendedprice * 100) / l_quantity) / 100 end""",
    "previous_close": "p_retailprice",
    "open": NULL_DOUBLE,
    "high": NULL_DOUBLE,
    "low": NULL_DOUBLE,
    "volume": """case when l_linenumber = 6 and l_returnflag = 'N' then null
        else cast(l_quantity as bigint) * 1000000 end""",
    "market_cap": "cast(floor(l_extendedprice * l_extendedprice * 50) as double)",
    "pe_ratio": NULL_DOUBLE,
    "dividend_yield": NULL_DOUBLE,
    "change": NULL_DOUBLE,
    "change_percent": "round((l_discount - 0.05) * 200 + (l_tax - 0.04) * 20, 2) + 0.0",
    "currency": "'USD'",
    "exchange": "concat('EX', l_linestatus)",
    "quote_type": "'EQUITY'",
    "quote_timestamp": """l_shipdate + interval '1' hour * (l_orderkey % 24)
        + interval '1' minute * l_linenumber""",
    "message_timestamp": """l_shipdate + interval '1' hour * (l_orderkey % 24)
        + interval '1' minute * l_linenumber""",
    "job_id": "concat('job-', cast(l_orderkey as string))",
    "source": "'market_feed'",
}

SCREENER = {
    "symbol": "concat('P', cast(o_custkey % 200 as string))",
    "name": NULL_TEXT,
    "price": "case when o_orderkey % 29 = 0 then 0.0e0 else o_totalprice / 1000 end",
    "change": NULL_DOUBLE,
    "change_percent": "round((o_totalprice - 250000) / 20000, 2) + 0.0",
    "volume": "cast(null as bigint)",
    "market_cap": "cast(floor(o_totalprice * o_totalprice * 2) as double)",
    "screener_type": """case when o_orderkey % 31 = 0 then null
        when o_orderpriority like '1%' then 'day_gainers'
        when o_orderpriority like '2%' then 'day_losers'
        when o_orderpriority like '3%' then 'most_actives'
        when o_orderpriority like '4%' then 'day_gainers'
        else 'undervalued' end""",
    "rank": "cast(o_orderkey % 25 + 1 as int)",
    "message_timestamp": "o_orderdate + interval '1' second * (o_orderkey % 86400)",
    "job_id": "concat('job-', cast(o_orderkey as string))",
    "source": "'market_feed'",
}

NEWS_BASE = "timestamp '1995-01-02 00:00:00'"
NEWS = {
    "symbol": "concat('P', cast(doc_id % 200 as string))",
    "title": """case when doc_id % 23 = 0 then null
        when doc_id % 10 = 0 then concat('Earnings growth beats all estimates, ', source)
        when doc_id % 10 = 1 then concat('Merger talks in decline: ', source)
        when doc_id % 10 = 2 then concat('New product launch by ', source)
        when doc_id % 10 = 3 then concat('CEO leaves after loss at ', source)
        when doc_id % 10 = 4 then concat('Revenue gain offsets loss, ', source)
        when doc_id % 10 = 5 then 'Brief'
        when doc_id % 10 = 6 then concat('Acquisition seen as positive - ', source)
        when doc_id % 10 = 7 then concat('Executive release on ', source)
        when doc_id % 10 = 8 then concat('Markets calm today, says ', source)
        else concat('Negative mood at ', source) end""",
    "url": """case when doc_id % 17 = 0 then null
        else concat('http://news.example/', cast(doc_id as string)) end""",
    "text": "text",
    "source": "source",
    "news_type": "'STORY'",
    "published_time": """case when doc_id % 19 = 0 then null
        else {base} + interval '1' day * (doc_id * 7 % 2499) end""",
    "image_url": NULL_TEXT,
    "message_timestamp": "{base} + interval '1' second * doc_id",
    "job_id": "concat('job-', cast(doc_id as string))",
}

HISTORY = {
    "symbol": "concat('P', cast(l_partkey as string))",
    "date": "l_shipdate",
    "close": "floor(round(l_extendedprice * 100) / l_quantity) / 100",
    "volume": "cast(l_quantity as bigint) * 1000000",
    "bar_interval": "case l_returnflag when 'A' then '1d' when 'N' then '1h' else '1m' end",
    "row_id": "l_orderkey * 10 + l_linenumber",
}

JOBS = {
    "job_id": "concat('job-', cast(o_orderkey as string))",
    "data_source": "o_orderpriority",
    "status": """case o_orderstatus when 'F' then 'failed' when 'O' then 'completed'
        else 'running' end""",
    "processed_items": "cast(floor(o_totalprice / 100) as bigint)",
    "failed_items": "o_orderkey % 50",
    "duration_seconds": "o_totalprice / 1000",
    "error_message": "case when o_orderstatus = 'F' then 'timeout' end",
    "created_at": "o_orderdate",
}

PRODUCTS = {
    "id": "cast(p_partkey as string)",
    "title": "p_name",
    "brand": "p_brand",
    "price": """case when p_partkey % 7 = 0 then ''
        when p_partkey % 3 = 0 then concat('$1,', substr(cast(p_retailprice as string), 1, 3))
        else concat('$', cast(p_retailprice as string)) end""",
    "category": "p_type",
    "stock_quantity": "p_size",
}

STOCKS = {
    "symbol": "concat(' p', cast(p_partkey as string), ' ')",
    "name": "concat(p_name, ' ')",
    "exchange": "case when p_partkey % 5 = 0 then null else p_brand end",
    "sector": """case when p_partkey % 6 = 0 then null when p_partkey % 17 = 0 then ''
        when p_name like '%gear' then 'Industrials' when p_name like '%gizmo' then 'Technology'
        when p_name like '%plate' then 'Financial Services' when p_name like '%rod' then 'Energy'
        when p_name like '%ring' then 'Consumer Staples' when p_name like '%bolt' then 'Utilities'
        when p_name like '%widget' then 'Healthcare' else 'Shipping' end""",
    "industry": "case when p_partkey % 4 = 0 then '' else p_type end",
    "market_cap": """case when p_partkey % 11 = 0 then 'n/a' when p_partkey % 9 = 0 then null
        else concat(cast(p_partkey % 400 as string), ',000,000,000') end""",
    "currency": "case when p_partkey % 3 = 0 then null else 'EUR' end",
}

TICKS = {
    "symbol": "event_type",
    "price": "value",
    "volume": "user_id",
    "change_percent": "round(value - 25, 2) + 0.0",
    "market_cap": "cast(floor(value * 1000) as double) * 1000000",
    "message_timestamp": "ts",
    "event_id": "event_id",
}

# view -> (columns, base table, joined table and condition)
VIEWS = {
    "quotes": (QUOTE, "lineitem", ("part", "l_partkey = p_partkey")),
    "screeners": (SCREENER, "orders", None),
    "news": (NEWS, "documents", None),
    "history": (HISTORY, "lineitem", None),
    "jobs": (JOBS, "orders", None),
    "products": (PRODUCTS, "part", None),
    "stocks": (STOCKS, "part", None),
    "ticks": (TICKS, "events", None),
}


def _dialect(expression: str, spark: bool) -> str:
    base = NEWS_BASE.replace("timestamp", "timestamp_ntz") if spark else NEWS_BASE
    return expression.replace("{base}", base)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def view(spark: SparkSession, sf_dir: str, name: str, columns: list[str] | None = None, place: str | None = None) -> DataFrame:
    """The view, or some of its columns; a join that feeds none of them is left out.

    That changes no rows: each line item has exactly one part. ``place`` names a further column with the file and
    number of the row in the base table, which tell what comes first there.
    """
    expressions, base, join = VIEWS[name]
    df = table(spark, sf_dir, base)
    if place:
        df = df.withColumn(place, F.struct("_metadata.file_path", "_metadata.row_index"))
    columns = columns or list(expressions)
    if join and any(re.search(r"\bp_", expressions[c]) for c in columns):
        other = table(spark, sf_dir, join[0])
        left, right = join[1].split(" = ")
        df = df.join(other, df[left] == other[right])
    return df.selectExpr(*[f"{_dialect(expressions[c], True)} as `{c}`" for c in columns], *([place] if place else []))


def view_sql(name: str) -> str:
    expressions, base, join = VIEWS[name]
    columns = ",\n  ".join(f'{_dialect(e, False)} as "{c}"' for c, e in expressions.items())
    source = f"{base} join {join[0]} on {join[1]}" if join else base
    return f"select {columns}\nfrom {source}"
