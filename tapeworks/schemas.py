"""Schemas of all entities. ``volume`` is a LONG: daily volumes pass 2^31."""

from __future__ import annotations

from pyspark.sql.types import StructType

QUOTE = (
    "symbol STRING, name STRING, price DOUBLE, previous_close DOUBLE, open DOUBLE, high DOUBLE, "
    "low DOUBLE, volume BIGINT, market_cap DOUBLE, pe_ratio DOUBLE, dividend_yield DOUBLE, "
    "change DOUBLE, change_percent DOUBLE, currency STRING, exchange STRING, quote_type STRING, "
    "timestamp TIMESTAMP"
)
SCREENER = (
    "symbol STRING, name STRING, price DOUBLE, change DOUBLE, change_percent DOUBLE, "
    "volume BIGINT, market_cap DOUBLE, screener_type STRING, rank INT"
)
NEWS = (
    "symbol STRING, title STRING, url STRING, text STRING, source STRING, news_type STRING, "
    "published_time TIMESTAMP, image_url STRING"
)
HISTORY = (
    "symbol STRING, date TIMESTAMP, open DOUBLE, high DOUBLE, low DOUBLE, close DOUBLE, "
    "volume BIGINT, adjusted_close DOUBLE, interval STRING"
)
TICKER = (
    "symbol STRING, name STRING, exchange STRING, sector STRING, industry STRING, "
    "market_cap DOUBLE, currency STRING, country STRING, website STRING, description STRING"
)
MODULE = "symbol STRING, module_type STRING, data STRING"
PRODUCT = (
    "product_id STRING, name STRING, brand STRING, model STRING, sku STRING, price DOUBLE, "
    "original_price DOUBLE, currency STRING, description STRING, short_description STRING, "
    "category STRING, subcategory STRING, in_stock BOOLEAN, stock_quantity INT, "
    "availability_status STRING, image_url STRING, image_urls ARRAY<STRING>, rating DOUBLE, "
    "review_count INT, specifications MAP<STRING,STRING>, features ARRAY<STRING>, "
    "product_url STRING, buy_url STRING"
)
JOB = (
    "job_id STRING, job_type STRING, status STRING, data_source STRING, "
    "parameters MAP<STRING,STRING>, started_at TIMESTAMP, completed_at TIMESTAMP, "
    "duration_seconds DOUBLE, total_items INT, processed_items BIGINT, failed_items BIGINT, "
    "error_message STRING, retry_count INT, max_retries INT, created_at TIMESTAMP"
)
CHECK = (
    "check_id STRING, data_source STRING, check_type STRING, status STRING, message STRING, "
    "details STRING, checked_at TIMESTAMP"
)
METRIC = (
    "job_id STRING, data_source STRING, records_processed BIGINT, records_failed BIGINT, "
    "processing_time_seconds DOUBLE, data_quality_score DOUBLE, api_calls_made BIGINT, "
    "api_errors BIGINT, memory_usage_mb DOUBLE, cpu_usage_percent DOUBLE, created_at TIMESTAMP"
)
ALERT = (
    "alert_id STRING, alert_type STRING, severity STRING, title STRING, message STRING, "
    "data_source STRING, job_id STRING, resolved BOOLEAN, resolved_at TIMESTAMP, "
    "created_at TIMESTAMP"
)

# data_type of the message envelope -> payload
PAYLOADS = {"stock_quote": QUOTE, "market_screener": SCREENER, "stock_news": NEWS}

# Fields a payload cannot do without.
MESSAGE_KEYS = {
    "stock_quote": ["symbol"],
    "market_screener": ["symbol", "screener_type"],
    "stock_news": ["symbol", "title", "url"],
}

# Message key on the sink topic of each data_type.
TOPIC_KEYS = {"stock_quote": "symbol", "market_screener": "screener_type", "stock_news": "symbol"}

# Lake layout: layer -> tables.
LAYERS = {
    "raw": ["stock_quotes", "market_screeners", "stock_news", "stock_history"],
    "processed": ["cleaned_quotes", "enriched_quotes", "aggregated_quotes", "market_summary"],
    "analytics": ["daily_summary", "sector_performance", "top_performers", "news_sentiment"],
}


def struct(ddl: str) -> StructType:
    return StructType.fromDDL(ddl)


def columns(ddl: str) -> list[str]:
    return struct(ddl).fieldNames()
