"""The batch job: daily aggregates, market summary and top performers, stored twice."""

from __future__ import annotations

from pyspark.sql import DataFrame

from tapeworks.operators.summary import batch_quotes, daily_by_symbol, daily_market, top_performers
from tapeworks.sources.sinks import write_table


# Rows in a JSON file: compressed, it cannot be split between tasks.
ROWS_PER_FILE = 1_000_000


def reports(quotes: DataFrame, time: str = "timestamp") -> dict[str, DataFrame]:
    processed = batch_quotes(quotes, time)
    return {
        "daily_aggregations": daily_by_symbol(processed),
        "market_summary": daily_market(processed),
        "top_performers": top_performers(processed),
    }


def run(quotes: DataFrame, output: str, time: str = "timestamp", per_file: int = ROWS_PER_FILE) -> dict[str, DataFrame]:
    """Store every report as Parquet and JSON.

    Each report is computed once: the JSON copy and the returned DataFrames read the Parquet. The copy is gzipped, in
    files of at most ``per_file`` rows: JSON repeats its field names in every row.
    """
    stored = {}
    for name, report in reports(quotes, time).items():
        path = write_table(report, f"{output.rstrip('/')}/{name}.parquet")
        stored[name] = quotes.sparkSession.read.schema(report.schema).parquet(path)
        write_table(stored[name], f"{output.rstrip('/')}/{name}.json", "json", compression="gzip",
                    per_file=per_file)
    return stored
