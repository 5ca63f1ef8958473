"""All results behind a dashboard page."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame

from tapeworks.operators import readmodel


def page(quotes: DataFrame, news: DataFrame, symbols: list[str] | None = None,
         start: str | dt.date | None = None, end: str | dt.date | None = None,
         pivot_dates: list | None = None, k: int = 5) -> dict[str, DataFrame]:
    """Results by name, for the chosen symbols and dates.

    The heat map needs the dates to show; pass those of the chosen range.
    """
    chosen = readmodel.select_view(quotes, symbols, start, end)
    latest = readmodel.latest_prices(chosen)
    results = {
        "bounds": readmodel.bounds(quotes),
        "symbols": readmodel.symbols(quotes),
        "summary": readmodel.latest_day_summary(chosen),
        "prices": readmodel.series(chosen, "price"),
        "volumes": readmodel.series(chosen, "volume"),
        "sentiment": readmodel.avg_sentiment(news),
        "latest_prices": readmodel.with_signed_change(latest),
        "top_movers": readmodel.top_movers(latest, k),
        "news": readmodel.recent_news(news),
    }
    if pivot_dates:
        results["heat_map"] = readmodel.pivot_change(chosen, "date", pivot_dates)
    return results
