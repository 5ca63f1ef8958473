"""The transform pipeline: clean, enrich, validate, aggregate."""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, Observation

from tapeworks.operators import clean, enrich, quality, summary
from tapeworks.operators.ops import counted, run_counts


@dataclass
class Transformed:
    data: DataFrame
    checks: DataFrame
    original: Observation
    cleaned: Observation
    enriched: Observation
    aggregations: dict[str, DataFrame] = field(default_factory=dict)

    def counts(self) -> dict[str, int]:
        """Row counts, once ``data`` has been written."""
        return run_counts(self.original, self.cleaned, self.enriched)


def transform(df: DataFrame, kind: str, as_of: dt.datetime | None = None,
              table: str | None = None) -> Transformed:
    """Clean and enrich records of one data type, check them and, for quotes, aggregate them.

    With ``table`` the enriched rows are written there once, and checks and aggregates read
    them back; without it they each compute the rows anew.
    """
    counted_input, original = counted(df, "original")
    counted_clean, cleaned = counted(clean.clean_stocks(counted_input), "cleaned")
    data, enriched = counted(enrich.enrich_stocks(counted_clean, as_of), "enriched")
    rows = enrich.enrich_stocks(clean.clean_stocks(df), as_of)
    if table is not None:
        data.write.mode("overwrite").parquet(table)
        rows = data = df.sparkSession.read.schema(data.schema).parquet(table)
    result = Transformed(
        data, quality.run_checks(rows, kind, as_of, null_is_invalid=False),
        original, cleaned, enriched)
    if kind == "stock_quotes":
        sectors = summary.sector_stats(rows)
        result.aggregations = {
            **({"sector_aggregation": sectors} if sectors is not None else {}),
            "market_summary": summary.market_summary(rows),
        }
    return result
