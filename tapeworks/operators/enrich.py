"""Enrichment of cleaned stocks."""

from __future__ import annotations

import datetime as dt
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from tapeworks.functions import bands


def quality_score(df: DataFrame, columns: list[str], denominator: str = "present") -> Column:
    """Share of filled attributes.

    ``present``: of those the record carried (``present_fields`` of ``clean_stocks``), so only
    empty texts and unreadable numbers lower it. ``schema``: of all ``columns``.
    """
    def filled(name: str) -> Column:
        value = F.col(name)
        ok = value.isNotNull()
        if isinstance(df.schema[name].dataType, StringType):
            ok = ok & (value != "")
        return ok.cast("int")

    total = reduce(lambda a, b: a + b, [filled(c) for c in columns])
    if denominator == "present":
        return F.coalesce(F.try_divide(total, F.col("present_fields")), F.lit(0.0))
    if denominator == "schema":
        return total / F.lit(len(columns))
    raise ValueError(f"unknown denominator: {denominator}")


def enrich_stocks(df: DataFrame, as_of: dt.datetime | None = None,
                  denominator: str = "present") -> DataFrame:
    """Size class, sector style and quality score; unknown cap or sector gets no label."""
    columns = [c for c in df.columns if c != "present_fields"]
    added = {"data_quality_score": quality_score(df, columns, denominator)}
    if "market_cap" in columns:
        cap = F.nullif(F.col("market_cap"), F.lit(0.0))
        added["market_cap_category"] = bands.band(cap, bands.MARKET_CAP, null_label=None)
    if "sector" in columns:
        added["sector_category"] = bands.style_of(F.col("sector"))
    added["enriched_at"] = F.current_timestamp() if as_of is None else F.lit(as_of)
    return df.withColumns(added).drop("present_fields")
