"""Catalogue extraction: category responses to products, headers and a summary."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tapeworks import schemas
from tapeworks.operators.catalogue import CATEGORY, FAILED, PRODUCT, extraction_summary, parse_categories
from tapeworks.session import shared_dir
from tapeworks.sources.sinks import write_table


def extract(responses: DataFrame, output: str | None = None, fmt: str = "json") -> dict[str, DataFrame]:
    """Products of all categories in one set, with headers, rejects and counts.

    The responses are read and parsed once, into a stored table; all results read their kind of rows in that. It has
    no partitions by kind: for those each task would sort all its rows, products with all their fields, in memory.
    With ``output`` each of them is written there in the given format.
    """
    spark = responses.sparkSession
    path = f"{output.rstrip('/')}/parsed" if output is not None else shared_dir(spark, "catalogue")
    rows = parse_categories(responses)
    rows.write.mode("overwrite").parquet(path)
    parsed = spark.read.schema(rows.schema).parquet(path)
    results = {
        "products": parsed.where(F.col("kind") == PRODUCT).select(
            "category_name", "category_url", *schemas.columns(schemas.PRODUCT)),
        "categories": parsed.where(F.col("kind") == CATEGORY).select("category_name", "category_url", "product_count"),
        "rejects": parsed.where(F.col("kind") == FAILED).select("category_name", "category_url", "record", "reason"),
        "summary": extraction_summary(parsed),
    }
    if output is not None:
        for name, df in results.items():
            write_table(df, f"{output.rstrip('/')}/{name}", fmt)
    return results
