"""Product catalogue: category pages and search pages to products."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tapeworks import schemas
from tapeworks.functions.text import blank_to_null, parse_number
from tapeworks.operators.feeds import REJECTED, Parsed, no_list, read_json, split

# Product fields whose JSON name differs or has an alternative.
PRODUCT_FIELDS = {
    "product_id": ["id"],
    "name": ["name", "title"],
    "image_url": ["image_url", "image"],
    "product_url": ["product_url", "url"],
}
PRICES = ("price", "original_price")


def _product_types() -> dict[str, str]:
    """Types of the fields that the feed sends; prices come as formatted texts."""
    return {name: "string" if field.name in PRICES else field.dataType.simpleString()
            for field in schemas.struct(schemas.PRODUCT) if field.name != "currency"
            for name in PRODUCT_FIELDS.get(field.name, [field.name])}


def _product(item: Column) -> dict[str, Column]:
    columns = {}
    for field in schemas.struct(schemas.PRODUCT):
        names = PRODUCT_FIELDS.get(field.name, [field.name])
        kind = field.dataType.simpleString()
        if field.name == "currency":
            columns[field.name] = F.lit("USD")
        elif field.name in PRICES:
            columns[field.name] = parse_number(item[names[0]], "$,")
        elif kind.startswith("array"):
            columns[field.name] = F.coalesce(item[names[0]], F.array().cast(kind))
        elif kind.startswith("map"):
            columns[field.name] = F.coalesce(item[names[0]], F.create_map().cast(kind))
        else:
            columns[field.name] = F.coalesce(
                *[blank_to_null(item[n]) for n in names[:-1]], item[names[-1]])
    return columns


def _pages(responses: DataFrame, keep: list[str], header: tuple[str, ...] = ()) -> DataFrame:
    return read_json(responses, keep, dict.fromkeys(header, "string"), "products", _product_types())


def _products(pages: DataFrame, keep: list[str]) -> Parsed:
    df = (pages.select(*keep, "_value", no_list("products").alias("_no_list"),
                       F.explode_outer("products").alias("item"))
          .where("item is not null or _no_list"))
    item = F.col("item")
    record = F.when(F.col("_no_list"), F.col("_value")).otherwise(F.to_json(item))
    return split(df, _product(item), {}, [], keep, item, record, F.col("_no_list"))


def normalize_products(responses: DataFrame) -> Parsed:
    """Products under ``products`` of category or search responses (``value``)."""
    return _products(_pages(responses, []), [])


def flatten_categories(responses: DataFrame) -> tuple[DataFrame, Parsed]:
    """Header row per category response, and its products tagged with the category."""
    pages = _pages(responses, [], ("category_name", "category_url", "total_products"))
    headers = pages.select(
        "category_name", "category_url",
        F.coalesce(F.col("total_products").try_cast("int"), F.lit(0)).alias("product_count"))
    return headers, _products(pages, ["category_name", "category_url"])


def flatten_search(responses: DataFrame) -> tuple[DataFrame, Parsed]:
    """Header row per search response tagged with ``query``, and its products.

    Without a total or a page size in the response the number of its readable products stands in.
    """
    pages = _pages(responses, ["query"], ("total_results", "page", "page_size", "search_time"))
    readable = F.coalesce(
        F.size(F.filter("products", lambda p: p[REJECTED].isNull())), F.lit(0))
    page = F.coalesce(F.col("page").try_cast("int"), F.lit(1)).alias("page")
    headers = pages.select(
        "query",
        F.coalesce(F.col("total_results").try_cast("int"), readable).alias("total_results"),
        page,
        F.coalesce(F.col("page_size").try_cast("int"), readable).alias("page_size"),
        F.col("search_time").try_cast("double").alias("search_time"))
    return headers, _products(pages.select("query", page, "products", "_value"), ["query", "page"])


def union_categories(parts: list[DataFrame]) -> DataFrame:
    """All products of several extractions; columns missing in one of them are NULL."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)


CATEGORY, PRODUCT, FAILED = "category", "product", "failed"


def parse_categories(responses: DataFrame) -> DataFrame:
    """All that category responses hold, parsed once: a row per category, product and rejected record.

    ``kind`` says which; products carry the category's name and address, rejects ``record`` and ``reason``.
    """
    pages = _pages(responses, [], ("category_name", "category_url", "total_products"))
    pages = pages.withColumns({
        "product_count": F.coalesce(F.col("total_products").try_cast("int"), F.lit(0)),
        "_no_list": no_list("products")})
    # The first item stands for the category itself, a second one without a record for a list that is missing.
    none = F.lit(None).cast(pages.schema["products"].dataType.elementType)
    items = F.when(F.col("_no_list"), F.array(none, none)).otherwise(
        F.concat(F.array(none), F.coalesce("products", F.array().cast(pages.schema["products"].dataType))))
    keep = ["category_name", "category_url", "product_count", "_pos"]
    rows = (pages.select(*keep[:-1], "_value", "_no_list", F.posexplode(items).alias("_pos", "item"))
            .where("_pos = 0 or item is not null or _no_list"))
    item, lost = F.col("item"), F.col("_no_list") & (F.col("_pos") > 0)
    record = F.when(F.col("_no_list"), F.col("_value")).otherwise(F.to_json(item))
    tagged = split(rows, _product(item), {}, [], keep, item, record, lost).tagged
    return tagged.withColumn("kind", F.when(F.col("_pos") == 0, CATEGORY).when(F.col("reason").isNull(), PRODUCT)
                             .otherwise(FAILED)).drop("_pos")


def extraction_summary(parsed: DataFrame) -> DataFrame:
    """Counts of one extraction (``parse_categories``): categories, products, processed and failed items."""
    found = F.count_if(F.col("kind") == PRODUCT)
    return parsed.agg(
        F.count_if(F.col("kind") == CATEGORY).alias("total_categories"),
        found.alias("total_products"),
        found.alias("processed_items"),
        F.count_if(F.col("kind") == FAILED).alias("failed_items"),
    )
