"""Envelopes and provider responses, with malformed records."""

from __future__ import annotations

import datetime as dt
import json

from pyspark.sql import functions as F

from tapeworks import schemas
from tapeworks.operators import catalogue, feeds
from tapeworks.operators.catalogue import parse_categories
from tapeworks.plans.catalogue import extract


def documents(spark, docs, **tags):
    rows = [(*tags.values(), d if isinstance(d, str) else json.dumps(d)) for d in docs]
    names = ", ".join([*[f"{t} string" for t in tags], "value string"])
    return spark.createDataFrame(rows, names)


def test_quotes_keep_good_records_of_a_bad_document(spark):
    body = [
        {"symbol": "A", "longName": "", "shortName": "Ay", "regularMarketPrice": 150.5,
         "regularMarketVolume": 3_000_000_000, "regularMarketTime": 1_700_000_000},
        {"symbol": "B", "longName": "Bee", "regularMarketPrice": "12.5", "regularMarketVolume": 5.0e7,
         "currency": "EUR", "regularMarketTime": "2024-01-01T10:00:00"},
        {"longName": "no symbol", "regularMarketPrice": 1},
        {"symbol": "D", "regularMarketPrice": "cheap"},
        {"symbol": "E", "regularMarketTime": "soon"},
        {"symbol": "F", "unknown": {"deep": [1]}},
    ]
    parsed = feeds.normalize_quotes(documents(spark, [{"body": body}, "no json", {"body": None}, {}]))
    good = {r.symbol: r for r in parsed.good.collect()}
    assert parsed.good.schema == schemas.struct(schemas.QUOTE) or (
        parsed.good.columns == schemas.columns(schemas.QUOTE))
    assert sorted(good) == ["A", "B", "F"]
    assert (good["A"].name, good["A"].price, good["A"].volume, good["A"].currency) == (
        "Ay", 150.5, 3_000_000_000, "USD")
    assert good["A"].timestamp == dt.datetime(2023, 11, 14, 22, 13, 20)
    assert (good["B"].price, good["B"].volume, good["B"].currency) == (12.5, 50_000_000, "EUR")
    assert good["B"].timestamp == dt.datetime(2024, 1, 1, 10)
    unreadable = parsed.rejects.where("reason = 'unreadable document'")
    assert [r.record for r in unreadable.collect()] == ["no json"]
    rejects = [(r.reason, json.loads(r.record).get("symbol"))
               for r in parsed.rejects.exceptAll(unreadable).collect()]
    assert sorted(rejects, key=str) == [
        ("missing required field", None), ("value of wrong type", "D"), ("value of wrong type", "E")]
    assert "cheap" in parsed.rejects.where("reason = 'value of wrong type'").agg(
        F.concat_ws("", F.collect_list("record"))).first()[0]


def test_documents_without_a_list_are_rejected(spark):
    docs = documents(spark, ["{broken", {"body": {"symbol": "A"}}, {"body": []}, {}])
    for normalize in (feeds.normalize_quotes, feeds.normalize_tickers):
        parsed = normalize(docs)
        assert parsed.good.count() == 0
        assert {r.reason for r in parsed.rejects.collect()} == {"unreadable document"}
        assert parsed.rejects.count() == 2
    products = catalogue.normalize_products(documents(spark, ["{broken", {"products": 5}, {"products": []}]))
    assert (products.good.count(), products.rejects.count()) == (0, 2)


def test_documents_that_fit_take_the_typed_path(spark):
    body = [{"symbol": s, "regularMarketPrice": 1.5} for s in "XY"]
    parsed = feeds.normalize_quotes(documents(spark, [{"body": body}]))
    assert [(r.symbol, r.price) for r in parsed.good.orderBy("symbol").collect()] == [
        ("X", 1.5), ("Y", 1.5)]
    assert parsed.rejects.count() == 0


def test_older_quote_feed_knows_long_names_only(spark):
    doc = {"body": [{"symbol": "A", "longName": None, "shortName": "Ay"}]}
    row = feeds.normalize_quotes(documents(spark, [doc]), name_fields=("longName",)).good.first()
    assert row.name is None


def test_tickers_search_modules(spark):
    doc = {"body": [{"symbol": "A", "marketCap": "3,000,000"}, {"symbol": "B", "marketCap": 5.0},
                    {"symbol": "C", "marketCap": "n/a", "currency": "GBP"}, {"name": "x"}]}
    parsed = feeds.normalize_tickers(documents(spark, [doc]))
    assert [(r.symbol, r.market_cap, r.currency) for r in parsed.good.orderBy("symbol").collect()] == [
        ("A", 3e6, "USD"), ("B", 5.0, "USD"), ("C", None, "GBP")]
    assert parsed.rejects.count() == 1
    doc = {"body": [{"symbol": "A", "shortname": "Ay", "sector": "Tech", "industryDisp": "Chips"}]}
    row = feeds.normalize_search(documents(spark, [doc])).good.first()
    assert (row.name, row.sector, row.industry, row.currency, row.country) == (
        "Ay", "Tech", "Chips", "USD", "US")
    modules = feeds.normalize_modules(
        documents(spark, [{"body": {"a": {"b": 1}}}, {}], symbol="A", module_type="profile"))
    assert sorted(r.data for r in modules.good.collect()) == ['{"a":{"b":1}}', "{}"]


def test_history_screeners_news(spark):
    doc = {"body": [{"timestamp_unix": 86400, "close": 2.0, "volume": 7}, {"close": 1.0}]}
    parsed = feeds.normalize_history(documents(spark, [doc], symbol="A", interval="1h"))
    row = parsed.good.first()
    assert (row.symbol, row.date, row.close, row.volume, row.interval) == (
        "A", dt.datetime(1970, 1, 2), 2.0, 7, "1h")
    assert parsed.rejects.count() == 1
    doc = {"body": [{"symbol": s} for s in "ZYX"]}
    ranks = feeds.normalize_screeners(documents(spark, [doc], screener_type="day_losers")).good
    assert {r.symbol: r["rank"] for r in ranks.collect()} == {"Z": 1, "Y": 2, "X": 3}
    doc = {"body": [{"title": "t", "url": "u", "type": "STORY", "img": "i"}, {"title": "no url"}]}
    parsed = feeds.normalize_news(documents(spark, [doc], symbol="A"))
    row = parsed.good.first()
    assert (row.symbol, row.news_type, row.image_url, row.published_time) == ("A", "STORY", "i", None)
    assert parsed.rejects.count() == 1


def envelope(data, **top):
    return {"timestamp": "2024-01-01T10:00:00", "data_type": "stock_quote", "data": data,
            "metadata": {"job_id": "j1", "source": "feed"}, **top}


def test_envelopes(spark):
    docs = [
        envelope({"symbol": "A", "price": 1.5, "volume": 3_000_000_000, "timestamp": 1_700_000_000}),
        envelope({"symbol": "B", "price": "2.5", "timestamp": "2024-01-01 09:00:00"}),
        envelope({"price": 1.0}), envelope({"symbol": "C", "price": "much"}), "not json", {"data": None},
    ]
    parsed = feeds.parse_envelope(documents(spark, docs), "stock_quote")
    good = {r.symbol: r for r in parsed.good.collect()}
    assert sorted(good) == ["A", "B"]
    assert good["A"].quote_timestamp == dt.datetime(2023, 11, 14, 22, 13, 20)
    assert (good["B"].price, good["B"].job_id, good["B"].source) == (2.5, "j1", "feed")
    assert good["B"].message_timestamp == dt.datetime(2024, 1, 1, 10)
    assert sorted(r.reason for r in parsed.rejects.collect()) == ["missing required field"] * 3 + [
        "value of wrong type"]


def test_news_envelope_keeps_both_sources(spark):
    doc = envelope({"symbol": "A", "title": "t", "url": "u", "source": "paper"})
    row = feeds.parse_envelope(documents(spark, [doc]), "stock_news").good.first()
    assert (row.news_source, row.data_source) == ("paper", "feed")


def test_to_envelope_keys_and_nulls(spark):
    df = spark.createDataFrame([("A", "day_gainers", None)], "symbol string, screener_type string, price double")
    row = feeds.to_envelope(df, "market_screener", "j", "feed").first()
    message = json.loads(row.value)
    assert row.key == "day_gainers"
    assert message["data"] == {"symbol": "A", "screener_type": "day_gainers"}
    assert message["metadata"] == {"job_id": "j", "source": "feed"}


CATEGORIES = [
    {"category_name": "toys", "category_url": "/toys", "total_products": 2, "products": [
        {"id": 1, "title": "Car", "price": "$1,299.00", "image": "i", "url": "u",
         "features": ["red"], "specifications": {"w": "1"}, "in_stock": True},
        {"id": "2", "name": "Bus", "title": "x", "price": 5, "stock_quantity": "9"}]},
    {"category_name": "food", "products": [{"id": "3", "price": "", "stock_quantity": "many"}]},
    {"category_name": "none"},
]


def test_catalogue(spark, tmp_path):
    results = extract(documents(spark, CATEGORIES), str(tmp_path / "out"))
    products = {r.product_id: r for r in results["products"].collect()}
    assert sorted(products) == ["1", "2"]
    first, second = products["1"], products["2"]
    assert (first.name, first.price, first.image_url, first.product_url, first.in_stock) == (
        "Car", 1299.0, "i", "u", True)
    assert (first.features, first.specifications, second.features) == (["red"], {"w": "1"}, [])
    assert (second.name, second.price, second.stock_quantity, second.currency) == ("Bus", 5.0, 9, "USD")
    assert second.category_name == "toys"
    assert {r.category_name: r.product_count for r in results["categories"].collect()} == {
        "toys": 2, "food": 0, "none": 0}
    assert results["summary"].first().asDict() == {
        "total_categories": 3, "total_products": 2, "processed_items": 2, "failed_items": 1}
    assert spark.read.json(str(tmp_path / "out" / "products")).count() == 2


def test_catalogue_is_parsed_once(spark, tmp_path):
    """One scan of the responses gives headers, products and rejects, whole documents among them."""
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.txt").write_text("\n".join([*map(json.dumps, CATEGORIES), "broken", '{"products": 5}']))
    responses = spark.read.text(str(tmp_path / "in"))
    parsed = parse_categories(responses)
    plan = parsed._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1 and plan.count("from_json") <= 2
    kinds = [(r.kind, r.category_name, r.reason) for r in parsed.orderBy("kind", "category_name", "reason").collect()]
    assert kinds == [("category", None, None), ("category", None, None), ("category", "food", None), ("category", "none", None),
                     ("category", "toys", None), ("failed", None, "unreadable document"), ("failed", None, "unreadable document"),
                     ("failed", "food", "value of wrong type"), ("product", "toys", None), ("product", "toys", None)]
    results = extract(responses, str(tmp_path / "out"))
    for df in results.values():  # results read the stored parse
        assert "from_json" not in df._jdf.queryExecution().executedPlan().toString()


def test_parsed_catalogue_is_stored_without_a_sort(spark, tmp_path):
    """One task writes all kinds into one file, in the order in which they were parsed."""
    results = extract(documents(spark, [{**c, "category_url": f"/{k}"} for k, c in enumerate(CATEGORIES * 3)]).coalesce(1),
                      str(tmp_path / "out"))
    stored = [f.relative_to(tmp_path / "out" / "parsed") for f in (tmp_path / "out" / "parsed").rglob("*.parquet")]
    assert len(stored) == 1 and len(stored[0].parts) == 1
    assert results["summary"].first().asDict() == {
        "total_categories": 9, "total_products": 6, "processed_items": 6, "failed_items": 3}
    assert {name: df.count() for name, df in results.items()} == {
        "products": 6, "categories": 9, "rejects": 3, "summary": 1}


def test_search_defaults_and_union(spark):
    docs = [{"products": [{"id": "1"}, {"id": "2", "rating": "bad"}]},
            {"total_results": 50, "page": 3, "page_size": 10, "search_time": 0.5, "products": []}]
    headers, products = catalogue.flatten_search(documents(spark, docs, query="car"))
    assert sorted((r.total_results, r.page, r.page_size) for r in headers.collect()) == [
        (1, 1, 1), (50, 3, 10)]
    assert [(r.product_id, r.page) for r in products.good.collect()] == [("1", 1)]
    a = spark.createDataFrame([("1", 2.0)], "product_id string, price double")
    b = spark.createDataFrame([("2",)], "product_id string")
    assert sorted(catalogue.union_categories([a, b]).collect()) == [("1", 2.0), ("2", None)]
