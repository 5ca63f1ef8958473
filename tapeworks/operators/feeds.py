"""JSON to typed rows: message envelopes and provider responses.

A record is rejected, not the whole document, when a required field is missing or a value does
not fit its type; rejects keep their JSON and a reason. JSON is parsed straight to the wanted
types. Only documents that do not fit are parsed once more, as text, to read what can be read
("150.5" as a price, 5.0E7 as a volume) and to find the records that cannot.
"""

from __future__ import annotations

from functools import reduce
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DataType

from tapeworks import schemas
from tapeworks.functions.text import blank_to_null, parse_number, to_long, to_time

CORRUPT, REJECTED = "_corrupt_record", "__rejected"


class Parsed(NamedTuple):
    """``tagged`` has all rows: those that are rejected with ``record`` and ``reason``, others without."""
    good: DataFrame
    rejects: DataFrame
    tagged: DataFrame


def _is_text(kind: str) -> bool:
    return kind == "string" or kind.startswith(("array", "map"))


def _cast(text: Column, kind: str) -> Column:
    if _is_text(kind):
        return text
    if kind == "bigint":
        return to_long(F.trim(text))
    if kind == "int":
        return to_long(F.trim(text)).try_cast("int")
    return F.trim(text).try_cast(kind)


def _any(conditions: list[Column]) -> Column:
    return reduce(lambda a, b: a | b, conditions, F.lit(False))


def once(df: DataFrame, keep: list[str], columns: dict[str, Column]) -> DataFrame:
    """``keep`` and ``columns``, each column computed a single time.

    Left to itself the optimizer copies an expression into every filter and projection that uses
    it, and JSON would be parsed once per field. It does not move anything across a generator.
    """
    row = F.struct(*[c.alias(n) for n, c in columns.items()])
    return df.select(*keep, F.inline(F.array(row)))


def _struct_ddl(types: dict[str, str]) -> str:
    return "struct<" + ", ".join(f"`{n}`: {k}" for n, k in types.items()) + ">"


def read_json(df: DataFrame, keep: list[str], header: dict[str, str], path: str,
              types: dict[str, str], many: bool = True) -> DataFrame:
    """Parse ``value``: its ``header`` texts, and as ``path`` the record(s) with typed fields.

    A record of the text pass has its JSON in ``__rejected`` when a value does not fit.
    """
    def ddl(record: str) -> str:
        body = f"array<{record}>" if many else record
        return ", ".join([*[f"`{n}` {k}" for n, k in header.items()], f"`{path}` {body}"])

    strict = {n: k for n, k in types.items() if not _is_text(k)}
    texts = types | dict.fromkeys(strict, "string")

    def fit(item: Column) -> Column:
        typed = {n: _cast(item[n], k) for n, k in types.items()}
        unfit = _any([item[n].isNotNull() & typed[n].isNull() for n in strict])
        return F.struct(*[c.alias(n) for n, c in typed.items()],
                        F.when(unfit, F.to_json(item)).alias(REJECTED))

    fast_ddl = ddl(_struct_ddl(types | {REJECTED: "string"})) + f", {CORRUPT} string"
    value = df.select(*keep, F.col("value").cast("string").alias("_value"))
    fast = once(value, [*keep, "_value"], {"_fast": F.from_json("_value", fast_ddl)})
    clean = F.col(f"_fast.{CORRUPT}").isNull()
    both = once(fast, [*keep, "_value", "_fast"], {
        "_text": F.when(~clean, F.from_json("_value", ddl(_struct_ddl(texts))))})
    text = F.col(f"_text.{path}")
    return both.select(
        *keep, "_value",
        *[F.when(clean, F.col(f"_fast.{n}")).otherwise(F.col(f"_text.{n}")).alias(n)
          for n in header],
        F.when(clean, F.col(f"_fast.{path}"))
        .otherwise(F.transform(text, fit) if many else F.when(text.isNotNull(), fit(text)))
        .alias(path))


def no_list(path: str) -> Column:
    """Whether a document (``_value``, parsed to the column ``path``) is no JSON or has something else
    than a list there. A document that says nothing there holds no records and is no error."""
    root = F.get_json_object("_value", "$")
    return F.col(path).isNull() & (root.isNull() | F.get_json_object("_value", f"$.{path}").isNotNull())


def split(df: DataFrame, columns: dict[str, Column], times: dict[str, Column], required: list[str],
          keep: list[str], item: Column, record: Column, unreadable: Column | None = None) -> Parsed:
    """Part good rows from rejects. ``times`` are the texts that time columns come from.

    Where ``unreadable`` holds, ``record`` is a whole document without readable records.
    """
    cast = once(df.withColumn("_record", F.coalesce(item[REJECTED], record)), [*keep, "_record"], {
        **{f"_{n}": c for n, c in columns.items()},
        "_unfit": item[REJECTED].isNotNull(),
        "_unreadable": F.lit(False) if unreadable is None else unreadable,
        **{f"_text_{n}": text for n, text in times.items()}})
    missing = _any([F.col(f"_{n}").isNull() for n in required])
    unfit = F.coalesce(F.col("_unfit"), F.lit(False)) | _any(
        [F.col(f"_text_{n}").isNotNull() & F.col(f"_{n}").isNull() for n in times])
    reason = (F.when(F.col("_unreadable"), "unreadable document")
              .when(missing, "missing required field").otherwise("value of wrong type"))
    wrong = missing | unfit | F.col("_unreadable")
    fields = [*keep, *[F.col(f"_{n}").alias(n) for n in columns]]
    told = [F.col("_record").alias("record"), reason.alias("reason")]
    return Parsed(
        cast.where(~wrong).select(*fields), cast.where(wrong).select(*keep, *told),
        cast.select(*fields, *[F.when(wrong, c).alias(n) for c, n in zip(told, ("record", "reason"))]))


# --- message envelopes ---------------------------------------------------------------------

def parse_envelope(messages: DataFrame, kind: str) -> Parsed:
    """Flatten messages of one ``data_type``; works on batches and streams.

    Quotes come out with ``quote_timestamp``; the two sources of news as ``news_source`` (the
    publisher) and ``data_source`` (where the message came from).
    """
    payload = schemas.struct(schemas.PAYLOADS[kind])
    types = {f.name: _json_type(f.dataType) for f in payload}
    header = {"timestamp": "string", "data_type": "string",
              "metadata": "struct<job_id: string, source: string>"}
    df = read_json(messages, [], header, "data", types, many=False)
    df = df.withColumns({
        "message_timestamp": to_time(F.col("timestamp")),
        "job_id": F.col("metadata.job_id"),
        "data_source": F.col("metadata.source"),
    })
    times = {n: F.col(f"data.{n}") for n, k in zip(types, payload) if _is_time(k.dataType)}
    columns = {n: to_time(times[n]) if n in times else F.col(f"data.{n}") for n in types}
    head, tail = ["message_timestamp", "data_type"], ["job_id", "data_source"]
    parsed = split(df, columns, times, schemas.MESSAGE_KEYS[kind], head + tail,
                   F.col("data"), F.col("_value"))
    renames = {"stock_quote": {"timestamp": "quote_timestamp", "data_source": "source"},
               "market_screener": {"data_source": "source"},
               "stock_news": {"source": "news_source"}}[kind]
    columns = [*head, *payload.fieldNames(), *tail]
    return Parsed(
        parsed.good.select(*columns).withColumnsRenamed(renames), parsed.rejects,
        parsed.tagged.select(*columns, "record", "reason").withColumnsRenamed(renames))


def _is_time(kind: DataType) -> bool:
    return kind.simpleString() == "timestamp"


def _json_type(kind: DataType) -> str:
    """Type to parse a JSON value to; times may be numbers or texts and are read later."""
    return "string" if _is_time(kind) else kind.simpleString()


def to_envelope(rows: DataFrame, data_type: str, job_id: str | Column, source: str,
                sent_at: Column | None = None, keep: tuple[str, ...] = ()) -> DataFrame:
    """Keyed JSON messages (``key``, ``value``) of payload rows, ready for a topic.

    NULL fields are left out of the JSON. Columns of ``keep`` come along.
    """
    payload = [c for c in schemas.columns(schemas.PAYLOADS[data_type]) if c in rows.columns]
    job = F.lit(job_id) if isinstance(job_id, str) else job_id
    sent = F.current_timestamp() if sent_at is None else sent_at
    message = F.struct(
        F.date_format(sent, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS").alias("timestamp"),
        F.lit(data_type).alias("data_type"),
        F.struct(*payload).alias("data"),
        F.struct(job.alias("job_id"), F.lit(source).alias("source")).alias("metadata"),
    )
    return rows.select(
        F.col(schemas.TOPIC_KEYS[data_type]).alias("key"), F.to_json(message).alias("value"), *keep)


# --- provider responses --------------------------------------------------------------------

# Field names of the provider's JSON. Of several the first non-empty one counts.
QUOTE_FIELDS = {
    "symbol": ["symbol"],
    "name": ["longName", "shortName"],
    "price": ["regularMarketPrice"],
    "previous_close": ["regularMarketPreviousClose"],
    "open": ["regularMarketOpen"],
    "high": ["regularMarketDayHigh"],
    "low": ["regularMarketDayLow"],
    "volume": ["regularMarketVolume"],
    "market_cap": ["marketCap"],
    "pe_ratio": ["trailingPE"],
    "dividend_yield": ["dividendYield"],
    "change": ["regularMarketChange"],
    "change_percent": ["regularMarketChangePercent"],
    "currency": ["currency"],
    "exchange": ["fullExchangeName"],
    "quote_type": ["quoteType"],
    "timestamp": ["regularMarketTime"],
}
TICKER_FIELDS = {
    "symbol": ["symbol"],
    "name": ["name"],
    "exchange": ["exchange"],
    "sector": ["sector"],
    "industry": ["industry"],
    "market_cap": ["marketCap"],
    "currency": ["currency"],
    "country": ["country"],
    "website": ["website"],
    "description": ["description"],
}
SEARCH_FIELDS = {
    "symbol": ["symbol"],
    "name": ["longname", "shortname"],
    "exchange": ["exchDisp"],
    "sector": ["sectorDisp", "sector"],
    "industry": ["industryDisp", "industry"],
}
HISTORY_FIELDS = {
    "date": ["timestamp_unix"],
    "open": ["open"],
    "high": ["high"],
    "low": ["low"],
    "close": ["close"],
    "volume": ["volume"],
}
SCREENER_FIELDS = {
    "symbol": ["symbol"],
    "name": ["longName", "shortName"],
    "price": ["regularMarketPrice"],
    "change": ["regularMarketChange"],
    "change_percent": ["regularMarketChangePercent"],
    "volume": ["regularMarketVolume"],
    "market_cap": ["marketCap"],
}
NEWS_FIELDS = {
    "title": ["title"],
    "url": ["url"],
    "text": ["text"],
    "source": ["source"],
    "news_type": ["type"],
    "image_url": ["img"],
}


def _normalize(responses: DataFrame, ddl: str, fields: dict[str, list[str]],
               required: list[str], keep: tuple[str, ...] = (),
               extra: dict[str, Column] | None = None,
               defaults: dict[str, str] | None = None,
               numbers: tuple[str, ...] = ()) -> Parsed:
    """``extra`` columns override, ``defaults`` fill gaps, ``numbers`` may be formatted texts
    whose unreadable values become NULL instead of rejecting the record."""
    schema = schemas.struct(ddl)
    types = {name: "string" if field.name in numbers else _json_type(field.dataType)
             for field in schema for name in fields.get(field.name, [])}
    pages = read_json(responses, list(keep), {}, "body", types)
    # An inner explode would have the optimizer add a filter that copies the whole parse.
    # A document without a readable list stays and is rejected; an empty list holds nothing.
    df = (pages.select(*keep, "_value", no_list("body").alias("_no_list"),
                       F.posexplode_outer("body").alias("pos", "item"))
          .where("pos is not null or _no_list"))
    columns, times = {}, {}
    for field in schema:
        alternatives = [F.col(f"item.`{n}`") for n in fields.get(field.name, [])]
        if field.name in (extra or {}):
            column = extra[field.name]
        elif not alternatives:
            column = F.lit(None).cast(field.dataType)
        else:
            column = F.coalesce(*[blank_to_null(a) for a in alternatives[:-1]], alternatives[-1])
            if _is_time(field.dataType):
                times[field.name] = column
                column = to_time(column)
            elif field.name in numbers:
                column = parse_number(column, ",")
        if field.name in (defaults or {}):
            column = F.coalesce(column, F.lit(defaults[field.name]))
        columns[field.name] = column
    record = F.when(F.col("_no_list"), F.col("_value")).otherwise(F.to_json("item"))
    return split(df, columns, times, required, [], F.col("item"), record, F.col("_no_list"))


def normalize_quotes(responses: DataFrame, name_fields: tuple[str, ...] = ("longName", "shortName"),
                     default_currency: str = "USD") -> Parsed:
    """Quotes of responses (``value``). An older feed knows only ``longName``."""
    fields = QUOTE_FIELDS | {"name": list(name_fields)}
    return _normalize(responses, schemas.QUOTE, fields, ["symbol"],
                      defaults={"currency": default_currency})


def normalize_tickers(responses: DataFrame) -> Parsed:
    """Tickers; the market cap may be text with commas."""
    return _normalize(responses, schemas.TICKER, TICKER_FIELDS, ["symbol"],
                      defaults={"currency": "USD"}, numbers=("market_cap",))


def normalize_search(responses: DataFrame) -> Parsed:
    """Search results, all of them in USD and from the US."""
    return _normalize(responses, schemas.TICKER, SEARCH_FIELDS, ["symbol"],
                      extra={"currency": F.lit("USD"), "country": F.lit("US")})


def normalize_history(responses: DataFrame) -> Parsed:
    """Price bars of responses tagged with ``symbol`` and ``interval``; epoch times are UTC."""
    return _normalize(responses, schemas.HISTORY, HISTORY_FIELDS, ["symbol", "date"],
                      keep=("symbol", "interval"),
                      extra={"symbol": F.col("symbol"),
                             "interval": F.coalesce("interval", F.lit("1d"))})


def normalize_screeners(responses: DataFrame) -> Parsed:
    """Screener rows of responses tagged with ``screener_type``; rank is the list position."""
    return _normalize(responses, schemas.SCREENER, SCREENER_FIELDS, ["symbol", "screener_type"],
                      keep=("screener_type",),
                      extra={"screener_type": F.col("screener_type"),
                             "rank": F.col("pos") + 1})


def normalize_news(responses: DataFrame) -> Parsed:
    """News of responses tagged with ``symbol``; the feed gives no time of publication."""
    return _normalize(responses, schemas.NEWS, NEWS_FIELDS, ["symbol", "title", "url"],
                      keep=("symbol",), extra={"symbol": F.col("symbol")})


def normalize_modules(responses: DataFrame) -> Parsed:
    """Module payloads of responses tagged with ``symbol`` and ``module_type``, kept as JSON.

    Read single values with ``get_json_object(data, path)``.
    """
    body = F.get_json_object(F.col("value").cast("string"), "$.body")
    df = responses.select(
        "symbol", "module_type", F.coalesce(body, F.lit("{}")).alias("data"),
        F.col("value").cast("string").alias("record"),
        # Well-formed JSON has a root, with or without a body.
        F.get_json_object(F.col("value").cast("string"), "$").isNull().alias("broken"))
    complete = F.col("symbol").isNotNull() & F.col("module_type").isNotNull()
    reason = F.when(F.col("broken"), "unreadable document").otherwise("missing required field")
    wrong = ~complete | F.col("broken")
    return Parsed(df.where(~wrong).drop("record", "broken"),
                  df.where(wrong).select("record", reason.alias("reason")),
                  df.select("symbol", "module_type", "data", F.when(wrong, F.col("record")).alias("record"),
                            F.when(wrong, reason).alias("reason")))
