"""Quality checks, alerts from checks, and tests that return failing rows."""

from __future__ import annotations

import datetime as dt
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


# Required fields by data type, status limits in percent, status weights.
REQUIRED = {
    "market_tickers": ["symbol", "name"],
    "stock_quotes": ["symbol", "price"],
    "stock_history": ["symbol", "date", "close"],
    "market_screeners": ["symbol", "screener_type"],
    "stock_news": ["symbol", "title", "url"],
}
COMPLETENESS_LIMITS = (20, 10)
VALIDITY_LIMITS = (10, 5)
STATUS_SCORES = {"valid": 1.0, "warning": 0.7, "error": 0.3}
OTHER_SCORE = 0.5
SCORE_ALERT = 0.8


class QualityError(RuntimeError):
    """At least one check has the status error."""


def _status(percent: Column, limits: tuple[int, int]) -> Column:
    return F.when(percent > limits[0], "error").when(percent > limits[1], "warning").otherwise("valid")


def _percent_text(percent: Column) -> Column:
    return F.format_string("%.1f%%", F.bround(percent, 1))


def _measures(df: DataFrame, kind: str, null_is_invalid: bool) -> DataFrame:
    """One row with all counts that the checks need: one scan, one pass."""
    required = REQUIRED.get(kind, ["symbol"])

    def missing(field: str) -> Column:
        return F.count_if(F.col(field).isNull()) if field in df.columns else F.count("*")

    invalid = F.lit(0).cast("bigint")
    if kind == "stock_quotes":
        bad_price = F.col("price") <= 0
        if null_is_invalid:
            bad_price = bad_price | F.col("price").isNull()
        invalid = F.count_if(bad_price) + F.count_if(F.col("volume") < 0)
    symbol = F.when(F.col("symbol") != "", F.col("symbol"))
    return df.agg(
        F.count("*").alias("records"),
        *[missing(f).alias(f"missing_{f}") for f in required],
        invalid.alias("invalid"),
        (F.count(symbol) - F.countDistinct(symbol)).alias("duplicates"),
    ).withColumns({
        "required": F.lit(len(required)),
        "missing": reduce(lambda a, b: a + b, [F.col(f"missing_{f}") for f in required]),
        "missing_fields": F.map_filter(
            F.create_map(*[x for f in required for x in (F.lit(f), F.col(f"missing_{f}"))]),
            lambda _, n: n > 0),
    })


def _completeness() -> Column:
    records = F.col("records")
    percent = F.try_divide("missing", records * F.col("required")) * 100
    empty = records == 0
    return F.struct(
        F.lit("completeness").alias("check_type"),
        F.when(empty, "error").otherwise(_status(percent, COMPLETENESS_LIMITS)).alias("status"),
        F.when(empty, "No data found")
        .otherwise(F.format_string("Missing %s of required fields", _percent_text(percent)))
        .alias("message"),
        F.to_json(F.struct(records.alias("record_count"), F.col("missing_fields"),
                           percent.alias("missing_percentage"))).alias("details"),
    )


def _validity() -> Column:
    records = F.col("records")
    percent = F.coalesce(F.try_divide("invalid", records) * 100, F.lit(0.0))
    return F.struct(
        F.lit("validity").alias("check_type"),
        _status(percent, VALIDITY_LIMITS).alias("status"),
        F.format_string("%s of records have invalid values", _percent_text(percent))
        .alias("message"),
        F.to_json(F.struct(records.alias("record_count"), F.col("invalid").alias("invalid_records"),
                           percent.alias("invalid_percentage"))).alias("details"),
    )


def _consistency() -> Column:
    duplicates = F.col("duplicates")
    return F.struct(
        F.lit("consistency").alias("check_type"),
        F.when(duplicates > 0, "warning").otherwise("valid").alias("status"),
        F.when(duplicates > 0, F.format_string("Found %d duplicate symbols", duplicates))
        .otherwise("No duplicate symbols found").alias("message"),
        F.to_json(F.struct(F.col("records").alias("record_count"),
                           duplicates.alias("duplicate_symbols"))).alias("details"),
    )


CHECKS = {"completeness": _completeness, "validity": _validity, "consistency": _consistency}


def run_checks(df: DataFrame, kind: str, as_of: dt.datetime | None = None,
               null_is_invalid: bool = True, checks: tuple[str, ...] = tuple(CHECKS)) -> DataFrame:
    """One row per check.

    A record may violate validity twice, so its percentage can pass 100. With
    ``null_is_invalid=False`` a missing price is no violation, as in data whose empty
    attributes were dropped.
    """
    checked_at = F.current_timestamp() if as_of is None else F.lit(as_of)
    rows = _measures(df, kind, null_is_invalid).select(
        F.explode(F.array(*[CHECKS[c]() for c in checks])).alias("c")).select("c.*")
    return rows.select(
        F.format_string("%s_%s_%d", "check_type", F.lit(kind),
                        F.unix_timestamp(checked_at)).alias("check_id"),
        F.lit(kind).alias("data_source"), "check_type", "status", "message", "details",
        checked_at.alias("checked_at"),
    )


def completeness(df: DataFrame, kind: str, **options) -> DataFrame:
    return run_checks(df, kind, checks=("completeness",), **options)


def validity(df: DataFrame, kind: str, **options) -> DataFrame:
    return run_checks(df, kind, checks=("validity",), **options)


def consistency(df: DataFrame, kind: str, **options) -> DataFrame:
    return run_checks(df, kind, checks=("consistency",), **options)


def average_score(checks: DataFrame) -> DataFrame:
    """Weighted score of all checks; no checks, full score."""
    score = F
    for status, weight in STATUS_SCORES.items():
        score = score.when(F.col("status") == status, weight)
    mean = F.avg(score.otherwise(OTHER_SCORE))
    return checks.agg(F.coalesce(mean, F.lit(1.0)).alias("score"))


def quality_alerts(checks: DataFrame, as_of: dt.datetime | None = None) -> DataFrame:
    """An alert per failed check, and one when the average score is low.

    ``checks`` are read twice: store them first, they are a few rows.
    """
    created = F.current_timestamp() if as_of is None else F.lit(as_of)
    error = F.col("status") == "error"
    per_check = checks.where(F.col("status").isin("error", "warning")).select(
        F.when(error, "error").otherwise("warning").alias("alert_type"),
        F.when(error, "high").otherwise("medium").alias("severity"),
        F.format_string("Data Quality %s: %s", F.initcap("status"), "data_source").alias("title"),
        F.concat_ws(": ", "check_type", "message").alias("message"),
        "data_source",
    )
    low = average_score(checks).where(F.col("score") < SCORE_ALERT).select(
        F.lit("warning").alias("alert_type"),
        F.lit("medium").alias("severity"),
        F.lit("Low Data Quality Score").alias("title"),
        F.format_string("Average data quality score is %s", _percent_text(F.col("score") * 100))
        .alias("message"),
        F.lit(None).cast("string").alias("data_source"),
    )
    return per_check.unionByName(low).withColumn("created_at", created)


def gate(checks: DataFrame) -> None:
    """Raise when a check failed, naming all of them. One line per source and kind of check comes back."""
    failed = (checks.where("status = 'error'").groupBy("data_source", "check_type")
              .agg(F.array_join(F.array_sort(F.collect_set("message")), "; ").alias("messages"))
              .orderBy("data_source", "check_type").collect())
    if failed:
        raise QualityError("; ".join(f"{row.data_source}: {row.messages}" for row in failed))


# --- tests on tables: each returns the failing rows ----------------------------------------

def failing_not_null(df: DataFrame, column: str) -> DataFrame:
    return df.where(F.col(column).isNull())


def failing_unique(df: DataFrame, column: str) -> DataFrame:
    """Values that occur more than once, with their number of rows."""
    counts = df.where(F.col(column).isNotNull()).groupBy(column).agg(F.count("*").alias("n_records"))
    return counts.where("n_records > 1")


def failing_accepted(df: DataFrame, column: str, values: list) -> DataFrame:
    """Rows with a value outside the list; NULL is a matter of the not-null test."""
    return df.where(~F.col(column).isin(values))


def failing_relationship(child: DataFrame, column: str, parent: DataFrame,
                         parent_column: str | None = None) -> DataFrame:
    """Child rows whose key has no parent.

    Parents may repeat, which an anti join does not mind; so no aggregate stands in the way of the adaptive
    skew join, which deals the rows of a hot child key over tasks by where they were read.
    """
    keys = parent.select(F.col(parent_column or column).alias(column))
    return child.where(F.col(column).isNotNull()).join(keys, column, "left_anti").select(*child.columns)


# The tests declared on raw tables and models.
NOT_NULL = {
    "stock_quotes": ["symbol", "price", "timestamp"],
    "market_screeners": ["symbol", "screener_type"],
    "stock_news": ["symbol", "title"],
    "stock_history": ["symbol", "date", "close"],
    "dim_stocks": ["stock_id", "symbol"],
    "fact_stock_quotes": ["quote_id", "stock_id", "quote_timestamp", "price"],
    "fact_market_performance": ["performance_id", "date"],
    "fact_news_sentiment": ["news_id", "stock_id", "published_time"],
    "mart_daily_summary": ["date"],
}
UNIQUE = {
    "stock_quotes": ["symbol"],
    "dim_stocks": ["stock_id", "symbol"],
    "fact_stock_quotes": ["quote_id"],
    "fact_market_performance": ["performance_id"],
    "fact_news_sentiment": ["news_id"],
    "mart_daily_summary": ["date"],
}
ACCEPTED = {
    "market_screeners": {"screener_type": ["day_gainers", "day_losers", "most_actives"]},
    "dim_stocks": {"is_active": [True, False]},
}
RELATIONSHIPS = {
    "fact_stock_quotes": {"stock_id": "dim_stocks"},
    "fact_news_sentiment": {"stock_id": "dim_stocks"},
}


def table_tests(name: str, df: DataFrame, parents: dict[str, DataFrame] | None = None) -> dict[str, DataFrame]:
    """Failing rows of every test declared on a table, by test name."""
    tests = {f"not_null_{name}_{c}": failing_not_null(df, c) for c in NOT_NULL.get(name, [])}
    tests |= {f"unique_{name}_{c}": failing_unique(df, c) for c in UNIQUE.get(name, [])}
    tests |= {f"accepted_values_{name}_{c}": failing_accepted(df, c, v)
              for c, v in ACCEPTED.get(name, {}).items()}
    for column, parent in RELATIONSHIPS.get(name, {}).items():
        if parents and parent in parents:
            tests[f"relationships_{name}_{column}"] = failing_relationship(df, column, parents[parent])
    return tests


def not_null_report(name: str, df: DataFrame) -> DataFrame:
    """Number of failing rows per declared not-null test, in one scan."""
    columns = NOT_NULL[name]
    counts = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in columns])
    return counts.unpivot([], columns, "column_name", "failing_rows")


def tested_columns(name: str) -> list[str]:
    """Columns of a table that tests are declared on."""
    declared = (NOT_NULL, UNIQUE, ACCEPTED, RELATIONSHIPS)
    return list(dict.fromkeys(c for tests in declared for c in tests.get(name, ())))


def failing_counts(name: str, df: DataFrame, parents: dict[str, DataFrame] | None = None) -> DataFrame:
    """Number of failing rows of every test declared on a table; of failing values for a unique test.

    Tests that ask each row alone share a scan. Foreign keys are counted before they meet the parent table, so one row
    per key is joined, and a hot key is one row.
    """
    alone = {f"not_null_{name}_{c}": F.col(c).isNull() for c in NOT_NULL.get(name, [])}
    alone |= {f"accepted_values_{name}_{c}": ~F.col(c).isin(v) for c, v in ACCEPTED.get(name, {}).items()}
    parts = [df.agg(*[F.count_if(c).alias(test) for test, c in alone.items()])
             .unpivot([], list(alone), "test", "failing_rows")] if alone else []
    for column in UNIQUE.get(name, []):
        parts.append(failing_unique(df, column).agg(F.count("*").alias("failing_rows"))
                     .select(F.lit(f"unique_{name}_{column}").alias("test"), "failing_rows"))
    for column, parent in RELATIONSHIPS.get(name, {}).items():
        if parents and parent in parents:
            keys = df.groupBy(column).agg(F.count("*").alias("n_records"))
            parts.append(failing_relationship(keys, column, parents[parent])
                         .agg(F.coalesce(F.sum("n_records"), F.lit(0)).alias("failing_rows"))
                         .select(F.lit(f"relationships_{name}_{column}").alias("test"), "failing_rows"))
    return reduce(DataFrame.unionByName, parts)
