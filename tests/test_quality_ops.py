"""Cleaning, enrichment, checks, alerts, logs, the transform pipeline."""

from __future__ import annotations

import datetime as dt
import json
import os

import pytest
from pyspark.sql import functions as F

from tapeworks import schemas, session
from tapeworks.operators import clean, enrich, latest, ops, quality
from tapeworks.plans.transform import transform
from tapeworks.sources import lake
from tapeworks.sources.sinks import save_failures
from workload import checks
from workload.views import view

SF_DIR = "/root/testdata/sf0.001"
NOW = dt.datetime(2024, 6, 1)
STOCK = "symbol string, name string, sector string, market_cap string, currency string"


def test_clean_and_enrich_stocks(spark):
    df = spark.createDataFrame([
        (" aapl ", " Apple ", "Technology", "3,000,000,000,000", None),
        ("x", None, "", "n/a", "EUR"), ("y", "Y", "Ships", None, "EUR"), ("z", "Z", None, "0", "EUR")], STOCK)
    got = {r.symbol: r for r in enrich.enrich_stocks(clean.clean_stocks(df), NOW).collect()}
    a = got["AAPL"]
    assert (a.name, a.market_cap, a.currency, a.market_cap_category, a.sector_category,
            a.data_quality_score) == ("Apple", 3e12, "USD", "Mega Cap", "Growth", 1.0)
    x = got["X"]  # carried symbol, sector, market cap and currency; filled are symbol and currency
    assert (x.market_cap, x.market_cap_category, x.sector_category, x.data_quality_score) == (None, None, None, 0.5)
    assert (got["Y"].sector_category, got["Y"].data_quality_score) == ("Other", 1.0)
    assert got["Z"].market_cap_category is None
    whole = enrich.enrich_stocks(clean.clean_stocks(df), NOW, "schema").where("symbol = 'X'").first()
    assert whole.data_quality_score == pytest.approx(2 / 5)
    with pytest.raises(ValueError):
        enrich.quality_score(df, ["symbol"], "other")


def test_clean_numbers(spark):
    df = spark.createDataFrame([(" a", "$1,234.50", 7)], "symbol string, price string, volume bigint")
    row = clean.clean_numbers(df).first()
    assert (row.symbol, row.price, row.volume, row.currency) == ("A", 1234.5, 7.0, "USD")


def test_filters(spark):
    df = spark.range(10).withColumn("date", F.date_add(F.lit("2024-01-01"), F.col("id").cast("int")))
    assert df.where(clean.conjunction([("id", ">", 2), ("id", "in", [3, 4, 9])])).count() == 3
    assert df.where(clean.conjunction([])).count() == 10
    with pytest.raises(ValueError):
        clean.conjunction([("id", "!=", 1)])
    assert clean.date_range(df, "2024-01-03", "2024-01-05").count() == 3
    assert clean.date_range(df.drop("date"), "2024-01-03").count() == 10
    wide = df.selectExpr("id * 500 as volume", "cast(id * 10 as double) as change_percent", "date")
    assert [r.volume for r in clean.threshold_filter(wide).collect()] == [1000, 1500, 2000, 2500]


@pytest.fixture(scope="module")
def raw(spark):
    return spark.createDataFrame(
        [("A", 1.0, 5), ("A", -1.0, -5), ("B", None, 5), (None, 2.0, None)],
        "symbol string, price double, volume bigint")


def test_checks(raw):
    got = {r.check_type: r for r in quality.run_checks(raw, "stock_quotes", NOW).collect()}
    assert {k: (r.status, r.message) for k, r in got.items()} == {
        "completeness": ("error", "Missing 25.0% of required fields"),
        "validity": ("error", "75.0% of records have invalid values"),
        "consistency": ("warning", "Found 1 duplicate symbols")}
    assert json.loads(got["completeness"].details)["missing_fields"] == {"symbol": 1, "price": 1}
    stamp = int(NOW.replace(tzinfo=dt.timezone.utc).timestamp())
    assert got["validity"].check_id == f"validity_stock_quotes_{stamp}"
    lenient = quality.validity(raw, "stock_quotes", null_is_invalid=False).first()
    assert lenient.message == "50.0% of records have invalid values"
    assert quality.completeness(raw.limit(0), "stock_quotes").first().message == "No data found"
    assert quality.validity(raw, "other").first().status == "valid"
    assert quality.completeness(raw, "stock_news").first().status == "error"  # two columns missing


@pytest.mark.parametrize("missing, status", [(10, "valid"), (11, "warning"), (20, "warning"), (21, "error")])
def test_completeness_limits(spark, missing, status):
    df = spark.range(100).select(F.when(F.col("id") >= missing, "S").alias("symbol"))
    assert quality.completeness(df, "other").first().status == status


def test_alerts_gate_and_score(spark, raw):
    checks = quality.run_checks(raw, "stock_quotes", NOW)
    alerts = {r.title: r for r in quality.quality_alerts(checks, NOW).collect()}
    assert sorted(alerts) == ["Data Quality Error: stock_quotes", "Data Quality Warning: stock_quotes",
                              "Low Data Quality Score"]
    assert alerts["Low Data Quality Score"].message == "Average data quality score is 43.3%"
    with pytest.raises(quality.QualityError, match="stock_quotes"):
        quality.gate(checks)
    quality.gate(checks.where("status <> 'error'"))
    assert quality.average_score(checks.limit(0)).first().score == 1.0


def test_failing_rows_and_storage(spark, tmp_path):
    dim = spark.createDataFrame([("1", "A", True), ("2", "B", None), ("2", "C", False)],
                                "stock_id string, symbol string, is_active boolean")
    fact = spark.createDataFrame([("q1", "1"), ("q2", "9"), ("q3", None)], "news_id string, stock_id string")
    fact = fact.withColumn("published_time", F.lit(NOW))
    tests = quality.table_tests("dim_stocks", dim)
    tests |= quality.table_tests("fact_news_sentiment", fact, {"dim_stocks": dim})
    counts = {r.test: r.failing_rows for r in save_failures(tests, str(tmp_path)).collect()}
    assert {k: v for k, v in counts.items() if v} == {
        "unique_dim_stocks_stock_id": 1, "not_null_fact_news_sentiment_stock_id": 1,
        "relationships_fact_news_sentiment_stock_id": 1}
    stored = spark.read.parquet(str(tmp_path / "unique_dim_stocks_stock_id")).first()
    assert (stored.stock_id, stored.n_records) == ("2", 2)
    odd = quality.failing_accepted(dim.select(F.lit("x").alias("t")), "t", ["y"])
    assert odd.count() == 3


JOB = "job_id string, data_source string, status string, duration_seconds double, processed_items bigint, " \
      "failed_items bigint, error_message string, created_at timestamp"


@pytest.fixture(scope="module")
def jobs(spark):
    day = [NOW - dt.timedelta(days=d) for d in (0, 5, 8)]
    return spark.createDataFrame([
        ("1", "q", "failed", 10.0, 0, 5, "boom", day[0]), ("2", "q", "completed", 301.0, 9, 1, None, day[1]),
        ("3", "n", "completed", None, 4, 0, None, day[2])], JOB)


def test_job_rules(jobs):
    titles = sorted(r.title for r in ops.job_alerts(jobs).collect())
    assert titles == ["High Failure Rate: q", "Job Failed: 1", "Slow Job: 2"]
    messages = {r.title: r.message for r in ops.job_alerts(jobs).collect()}
    assert messages["Job Failed: 1"] == "Job 1 failed: boom"
    assert messages["Slow Job: 2"] == "Job 2 took 301.00 seconds"
    assert messages["High Failure Rate: q"] == "Failure rate for q is 50.0%"


def test_job_logs(jobs):
    assert {r.job_id: r.data_quality_score for r in ops.run_quality(jobs).collect()} == {
        "1": None, "2": 0.9, "3": 1.0}
    total = ops.run_summary(jobs).first()
    assert (total.data_sources_processed, total.successful_sources, total.failed_sources,
            total.processed_items, total.failed_items) == (2, 1, 1, 13, 6)
    averages = ops.metric_averages(ops.collect_metrics(jobs), last=2).first()
    assert (averages.jobs, averages.total_jobs, averages.avg_processing_time, averages.avg_data_quality_score) == (2, 3, 155.5, 0.45)
    assert [r.job_id for r in ops.jobs_by_status(jobs, "completed", 1).collect()] == ["2"]
    assert [r.job_id for r in ops.recent(jobs, 2).collect()] == ["1", "2"]
    assert ops.keep_recent(jobs, NOW, ops.JOB_DAYS).count() == 2


def test_alert_log(spark):
    alerts = spark.createDataFrame(
        [("a", "error", "high"), ("b", "warning", "medium"), ("c", "warning", "medium")],
        "alert_id string, alert_type string, severity string")
    done = spark.createDataFrame([("b", NOW), ("b", NOW - dt.timedelta(1))], "alert_id string, resolved_at timestamp")
    resolved = ops.resolve(alerts, done)
    assert resolved.where("resolved").first().resolved_at == NOW
    rollup = {(r.dimension, r.value): (r.alerts, r.unresolved) for r in ops.alert_rollup(resolved).collect()}
    assert rollup == {("all", "all"): (3, 2), ("alert_type", "error"): (1, 1), ("alert_type", "warning"): (2, 1),
                      ("severity", "high"): (1, 1), ("severity", "medium"): (2, 1)}


def test_alerts_keep_their_ids(spark, jobs, tmp_path):
    log = str(tmp_path / "alerts")
    for part in (jobs.where("job_id = '1'"), jobs, jobs):
        ops.append_alerts(ops.job_alerts(part, "monday"), log)
    stored = spark.read.parquet(log).collect()
    assert sorted(r.title for r in stored) == ["High Failure Rate: q", "Job Failed: 1", "Slow Job: 2"]
    assert len({r.alert_id for r in stored}) == 3 and not any(r.resolved for r in stored)
    assert {r.title: r.created_at for r in stored}["Slow Job: 2"] == NOW - dt.timedelta(days=5)
    assert set(spark.read.parquet(log).columns) == set(schemas.columns(schemas.ALERT))
    ops.append_alerts(ops.job_alerts(jobs, "tuesday"), log)
    assert spark.read.parquet(log).count() == 6


def test_policies_have_places(jobs, tmp_path):
    read = jobs.sparkSession.read.parquet
    policies = [lake.Policy("q", 3, True, str(tmp_path / "cold")), lake.Policy("n", 3), lake.Policy("x", 1, enabled=False)]
    for _ in range(2):
        lake.apply_retention(jobs, policies, NOW, str(tmp_path / "keep"))
    assert [r.job_id for r in read(str(tmp_path / "keep")).collect()] == ["1"]
    assert [r.job_id for r in read(str(tmp_path / "cold")).collect()] == ["2"]  # the row of n has no archive


def test_api_error_rates(spark):
    df = spark.createDataFrame([("q", 100, 4), ("q", 100, 8), ("n", 100, 5), ("z", 0, 0)],
                               "data_source string, api_calls_made bigint, api_errors bigint")
    assert {r.data_source: (r.error_rate, r.alert) for r in ops.api_error_rates(df).collect()} == {
        "q": (0.06, True), "n": (0.05, False), "z": (0.0, False)}


def test_retention_policies(jobs, tmp_path):
    lake.apply_retention(jobs, {"q": 3}, NOW, str(tmp_path / "keep"), str(tmp_path / "archive"))
    read = jobs.sparkSession.read.parquet
    assert [r.job_id for r in read(str(tmp_path / "archive")).collect()] == ["2"]
    # A later run adds to the archive; the same run again replaces its own part.
    later = jobs.where("job_id = '2'").withColumn("job_id", F.lit("9"))
    for _ in range(2):
        lake.apply_retention(later, {"q": 3}, NOW + dt.timedelta(days=1), str(tmp_path / "keep2"), str(tmp_path / "archive"))
    assert sorted(r.job_id for r in read(str(tmp_path / "archive")).collect()) == ["2", "9"]
    assert sorted(r.job_id for r in read(str(tmp_path / "keep")).collect()) == ["1", "3"]
    assert lake.mark_expired(jobs, {}, NOW).where("expired").count() == 0


def test_transform_pipeline(spark, tmp_path):
    df = spark.createDataFrame(
        [("AAPL", 150.25, 1.5, 50_000_000, 3.0e12, "Technology"), ("MSFT", 300.5, -0.5, 30_000_000, 2.5e12, "Technology")],
        "symbol string, price double, change_percent double, volume bigint, market_cap double, sector string")
    result = transform(df, "stock_quotes", NOW, str(tmp_path / "t"))
    assert {(r.market_cap_category, r.sector_category, r.data_quality_score) for r in result.data.collect()} == {
        ("Mega Cap", "Growth", 1.0)}
    assert result.counts() == {"original_count": 2, "cleaned_count": 2, "enriched_count": 2}
    market = result.aggregations["market_summary"].first()
    assert (market.total_stocks, market.gainers, market.losers) == (2, 1, 1)
    assert result.aggregations["sector_aggregation"].first().price_median == 225.38
    assert {r.status for r in result.checks.collect()} == {"valid"}
    assert transform(df, "market_tickers", NOW).aggregations == {}


def test_failing_counts_are_those_of_the_failing_rows(spark):
    """Parents that repeat, keys that are missing and rows without a value count as in the single tests."""
    dim = spark.createDataFrame([("a", "A", True), ("b", "B", None), ("b", None, False)],
                                "stock_id string, symbol string, is_active boolean")
    fact = spark.createDataFrame(
        [("1", "a", NOW, 1.0), ("1", "x", None, None), ("2", "x", NOW, 2.0), (None, "y", NOW, None), (None, None, NOW, 3.0)],
        "quote_id string, stock_id string, quote_timestamp timestamp, price double")
    screeners = spark.createDataFrame([("A", "day_gainers"), ("B", "other"), (None, None)], "symbol string, screener_type string")
    for name, df in {"dim_stocks": dim, "fact_stock_quotes": fact, "market_screeners": screeners}.items():
        got = {r.test: r.failing_rows for r in quality.failing_counts(name, df, {"dim_stocks": dim}).collect()}
        assert got == {test: rows.count() for test, rows in quality.table_tests(name, df, {"dim_stocks": dim}).items()}
    assert quality.failing_counts("fact_stock_quotes", fact, {"dim_stocks": dim}).where(
        "test = 'relationships_fact_stock_quotes_stock_id'").first().failing_rows == 3


@pytest.fixture
def stored_plans(monkeypatch):
    """Optimized plans of the tables that are stored."""
    plans, store = [], session.stored

    def noted(df, purpose):
        plans.append(df._jdf.queryExecution().optimizedPlan().toString())
        return store(df, purpose)

    monkeypatch.setattr(session, "stored", noted)
    monkeypatch.setattr(latest, "stored", noted)
    return plans


@pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no test tables")
def test_declared_tests_join_the_quotes_once(spark, stored_plans):
    """Quotes are joined to their parts for one stored table, which all models read."""
    assert checks.declared_tests(spark, SF_DIR).count() == 33
    assert sum("p_partkey" in plan for plan in stored_plans) == 1


@pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no test tables")
def test_tested_columns_hang_on_stored_ones_only(spark):
    """Whole tables give the same rows as those of which only some columns are kept."""
    views = [view(spark, SF_DIR, name) for name in ("quotes", "screeners", "news", "history")]
    whole = checks.tested_tables(*views, keep=lambda df, name: df)
    for name, df in checks.tested_tables(*views).items():
        assert df.columns == whole[name].columns and set(df.columns) == set(quality.tested_columns(name))
        assert df.exceptAll(whole[name]).isEmpty() and whole[name].exceptAll(df).isEmpty(), name
