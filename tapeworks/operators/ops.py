"""Queries on the logs of pipeline runs: jobs, metrics and alerts."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from tapeworks.functions.market import mean, safe_ratio, surrogate_key
from tapeworks.sources.lake import exists

# Alert thresholds and retention of the logs in days.
SLOW_SECONDS = 300
FAILURE_RATE = 0.1
API_ERROR_RATE = 0.05
ALERT_DAYS = 30
JOB_DAYS = 7


def _alert(rule: str, kind: str, severity: str, title: Column, message: Column, data_source: Column, run: str,
           created_at: Column, job_id: Column | None = None) -> list[Column]:
    subject = data_source if job_id is None else job_id
    return [
        surrogate_key(F.lit(rule), subject, F.lit(run)).alias("alert_id"),
        F.lit(kind).alias("alert_type"), F.lit(severity).alias("severity"),
        title.alias("title"), message.alias("message"), data_source.alias("data_source"),
        (F.lit(None).cast("string") if job_id is None else job_id).alias("job_id"),
        F.lit(False).alias("resolved"), F.lit(None).cast("timestamp").alias("resolved_at"),
        created_at.alias("created_at"),
    ]


def failure_rates(jobs: DataFrame) -> DataFrame:
    """Jobs, failed jobs and their share per data source."""
    return _rates(jobs)


def _rates(jobs: DataFrame, *more: Column) -> DataFrame:
    failed = F.count_if(F.col("status") == "failed")
    return jobs.groupBy("data_source").agg(
        F.count("*").alias("jobs"), failed.alias("failed_jobs"),
        (failed / F.count("*")).alias("failure_rate"), *more)


def job_alerts(jobs: DataFrame, run: str = "") -> DataFrame:
    """Alerts for failed jobs, slow jobs, and sources that fail too often.

    The id is a hash of the rule, what it is about (the job or the source) and the ``run``, so a repeated run
    makes the same ids. An alert has the time of its job, that of a source the time of its newest job.
    """
    job, source, at = F.col("job_id"), F.col("data_source"), F.col("created_at")
    # Both rules on a job are read off the same row, so the log is scanned once for them.
    rules = F.array(
        F.when(F.col("status") == "failed", F.struct(*_alert(
            "failed", "error", "high", F.concat(F.lit("Job Failed: "), job),
            F.concat(F.lit("Job "), job, F.lit(" failed: "), F.coalesce("error_message", F.lit(""))),
            source, run, at, job))),
        F.when(F.col("duration_seconds") > SLOW_SECONDS, F.struct(*_alert(
            "slow", "warning", "medium", F.concat(F.lit("Slow Job: "), job),
            F.format_string("Job %s took %.2f seconds", job, F.bround("duration_seconds", 2)),
            source, run, at, job))),
    )
    per_job = jobs.select(F.explode(rules).alias("a")).where("a is not null").select("a.*")
    rates = _rates(jobs, F.max(at).alias("created_at")).where(F.col("failure_rate") > FAILURE_RATE)
    per_source = rates.select(*_alert(
        "failure_rate", "warning", "medium", F.concat(F.lit("High Failure Rate: "), source),
        F.format_string("Failure rate for %s is %.1f%%", source,
                        F.bround(F.col("failure_rate") * 100, 1)),
        source, run, at))
    return per_job.unionByName(per_source)


def append_alerts(alerts: DataFrame, log: str) -> None:
    """Add alerts to the log; those whose id it has are left out, so a repeated run adds nothing."""
    spark = alerts.sparkSession
    if exists(spark, log):
        alerts = alerts.join(spark.read.parquet(log).select("alert_id"), "alert_id", "left_anti")
    alerts.write.mode("append").parquet(log)


def run_quality(jobs: DataFrame) -> DataFrame:
    """Share of items that went through, per job; NULL when nothing did."""
    done, failed = F.col("processed_items"), F.col("failed_items")
    return jobs.withColumn(
        "data_quality_score", F.when(done > 0, done / (done + failed)))


def run_summary(jobs: DataFrame) -> DataFrame:
    """One row over a run: sources seen, succeeded and failed, and item totals.

    A source has succeeded when all its jobs completed.
    """
    sources = jobs.groupBy("data_source").agg(
        F.every(F.col("status") == "completed").alias("ok"),
        F.sum("processed_items").alias("processed"),
        F.sum("failed_items").alias("failed"),
        F.sum("duration_seconds").alias("seconds"),
    )
    return sources.agg(
        F.count("*").alias("data_sources_processed"),
        F.count_if("ok").alias("successful_sources"),
        F.count_if(~F.col("ok")).alias("failed_sources"),
        F.sum("processed").alias("processed_items"),
        F.sum("failed").alias("failed_items"),
        F.sum("seconds").alias("total_time_seconds"),
    )


def collect_metrics(jobs: DataFrame) -> DataFrame:
    """Metric rows of jobs."""
    measured = [c for c in ("memory_usage_mb", "cpu_usage_percent") if c in jobs.columns]
    return run_quality(jobs).select(
        "job_id", "data_source", *measured,
        F.col("processed_items").alias("records_processed"),
        F.col("failed_items").alias("records_failed"),
        F.coalesce("duration_seconds", F.lit(0.0)).alias("processing_time_seconds"),
        "data_quality_score", "created_at")


def recent(df: DataFrame, k: int = 10, time: str = "created_at", tie: str = "job_id") -> DataFrame:
    """The ``k`` newest rows, newest first."""
    return df.orderBy(F.col(time).desc_nulls_last(), tie).limit(k)


def jobs_by_status(jobs: DataFrame, status: str | None = None, k: int | None = None) -> DataFrame:
    """Jobs of one status (or all), newest first."""
    if status is not None:
        jobs = jobs.where(F.col("status") == status)
    ordered = jobs.orderBy(F.col("created_at").desc_nulls_last(), "job_id")
    return ordered if k is None else ordered.limit(k)


METRIC_AVERAGES = {
    "processing_time_seconds": "avg_processing_time",
    "records_processed": "avg_records_processed",
    "data_quality_score": "avg_data_quality_score",
    "memory_usage_mb": "avg_memory_usage",
    "cpu_usage_percent": "avg_cpu_usage",
}


def metric_averages(metrics: DataFrame, last: int = 100) -> DataFrame:
    """Averages over the ``last`` newest metrics, their number, and that of all (``total_jobs``).

    Missing values count as 0.
    """
    averages = recent(metrics, last).agg(F.count("*").alias("jobs"), *[
        mean(F.coalesce(F.col(c).cast("double"), F.lit(0.0))).alias(name)
        for c, name in METRIC_AVERAGES.items() if c in metrics.columns])
    return averages.withColumn("total_jobs", metrics.agg(F.count("*")).scalar())


def api_error_rates(metrics: DataFrame, threshold: float = API_ERROR_RATE) -> DataFrame:
    """Error rate of API calls per data source and whether it calls for an alert."""
    errors, calls = F.sum("api_errors"), F.sum("api_calls_made")
    return metrics.groupBy("data_source").agg(
        calls.alias("api_calls"), errors.alias("api_errors"),
        safe_ratio(errors, calls).alias("error_rate"),
    ).withColumn("alert", F.col("error_rate") > threshold)


def alert_rollup(alerts: DataFrame) -> DataFrame:
    """Alerts in total and unresolved, over all and by type and severity, in one pass."""
    counts = alerts.groupBy("alert_type", "severity").agg(
        F.count("*").alias("n"), F.count_if(~F.col("resolved")).alias("open"))
    groups = F.array(
        F.struct(F.lit("all").alias("dimension"), F.lit("all").alias("value")),
        F.struct(F.lit("alert_type").alias("dimension"), F.col("alert_type").alias("value")),
        F.struct(F.lit("severity").alias("dimension"), F.col("severity").alias("value")))
    return (
        counts.withColumn("g", F.explode(groups)).groupBy("g.dimension", "g.value")
        .agg(F.sum("n").alias("alerts"), F.sum("open").alias("unresolved"))
    )


def resolve(alerts: DataFrame, resolutions: DataFrame) -> DataFrame:
    """Alerts in their latest state, from the log of alerts and that of their resolutions."""
    latest = resolutions.groupBy("alert_id").agg(F.max("resolved_at").alias("resolved_at"), F.lit(True).alias("resolved"))
    return (alerts.drop("resolved", "resolved_at").join(latest, "alert_id", "left")
            .withColumn("resolved", F.coalesce("resolved", F.lit(False))))


def keep_recent(log: DataFrame, as_of: dt.datetime, days: int, time: str = "created_at") -> DataFrame:
    """Log rows not older than ``days`` at ``as_of``."""
    return log.where(F.col(time) >= F.lit(as_of - dt.timedelta(days=days)))


def counted(df: DataFrame, name: str) -> tuple[DataFrame, Observation]:
    """Count rows on their way to the next action, without a job of its own."""
    observation = Observation(name)
    return df.observe(observation, F.count(F.lit(1)).alias("rows")), observation


def run_counts(original: Observation, cleaned: Observation, enriched: Observation) -> dict[str, int]:
    """Row counts of a finished run; waits for the action that was observed."""
    return {"original_count": original.get["rows"], "cleaned_count": cleaned.get["rows"],
            "enriched_count": enriched.get["rows"]}
