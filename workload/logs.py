"""Queries on logs of pipeline runs."""

from __future__ import annotations

import datetime as dt
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tapeworks.operators import ops
from tapeworks.session import shared_dir
from tapeworks.sources import lake
from workload.registry import cte, query
from workload.views import view

NOW = dt.datetime(1998, 7, 1)
POLICIES = {"1-URGENT": 365, "2-HIGH": 180, "3-MEDIUM": 90}

cte("failure_rates", """
select data_source, count(*) as jobs, count(case when status = 'failed' then 1 end) as failed_jobs,
  count(case when status = 'failed' then 1 end) / count(*) as failure_rate
from jobs group by data_source""")
# A duration is cents of a price over 100,000; to two decimals, halves to even.
cte("slow_times", """
select *, hundredths + case when rest > 500 or (rest = 500 and hundredths % 2 = 1) then 1 else 0 end as shown
from (select *, cents // 1000 as hundredths, cents % 1000 as rest
  from (select *, cast(round(duration_seconds * 100000) as bigint) as cents from jobs where duration_seconds > 300))""")
cte("alerts", """
select md5('failed-' || job_id || '-nightly') as alert_id, 'error' as alert_type, 'high' as severity, 'Job Failed: ' || job_id as title,
  'Job ' || job_id || ' failed: ' || error_message as message, data_source, job_id, created_at
from jobs where status = 'failed'
union all
select md5('slow-' || job_id || '-nightly'), 'warning', 'medium', 'Slow Job: ' || job_id,
  'Job ' || job_id || ' took ' || shown // 100 || '.' || lpad(cast(shown % 100 as varchar), 2, '0') || ' seconds',
  data_source, job_id, created_at
from slow_times
union all
select md5('failure_rate-' || data_source || '-nightly'), 'warning', 'medium', 'High Failure Rate: ' || data_source,
  printf('Failure rate for %s is %.1f%%', data_source, failure_rate * 100), data_source, null,
  (select max(created_at) from jobs where jobs.data_source = failure_rates.data_source)
from failure_rates where failure_rate > 0.1""")


def jobs(spark, sf_dir, *columns):
    return view(spark, sf_dir, "jobs", list(columns) or None)


@query("select * from failure_rates")
def job_failure_rate(spark, sf_dir):
    return ops.failure_rates(jobs(spark, sf_dir, "data_source", "status"))


@query("""
select job_id, data_source, title from alerts where title like 'Slow Job%'""")
def slow_jobs(spark, sf_dir):
    alerts = ops.job_alerts(jobs(spark, sf_dir))
    return alerts.where(F.col("title").startswith("Slow Job")).select("job_id", "data_source", "title")


RUN = "nightly"


@query("""
select alert_id, alert_type, severity, title, message, data_source, job_id, false as resolved, created_at from alerts""")
def job_alerts(spark, sf_dir):
    return ops.job_alerts(jobs(spark, sf_dir), RUN).drop("resolved_at")


def alert_log(spark, sf_dir):
    """The stored log of alerts after two runs of a part of the jobs and two of all of them."""
    log = f"{shared_dir(spark, 'alerts')}/log"
    alerts = ops.job_alerts(jobs(spark, sf_dir), RUN)
    for some in (alerts.where("alert_type = 'error'"), alerts.where("alert_type = 'error'"), alerts, alerts):
        ops.append_alerts(some, log)
    return spark.read.parquet(log)


@query("""
with a as (select *, job_id is not null and right(job_id, 1) in ('0', '5') as resolved from alerts)
select 'all' as dimension, 'all' as value, count(*) as alerts,
  count(case when not resolved then 1 end) as unresolved from a
union all select 'alert_type', alert_type, count(*), count(case when not resolved then 1 end)
from a group by 2
union all select 'severity', severity, count(*), count(case when not resolved then 1 end)
from a group by 2""")
def alert_rollup(spark, sf_dir):
    alerts = alert_log(spark, sf_dir)
    resolved = alerts.where(F.col("job_id").rlike("[05]$")).select("alert_id", F.lit(NOW).alias("resolved_at"))
    return ops.alert_rollup(ops.resolve(alerts, resolved))


@query("""
select alert_id, title, message, created_at from alerts order by created_at desc, alert_id limit 5""")
def recent_alerts(spark, sf_dir):
    return ops.recent(alert_log(spark, sf_dir).select("alert_id", "title", "message", "created_at"), 5, tie="alert_id")


@query("""
select job_id, data_source, status, created_at from jobs
order by created_at desc, job_id limit 10""")
def recent_jobs(spark, sf_dir):
    return ops.recent(jobs(spark, sf_dir, "job_id", "data_source", "status", "created_at"))


@query("select job_id, data_source, created_at from jobs where status = 'failed'")
def failed_jobs(spark, sf_dir):
    log = jobs(spark, sf_dir, "job_id", "data_source", "status", "created_at")
    return ops.jobs_by_status(log, "failed").drop("status")


@query("""
select job_id, case when processed_items > 0 then
  cast(processed_items as double) / (processed_items + failed_items) end as data_quality_score
from jobs""")
def run_quality(spark, sf_dir):
    log = jobs(spark, sf_dir, "job_id", "processed_items", "failed_items")
    return ops.run_quality(log).select("job_id", "data_quality_score")


@query("""
select count(*) as data_sources_processed, count(case when ok then 1 end) as successful_sources,
  count(case when not ok then 1 end) as failed_sources, cast(sum(p) as bigint) as processed_items,
  cast(sum(f) as bigint) as failed_items, round(sum(s), 3) + 0.0 as total_time_seconds
from (select bool_and(status = 'completed') as ok, sum(processed_items) as p,
    sum(failed_items) as f, sum(duration_seconds) as s from jobs group by data_source)""")
def run_summary(spark, sf_dir):
    summary = ops.run_summary(jobs(spark, sf_dir))
    return summary.withColumn(
        "total_time_seconds", F.round("total_time_seconds", 3) + F.lit(0.0))


@query("""
select count(*) as jobs, (select count(*) from jobs) as total_jobs, round(avg(coalesce(duration_seconds, 0)), 6) + 0.0 as avg_processing_time,
  round(avg(processed_items), 6) + 0.0 as avg_records_processed,
  round(avg(memory), 6) + 0.0 as avg_memory_usage, round(avg(cpu), 6) + 0.0 as avg_cpu_usage,
  round(avg(coalesce(case when processed_items > 0
    then cast(processed_items as double) / (processed_items + failed_items) end, 0)), 9) + 0.0 as avg_data_quality_score
from (select *, coalesce(case when failed_items % 3 > 0 then failed_items * 16.0e0 end, 0) as memory,
    (failed_items % 7) * 12.5e0 as cpu
  from (select * from jobs order by created_at desc, job_id limit 100))""")
def recent_metrics_avg(spark, sf_dir):
    log = jobs(spark, sf_dir).withColumns({
        "memory_usage_mb": F.expr("case when failed_items % 3 > 0 then failed_items * 16.0D end"),
        "cpu_usage_percent": F.expr("(failed_items % 7) * 12.5D")})
    averages = ops.metric_averages(ops.collect_metrics(log))
    return averages.withColumns({
        c: F.round(c, 6) + F.lit(0.0) for c in ("avg_processing_time", "avg_records_processed", "avg_memory_usage",
                                                "avg_cpu_usage")})


@query("""
select data_source, cast(sum(processed_items) as bigint) as api_calls,
  cast(sum(failed_items) as bigint) as api_errors,
  case when sum(processed_items) > 0 then
    cast(sum(failed_items) as double) / cast(sum(processed_items) as double) else 0 end
    as error_rate,
  cast(sum(failed_items) as double) / sum(processed_items) > 0.05 as alert
from jobs group by data_source""")
def api_error_rate(spark, sf_dir):
    log = jobs(spark, sf_dir, "data_source", "processed_items", "failed_items")
    return ops.api_error_rates(log.select(
        "data_source", F.col("processed_items").alias("api_calls_made"),
        F.col("failed_items").alias("api_errors")))


@query("""
select job_id, created_at from jobs
where created_at >= timestamp '1998-07-01' - interval '7' day""")
def retention(spark, sf_dir):
    return ops.keep_recent(jobs(spark, sf_dir, "job_id", "created_at"), NOW, ops.JOB_DAYS)


@query("""
select job_id, data_source, created_at, coalesce(created_at < date '1998-07-01' - interval '1' day
  * case data_source when '1-URGENT' then 365 when '2-HIGH' then 180 when '3-MEDIUM' then 90 end,
  false) as expired
from jobs""")
def retention_archive(spark, sf_dir):
    log = jobs(spark, sf_dir, "job_id", "data_source", "created_at")
    return lake.mark_expired(log, POLICIES, NOW)


@query("""
select job_id, data_source, created_at, case when created_at >= date '1998-07-01' - interval '1' day
    * case data_source when '1-URGENT' then 365 when '2-HIGH' then 180 when '3-MEDIUM' then 90 else 100000 end
  then 'kept' when data_source = '1-URGENT' then 'cold' else 'colder' end as place
from jobs
where data_source <> '3-MEDIUM' or created_at >= date '1998-07-01' - interval '90' day""")
def retention_archive_rerun(spark, sf_dir):
    """Rows after a run that was repeated: kept, in the archive of their source, or dropped without one."""
    root = shared_dir(spark, "retention")
    policies = [lake.Policy("1-URGENT", 365, True, f"{root}/cold"), lake.Policy("2-HIGH", 180, True, f"{root}/colder"),
                lake.Policy("3-MEDIUM", 90), lake.Policy("4-NOT SPECIFIED", 1, True, f"{root}/never", enabled=False)]
    log = jobs(spark, sf_dir, "job_id", "data_source", "created_at")
    for _ in range(2):
        lake.apply_retention(log, policies, NOW, f"{root}/kept")
    parts = [spark.read.parquet(f"{root}/{place}").select(*log.columns, F.lit(place).alias("place"))
             for place in ("kept", "cold", "colder")]
    return reduce(DataFrame.unionByName, parts)
