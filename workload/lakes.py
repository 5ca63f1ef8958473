"""Lake tables: written from the test tables and read back."""

from __future__ import annotations

import datetime as dt
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tapeworks.plans import batch as batch_plan
from tapeworks.session import shared_dir
from tapeworks.sources import intake, lake, sinks
from workload.registry import query
from workload.summaries import PERFORMERS, batch, rounded
from workload.views import view


def daily_history(spark, sf_dir):
    """History with the date of its bars, by month to keep the folders few."""
    df = view(spark, sf_dir, "history").withColumnRenamed("date", "bar_time")
    return df.withColumn("date", F.trunc("bar_time", "month"))


@query("""
select symbol, date as bar_time, close, volume, bar_interval, row_id,
  cast(date_trunc('month', date) as date) as date from history
where date >= date '1996-03-01' and date < date '1997-03-01' and close > 500
  and bar_interval in ('1d', '1h')""")
def lake_partition_roundtrip(spark, sf_dir):
    path = sinks.write_table(daily_history(spark, sf_dir), f"{shared_dir(spark, 'lake')}/history",
                             partition_by=["date"])
    return lake.read_table(spark, path, "1996-03-01", "1997-02-28",
                           [("close", ">", 500), ("bar_interval", "in", ["1d", "1h"])])


@query("""
select brand, cast(count(*) as bigint) as n, fmt from (
  select brand, 'json' as fmt from products union all select brand, 'csv' from products
  union all select brand, 'parquet' from products) group by brand, fmt""")
def format_roundtrip(spark, sf_dir):
    df = view(spark, sf_dir, "products")
    ddl = "id string, title string, brand string, price string, category string, stock_quantity int"
    root = shared_dir(spark, "formats")
    parts = [
        lake.read_table(spark, sinks.write_table(df, f"{root}/{fmt}", fmt), fmt=fmt, ddl=ddl)
        .select("brand", F.lit(fmt).alias("fmt")) for fmt in ("json", "csv", "parquet")]
    return (parts[0].unionByName(parts[1]).unionByName(parts[2])
            .groupBy("brand", "fmt").agg(F.count("*").alias("n")))


@query("""
select symbol, date, close, bar_interval from history
where date >= date '1998-07-01'""")
def lake_expire(spark, sf_dir):
    root = shared_dir(spark, "expire")
    path = sinks.write_table(daily_history(spark, sf_dir), f"{root}/history", partition_by=["date"])
    deleted = lake.expire(spark, path, dt.datetime(1998, 7, 31), 30, archive=f"{root}/archive")
    assert deleted > 0
    return lake.read_table(spark, path).select(
        "symbol", F.col("bar_time").alias("date"), "close", "bar_interval")


@query("""
select symbol, date as bar_time, close, row_id, case when date < date '1998-07-01' then 'archive' else 'table' end as place
from history""")
def expire_archive_rerun(spark, sf_dir):
    """Every row is in the archive or in the table, once: a file lands between copy and delete, and a run repeats."""
    root = shared_dir(spark, "rerun")
    path, archive, as_of = f"{root}/history", f"{root}/archive", dt.datetime(1998, 7, 31)
    history = daily_history(spark, sf_dir).select("symbol", "bar_time", "close", "row_id", "date")
    late = F.col("row_id") % 50 == 7
    sinks.write_table(history.where(~late), path, partition_by=["date"])
    manifest = lake.expiry_manifest(spark, path, as_of)
    lake.archive_files(spark, path, archive, manifest)
    sinks.write_table(history.where(late), path, mode="append", partition_by=["date"])
    lake.delete_files(spark, path, manifest.select("source_file"))
    policy = [lake.Policy("history", 30, True, archive), lake.Policy("nothing", enabled=False)]
    for _ in range(2):
        lake.expire_tables(spark, root, policy, as_of)
    parts = [spark.read.parquet(p).select("symbol", "bar_time", "close", "row_id", F.lit(n).alias("place"))
             for n, p in (("archive", archive), ("table", path))]
    return parts[0].unionByName(parts[1])


@query("""
select drop, screener_type, count(*) as rows, cast(sum(rank) as bigint) as rank_sum, round(sum(price), 5) + 0.0 as price_sum
from (select *, cast(substr(job_id, 5) as bigint) % 3 + 1 as drop from screeners) group by drop, screener_type""")
def landed_intake(spark, sf_dir):
    """Files of three drops, taken over four runs, one of them without a new file."""
    root = shared_dir(spark, "intake")
    df = view(spark, sf_dir, "screeners", ["symbol", "price", "rank", "screener_type", "job_id"])
    numbered = df.withColumn("drop", F.expr("cast(cast(substr(job_id, 5) as bigint) % 3 + 1 as int)")).drop("job_id")
    ddl = "symbol STRING, price DOUBLE, rank INT, screener_type STRING, drop INT"
    for number in (1, 2, None, 3):
        if number is not None:
            numbered.where(F.col("drop") == number).repartition(2).write.mode("append").json(f"{root}/landed")
        records = intake.landed_files(spark, f"{root}/landed", ddl, archive=f"{root}/taken", files_per_batch=1)
        intake.take_landed(records, f"{root}/table", f"{root}/checkpoint").awaitTermination()
    taken = spark.read.parquet(f"{root}/table").groupBy("drop", "screener_type").agg(
        F.count("*").alias("rows"), F.sum("rank").alias("rank_sum"), F.sum("price").alias("price_sum"))
    return rounded(taken.withColumn("drop", F.col("drop").cast("long")), price_sum=5)


def landed(spark, sf_dir):
    root = shared_dir(spark, "layers")
    stamp = dt.datetime(2024, 1, 2, 3, 4, 5)
    screeners = view(spark, sf_dir, "screeners").withColumnRenamed("screener_type", "kind")
    monthly = screeners.withColumn("date", F.trunc("message_timestamp", "year"))
    sinks.land_both(monthly, monthly, root, "market_screeners", "market_summary", ingest_ts=stamp)
    return root


@query("select unnest(['raw', 'processed']) as table_name")
def lake_tables(spark, sf_dir):
    return lake.list_tables(spark, landed(spark, sf_dir))


@query("""
select 'raw/market_screeners' as table_name, strftime(min(date_trunc('year', message_timestamp)), '%Y-%m-%d') as min_date,
  strftime(max(date_trunc('year', message_timestamp)), '%Y-%m-%d') as max_date, true as has_files, cast(null as varchar) as error
from screeners""")
def lake_table_info(spark, sf_dir):
    """Numbers and sizes of files, which no SQL knows, only as far as there are some."""
    info = lake.table_info(spark, landed(spark, sf_dir), "raw/market_screeners")
    some = (F.col("file_count") > 0) & (F.col("total_size_bytes") > 0) & F.col("last_modified").isNotNull()
    return info.select("table_name", "min_date", "max_date", some.alias("has_files"), "error")


@query("""
select layer, cast(rank as integer) as rank, count(*) as rows, round(sum(price), 5) + 0.0 as price_sum,
  timestamp '2024-01-02 03:04:05' as ingest_ts
from screeners, (select unnest(['raw', 'processed']) as layer) group by layer, rank""")
def landed_layers(spark, sf_dir):
    """An extraction landed as JSON and as typed rows, both read back."""
    root = landed(spark, sf_dir)
    ddl = "rank INT, price DOUBLE, ingest_ts TIMESTAMP, date DATE"
    parts = [lake.read_table(spark, f"{root}/raw/market_screeners", fmt="json", ddl=ddl).withColumn("layer", F.lit("raw")),
             lake.read_table(spark, f"{root}/processed/market_summary").withColumn("layer", F.lit("processed"))]
    columns = ["layer", "rank", "price", F.col("ingest_ts").cast("timestamp_ntz").alias("ingest_ts")]
    both = parts[0].select(*columns).unionByName(parts[1].select(*columns))
    return rounded(both.groupBy("layer", "rank", "ingest_ts").agg(
        F.count("*").alias("rows"), F.sum("price").alias("price_sum")), price_sum=5)


@query("select rank, count(*) as rows from screeners where rank > 12 group by rank")
def latest_json(spark, sf_dir):
    """The newest of two files."""
    df = view(spark, sf_dir, "screeners", ["symbol", "price", "rank"])
    path = f"{shared_dir(spark, 'latest')}/screeners"
    for part in (F.col("rank") <= 12, F.col("rank") > 12):
        sinks.write_table(df.where(part).coalesce(1), path, "json", "append")
    ddl = "symbol STRING, price DOUBLE, rank INT"
    newest = lake.read_latest_json(spark, path, ddl, layout="lines")
    return newest.groupBy("rank").agg(F.count("*").alias("rows"))


@query("select symbol, count(*) as responses, bar_interval as interval from history "
       "where symbol in (select symbol from history group by 1) group by symbol, bar_interval")
def feed_pages(spark, sf_dir):
    df = view(spark, sf_dir, "history").select(
        "symbol", F.col("bar_interval").alias("interval"),
        F.to_json(F.struct("symbol", F.array(F.struct("close")).alias("body"))).alias("value"))
    path = f"{shared_dir(spark, 'feed')}/history"
    df.select("interval", "value").write.partitionBy("interval").text(path)
    pages = lake.read_feed(spark, path, ["interval"], layout="lines")
    return (pages.select("interval", F.get_json_object("value", "$.symbol").alias("symbol"))
            .groupBy("symbol", "interval").agg(F.count("*").alias("responses")))


@query(f"select * from ({PERFORMERS}) order by avg_change_percent desc nulls last, symbol limit 10")
def batch_reports(spark, sf_dir):
    stored = batch_plan.run(batch(spark, sf_dir).drop("dollar_volume", "price_trend", "hour", "date"),
                            shared_dir(spark, "reports"), "quote_timestamp")
    return rounded(stored["top_performers"], avg_price=7)


@query(f"""
select 'top_performers' as report, count(*) as rows, cast(sum(total_volume) as bigint) as volume
from (select * from ({PERFORMERS}) order by avg_change_percent desc nulls last, symbol limit 10)
union all
select 'daily_aggregations', count(*), cast(sum(v) as bigint)
from (select sum(volume) as v from quotes group by symbol, cast(quote_timestamp as date))
union all
select 'market_summary', count(*), cast(sum(v) as bigint)
from (select sum(volume) as v from quotes group by cast(quote_timestamp as date))""")
def batch_reports_json(spark, sf_dir):
    """The JSON copies of all three reports."""
    root = shared_dir(spark, "reports")
    batch_plan.run(batch(spark, sf_dir).drop("dollar_volume", "price_trend", "hour", "date"), root, "quote_timestamp")
    parts = [lake.read_table(spark, f"{root}/{name}.json", fmt="json", ddl="total_volume LONG").select(
        F.lit(name).alias("report"), "total_volume") for name in ("top_performers", "daily_aggregations", "market_summary")]
    return (reduce(DataFrame.unionByName, parts).groupBy("report")
            .agg(F.count("*").alias("rows"), F.sum("total_volume").alias("volume")))
