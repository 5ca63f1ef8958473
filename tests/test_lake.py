"""Reads, writes, listing, retention and tables."""

from __future__ import annotations

import datetime as dt
import json
import os

import pytest
from pyspark.sql import functions as F

from tapeworks import schemas
from tapeworks.session import shared_dir
from tapeworks.sources import intake, lake, messages, sinks

NOW = dt.datetime(2024, 6, 30, 12)


@pytest.fixture
def history(spark):
    return spark.range(100).select(
        F.concat(F.lit("S"), (F.col("id") % 3).cast("string")).alias("symbol"),
        F.date_add(F.lit("2024-01-01"), (F.col("id") % 10).cast("int")).alias("date"),
        F.col("id").cast("double").alias("close"))


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_partitioned_table_prunes_and_pushes_down(spark, history, tmp_path):
    path = sinks.write_table(history, str(tmp_path / "h"), partition_by=["date"], compression="zstd")
    assert sorted(d for d in os.listdir(path) if d.startswith("date="))[0] == "date=2024-01-01"
    df = lake.read_table(spark, path, "2024-01-02", "2024-01-03", [("close", ">", 50)]).select("close")
    plan = plan_of(df)
    assert "PartitionFilters: [isnotnull(date" in plan and "GreaterThan(close,50.0)" in plan
    assert "ReadSchema: struct<close:double>" in plan
    assert df.count() == 10
    # Another write of one day replaces that day only.
    sinks.write_table(history.where("date = '2024-01-01' and close < 50"), path, partition_by=["date"])
    assert lake.read_table(spark, path).count() == 95


def test_two_partition_columns_and_few_files(spark, history, tmp_path):
    path = sinks.write_table(history.repartition(8), str(tmp_path / "h"), partition_by=["date", "symbol"])
    folders = {os.path.dirname(f.path) for f in lake.files(spark, path).collect()}
    assert len(folders) == 30 and lake.files(spark, path).count() == 30


@pytest.mark.parametrize("fmt", ["json", "csv", "parquet"])
def test_formats(spark, tmp_path, fmt):
    df = spark.createDataFrame([("a,b", 1.5, ["x"])], "name string, price double, tags array<string>")
    path = sinks.write_table(df, str(tmp_path / fmt), fmt)
    ddl = "name string, price double, tags " + ("string" if fmt == "csv" else "array<string>")
    row = lake.read_table(spark, path, fmt=fmt, ddl=ddl).first()
    assert (row.name, row.price) == ("a,b", 1.5)
    assert row.tags == ('["x"]' if fmt == "csv" else ["x"])


def test_unknown_names_are_refused(spark, history, tmp_path):
    with pytest.raises(ValueError):
        sinks.write_table(history, str(tmp_path / "x"), "xml")
    with pytest.raises(ValueError):
        sinks.land(history, str(tmp_path), "raw", "nothing")
    with pytest.raises(ValueError):
        sinks.materialize(history, "x", "heap")
    with pytest.raises(ValueError):
        lake.expired_files(spark, sinks.write_table(history, str(tmp_path / "y")), NOW, 1, by="size")


def test_landing_and_listing(spark, tmp_path):
    root = str(tmp_path / "lake")
    df = spark.createDataFrame([("A", dt.datetime(2024, 1, 2, 5)), ("B", dt.datetime(2024, 1, 3, 5))],
                               "symbol string, quote_timestamp timestamp")
    sinks.land_both(df, df, root, "stock_quotes", "cleaned_quotes", time="quote_timestamp", ingest_ts=NOW)
    sinks.land(df, root, "raw", "stock_quotes", "quote_timestamp", NOW, fmt="json")
    sinks.land(df, root, "analytics", "daily_summary", ingest_ts=NOW)
    assert {r.table_name for r in lake.list_tables(spark, root).collect()} == {"raw", "processed", "analytics"}
    assert {r.table_name for r in lake.list_tables(spark, f"{root}/raw").collect()} == {"stock_quotes"}
    info = lake.table_info(spark, root, "raw/stock_quotes").first()
    assert (info.file_count, info.min_date, info.max_date, info.error) == (4, "2024-01-02", "2024-01-03", None)
    assert info.total_size_bytes > 0 and info.last_modified is not None
    assert lake.table_info(spark, root, "raw/none").first().error == "Table not found"
    by_ingest = spark.read.parquet(f"{root}/analytics/daily_summary")
    assert [str(r.date) for r in by_ingest.select("date").distinct().collect()] == ["2024-06-30"]
    assert sinks.create_layout(spark, root, NOW).count() == 12


def test_newest_json_file(spark, tmp_path):
    ddl = "symbol string, price double"
    assert lake.read_latest_json(spark, str(tmp_path / "none"), ddl).count() == 0
    for age, name in [(200, "quotes_b"), (100, "quotes_a"), (1, "news_a")]:
        path = tmp_path / f"{name}.json"
        path.write_text(json.dumps([{"symbol": name, "price": 1}], indent=2))
        stamp = NOW.timestamp() - age
        os.utime(path, (stamp, stamp))
    assert lake.read_latest_json(spark, str(tmp_path), ddl, "quotes_*.json").first().symbol == "quotes_a"
    assert lake.read_latest_json(spark, str(tmp_path), ddl, "none_*.json").count() == 0
    (tmp_path / "lines.json").write_text("\n".join(json.dumps({"symbol": f"s{i}", "price": i}) for i in range(100)))
    assert lake.read_latest_json(spark, str(tmp_path), ddl, "lines.json", layout="lines").count() == 100
    with pytest.raises(ValueError):
        lake.read_latest_json(spark, str(tmp_path), ddl, layout="rows")


def test_archive_survives_reruns_and_late_rows(spark, history, tmp_path):
    path, archive = str(tmp_path / "table"), str(tmp_path / "archive")
    as_of = dt.datetime(2024, 1, 10)
    rows = spark.range(20).selectExpr("id", "date_add(date'2024-01-01', cast(id % 2 as int)) as date")
    rows.repartition(2).write.partitionBy("date").parquet(path)
    # A run that broke off after the copy and some deletes.
    copied = spark.read.parquet(path).withColumn("source_file", F.col("_metadata.file_path"))
    copied.write.partitionBy("date").parquet(archive)
    next(iter(sorted((tmp_path / "table" / "date=2024-01-01").glob("*.parquet")))).unlink()
    lake.expire(spark, path, as_of, 5, archive)
    assert spark.read.parquet(archive).count() == 20
    rows.where("id < 4").write.mode("append").partitionBy("date").parquet(path)
    lake.expire(spark, path, as_of, 5, archive)
    assert spark.read.parquet(archive).count() == 24


def test_late_files_are_neither_lost_nor_copied_twice(spark, tmp_path):
    path, archive, as_of = str(tmp_path / "t"), str(tmp_path / "a"), dt.datetime(2024, 1, 10)
    rows = spark.range(12).selectExpr("id", "date_add(date'2024-01-01', cast(id % 6 as int)) as date")
    rows.write.partitionBy("date").parquet(path)
    manifest = lake.expiry_manifest(spark, path, as_of, 5)
    assert manifest.agg(F.sum("rows")).first()[0] == 8
    lake.archive_files(spark, path, archive, manifest)
    rows.where("id < 2").selectExpr("id + 100 as id", "date").write.mode("append").partitionBy("date").parquet(path)
    assert lake.delete_files(spark, path, manifest.select("source_file")) == manifest.count()
    assert sorted(r.id for r in spark.read.parquet(path).collect()) == [4, 5, 10, 11, 100, 101]
    assert sorted(f.name for f in (tmp_path / "t").iterdir() if f.is_dir()) == [
        f"date=2024-01-0{d}" for d in (1, 2, 5, 6)]  # folders that are empty now are gone
    policies = [lake.Policy("t", 5, True, archive), lake.Policy("none", enabled=False)]
    assert lake.expire_tables(spark, str(tmp_path), policies, as_of)["t"] >= 1
    assert lake.expire_tables(spark, str(tmp_path), policies, as_of) == {"t": 0}
    assert sorted(r.id for r in spark.read.parquet(archive).collect()) == [0, 1, 2, 3, 6, 7, 8, 9, 100, 101]


def test_archive_is_written_by_tasks_of_few_rows(spark, tmp_path):
    """A large file is copied by several tasks; small ones share a task."""
    path, archive, as_of = str(tmp_path / "t"), str(tmp_path / "a"), dt.datetime(2024, 1, 10)
    rows = spark.range(5000).selectExpr(
        "id", "date_add(date'2024-01-01', case when id < 4000 then 0 else cast(id % 8 as int) end) as date")
    rows.coalesce(1).write.partitionBy("date").parquet(path)
    manifest = lake.expiry_manifest(spark, path, as_of, 5)
    lake.archive_files(spark, path, archive, manifest, rows_per_task=500)
    held = spark.read.parquet(archive)
    tasks = held.groupBy(F.regexp_extract("_metadata.file_name", "part-([0-9]+)", 1).alias("task")).count().collect()
    assert 7 <= len(tasks) <= 10 and max(r["count"] for r in tasks) < 1500
    assert sorted(r.id for r in held.collect()) == sorted(r.id for r in rows.where("date < '2024-01-05'").collect())
    assert held.groupBy("source_file").count().count() == 4


def test_archive_waits_for_the_first_expired_file(spark, tmp_path):
    """A run without an expired file leaves no empty archive that the next run could not read."""
    path, archive = str(tmp_path / "t"), str(tmp_path / "a")
    spark.range(10).selectExpr("id", "date'2024-01-01' as date").write.partitionBy("date").parquet(path)
    assert lake.expire(spark, path, dt.datetime(2024, 1, 3), 5, archive) == 0
    assert lake.expire(spark, path, dt.datetime(2024, 1, 10), 5, archive) > 0
    assert spark.read.parquet(archive).count() == 10


def test_nothing_is_deleted_without_a_whole_archive(spark, tmp_path):
    path, archive, as_of = str(tmp_path / "t"), str(tmp_path / "a"), dt.datetime(2024, 1, 10)
    rows = spark.range(10).selectExpr("id", "date'2024-01-01' as date")
    rows.coalesce(1).write.partitionBy("date").parquet(path)
    short = spark.read.parquet(path).withColumn("source_file", F.col("_metadata.file_path")).limit(4)
    short.write.partitionBy("date").parquet(archive)
    with pytest.raises(RuntimeError, match="nothing was deleted"):
        lake.expire(spark, path, as_of, 5, archive)
    assert spark.read.parquet(path).count() == 10


@pytest.mark.parametrize("layout", ["lines", "document"])
def test_landed_files_are_taken_once(spark, tmp_path, layout):
    folder, target = tmp_path / "landed", str(tmp_path / "table")
    folder.mkdir()

    def land(name, *symbols):
        rows = [{"symbol": s, "price": 1.5} for s in symbols]
        (folder / name).write_text(json.dumps(rows, indent=1) if layout == "document" else "\n".join(map(json.dumps, rows)))

    def run():
        records = intake.landed_files(spark, str(folder), "symbol string, price double", layout=layout,
                                      archive=str(tmp_path / "taken"))
        intake.take_landed(records, target, str(tmp_path / "checkpoint")).awaitTermination()
        return sorted((r.symbol, os.path.basename(r.source_file)) for r in spark.read.parquet(target).collect())

    land("a.json", "A", "B")
    land("other.txt", "X")
    assert run() == [("A", "a.json"), ("B", "a.json")] == run()
    land("b.json", "A")
    old = os.stat(folder / "b.json").st_mtime - 300 * 86400
    os.utime(folder / "b.json", (old, old))  # an old time does not hide a new file
    want = [("A", "a.json"), ("A", "b.json"), ("B", "a.json")]
    assert run() == want == run()
    land("c.json", "C")
    run()
    assert [f.name for f in (tmp_path / "taken").rglob("a.json")] == ["a.json"] and (folder / "other.txt").exists()
    with pytest.raises(ValueError):
        intake.landed_files(spark, str(folder), "a int", layout="rows")


def test_feed_with_tags(spark, tmp_path):
    for symbol, interval in [("A", "1d"), ("A", "1h"), ("B%20C+D", "1d")]:
        folder = tmp_path / f"symbol={symbol}" / f"interval={interval}"
        folder.mkdir(parents=True)
        (folder / "page1.json").write_text('{\n "body": []\n}')
    got = lake.read_feed(spark, str(tmp_path), ["symbol", "interval"]).collect()
    assert sorted((r.symbol, r.interval, json.loads(r.value)["body"]) for r in got) == [
        ("A", "1d", []), ("A", "1h", []), ("B C+D", "1d", [])]
    (tmp_path / "symbol=A" / "interval=1d" / "page1.json").write_text('{"body": 1}\n{"body": 2}\n')
    lines = lake.read_feed(spark, str(tmp_path / "symbol=A" / "interval=1d"), ["symbol"], layout="lines")
    assert sorted(r.value for r in lines.collect()) == ['{"body": 1}', '{"body": 2}']
    with pytest.raises(ValueError):
        lake.read_feed(spark, str(tmp_path), layout="rows")


def test_expire_by_date_with_archive(spark, history, tmp_path):
    path = sinks.write_table(history, str(tmp_path / "h"), partition_by=["date"])
    archive = str(tmp_path / "archive")
    as_of = dt.datetime(2024, 1, 15)
    for expected in (7, 0):  # the second run finds nothing and must not disturb the archive
        assert lake.expire(spark, path, as_of, 7, archive) == expected
        assert (lake.read_table(spark, path).count(), lake.read_table(spark, archive).count()) == (30, 70)


def test_expire_by_file_age(spark, history, tmp_path):
    path = sinks.write_table(history.coalesce(1), str(tmp_path / "h"))
    for f in os.listdir(path):
        if f.endswith(".parquet"):
            os.utime(f"{path}/{f}", (NOW.timestamp() - 40 * 86400,) * 2)
    sinks.write_table(history.coalesce(1), path, mode="append")
    assert lake.expire(spark, path, NOW, 30, by="modified") == 1
    assert lake.read_table(spark, path).count() == 100
    with pytest.raises(ValueError):
        lake.expire(spark, path, NOW, 30, str(tmp_path / "a"), by="modified")


def test_relations(spark, history):
    sinks.materialize(history, "stg_history", "view")
    sinks.materialize(history, "mart_history", "table")
    assert lake.relation(spark, "stg_history").count() == 100
    assert lake.relation(spark, "analytics.mart_history").count() == 100
    version = spark.sql("show tblproperties analytics.mart_history ('schema_version')").first()
    assert version.value == sinks.SCHEMA_VERSION


def test_rows_and_metrics_export(spark, tmp_path):
    df = lake.rows(spark, [{"symbol": "A", "timestamp": "2024-01-01 10:00:00"}], schemas.QUOTE)
    assert df.first().timestamp == dt.datetime(2024, 1, 1, 10) and df.columns == schemas.columns(schemas.QUOTE)
    path = sinks.export_metrics(lake.rows(spark, [{"job_id": "1", "records_processed": 2}], schemas.METRIC),
                                str(tmp_path / "m"))
    assert spark.read.json(path).first().records_processed == 2


def test_message_options(spark, tmp_path):
    options = messages.kafka_options("h:1", "t", maxOffsetsPerTrigger="5")
    assert options == {"kafka.bootstrap.servers": "h:1", "subscribe": "t", "startingOffsets": "latest",
                       "maxOffsetsPerTrigger": "5"}
    assert messages.kafka_sink_options("h:1", "t", kafka__linger__ms="5") == {
        "kafka.bootstrap.servers": "h:1", "topic": "t", "kafka.acks": "all", "kafka.retries": "3",
        "kafka.linger.ms": "5"}
    with pytest.raises(ValueError):
        messages.read_messages(spark, "pigeon")
    (tmp_path / "m.txt").write_text("one\ntwo\n")
    assert messages.read_messages(spark, "files", stream=False, path=str(tmp_path)).count() == 2
    demo = messages.demo_prices(messages.read_messages(spark, "rate", rowsPerSecond="5"), seed=1)
    assert demo.isStreaming and demo.columns[-2:] == ["random_price", "random_volume"]


def test_shared_dir_follows_the_setting(spark):
    base = spark.conf.get("spark.checkpoint.dir")
    first, second = shared_dir(spark, "x"), shared_dir(spark, "x")
    assert first.startswith(base) and first != second
