"""Writing: files in several formats, lake layers, tables, streams and messages."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery

from tapeworks import schemas

SCHEMA_VERSION = "1.0"


def write_table(df: DataFrame, path: str, fmt: str = "parquet", mode: str = "overwrite",
                partition_by: Sequence[str] = (), compression: str | None = None, per_file: int = 0) -> str:
    """Write as json, csv or parquet, optionally in partitions and in files of at most ``per_file`` rows.

    Partitioned writes are rebalanced on their columns: a small partition gets one file, and a
    day or symbol with very many rows is split over several tasks and files.
    """
    if fmt not in ("json", "csv", "parquet"):
        raise ValueError(f"unknown format: {fmt}")
    if fmt == "csv":
        nested = [f.name for f in df.schema
                  if f.dataType.simpleString().startswith(("array", "map", "struct"))]
        df = df.withColumns({c: F.to_json(c) for c in nested}) if nested else df
    if partition_by:
        df = df.hint("rebalance", *[F.col(c) for c in partition_by])
    writer = df.write.mode(mode).format(fmt)
    if fmt == "csv":
        writer = writer.option("header", "true")
    if compression or fmt == "parquet":
        writer = writer.option("compression", compression or "snappy")
    if per_file:
        writer = writer.option("maxRecordsPerFile", per_file)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
        if mode == "overwrite":
            writer = writer.option("partitionOverwriteMode", "dynamic")
    writer.save(path)
    return path


def with_date(df: DataFrame, time: str) -> DataFrame:
    """Add the ``date`` to partition by, from an event time."""
    return df.withColumn("date", F.to_date(time))


def land(df: DataFrame, root: str, layer: str, table: str, time: str | None = None,
         ingest_ts: dt.datetime | None = None, fmt: str = "parquet") -> str:
    """Append rows to ``layer/table`` in date partitions, stamped with the time of ingestion.

    The date is that of the event ``time``, else the date of ingestion.
    """
    if table not in schemas.LAYERS.get(layer, []):
        raise ValueError(f"unknown lake table: {layer}/{table}")
    stamp = F.current_timestamp() if ingest_ts is None else F.lit(ingest_ts)
    stamped = df.withColumn("ingest_ts", stamp)
    if "date" not in df.columns:
        stamped = with_date(stamped, time or "ingest_ts")
    return write_table(stamped, f"{root.rstrip('/')}/{layer}/{table}", fmt, "append", ["date"])


def land_both(raw: DataFrame, processed: DataFrame, root: str, table: str, processed_table: str,
              **options) -> tuple[str, str]:
    """Land an extraction twice: as it came and as it was parsed."""
    return (land(raw, root, "raw", table, fmt="json", **options),
            land(processed, root, "processed", processed_table, **options))


def materialize(df: DataFrame, name: str, kind: str, database: str = "analytics",
                bucket_by: str | None = None, buckets: int = 256) -> None:
    """Staging relations become views, marts become tables, optionally in buckets of a join key.

    Tables with equal buckets of their join key meet without a shuffle. A hot key fills one bucket; leave it
    to the adaptive skew join instead.
    """
    if kind == "view":
        df.createOrReplaceTempView(name)
    elif kind == "table":
        spark = df.sparkSession
        spark.sql(f"create database if not exists {database}")
        writer = df.write.mode("overwrite").format("parquet")
        if bucket_by:
            # Rows come by bucket, so that a task writes its buckets and not a file of each.
            by_bucket = df.repartition(buckets, bucket_by)
            writer = by_bucket.write.mode("overwrite").format("parquet").bucketBy(buckets, bucket_by).sortBy(bucket_by)
        writer.saveAsTable(f"{database}.{name}")
        spark.sql(f"alter table {database}.{name} "
                  f"set tblproperties ('schema_version' = '{SCHEMA_VERSION}')")
    else:
        raise ValueError(f"unknown kind of relation: {kind}")


def save_failures(tests: dict[str, DataFrame], root: str) -> DataFrame:
    """Store the failing rows of each test and return the number per test."""
    spark = next(iter(tests.values())).sparkSession
    counts = None
    for name, failing in tests.items():
        path = f"{root.rstrip('/')}/{name}"
        failing.write.mode("overwrite").parquet(path)
        stored = spark.read.schema(failing.schema).parquet(path)
        row = stored.agg(F.count("*").alias("failing_rows")).select(
            F.lit(name).alias("test"), "failing_rows")
        counts = row if counts is None else counts.unionByName(row)
    return counts


def export_metrics(metrics: DataFrame, path: str) -> str:
    """Metrics log as JSON."""
    return write_table(metrics, path, "json")


def write_stream(df: DataFrame, checkpoint: str, trigger: dict, path: str | None = None,
                 sink: str = "parquet", name: str | None = None, partition_by: Sequence[str] = (),
                 **options: str) -> StreamingQuery:
    """Start an append query with its own checkpoint, optionally in partitions.

    ``trigger`` is ``{"processingTime": "30 seconds"}`` or ``{"availableNow": True}``.
    """
    writer: DataStreamWriter = (
        df.writeStream.outputMode("append").format(sink).options(**options)
        .option("checkpointLocation", checkpoint).trigger(**trigger))
    if path is not None:
        writer = writer.option("path", path)
    if name is not None:
        writer = writer.queryName(name)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    return writer.start()


def create_layout(spark: SparkSession, root: str, as_of: dt.datetime) -> DataFrame:
    """Describe the lake tables in ``_tables`` below the root and return that description."""
    rows = [(layer, table, as_of, SCHEMA_VERSION)
            for layer, tables in schemas.LAYERS.items() for table in tables]
    layout = spark.createDataFrame(
        rows, "layer STRING, table_name STRING, created_at TIMESTAMP, schema_version STRING")
    layout.coalesce(1).write.mode("overwrite").json(f"{root.rstrip('/')}/_tables")
    return layout
