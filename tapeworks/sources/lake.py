"""Lake tables on a file system: reads, listing, statistics and retention."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence
from concurrent.futures import ThreadPoolExecutor
from itertools import islice
from typing import NamedTuple

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tapeworks import schemas
from tapeworks.operators.clean import conjunction, date_range
from tapeworks.session import stored


def rows(spark: SparkSession, data: list[dict], ddl: str) -> DataFrame:
    """In-line rows; fields absent from a dict are NULL, times may be ISO text."""
    schema = schemas.struct(ddl)
    times = [f.name for f in schema if f.dataType.simpleString() == "timestamp"]
    raw = schemas.struct(", ".join(
        f"`{f.name}` {'string' if f.name in times else f.dataType.simpleString()}" for f in schema))
    values = [[str(r[n]) if n in times and r.get(n) is not None else r.get(n)
               for n in raw.fieldNames()] for r in data]
    df = spark.createDataFrame(values, raw)
    return df.withColumns({t: F.col(t).cast("timestamp") for t in times}) if times else df


def relation(spark: SparkSession, name: str) -> DataFrame:
    """A registered view or table by name."""
    return spark.table(name)


def read_table(spark: SparkSession, path: str, start: str | dt.date | None = None,
               end: str | dt.date | None = None, filters: Sequence[tuple] = (),
               fmt: str = "parquet", ddl: str | None = None) -> DataFrame:
    """A lake table between two dates, both inclusive, with further filters.

    Nothing is read here: dates prune partitions and filters reach the Parquet scan.
    """
    reader = spark.read.format(fmt)
    if ddl:
        reader = reader.schema(ddl)
    if fmt == "csv":
        reader = reader.option("header", "true")
    df = date_range(reader.load(path), start, end)
    return df.where(conjunction(list(filters))) if filters else df


def files(spark: SparkSession, path: str, pattern: str | None = None) -> DataFrame:
    """Path, size and time of all data files below ``path``; contents are not read."""
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", "true")
    if pattern:
        reader = reader.option("pathGlobFilter", pattern)
    return reader.load(path).select("path", "length", "modificationTime")


def exists(spark: SparkSession, path: str) -> bool:
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()).exists(target)


def read_latest_json(spark: SparkSession, folder: str, ddl: str, pattern: str = "*.json",
                     layout: str = "document") -> DataFrame:
    """Records of the JSON file modified last; none when there is no such file.

    ``layout`` is "lines" (a record per line) or "document" (one record or array over the whole file).
    Only one path comes to the driver, and only that file is read.
    """
    if layout not in ("lines", "document"):
        raise ValueError(f"unknown layout: {layout}")
    newest = []
    if exists(spark, folder):
        newest = (files(spark, folder, pattern)
                  .orderBy(F.desc("modificationTime"), F.desc("path")).limit(1).collect())
    if not newest:
        return spark.createDataFrame([], schemas.struct(ddl))
    return spark.read.schema(ddl).option("multiLine", layout == "document").json(newest[0].path)


def read_feed(spark: SparkSession, paths: str | list[str], tags: Sequence[str] = (),
              layout: str = "document") -> DataFrame:
    """Landed responses as ``value`` with tag columns: one JSON document per file, or ("lines") per line.

    A file of lines is split over tasks like any text; a document is read as a whole.

    Pages, batches of symbols, intervals and lists of one feed are folders or files of one
    dataset. Tags are read from ``tag=value`` folders.
    """
    # Listing below a tag folder would hide the tag from partition discovery, so it comes from
    # the path of each file.
    if layout not in ("lines", "document"):
        raise ValueError(f"unknown layout: {layout}")
    raw = (spark.read.text(paths, wholetext=layout == "document", recursiveFileLookup=True)
           .select("value", F.col("_metadata.file_path").alias("_path")))
    def decoded(text: Column) -> Column:
        return F.url_decode(F.replace(text, F.lit("+"), F.lit("%2B")))

    # Two times: folder names escape the tag, and paths escape the folder name.
    return raw.select("value", *[
        decoded(decoded(F.nullif(F.regexp_extract("_path", f"/{t}=([^/]+)/", 1), F.lit("")))).alias(t)
        for t in tags])


def _below(root: str) -> Column:
    """Path of a file relative to ``root``."""
    tail = root.rstrip("/").split("://")[-1].lstrip("/")
    return F.substring_index("path", f"{tail}/", -1)


def list_tables(spark: SparkSession, root: str) -> DataFrame:
    """Names of the folders right below ``root`` that hold files."""
    first = F.substring_index(_below(root), "/", 1)
    return files(spark, root).where(_below(root).contains("/")).select(first.alias("table_name")).distinct()


def table_info(spark: SparkSession, root: str, table: str) -> DataFrame:
    """One row: files, size, first and last date partition, last change, or an error."""
    path = f"{root.rstrip('/')}/{table}"
    schema = ("table_name STRING, file_count BIGINT, total_size_bytes BIGINT, total_size_mb DOUBLE, "
              "min_date STRING, max_date STRING, last_modified TIMESTAMP, error STRING")
    if not exists(spark, path):
        return spark.createDataFrame(
            [(table, 0, 0, 0.0, None, None, None, "Table not found")], schema)
    day = F.nullif(F.regexp_extract("path", "/date=([^/]+)/", 1), F.lit(""))
    count = F.count("*")
    size = F.coalesce(F.sum("length"), F.lit(0))
    return files(spark, path).agg(
        F.lit(table).alias("table_name"),
        count.alias("file_count"),
        size.alias("total_size_bytes"),
        F.bround(size / (1024 * 1024), 2).alias("total_size_mb"),
        F.min(day).alias("min_date"), F.max(day).alias("max_date"),
        F.max("modificationTime").alias("last_modified"),
        F.when(count == 0, "Table not found").alias("error"),
    )


def expired_files(spark: SparkSession, path: str, as_of: dt.datetime, days: int,
                  by: str = "date") -> DataFrame:
    """Files older than ``days``, by their date partition or by their time of change."""
    cutoff = as_of - dt.timedelta(days=days)
    listed = files(spark, path)
    if by == "modified":
        return listed.where(F.col("modificationTime") < F.lit(cutoff))
    if by == "date":
        day = F.regexp_extract("path", "/date=([^/]+)/", 1).try_cast("date")
        return listed.where(day < F.lit(cutoff.date()))
    raise ValueError(f"unknown age: {by}")


def expiry_manifest(spark: SparkSession, path: str, as_of: dt.datetime, days: int = 30) -> DataFrame:
    """Stored list of the files of a Parquet table by date that are older than ``days``: source_file, date, rows.

    Copy, check and delete all go by this list, so a file that lands later is touched by none of them.
    """
    cutoff = (as_of - dt.timedelta(days=days)).date()
    old = (spark.read.parquet(path).where(F.col("date") < F.lit(cutoff))
           .groupBy(F.col("_metadata.file_path").alias("source_file"), "date").agg(F.count("*").alias("rows")))
    return stored(old, "expiry-manifest")


def archive_files(spark: SparkSession, path: str, archive: str, manifest: DataFrame,
                  rows_per_task: int = 1_000_000) -> None:
    """Add the rows of the listed files to ``archive``, by date, each with its ``source_file``.

    Files that the archive knows are not copied again. Raises unless it then holds each file with all its rows.
    A task sorts its rows by date to write them, so they are dealt to ranges of about ``rows_per_task`` rows, however
    large the files are; a range holds files, or a part of one, and so few dates.
    """
    wanted = manifest
    if exists(spark, archive):
        wanted = manifest.join(spark.read.parquet(archive).select("source_file").distinct(), "source_file", "left_anti")
    todo = wanted.agg(F.sum("rows").alias("rows"), F.max("date").alias("last")).first()
    if todo.rows:
        (spark.read.parquet(path).where(F.col("date") <= F.lit(todo["last"]))
         .withColumns({"source_file": F.col("_metadata.file_path"), "_row": F.col("_metadata.row_index")})
         .join(wanted.select("source_file"), "source_file", "left_semi")
         .repartitionByRange(1 + todo.rows // rows_per_task, "source_file", "_row").drop("_row")
         .write.mode("append").partitionBy("date").parquet(archive))
    if manifest.isEmpty():
        return
    spark.catalog.refreshByPath(archive)
    held = spark.read.parquet(archive).groupBy("source_file").agg(F.count("*").alias("held"))
    short = manifest.join(held, "source_file", "left").where("held is null or held <> rows")
    if not short.isEmpty():
        raise RuntimeError(f"{archive} does not hold all expired rows of {path}; nothing was deleted")


def delete_files(spark: SparkSession, path: str, names: DataFrame, threads: int = 16) -> int:
    """Delete the listed files (one column of addresses) and the folders that this leaves empty; returns their number.

    Names pass the driver a partition at a time, and ``threads`` of them are deleted at once.
    """
    hadoop = spark._jvm.org.apache.hadoop.fs
    conf = spark._jsc.hadoopConfiguration()

    def delete(name: str) -> tuple[bool, str]:
        # A listing gives plain paths, the manifest escaped addresses.
        target = hadoop.Path(spark._jvm.java.net.URI(name)) if escaped else hadoop.Path(name)
        return target.getFileSystem(conf).delete(target, False), target.getParent().toString()

    escaped, deleted, folders = names.columns == ["source_file"], 0, set()
    with ThreadPoolExecutor(threads) as pool:
        held = (row[0] for row in names.toLocalIterator())
        while part := list(islice(held, 1000)):
            for done, folder in pool.map(delete, part):
                deleted += done
                folders.add(folder)
    root = hadoop.Path(path)
    for folder in folders:
        target = hadoop.Path(folder)
        system = target.getFileSystem(conf)
        below = folder.rstrip("/") != system.makeQualified(root).toString().rstrip("/")
        if below and system.exists(target) and not system.listStatus(target):
            try:
                system.delete(target, False)
            except Py4JJavaError:
                pass  # a late file has filled the folder meanwhile; it stays
    spark.catalog.refreshByPath(path)
    return deleted


def expire(spark: SparkSession, path: str, as_of: dt.datetime, days: int = 30,
           archive: str | None = None, by: str = "date") -> int:
    """Delete the files of a Parquet table that are older than ``days``; returns their number.

    With ``archive`` the rows are first added there, by date partition. A run that broke off between copy
    and delete can be repeated, and late files of an archived day are added to it by the next run. Nothing is
    deleted unless the archive holds all rows of the files to delete.
    """
    if archive is None:
        return delete_files(spark, path, expired_files(spark, path, as_of, days, by).select("path"))
    if by != "date":
        raise ValueError("an archive needs a table partitioned by date")
    manifest = expiry_manifest(spark, path, as_of, days)
    archive_files(spark, path, archive, manifest)
    return delete_files(spark, path, manifest.select("source_file"))


class Policy(NamedTuple):
    """How long the rows of a data type are kept, and where older ones go."""
    data_type: str
    retention_days: int = 30
    archive_enabled: bool = False
    archive_location: str | None = None
    enabled: bool = True


def expire_tables(spark: SparkSession, root: str, policies: Sequence[Policy], as_of: dt.datetime) -> dict[str, int]:
    """Apply each enabled policy to the table below ``root`` that it names; deleted files by data type."""
    return {p.data_type: expire(spark, f"{root.rstrip('/')}/{p.data_type}", as_of, p.retention_days,
                                p.archive_location if p.archive_enabled else None)
            for p in policies if p.enabled}


def mark_expired(df: DataFrame, policies: dict[str, int] | Sequence[Policy], as_of: dt.datetime,
                 source: str = "data_source", time: str = "created_at") -> DataFrame:
    """Flag rows older than the retention of their source; sources without one are kept."""
    days = policies if isinstance(policies, dict) else {p.data_type: p.retention_days for p in policies if p.enabled}
    if not days:
        return df.withColumn("expired", F.lit(False))
    pairs = [F.lit(part) for pair in days.items() for part in pair]
    cutoff = F.date_sub(F.lit(as_of.date()), F.create_map(*pairs)[F.col(source)])
    return df.withColumn("expired", F.coalesce(F.col(time) < cutoff, F.lit(False)))


def apply_retention(df: DataFrame, policies: dict[str, int] | Sequence[Policy], as_of: dt.datetime, keep: str,
                    archive: str | None = None, source: str = "data_source",
                    time: str = "created_at") -> None:
    """Write the rows to keep to ``keep`` and, before that, the expired ones to their archive.

    That is ``archive`` for all, or the place that the policy of their source names; rows of a source whose
    policy has no archive are dropped. Each run has its own partition of an archive, named by ``as_of``; a
    repeated run replaces only that. No path may be one that ``df`` is read from.
    """
    places = {} if isinstance(policies, dict) else {
        p.data_type: p.archive_location or archive for p in policies if p.enabled and p.archive_enabled}
    targets = [archive] if isinstance(policies, dict) else sorted(set(places.values()))
    read = [file.split("://")[-1].lstrip("/") for file in df.inputFiles()]
    for path in filter(None, (keep, *targets)):
        own = path.split("://")[-1].strip("/") + "/"
        if any(file.startswith(own) or f"/{own}" in file for file in read):
            raise ValueError(f"{path} is an input of the rows")
    marked = mark_expired(df, policies, as_of, source, time)
    for place in filter(None, targets):
        here = marked.where("expired")
        if places:
            here = here.where(F.col(source).isin([s for s, p in places.items() if p == place]))
        here.drop("expired").write.mode("overwrite").parquet(f"{place.rstrip('/')}/run={as_of:%Y%m%dT%H%M%S}")
    marked.where("not expired").drop("expired").write.mode("overwrite").parquet(keep)
