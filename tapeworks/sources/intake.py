"""Landed JSON files, each taken once: a file stream whose checkpoint remembers what was read."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tapeworks.sources.sinks import write_stream


def landed_files(spark: SparkSession, folder: str, ddl: str, pattern: str = "*.json", layout: str = "lines",
                 archive: str | None = None, files_per_batch: int | None = None,
                 max_age: str = "3650d") -> DataFrame:
    """Records of the JSON files below ``folder`` as a stream, with the file they came from.

    ``layout`` is "lines" (a record per line) or "document" (one record or array over the whole file). A new
    file counts by its name; names are remembered until their files are ``max_age`` older than the newest one,
    and files as old as that are never taken. With ``archive`` (a folder elsewhere) files that a finished
    batch has read are moved there, so that the listing stays short.
    """
    if layout not in ("lines", "document"):
        raise ValueError(f"unknown layout: {layout}")
    reader = (spark.readStream.schema(ddl).option("pathGlobFilter", pattern)
              .option("multiLine", layout == "document").option("maxFileAge", max_age))
    if archive is not None:
        reader = reader.option("cleanSource", "archive").option("sourceArchiveDir", archive)
    if files_per_batch is not None:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.json(folder).withColumn("source_file", F.col("_metadata.file_path"))


def take_landed(records: DataFrame, target: str, checkpoint: str, trigger: dict | None = None) -> StreamingQuery:
    """Append the records of files that are new since the last run to the Parquet table ``target``.

    The checkpoint and the log of the sink make it exactly-once: a run without new files adds nothing, and one
    that broke off goes on where it stood.
    """
    return write_stream(records, checkpoint, trigger or {"availableNow": True}, path=target)
