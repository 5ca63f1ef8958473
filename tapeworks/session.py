"""Session settings and the shared folder for checkpoints and intermediate tables."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

# For state of many keys: RocksDB keeps it on disk and in bounded memory for all stores of an executor; a commit
# adds its changes to the checkpoint, not whole files again.
_STORE = "spark.sql.streaming.stateStore"
STATE = {
    f"{_STORE}.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    f"{_STORE}.compression.codec": "zstd",
    f"{_STORE}.rocksdb.compression": "zstd",
    f"{_STORE}.rocksdb.blockSizeKB": "64",
    # Otherwise each store sets 4 MB of disk aside, however little it holds.
    f"{_STORE}.rocksdb.allowFAllocate": "false",
    f"{_STORE}.rocksdb.changelogCheckpointing.enabled": "true",
    f"{_STORE}.rocksdb.boundedMemoryUsage": "true",
    f"{_STORE}.rocksdb.maxMemoryUsageMB": "256",
    f"{_STORE}.rocksdb.trackTotalNumberOfRows": "false",
}
# Shuffle files go when the write or micro-batch that made them ends, not when the driver collects its garbage.
FREE_SHUFFLES = {"spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true"}

# ANSI mode stays on: the library uses try_cast / try_divide where bad input is expected.
DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Streaming state of many symbols does not fit on the heap of an executor.
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
}


def build_session(app: str = "tapeworks", master: str | None = None, **conf: str) -> SparkSession:
    """Session with the library's defaults; dots in ``conf`` names may be written as ``__``."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = DEFAULTS | {name.replace("__", "."): value for name, value in conf.items()}
    for name, value in settings.items():
        builder = builder.config(name, value)
    return builder.getOrCreate()


@contextmanager
def unless_set(spark: SparkSession, conf: dict[str, str]) -> Iterator[None]:
    """``conf`` holds inside, but for settings that the session has already. Streams keep what held at their start."""
    new = {name: value for name, value in conf.items() if spark.conf.get(name, None) is None}
    try:
        for name, value in new.items():
            spark.conf.set(name, value)
        yield
    finally:
        for name in new:
            spark.conf.unset(name)


def shared_dir(spark: SparkSession, purpose: str) -> str:
    """New folder below ``spark.checkpoint.dir``, which every executor can reach.

    Only a local session without that setting gets a temporary folder.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if base:
        return f"{base.rstrip('/')}/{purpose}-{uuid.uuid4().hex}"
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    return tempfile.mkdtemp(prefix=f"{purpose}-")


def stored(df: DataFrame, purpose: str) -> DataFrame:
    """Write ``df`` below the shared folder and read it back: its lineage ends there and its size is known."""
    path = shared_dir(df.sparkSession, purpose)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
