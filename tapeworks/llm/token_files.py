"""Token ids in flat binary files with 64-bit document offsets, written and read in parallel."""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
import pyarrow.fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tapeworks.llm.bpe_ids import encoder
from tapeworks.llm.common import slices


def _file(folder: str, kind: str, shard: int) -> str:
    return f"{folder}/{kind}-{shard:06d}.bin"


def write_token_files(docs: DataFrame, folder: str, tokenizer: str, end_id: int = 0,
                      doc_id: str = "doc_id", text: str = "text", dtype: str = "<u2") -> None:
    """Encode every text, append ``end_id`` and write the ids in ascending order of ``doc_id``.

    Shard s of the order holds ``tokens-s.bin`` (ids one after the other, in ``dtype``),
    ``offsets-s.bin`` (n + 1 signed 64-bit positions in it) and ``ids-s.bin`` (n document ids as signed
    64-bit integers, then n bytes that are 1 where the id is NULL). The Parquet table ``bases`` tells
    how many ids stand in the shards before. ``dtype`` must hold the largest id; ``folder`` must be
    reachable by all executors.

    NULL ids come first, equal ids in the order of their texts' hashes; NULL and empty texts are
    ``end_id`` alone; an empty table writes no shard; other columns are ignored. A task writes under
    names of its own and renames when done, so a repeated task leaves the same files.
    """
    whole = F.coalesce(docs[text], F.lit(""))
    rows = docs.select(docs[doc_id].cast("long").alias("doc_id"), whole.alias("text"))
    order = ["doc_id", F.xxhash64("text")]

    def write(batches):
        encode, task = encoder(tokenizer), TaskContext.get()
        shard, own = task.partitionId(), f".{task.taskAttemptId()}"
        limit = np.iinfo(dtype).max
        sizes, keys, stream = [np.zeros(1, np.int64)], [], None
        fs, base = pa.fs.FileSystem.from_uri(folder)
        for batch in slices(batches):
            if stream is None:
                fs.create_dir(base)
                stream = fs.open_output_stream(_file(base, "tokens", shard) + own)
            ids = [np.frombuffer(raw, "<u4") for raw in encode(batch.column(1).to_pylist())]
            sizes.append(np.array([len(x) + 1 for x in ids], np.int64))
            keys += batch.column(0).to_pylist()
            flat = np.concatenate([part for x in ids for part in (x, [end_id])])
            if flat.max() > limit:
                raise ValueError(f"id {flat.max()} does not fit {dtype}")
            stream.write(flat.astype(dtype).tobytes())
        if stream is None:
            return
        stream.close()
        offsets = np.cumsum(np.concatenate(sizes))
        held = {"offsets": offsets.astype("<i8").tobytes(),
                "ids": np.array([k or 0 for k in keys], "<i8").tobytes()
                + np.array([k is None for k in keys], np.uint8).tobytes()}
        for kind, data in held.items():
            with fs.open_output_stream(_file(base, kind, shard) + own) as out:
                out.write(data)
        for kind in ("tokens", *held):
            fs.move(_file(base, kind, shard) + own, _file(base, kind, shard))
        yield pa.record_batch([pa.array([shard], pa.int32()), pa.array([len(keys)], pa.int64()),
                               pa.array([int(offsets[-1])], pa.int64())], ["shard", "docs", "tokens"])

    (rows.repartitionByRange(*order).sortWithinPartitions(*order)
     .mapInArrow(write, "shard int, docs long, tokens long")
     .write.parquet(f"{folder}/shards"))
    # One row per shard.
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    shards = docs.sparkSession.read.parquet(f"{folder}/shards")
    shards.withColumn("base", F.coalesce(F.sum("tokens").over(before), F.lit(0))) \
        .withColumn("dtype", F.lit(dtype)).write.parquet(f"{folder}/bases")


def read_token_files(spark: SparkSession, folder: str, batch_docs: int = 4096) -> DataFrame:
    """Per document of the files: doc_id, start (ids before it), n_tokens, ids_crc32.

    One task per shard; local files are memory-mapped, others are read in ranges.
    """
    bases = spark.read.parquet(f"{folder}/bases")
    schema = T.StructType([T.StructField(n, T.LongType())
                           for n in ("doc_id", "start", "n_tokens", "ids_crc32")])

    def read(batches):
        fs, base_path = pa.fs.FileSystem.from_uri(folder)
        for row in (r for b in batches for r in b.to_pylist()):
            shard, base, n = row["shard"], row["base"], row["docs"]
            with fs.open_input_file(_file(base_path, "offsets", shard)) as file:
                offsets = np.frombuffer(file.read(), "<i8")
            with fs.open_input_file(_file(base_path, "ids", shard)) as file:
                raw = file.read()
            keys, missing = np.frombuffer(raw, "<i8", n), np.frombuffer(raw, np.uint8, n, 8 * n) > 0
            name, kind = _file(base_path, "tokens", shard), np.dtype(row["dtype"])
            local = isinstance(fs, pa.fs.LocalFileSystem)
            flat = np.memmap(name, kind, "r") if local else None
            for at in range(0, n, batch_docs):
                to = min(at + batch_docs, n)
                first, last = int(offsets[at]), int(offsets[to])
                if local:
                    part = flat[first:last]
                else:
                    with fs.open_input_file(name) as file:
                        part = np.frombuffer(file.read_at((last - first) * kind.itemsize,
                                                          first * kind.itemsize), kind)
                ends = (offsets[at:to + 1] - first).tolist()
                crc = [zlib.crc32(part[a:b].astype("<u4")) for a, b in zip(ends, ends[1:])]
                yield pa.record_batch(
                    [pa.array(keys[at:to], mask=missing[at:to]), pa.array(base + offsets[at:to]),
                     pa.array(np.diff(offsets[at:to + 1])), pa.array(crc, pa.int64())], schema.names)

    return bases.repartition(max(1, bases.count()), "shard").mapInArrow(read, schema)
