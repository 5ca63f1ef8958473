"""Web pages in WARC archives of Zstandard frames: one frame per record, a dictionary in the first frame.

An archive is ``.warc.zst``: a skippable frame with the dictionary, if there is one, then one frame per
record. Equal payloads are stored once; the other records are revisits of that one.
"""

from __future__ import annotations

import datetime as dt
import hashlib
import re
import struct
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.fs
import zstandard
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tapeworks.llm.common import slices, stored

# Names, formats and numbers of the archive format.
VERSIONS = (b"WARC/1.0", b"WARC/1.1")
REQUIRED = ("WARC-Type", "WARC-Record-ID", "WARC-Date", "Content-Length")
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
DICTIONARY_MAGIC = 0x184D2A5D
SKIPPABLE_MAGICS = range(0x184D2A50, 0x184D2A60)
FRAME_MAGIC = struct.pack("<I", 0xFD2FB528)
END = b"\r\n\r\n"

READ_BYTES = 1 << 20
DICTIONARY_BYTES = 1 << 15
SAMPLES, SAMPLE_BYTES = 256, 1 << 16  # what a dictionary is trained on: pages of an archive, each up to this size


class BadRecord(ValueError):
    """A frame that holds no valid record, or, with an offset, cannot be decoded."""

    def __init__(self, message: str, offset: int | None = None):
        super().__init__(message)
        self.offset = offset


# --- one archive ---------------------------------------------------------------------------------

def train_dictionary(samples: list[bytes]) -> zstandard.ZstdCompressionDict | None:
    """Dictionary of the samples; None where they are too few or too small for one."""
    samples = [s for s in samples if 0 < len(s) <= SAMPLE_BYTES]
    if len(samples) < 8 or sum(map(len, samples)) < 8 * DICTIONARY_BYTES:
        return None
    return zstandard.train_dictionary(DICTIONARY_BYTES, samples, k=256, d=8, dict_id=1)


def dictionary_frame(dictionary: zstandard.ZstdCompressionDict) -> bytes:
    data = dictionary.as_bytes()
    return struct.pack("<II", DICTIONARY_MAGIC, len(data)) + data


def record(headers: dict[str, str], block: bytes) -> bytes:
    fields = headers | {"WARC-Block-Digest": f"sha256:{hashlib.sha256(block).hexdigest()}",
                        "Content-Length": str(len(block))}
    head = "".join(f"{name}: {value}\r\n" for name, value in fields.items())
    return VERSIONS[-1] + b"\r\n" + head.encode() + b"\r\n" + block + END


def frames(source, dictionary: zstandard.ZstdCompressionDict | None = None) -> Iterator[tuple[int, bytes]]:
    """Offset and content of each data frame of a file; a leading dictionary frame is loaded."""
    held, offset = b"", 0

    def fill(size: int) -> bool:
        nonlocal held
        while len(held) < size:
            more = source.read(max(READ_BYTES, size - len(held)))
            if not more:
                return False
            held += more
        return True

    decoder = zstandard.ZstdDecompressor(dict_data=dictionary)
    while fill(1):
        if not fill(4):
            raise BadRecord("cut off within a frame's first bytes", offset)
        magic = struct.unpack("<I", held[:4])[0]
        if magic in SKIPPABLE_MAGICS:
            size = 8 + struct.unpack("<I", held[4:8])[0] if fill(8) else 8
            if not fill(size):
                raise BadRecord("cut off within a skippable frame", offset)
            if magic == DICTIONARY_MAGIC and offset == 0:
                data = held[8:size]
                if data.startswith(FRAME_MAGIC):  # the dictionary may be compressed itself
                    data = zstandard.ZstdDecompressor().decompressobj().decompress(data)
                decoder = zstandard.ZstdDecompressor(dict_data=zstandard.ZstdCompressionDict(data))
            held, offset = held[size:], offset + size
            continue
        frame, parts, fed = decoder.decompressobj(), [], 0
        try:
            while not frame.eof:
                if not fill(1):
                    raise BadRecord("cut off within a frame", offset)
                parts.append(frame.decompress(held))
                fed, held = fed + len(held), b""
        except zstandard.ZstdError as error:
            raise BadRecord(str(error), offset) from error
        held = frame.unused_data
        yield offset, b"".join(parts)
        offset += fed - len(held)


def _headers(lines: list[bytes]) -> dict[str, str]:
    found: dict[str, str] = {}
    for line in lines:
        name, colon, value = line.partition(b":")
        key = name.decode("utf-8", "replace").lower()
        if not colon or not name or name != name.strip() or key in found:
            raise BadRecord(f"bad header line {line[:80]!r}")
        found[key] = value.strip().decode("utf-8", "replace")
    return found


def _length(headers: dict[str, str]) -> int:
    text = headers.get("content-length", "")
    if not re.fullmatch("[0-9]+", text):
        raise BadRecord(f"bad Content-Length {text!r}")
    return int(text)


def _check_digest(name: str, given: str | None, data: bytes) -> None:
    if given is not None and given != f"sha256:{hashlib.sha256(data).hexdigest()}":
        raise BadRecord(f"{name} does not fit")


def parse_record(raw: bytes) -> dict:
    """Headers (lower case), type and payload of the record that a frame holds, once all of it fits."""
    head, end, rest = raw.partition(END)
    version, *lines = head.split(b"\r\n")
    if version not in VERSIONS or not end:
        raise BadRecord(f"no record: {raw[:40]!r}")
    headers = _headers(lines)
    missing = [name for name in REQUIRED if not headers.get(name.lower())]
    if missing:
        raise BadRecord(f"no {', '.join(missing)}")
    size = _length(headers)
    if len(rest) != size + len(END) or not rest.endswith(END):
        raise BadRecord(f"Content-Length {size}, but {len(rest) - len(END)} bytes in the frame")
    block = rest[:size]
    _check_digest("WARC-Block-Digest", headers.get("warc-block-digest"), block)
    kind, out = headers["warc-type"], {"headers": headers, "payload": None, "payload_bytes": None}
    if kind in ("response", "revisit"):
        start, blank, payload = block.partition(END)
        status, *lines = start.split(b"\r\n")
        if not status.startswith(b"HTTP/") or not blank:
            raise BadRecord("no HTTP header")
        out["payload_bytes"] = _length(_headers(lines))
        if kind == "response":
            if len(payload) != out["payload_bytes"]:
                raise BadRecord(f"HTTP Content-Length {out['payload_bytes']}, but {len(payload)} bytes")
            _check_digest("WARC-Payload-Digest", headers.get("warc-payload-digest"), payload)
            out["payload"] = payload
        elif payload or not headers.get("warc-refers-to") or not headers.get("warc-payload-digest"):
            raise BadRecord("a revisit names its record and digest and has no payload")
    return out


# --- tables --------------------------------------------------------------------------------------

def _record_id(page_id: int | None, row: int) -> str:
    return f"<urn:page:{'' if page_id is None else page_id}:{row}>"


def page_of(record_id: Column) -> Column:
    """Id of the page that a record id names."""
    return F.nullif(F.split_part(record_id, F.lit(":"), F.lit(3)), F.lit("")).cast("long")


def with_originals(pages: DataFrame, least: int) -> DataFrame:
    """Add the record that a page with an equal payload of ``least`` bytes or more came in first.

    Only digests that repeat are joined, and the payloads of others get keys of their own, so neither one
    popular page nor many small ones come to one task.
    """
    place = F.struct(F.col("page_id").isNull().alias("none"), "page_id", "row")
    firsts = (pages.where(F.octet_length("html") >= least).groupBy("digest")
              .agg(F.min(place).alias("first"), F.count("*").alias("c")).where("c > 1")
              .select(F.col("digest").alias("key"), "first.page_id", "first.row"))
    firsts = stored(firsts.toDF("key", "first_id", "first_row"), "warc-firsts")
    own = F.concat(F.lit("-"), F.col("row").cast("string"))
    keyed = pages.withColumn("key", F.when(F.octet_length("html") >= least, F.col("digest")).otherwise(own))
    return keyed.join(firsts, "key", "left").drop("key")


def write_warc(pages: DataFrame, folder: str, least: int = 100, archive_bytes: int = 256 << 20,
               date: dt.datetime | None = None, page_id: str = "page_id", url: str = "url",
               html: str = "html") -> None:
    """Write a record per page to archives below ``folder``, which all executors must reach.

    Of records with equal payloads of ``least`` bytes or more that with the smallest ``page_id`` is a
    response, the others are its revisits; smaller payloads are all responses. An archive takes about
    ``archive_bytes`` of payloads. The table ``archives`` lists name, bytes and records.

    A NULL page is an empty payload; NULL ids come last; of rows with equal payload and id one is the
    response; a NULL address becomes the page's own name; blanks and control signs of an address are
    escaped; very long pages are one record each; an empty table writes no archive; other columns are
    ignored. A task writes under names of its own and renames when done.
    """
    stamp = (date or dt.datetime.now(dt.timezone.utc)).strftime("%Y-%m-%dT%H:%M:%SZ")
    body = F.coalesce(pages[html], F.lit(""))
    # Stored, so that a row keeps its number whatever is computed anew.
    rows = stored(pages.select(pages[page_id].cast("long").alias("page_id"), pages[url].alias("url"), body.alias("html"),
                               F.sha2(body, 256).alias("digest"), F.monotonically_increasing_id().alias("row")),
                  "warc-pages")

    def blocks(row: dict) -> bytes:
        payload, first = row["html"].encode(), row["first_row"]
        later = first is not None and first != row["row"]
        name = _record_id(row["page_id"], row["row"])
        address = re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", row["url"] or name[1:-1])
        headers = {"WARC-Type": "revisit" if later else "response", "WARC-Record-ID": name, "WARC-Date": stamp,
                   "WARC-Target-URI": address, "WARC-Payload-Digest": f"sha256:{row['digest']}",
                   "Content-Type": "application/http; msgtype=response"}
        if later:
            headers |= {"WARC-Profile": PROFILE, "WARC-Refers-To": _record_id(row["first_id"], first)}
        http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n"
        return record(headers, http.encode() + (b"" if later else payload))

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, base = pa.fs.FileSystem.from_uri(folder)
        task, number, out = TaskContext.get(), 0, None

        def done() -> pa.RecordBatch:
            nonlocal out, number
            size = out.tell()
            out.close()
            out, number = None, number + 1
            fs.move(f"{base}/{name}.{task.taskAttemptId()}", f"{base}/{name}")
            return pa.RecordBatch.from_pydict({"name": [name], "bytes": [size], "records": [records]})

        for batch in slices(batches):
            rows = batch.to_pylist()
            for row in rows:
                if out is None:
                    name, records, held = f"pages-{task.partitionId():06d}-{number:04d}.warc.zst", 0, 0
                    fs.create_dir(base)
                    out = fs.open_output_stream(f"{base}/{name}.{task.taskAttemptId()}", compression=None)
                    dictionary = train_dictionary([r["html"].encode() for r in rows[:SAMPLES]])
                    coder = zstandard.ZstdCompressor(level=3, dict_data=dictionary, write_checksum=True)
                    if dictionary is not None:
                        dictionary.precompute_compress(level=3)
                        out.write(dictionary_frame(dictionary))
                    info = {"WARC-Type": "warcinfo", "WARC-Record-ID": f"<urn:archive:{name}>", "WARC-Date": stamp,
                            "WARC-Filename": name, "Content-Type": "application/warc-fields"}
                    out.write(coder.compress(record(info, b"format: WARC File Format 1.1\r\n")))
                raw = blocks(row)
                out.write(coder.compress(raw))
                records, held = records + 1, held + len(raw)
                if held >= archive_bytes:
                    yield done()
        if out is not None:
            yield done()

    (with_originals(rows, least).mapInArrow(write, "name string, bytes long, records long")
     .write.parquet(f"{folder}/archives"))


RECORD = T.StructType([
    T.StructField("archive", T.StringType()), T.StructField("offset", T.LongType()),
    T.StructField("record_type", T.StringType()), T.StructField("record_id", T.StringType()),
    T.StructField("refers_to", T.StringType()), T.StructField("target_uri", T.StringType()),
    T.StructField("date", T.StringType()), T.StructField("payload_bytes", T.LongType()),
    T.StructField("payload_digest", T.StringType()), T.StructField("payload", T.BinaryType()),
    T.StructField("problem", T.StringType())])


def read_warc(spark: SparkSession, folder: str, payloads: bool = True) -> DataFrame:
    """Records of the archives below ``folder``, a task per archive, a frame at a time.

    Version, required fields, lengths and digests are checked. A record that does not fit has ``problem``
    and no other fields but archive and offset; where a frame cannot be decoded, the rest of that archive
    is lost and its row says so. Without ``payloads`` the column ``payload`` is NULL, the checks are made
    all the same. Descriptions of archives (``warcinfo``) are rows too; no archive gives no row.
    """
    archives = spark.read.parquet(f"{folder}/archives").select("name")

    def rows(fs: pa.fs.FileSystem, base: str, name: str) -> Iterator[tuple]:
        with fs.open_input_stream(f"{base}/{name}", compression=None) as source:
            try:
                for at, raw in frames(source):
                    try:
                        got = parse_record(raw)
                    except BadRecord as error:
                        yield (name, at, *[None] * 8, str(error))
                        continue
                    h = got["headers"]
                    digest = h.get("warc-payload-digest")
                    yield (name, at, h["warc-type"], h["warc-record-id"].strip("<>"),
                           h["warc-refers-to"].strip("<>") if "warc-refers-to" in h else None,
                           h.get("warc-target-uri"), h["warc-date"], got["payload_bytes"],
                           digest and digest.removeprefix("sha256:"), got["payload"] if payloads else None, None)
            except BadRecord as error:
                yield (name, error.offset, *[None] * 8, str(error))

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, base = pa.fs.FileSystem.from_uri(folder)
        kinds = {T.LongType(): pa.int64(), T.BinaryType(): pa.binary()}
        schema = pa.schema([(f.name, kinds.get(f.dataType, pa.string())) for f in RECORD])
        for name in (n for b in batches for n in b.column(0).to_pylist()):
            held, size = [], 0
            for row in rows(fs, base, name):
                held.append(row)
                size += 200 + len(row[9] or b"")
                if size > READ_BYTES:
                    yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*held), schema)], schema=schema)
                    held, size = [], 0
            if held:
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*held), schema)], schema=schema)

    return archives.repartitionByRange(max(1, archives.count()), "name").mapInArrow(read, RECORD)
