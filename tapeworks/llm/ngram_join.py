"""N-gram Jaccard join of documents by MinHash banding, verified on whole n-gram sets."""

from __future__ import annotations

import math
import re

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tapeworks.llm.common import WORD, field, slices, stored

SPLIT = re.compile(WORD)
MIX = np.uint64(0x9E3779B97F4A7C15)


def choose_bands(similarity: float, recall: float, low: float = 0.3, most_low: float = 0.05) -> tuple[int, int]:
    """Bands and rows per band with the fewest hashes, such that a pair at ``similarity`` shares a band
    with probability ``recall`` and a pair at ``low`` with ``most_low`` at most."""
    fits = []
    for rows in range(1, 33):
        bands = max(1, math.ceil(math.log(1 - recall) / math.log(1 - similarity ** rows)))
        if 1 - (1 - low ** rows) ** bands <= most_low:
            fits.append((bands * rows, bands, rows))
    return min(fits)[1:]


class Shingles:
    """64-bit hashes of the distinct word n-grams of a text; each distinct word is hashed once."""

    def __init__(self, n: int, limit: int = 400_000) -> None:
        self.n, self.limit, self.known = n, limit, {}
        self.power = [pow(int(MIX), k, 1 << 64) for k in range(n)]

    def __call__(self, text: str) -> np.ndarray:
        words = SPLIT.findall(text)
        if len(self.known) > self.limit:
            self.known = {}
        known = self.known
        for word in set(words).difference(known):
            known[word] = xxhash.xxh64_intdigest(word.encode())
        w = np.fromiter(map(known.__getitem__, words), np.uint64, len(words))
        n = min(self.n, len(w))  # a shorter text is one n-gram
        if not n:
            return w
        out = np.zeros(len(w) - n + 1, np.uint64)
        for k in range(n):
            out += w[k:len(w) - n + 1 + k] * np.uint64(self.power[k])
        out ^= out >> np.uint64(31)
        out *= MIX
        out ^= out >> np.uint64(29)
        return np.unique(out)


def band_hashes(shingles: np.ndarray, bands: int, rows: int, seed: int = 3) -> np.ndarray:
    """One 64-bit hash per band of a MinHash signature; none for an empty set."""
    if not len(shingles):
        return np.zeros(0, np.int64)
    random = np.random.default_rng(seed)
    a = random.integers(1, 1 << 63, bands * rows, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
    b = random.integers(0, 1 << 63, bands * rows, dtype=np.uint64)
    least = np.full(bands * rows, np.iinfo(np.uint64).max, np.uint64)
    for start in range(0, len(shingles), 2048):
        x = shingles[start:start + 2048, None] * a + b
        # High bits of a product depend on all lower ones.
        np.minimum(least, x.min(axis=0), out=least)
    out = np.zeros(bands, np.uint64)
    for k, column in enumerate(least.reshape(bands, rows).T):
        out = (out ^ column) * MIX + np.uint64(k)
        out ^= out >> np.uint64(32)
    return out.view(np.int64)


def intersections(sets: list[np.ndarray], width: int = 4096) -> np.ndarray:
    """Sizes of all pairwise intersections, from products of blocks of the incidence matrix."""
    n = len(sets)
    owner = np.repeat(np.arange(n), [len(s) for s in sets])
    values, place, counts = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    shared = counts > 1  # what only one document has is in no intersection
    order = np.argsort(place, kind="stable")
    keep = order[shared[place[order]]]
    column = (np.cumsum(shared) - 1)[place[keep]]
    rows = owner[keep]
    out = np.zeros((n, n), np.float32)
    total = int(shared.sum())
    for start in range(0, total, width):
        lo, hi = np.searchsorted(column, [start, start + width])
        block = np.zeros((n, min(width, total - start)), np.float32)
        block[rows[lo:hi], column[lo:hi] - start] = 1
        out += block @ block.T
    return out


def links(sets: list[np.ndarray], chunks: list[int], similarity: float) -> tuple[np.ndarray, np.ndarray]:
    """Number of links of each document, and the root of its linked part, within a pair of chunks.

    In a chunk with itself all pairs count, between two chunks only those from one to the other.
    """
    size = np.array([len(s) for s in sets], np.float64)
    both = intersections(sets).astype(np.float64)
    union = size[:, None] + size[None, :] - both
    linked = (union > 0) & (both >= similarity * union - 1e-9)
    np.fill_diagonal(linked, False)
    side = np.array(chunks)
    if side.min() != side.max():
        linked &= side[:, None] != side[None, :]
    root = np.arange(len(sets))
    while True:  # the smallest number among the linked ones, until nothing changes
        least = np.where(linked, root[None, :], len(sets)).min(axis=1, initial=len(sets))
        new = np.minimum(root, least)
        new = new[new]
        if np.array_equal(new, root):
            return linked.sum(axis=1), root
        root = new


def components(edges: DataFrame, purpose: str) -> DataFrame:
    """Connected components of the pairs (a, b): node, root (its smallest member).

    Each round takes the smallest root among neighbours and then the root of that root, so a long chain
    takes as many rounds as the logarithm of its length. Rounds end in stored tables.
    """
    both = stored(edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
                  .distinct(), purpose)
    roots = both.groupBy(F.col("a").alias("node")).agg(F.least(F.col("node"), F.min("b")).alias("root"))
    roots = stored(roots, purpose)
    while True:
        near = (both.join(roots.select(F.col("node").alias("b"), "root"), "b")
                .groupBy(F.col("a").alias("node")).agg(F.min("root").alias("near")))
        least = (roots.join(near, "node")
                 .select("node", F.col("root").alias("old"), F.least("root", "near").alias("root")))
        # Both a node and its old root move to the root of the smaller root.
        jump = roots.select(F.col("node").alias("root"), F.col("root").alias("next"))
        new = stored(least.join(jump, "root", "left")
                     .select("node", "old", F.least("root", F.coalesce("next", "root")).alias("root")), purpose)
        changed = new.where(F.col("root") != F.col("old")).limit(1).count()
        roots = new.select("node", "root")
        if not changed:
            return roots


def _grouped(batches, names: tuple[str, ...]):
    """Runs of rows with equal values of ``names`` in a sorted stream of Arrow batches."""
    key, rows = None, []
    for batch in slices(batches):
        for row in batch.to_pylist():
            now = tuple(row[n] for n in names)
            if now != key and rows:
                yield key, rows
                rows = []
            key = now
            rows.append(row)
    if rows:
        yield key, rows


def ngram_join(docs: DataFrame, n: int = 5, similarity: float = 0.8, recall: float = 0.999, block: int = 256,
               doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Near duplicates of every document: doc_id, class_id, n_copies, n_links, group_id.

    ``class_id`` is the smallest id of the documents with the same text and ``n_copies`` their number.
    ``n_links`` counts the other texts whose sets of word ``n``-grams have a Jaccard similarity of
    ``similarity`` or more with this one's. ``group_id`` is the smallest id of all texts that links
    connect. Banding finds a pair at the limit with probability ``recall``, more similar ones with more.

    One row per row of ``docs``. NULL texts have no class: they get their own id, one copy, no links;
    texts without words are only copies of equal texts; texts with fewer than ``n`` words are one n-gram;
    NULL ids count as larger than others; other columns are ignored; an empty table gives no rows.

    Texts in a bucket of a band are chained to its smallest; the connected parts of these chains hold
    all candidates. A part is cut into chunks of about ``block`` texts, and every pair of its chunks is
    one unit of work that holds two chunks' sets and returns counts and at most one edge per text. So
    neither a bucket nor a part is gathered in one place and no pair of texts is a row.
    """
    bands, rows = choose_bands(similarity, recall)
    id_type = docs.schema[doc_id].dataType
    given = docs.select(docs[doc_id].alias("doc_id"), F.md5(docs[text]).alias("key"), docs[text].alias("text"))
    schema = T.StructType([field(docs, doc_id, "doc_id"), T.StructField("key", T.StringType()),
                           T.StructField("bands", T.ArrayType(T.LongType()))])

    def sign(batches):
        shingles = Shingles(n)
        for batch in slices(batches):
            found = [band_hashes(shingles(x or ""), bands, rows) for x in batch.column(2).to_pylist()]
            offsets = np.r_[0, np.cumsum([len(f) for f in found])].astype(np.int32)
            values = np.concatenate(found) if found else np.zeros(0, np.int64)
            yield pa.record_batch([batch.column(0), batch.column(1),
                                   pa.ListArray.from_arrays(pa.array(offsets), pa.array(values))], schema.names)

    signed = stored(given.mapInArrow(sign, schema), "ngram-signatures")
    smallest = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id"))
    classes = stored(signed.where(F.col("key").isNotNull()).groupBy("key").agg(
        smallest.alias("first"), F.count("*").alias("n_copies"), F.any_value("bands").alias("bands"))
        .select("key", "first", "n_copies", "bands"), "ngram-classes")
    placed = classes.select("key", F.posexplode("bands").alias("band", "hash"))
    buckets = (placed.groupBy("band", "hash").agg(F.min("key").alias("b"), F.count("*").alias("c"))
               .where(F.col("c") > 1).drop("c"))
    edges = placed.join(buckets, ["band", "hash"]).where(F.col("key") != F.col("b")) \
        .select(F.col("key").alias("a"), "b")
    # A text's bands give up to that many smallest members; chained to the least of them, they leave one
    # edge per text and few among the smallest members.
    stars = edges.groupBy("a").agg(F.min("b").alias("m"), F.collect_set("b").alias("bs"))
    stars = stored(stars, "ngram-stars")
    edges = stars.select("a", F.col("m").alias("b")).union(
        stars.select(F.explode("bs").alias("a"), F.col("m").alias("b")).where(F.col("a") != F.col("b")))
    parts = components(edges.distinct(), "ngram-parts")
    # Stored, so that a join sees a plain table: small ones are broadcast, a hot root can be split.
    sizes = stored(parts.groupBy("root").agg(F.count("*").alias("size")), "ngram-sizes")
    members = stored(
        parts.join(sizes, "root").withColumn("chunks", F.ceil(F.col("size") / block).cast("int"))
        .select(F.col("node").alias("key"), "root", "chunks",
                F.pmod(F.xxhash64("node"), F.col("chunks")).cast("int").alias("chunk")), "ngram-members")

    # Each text once: the row of its smallest id, one of them if that has several. The id is a key of the
    # join, so many copies of a text do not meet.
    chosen = members.join(classes.select("key", F.col("first.doc_id").alias("first_id")), "key")
    texts = (given.join(chosen, (given["key"] == chosen["key"]) & given["doc_id"].eqNullSafe(chosen["first_id"]))
             .select(chosen["key"], "root", "chunks", "chunk", "text"))

    def gather(batches):
        shingles = Shingles(n)
        for batch in slices(batches):
            sets = [shingles(x).tobytes() for x in batch.column(4).to_pylist()]
            yield pa.record_batch([*batch.columns[:4], pa.array(sets, pa.binary())],
                                  [*batch.schema.names[:4], "shingles"])

    sets = texts.mapInArrow(gather, "key string, root string, chunks int, chunk int, shingles binary")
    other = F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)).alias("other")
    pairs = (sets.select("*", other)
             .select("key", "root", "chunk", "shingles", F.least("chunk", "other").alias("p"),
                     F.greatest("chunk", "other").alias("q")))
    unit = ("root", "p", "q")

    def verify(batches):
        for _, held in _grouped(batches, unit):
            found = {r["key"]: r for r in held}  # a row twice is one text
            keys = list(found)
            sets_of = [np.frombuffer(found[k]["shingles"], np.uint64) for k in keys]
            count, root = links(sets_of, [found[k]["chunk"] for k in keys], similarity)
            if count.any():
                some = np.flatnonzero(count)
                yield pa.record_batch([pa.array([keys[i] for i in some]), pa.array(count[some].astype(np.int64)),
                                       pa.array([keys[root[i]] for i in some])], ["key", "links", "near"])

    verified = stored(pairs.repartition(*unit).sortWithinPartitions(*unit)
                      .mapInArrow(verify, "key string, links long, near string"), "ngram-links")
    counts = verified.groupBy("key").agg(F.sum("links").alias("n_links"))
    linked = components(verified.where(F.col("key") != F.col("near"))
                        .select(F.col("key").alias("a"), F.col("near").alias("b")).distinct(), "ngram-groups")
    linked = linked.withColumnsRenamed({"node": "key", "root": "part"})
    firsts = stored(linked.join(classes.select("key", "first"), "key").groupBy("part")
                    .agg(F.min("first").alias("group_first")), "ngram-firsts")
    known = (classes.drop("bands").join(counts, "key", "left")
             .join(linked.join(firsts, "part").drop("part"), "key", "left"))
    known = stored(known.select(
        "key", F.col("first.doc_id").alias("class_id"), "n_copies", F.coalesce("n_links", F.lit(0)).alias("n_links"),
        F.when(F.col("group_first").isNull(), F.col("first.doc_id")).otherwise(F.col("group_first.doc_id"))
        .alias("group_id")), "ngram-result")
    alone = F.col("key").isNull()
    return (signed.select("doc_id", "key").join(known, "key", "left")
            .select("doc_id", F.when(alone, F.col("doc_id")).otherwise(F.col("class_id")).cast(id_type).alias("class_id"),
                    F.coalesce("n_copies", F.lit(1)).alias("n_copies"), F.coalesce("n_links", F.lit(0)).alias("n_links"),
                    F.when(alone, F.col("doc_id")).otherwise(F.col("group_id")).cast(id_type).alias("group_id")))
