"""Merkle manifest of a table: an append log of tree nodes in postorder, proofs read from it by position.

The leaves of a tree are numbered in order and dealt to builders in aligned blocks of 2^bits. A builder
appends a node as soon as it is complete, so its part of the log is in postorder, and the roots of the
blocks are the leaves of the next level's builders. Where a node stands follows from the sizes of the
subtrees before it (``position``); siblings are read there, no search and no stored pointers.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tapeworks.llm.common import slices
from tapeworks.session import shared_dir

SIZE = 32  # bytes of a digest


# --- one log -------------------------------------------------------------------------------------

def position(n: int, height: int, index: int) -> int:
    """Place of a node in the postorder log of a tree with ``n`` leaves.

    m leaves complete 2m - popcount(m) nodes: each set bit of m is a full subtree of 2^(k+1) - 1. A full
    node comes ``height`` places after its last leaf. The last node of a height that ``n`` does not
    fill is closed at the end, one height after the other from the first that is not full.
    """
    last = (index + 1) << height
    if last <= n:
        return 2 * (last - 1) - (last - 1).bit_count() + height
    full = (n & -n).bit_length() - 1
    return 2 * n - n.bit_count() + height - full - 1


def parent(*children: bytes) -> bytes:
    return hashlib.sha256("".join(c.hex() for c in children).encode()).digest()


def append_log(leaves: Sequence[bytes], top: int) -> list[bytes]:
    """Nodes of the tree of ``leaves`` up to the height ``top``, in the order in which they are complete.

    Every two neighbours become their parent; a last node without one becomes a parent alone.
    """
    log: list[bytes] = []
    pending: list[bytes] = [b""] * (top + 1)  # the last node of each height
    for i, node in enumerate(leaves):
        log.append(node)
        height = 0
        while i >> height & 1 and height < top:
            node = parent(pending[height], node)
            log.append(node)
            height += 1
        pending[height] = node
    n = len(leaves)
    for height in range(top):
        if n & (1 << height + 1) - 1:
            last = -(-n >> height) - 1
            pair = [log[position(n, height, k)] for k in range(last & ~1, last + 1)]
            log.append(parent(*pair))
    return log


def siblings(log: Sequence[bytes], n: int, top: int, leaf: int) -> list[tuple[str, bytes]]:
    """Side and digest of the sibling at each height below ``top``; side ``-`` where there is none."""
    found = []
    for height in range(top):
        other = leaf >> height ^ 1
        if other << height >= n:
            found.append(("-", b""))
        else:
            found.append(("l" if other < leaf >> height else "r", log[position(n, height, other)]))
    return found


def fold(leaf: bytes, path: Sequence[tuple[str, bytes]]) -> bytes:
    """Root that a leaf and its siblings lead to."""
    for side, other in path:
        leaf = parent(leaf) if side == "-" else parent(other, leaf) if side == "l" else parent(leaf, other)
    return leaf


# --- builders ------------------------------------------------------------------------------------

@dataclass
class Forest:
    """Logs of the trees, one table per level of builders, lowest first.

    A row is the part that one builder wrote: tree, block, n (leaves of the whole tree), log (digests one
    after the other) and, in the lowest level, items (what its leaves stand for).
    """
    levels: list[DataFrame]
    bits: int

    def roots(self) -> DataFrame:
        """tree, n, root."""
        return self.levels[-1].select("tree", "n", F.substring("log", -SIZE, SIZE).alias("root"))


def _stored(df: DataFrame, path: str) -> DataFrame:
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _split(raw: bytes) -> list[bytes]:
    return [raw[k:k + SIZE] for k in range(0, len(raw), SIZE)]


def _nodes(n: int, level: int, bits: int) -> tuple[int, int]:
    """Nodes at the foot of a level of a tree with ``n`` leaves, and the height of its builders."""
    foot = -(-n >> level * bits)
    return foot, bits if foot > 1 << bits else (foot - 1).bit_length()


def numbered(leaves: DataFrame, order: Sequence[str], path: str) -> DataFrame:
    """Add ``i``, the place of a row among those of its ``tree`` in ``order``, and ``n``, their number.

    Sorted ranges are counted and get their first numbers from prefix sums, one row per range and tree.
    """
    keys = ["tree", *order, "salt"]
    # Equal leaves may stand in any order; the salt lets a large group of them fill several ranges.
    salted = _stored(leaves.withColumn("salt", F.monotonically_increasing_id()), f"{path}/leaves")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, seen = TaskContext.get().partitionId(), (None, 0)
        for batch in batches:
            tree, at = seen
            places = []
            for name in batch.column("tree").to_pylist():
                tree, at = (tree, at + 1) if name == tree else (name, 0)
                places.append(at)
            seen = tree, at
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array([part] * len(places), pa.int32()), pa.array(places, pa.int64())],
                [*batch.schema.names, "part", "at"])

    schema = T.StructType([*salted.schema, T.StructField("part", T.IntegerType()), T.StructField("at", T.LongType())])
    ranges = _stored(salted.repartitionByRange(*keys).sortWithinPartitions(*keys).mapInArrow(count, schema),
                     f"{path}/ranges")
    whole = Window.partitionBy("tree")
    before = whole.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    firsts = (ranges.groupBy("tree", "part").agg(F.count("*").alias("c"))
              .select("tree", "part", F.coalesce(F.sum("c").over(before), F.lit(0)).alias("first"),
                      F.sum("c").over(whole).alias("n")))
    return (ranges.join(firsts, ["tree", "part"])
            .withColumn("i", F.col("first") + F.col("at")).drop("part", "at", "first", "salt"))


def build(leaves: DataFrame, path: str, bits: int = 10) -> Forest:
    """Logs of all trees of ``leaves``: tree, i, n, node, item. A builder holds at most 2^bits leaves."""
    tree, item = leaves.schema["tree"].dataType.simpleString(), leaves.schema["item"].dataType.simpleString()

    def builder(level: int) -> Callable[[pa.Table], pa.Table]:
        def write(group: pa.Table) -> pa.Table:
            group = group.sort_by("i")
            n = group.column("n")[0].as_py()
            log = append_log(group.column("node").to_pylist(), _nodes(n, level, bits)[1])
            columns = [group.column(c).slice(0, 1) for c in ("tree", "block", "n")]
            columns.append(pa.array([b"".join(log)]))
            if level == 0:
                items = group.column("item").combine_chunks()
                columns.append(pa.ListArray.from_arrays([0, len(items)], items))
            return pa.Table.from_arrays(columns, ["tree", "block", "n", "log", "items"][:len(columns)])
        return write

    ddl = f"tree {tree}, block long, n long, log binary"
    levels: list[DataFrame] = []
    largest = leaves.agg(F.max("n")).first()[0] or 0
    nodes = leaves
    while True:
        level = len(levels)
        parts = (nodes.withColumn("block", F.shiftright("i", bits)).groupBy("tree", "block")
                 .applyInArrow(builder(level), ddl if level else f"{ddl}, items array<{item}>"))
        levels.append(_stored(parts, f"{path}/level-{level}"))
        if largest <= 1 << bits * (level + 1):
            return Forest(levels, bits)
        nodes = levels[-1].select("tree", F.col("block").alias("i"), "n",
                                  F.substring("log", -SIZE, SIZE).alias("node"))


def logged_nodes(forest: Forest) -> DataFrame:
    """The whole log of each tree, node by node: tree, position, height, node."""
    bits = forest.bits

    def unfold(level: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for row in (r for b in batches for r in b.to_pylist()):
                n, block, log = row["n"], row["block"], _split(row["log"])
                foot, top = _nodes(n, level, bits)
                own = min(foot - (block << bits), 1 << bits)
                out = []
                for height in range(1 if level else 0, top + 1):
                    for index in range(-(-own >> height)):
                        place = position(n, height + level * bits, (block << bits - height) + index)
                        out.append((row["tree"], place, height + level * bits, log[position(own, height, index)]))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c) for c in zip(*out)] if out else [[], [], [], []],
                    schema=pa.schema([("tree", pa.string()), ("position", pa.int64()), ("height", pa.int32()),
                                      ("node", pa.binary())]))
        return run

    ddl = "tree string, position long, height int, node binary"
    parts = [df.select("tree", "block", "n", "log").mapInArrow(unfold(k), ddl) for k, df in enumerate(forest.levels)]
    whole = parts[0]
    for part in parts[1:]:
        whole = whole.unionAll(part)
    return whole


# --- proofs --------------------------------------------------------------------------------------

def _path(raw: bytes, sides: str) -> list[tuple[str, bytes]]:
    digests = iter(_split(raw))
    return [(s, b"" if s == "-" else next(digests)) for s in sides]


def _packed(path: Sequence[tuple[str, bytes]]) -> tuple[str, bytes]:
    return "".join(s for s, _ in path), b"".join(d for _, d in path)


def descend(forest: Forest, above: DataFrame) -> DataFrame:
    """Lowest parts of the logs with the way from their roots up.

    ``above`` has per tree: tree, sides, digests (the way from its root on) and other columns, which come along.
    """
    bits = forest.bits
    above = above.withColumn("block", F.lit(0).cast("long"))
    more = [f for f in above.schema if f.name not in ("tree", "sides", "digests", "block")]

    def expand(level: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in slices(batches, 1):
                row = batch.to_pylist()[0]
                foot, top = _nodes(row["n"], level, bits)
                own, log = min(foot - (row["block"] << bits), 1 << bits), _split(row["log"])
                ways = [_packed(siblings(log, own, top, k)) for k in range(own)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([row["tree"]] * own, pa.string()),
                     pa.array([s + row["sides"] for s, _ in ways]), pa.array([d + row["digests"] for _, d in ways]),
                     pa.array([(row["block"] << bits) + k for k in range(own)], pa.int64()),
                     *[pa.array([row[f.name]] * own, batch.schema.field(f.name).type) for f in more]],
                    ["tree", "sides", "digests", "block", *[f.name for f in more]])
        return run

    for level in range(len(forest.levels) - 1, 0, -1):
        above = (forest.levels[level].join(above, ["tree", "block"])
                 .mapInArrow(expand(level), above.select("tree", "sides", "digests", "block",
                                                         *[f.name for f in more]).schema))
    return forest.levels[0].join(above, ["tree", "block"])


def _field(value: Column) -> Column:
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text), F.lit(":"), text), F.lit("-"))


def row_digest(columns: Sequence[Column]) -> Column:
    """Digest of a row: per column ``-`` if NULL, else its length in bytes, ``:`` and its text."""
    return F.unhex(F.sha2(F.concat(*[_field(c) for c in columns]), 256))


COLUMNS = ("doc_id", "source", "lang", "n_chars", "text")


def merkle_manifest(docs: DataFrame, claims: dict[str, Column] | None = None, columns: Sequence[str] = COLUMNS,
                    doc_id: str = "doc_id", group: str = "lang", folder: str | None = None,
                    bits: int = 10) -> DataFrame:
    """Manifest of ``docs`` with a proof for each row, checked against the row as it is claimed to be.

    A tree per ``group`` (NULL is a group of its own, before all others), whose leaves are the digests
    of ``columns`` in the order of ``doc_id``; over the roots of the groups stands one more tree.
    ``claims`` replaces columns by what someone claims of the row. The logs stay below ``folder``.

    Returns per row doc_id, leaf, subroot, root, sides (``l``, ``r`` or ``-`` per height), siblings
    (from the leaf to the root), folded_root (of the claimed leaf) and verified, digests in hex. NULL ids
    come first and equal ids in the order of their digests; equal rows are leaves of their own and
    interchangeable; NULL and empty texts and very long ones have digests like others; an empty table
    gives no row; other columns are ignored.
    """
    folder = folder or shared_dir(docs.sparkSession, "merkle")
    claimed = [(claims or {}).get(c, docs[c]) for c in columns]
    leaves = docs.select(
        F.coalesce(F.concat(F.lit("="), docs[group]), F.lit("")).alias("tree"), docs[doc_id].cast("long").alias("doc_id"),
        row_digest([docs[c] for c in columns]).alias("node"), row_digest(claimed).alias("claim"))
    leaves = numbered(leaves, ["doc_id", "node"], f"{folder}/documents")
    trees = build(leaves.select("tree", "i", "n", "node", F.struct("doc_id", "claim").alias("item")),
                  f"{folder}/documents", bits)
    subroots = trees.roots()
    crown = numbered(subroots.select(F.lit("").alias("tree"), F.col("root").alias("node"), F.col("tree").alias("item")),
                     ["item"], f"{folder}/groups")
    crown = build(crown, f"{folder}/groups", bits)
    start = crown.roots().select("tree", F.lit("").alias("sides"), F.lit(b"").alias("digests"), "root")
    ways = descend(crown, start)
    ways = ways.mapInArrow(_unfold_groups(bits), "tree string, sides string, digests binary, root binary")
    above = ways.join(subroots.select("tree", F.col("root").alias("subroot")), "tree")
    hexed = ("leaf", "subroot", "root", "folded_root")
    ddl = ("doc_id long, leaf string, subroot string, root string, sides string, siblings array<string>, "
           "folded_root string, verified boolean")
    return descend(trees, _stored(above, f"{folder}/ways")).mapInArrow(_prove(bits, hexed), ddl)


def _unfold_groups(bits: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 1):
            row = batch.to_pylist()[0]
            _, top = _nodes(row["n"], 0, bits)
            own, log = len(row["items"]), _split(row["log"])
            ways = [_packed(siblings(log, own, top, k)) for k in range(own)]
            yield pa.RecordBatch.from_arrays(
                [pa.array(row["items"], pa.string()), pa.array([s + row["sides"] for s, _ in ways]),
                 pa.array([d + row["digests"] for _, d in ways]), pa.array([row["root"]] * own)],
                ["tree", "sides", "digests", "root"])
    return run


def _prove(bits: int, hexed: Sequence[str]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Rows of the lowest parts: siblings by position, then the claimed leaf folded up to the root."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 1):
            row = batch.to_pylist()[0]
            _, top = _nodes(row["n"], 0, bits)
            own, log = len(row["items"]), _split(row["log"])
            above = _path(row["digests"], row["sides"])
            out = []
            for k, item in enumerate(row["items"]):
                way = siblings(log, own, top, k) + above
                folded = fold(item["claim"], way)
                out.append((item["doc_id"], log[position(own, 0, k)].hex(), "".join(s for s, _ in way),
                            [d.hex() for s, d in way if s != "-"], folded.hex(), folded == row["root"]))
            ids, leaf, sides, others, folded, verified = zip(*out)
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids, pa.int64()), pa.array(leaf), pa.array([row["subroot"].hex()] * own),
                 pa.array([row["root"].hex()] * own), pa.array(sides), pa.array(others, pa.list_(pa.string())),
                 pa.array(folded), pa.array(verified)],
                ["doc_id", "leaf", "subroot", "root", "sides", "siblings", "folded_root", "verified"])
    return run
