"""Approximate nearest neighbours by inner product: NN-descent graph and greedy graph search."""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tapeworks.llm.common import stored

LISTS = "u long, v array<long>, s array<double>"


def _groups(batches, key: list[str]):
    """Tables of the rows that follow each other with equal ``key`` columns in a sorted stream."""
    held: list[pa.RecordBatch] = []
    last = None
    for batch in batches:
        if not batch.num_rows:
            continue
        keys = np.stack([batch.column(batch.schema.get_field_index(k)).to_numpy(zero_copy_only=False)
                         for k in key], axis=1)
        cuts = [0, *(np.flatnonzero(np.any(keys[1:] != keys[:-1], axis=1)) + 1).tolist(), batch.num_rows]
        for a, b in zip(cuts, cuts[1:]):
            now = tuple(keys[a])
            if held and now != last:
                yield pa.Table.from_batches(held)
                held = []
            held.append(batch.slice(a, b - a))
            last = now
    if held:
        yield pa.Table.from_batches(held)


def _pack(vectors: np.ndarray, kind: str) -> list[bytes]:
    """Vectors as bytes in the precision of the input, so that no near copies become equal."""
    return [x.tobytes() for x in vectors.astype(kind)]


def _unpack(column: pa.ChunkedArray, kind: str) -> np.ndarray:
    """Packed vectors for products in double precision."""
    return np.frombuffer(b"".join(column.to_pylist()), kind).reshape(len(column), -1).astype(np.float64)


def _numbers(table: pa.Table, name: str) -> np.ndarray:
    return table.column(name).to_numpy()


def _lists(rows: list[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]) -> pa.RecordBatch:
    """One batch of lists from (nodes, length of each one's list, members of all lists, their scores)."""
    u, sizes, v, s = (np.concatenate(part) for part in zip(*rows))
    offsets = pa.array(np.r_[0, np.cumsum(sizes)].astype(np.int32))
    return pa.record_batch([pa.array(u.astype(np.int64)),
                            pa.ListArray.from_arrays(offsets, pa.array(v.astype(np.int64))),
                            pa.ListArray.from_arrays(offsets, pa.array(s.astype(np.float64)))], ["u", "v", "s"])


def _in_batches(rows, size: int = 2000):
    held, count = [], 0
    for row in rows:
        held.append(row)
        count += len(row[0])
        if count >= size:
            yield _lists(held)
            held, count = [], 0
    if held:
        yield _lists(held)


def _best_pairs(ids: np.ndarray, vectors: np.ndarray, k: int, least: np.ndarray | None = None,
                new: np.ndarray | None = None):
    """For each member of a small group the ``k`` nearest other members above its own limit.

    With ``new``, only pairs that hold a new member are compared.
    """
    near = vectors @ vectors.T
    np.fill_diagonal(near, -np.inf)
    if least is not None:
        near[near <= least[:, None]] = -np.inf
    if new is not None:
        near[np.ix_(~new, ~new)] = -np.inf
    k = min(k, len(ids) - 1)
    if k < 1:
        return
    top = np.argpartition(-near, k - 1, axis=1)[:, :k]
    score = np.take_along_axis(near, top, axis=1)
    ok = score > -np.inf
    sizes = ok.sum(axis=1)
    some = sizes > 0
    if some.any():
        yield ids[some], sizes[some], ids[top[ok]], score[ok]


def _merge(lists: DataFrame, k: int) -> DataFrame:
    """The ``k`` nearest of all lists of a node."""
    def merge(batches):
        def rows():
            for table in _groups(batches, ["u"]):
                v = table.column("v").combine_chunks().flatten().to_numpy()
                s = table.column("s").combine_chunks().flatten().to_numpy()
                v, first = np.unique(v, return_index=True)
                s = s[first]
                order = np.lexsort((v, -s))[:k]
                yield _numbers(table, "u")[:1], [len(order)], v[order], s[order]
        return _in_batches(rows())

    return lists.repartition("u").sortWithinPartitions("u").mapInArrow(merge, LISTS)


def distinct_vectors(vectors: DataFrame, vec_id: str, vector: str, copies: int) -> tuple[DataFrame, DataFrame]:
    """Nodes (nid, vector), one per distinct vector, and the ``copies`` smallest ids of each (nid, vec_id).

    Vectors that are NULL, empty, zero, or hold a NULL, NaN or infinite component are left out. More ids
    than the results of a search plus one can never be among them, for ties go to the smaller id.
    """
    v = F.col("vector")
    finite = ~F.exists(v, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    valid = (vectors.select(vectors[vec_id].alias("vec_id"), vectors[vector].cast("array<double>").alias("vector"))
             .where(F.col("vec_id").isNotNull() & (F.size(v) > 0) & finite & F.exists(v, lambda x: x != 0))
             .withColumn("nid", F.xxhash64(F.transform(v, lambda x: x + F.lit(0.0)))))
    ids = valid.select("nid", "vec_id").distinct()
    rank = F.row_number().over(Window.partitionBy("nid").orderBy("vec_id"))
    members = ids.withColumn("r", rank).where(F.col("r") <= copies).drop("r")
    nodes = valid.groupBy("nid").agg(F.any_value("vector").alias("vector"))
    return nodes, members


def neighbour_graph(packed: DataFrame, k: int, settled: float, members: int, emit: int, tables: int, leaf: int,
                    seed: int, kind: str) -> tuple[DataFrame, DataFrame]:
    """NN-descent over (nid, packed): neighbour lists (u, v, s), and links (center, member) both ways.

    The first lists come from random hyperplanes: in each of ``tables``, nodes on the same sides of all
    planes are compared. Each round joins every node's neighbours and reverse neighbours with their
    vectors, compares those pairs of which one is new at that node, and keeps the ``k`` nearest of each.
    It ends when a share of at most ``settled`` of the links is new.
    """
    count = packed.count()
    depth = max(0, math.ceil(math.log2(max(1, count) / leaf)))

    def sides(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            x = _unpack(pa.chunked_array([batch.column(1)]), kind)
            for table in range(tables):
                planes = np.random.default_rng([seed, table]).standard_normal((x.shape[1], max(1, depth)))
                bits = (x @ planes > 0) @ (1 << np.arange(max(1, depth)))
                code = bits if depth else np.zeros(len(x), np.int64)
                yield pa.record_batch([pa.array(np.full(len(x), table)), pa.array(code.astype(np.int64)),
                                       batch.column(0)], ["table", "code", "nid"])

    placed = stored(packed.mapInArrow(sides, "table long, code long, nid long"), "sides")
    # A side of the planes may hold more than planned; it is dealt over parts. Stored sizes let Spark split its join.
    sizes = stored(placed.groupBy("table", "code").agg(F.ceil(F.count("*") / (2 * leaf)).alias("parts")), "side-sizes")
    placed = (placed.join(sizes, ["table", "code"])
              .withColumn("part", F.pmod(F.xxhash64("nid", "table"), F.col("parts"))).join(packed, "nid"))
    key = ["table", "code", "part"]

    def compare(batches):
        def rows():
            for table in _groups(batches, key):
                yield from _best_pairs(_numbers(table, "nid"), _unpack(table.column("packed"), kind), k)
        return _in_batches(rows())

    lists = placed.repartition(*key).sortWithinPartitions(*key).mapInArrow(compare, LISTS)
    graph = stored(_merge(lists, k), "neighbours")
    links = stored(_links(graph, members), "neighbour-links")

    def join(batches):
        def rows():
            for table in _groups(batches, ["center"]):
                yield from _best_pairs(_numbers(table, "member"), _unpack(table.column("packed"), kind), emit,
                                       _numbers(table, "least"),
                                       table.column("new").to_numpy(zero_copy_only=False).astype(bool))
        return _in_batches(rows())

    while (links.agg(F.avg(F.col("new").cast("int"))).first()[0] or 0.0) > settled:
        limits = graph.select(F.col("u").alias("member"), F.when(F.size("s") >= k, F.element_at("s", -1))
                              .otherwise(F.lit(float("-inf"))).alias("least"))
        held = (links.where("active").join(packed.withColumnRenamed("nid", "member"), "member")
                .join(limits, "member"))
        found = held.select("center", "member", "packed", "least", "new").repartition("center") \
            .sortWithinPartitions("center").mapInArrow(join, LISTS)
        graph = stored(_merge(graph.unionByName(found), k), "neighbours")
        links = stored(_links(graph, members, links), "neighbour-links")
    return graph, links.select("center", "member")


def _links(graph: DataFrame, members: int, before: DataFrame | None = None) -> DataFrame:
    """The ``members`` nearest among neighbours and reverse neighbours of each node: center, member, new, active.

    A link is new if it is not among those ``before``, and a center active if it has a new one.
    """
    edges = graph.select(F.col("u").alias("center"), F.explode(F.arrays_zip("v", "s")).alias("x")) \
        .select("center", F.col("x.v").alias("member"), F.col("x.s").alias("s"), F.lit(True).alias("new"))
    both = edges.unionByName(edges.select(F.col("member").alias("center"), F.col("center").alias("member"), "s", "new"))
    if before is not None:
        both = both.unionByName(before.select("center", "member", F.lit(None).cast("double").alias("s"),
                                              F.lit(False).alias("new")))
    both = both.groupBy("center", "member").agg(F.max("s").alias("s"), F.every("new").alias("new")).where("s is not null")
    center = Window.partitionBy("center")
    rank = F.row_number().over(center.orderBy(F.desc("s"), "member"))
    return (both.withColumn("r", rank).where(F.col("r") <= members)
            .withColumn("active", F.some("new").over(center)).select("center", "member", "new", "active"))


def greedy_search(packed: DataFrame, links: DataFrame, graph: DataFrame, queries: DataFrame, beam: int,
                  wide: int, kind: str) -> DataFrame:
    """Best nodes of each query node: u, v, s. ``queries`` has nid; a query is a node of the graph.

    A beam starts with the query's own neighbours. Each round opens the ``wide`` nearest nodes of the
    beam not opened yet, scores what they link to and keeps the ``beam`` nearest; it ends when every
    node of every beam is open.
    """
    state = stored(graph.join(queries.select(F.col("nid").alias("u")), "u")
                   .select("u", "v", "s", F.array().cast("array<long>").alias("open")), "beams")
    vectors = packed.select(F.col("nid").alias("member"), F.col("packed").alias("candidate"))
    while True:
        fresh = F.filter("v", lambda x: ~F.array_contains("open", x))
        opened = state.select("u", F.slice(fresh, 1, wide).alias("now"))
        front = opened.select("u", F.explode("now").alias("center"))
        if front.limit(1).count() == 0:
            break
        reached = front.join(links, "center").select("u", "member").distinct().where(F.col("u") != F.col("member"))
        scored = reached.join(vectors, "member").select(
            "u", "member", "candidate", F.lit(None).cast("array<long>").alias("v"),
            F.lit(None).cast("array<double>").alias("s"), F.lit(None).cast("array<long>").alias("open"))
        own = (state.join(packed.select(F.col("nid").alias("u"), "packed"), "u").join(opened, "u")
               .select("u", F.lit(None).cast("long").alias("member"), F.col("packed").alias("candidate"), "v", "s",
                       F.concat("open", "now").alias("open")))

        def advance(batches):
            for table in _groups(batches, ["u"]):
                member = table.column("member")
                mine = member.is_null().to_numpy()
                k = int(np.flatnonzero(mine)[0])
                x = _unpack(table.column("candidate"), kind)
                near = x[~mine] @ x[k]
                old = np.array(table.column("v")[k].as_py(), np.int64)
                v = np.r_[old, member.drop_null().to_numpy()]
                s = np.r_[np.array(table.column("s")[k].as_py(), np.float64), near]
                v, first = np.unique(v, return_index=True)
                s = s[first]
                order = np.lexsort((v, -s))[:beam]
                opened = table.column("open")[k].as_py()
                yield pa.record_batch([pa.array([table.column("u")[0].as_py()]),
                                       pa.array([v[order].tolist()], pa.list_(pa.int64())),
                                       pa.array([s[order].tolist()], pa.list_(pa.float64())),
                                       pa.array([opened], pa.list_(pa.int64()))], ["u", "v", "s", "open"])

        # Distinct beams meet their candidates by the query, all of bounded number.
        state = stored(scored.unionByName(own).repartition("u").sortWithinPartitions("u")
                       .mapInArrow(advance, LISTS + ", open array<long>"), "beams")
    return state.select("u", "v", "s")


def nearest_neighbours(vectors: DataFrame, is_query: Column, top: int = 20, k: int = 40, settled: float = 0.1,
                       members: int = 64, emit: int = 6, tables: int = 8, leaf: int = 256, beam: int = 120,
                       wide: int = 48, seed: int = 5, vec_id: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """The ``top`` nearest vectors of each row that ``is_query`` selects: query_id, rank, vec_id, score.

    Nearness is the inner product in double precision; ties go to the smaller vec_id; a row is never its
    own neighbour. NULL, empty, zero or non-finite vectors and rows without an id take no part; rows of
    equal id and vector are one; vectors of unequal length are an error; an empty table gives no rows; other
    columns are ignored. All rows are indexed: equal vectors are one node of the graph, and their ids
    come back at the end, so copies cost nothing and none is lost. ``members``, ``emit``, ``beam`` and
    ``wide`` bound the work per node and make the search approximate, as does ``settled``, the share of new
    links at which the graph is taken as done; recall is measured in the tests.
    """
    # The precision that holds the given components unrounded.
    kind = "<f4" if vectors.schema[vector].dataType.elementType == T.FloatType() else "<f8"
    nodes, same = distinct_vectors(vectors, vec_id, vector, top + 1)
    nodes, same = stored(nodes, "nodes"), stored(same, "node-ids")
    lengths = nodes.agg(F.min(F.size("vector")), F.max(F.size("vector"))).first()
    if lengths[0] != lengths[1]:
        raise ValueError(f"vectors of unequal length: {lengths[0]} to {lengths[1]} components")

    def pack(batches):
        for batch in batches:
            if batch.num_rows:
                x = batch.column(1).flatten().to_numpy().reshape(batch.num_rows, -1)
                yield pa.record_batch([batch.column(0), pa.array(_pack(x, kind), pa.binary())], ["nid", "packed"])

    packed = stored(nodes.select("nid", "vector").mapInArrow(pack, "nid long, packed binary"), "packed")
    asked = stored(vectors.where(is_query).select(vectors[vec_id].alias("query_id"),
                                                  F.xxhash64(F.transform(vectors[vector].cast("array<double>"),
                                                                         lambda x: x + F.lit(0.0))).alias("nid"))
                   .where(F.col("query_id").isNotNull()).distinct()
                   .join(nodes.select("nid"), "nid", "left_semi"), "queries")
    graph, links = neighbour_graph(packed, k, settled, members, emit, tables, leaf, seed, kind)
    single = packed.select(F.col("nid").alias("u")).join(graph.select("u"), "u", "left_anti").select(
        "u", F.array().cast("array<long>").alias("v"), F.array().cast("array<double>").alias("s"))
    found = greedy_search(packed, links, graph.unionByName(single), asked.select("nid").distinct(), beam, wide, kind)
    # The whole beam is scored again, in the order of the components: products in blocks differ in last bits.
    pairs = found.select("u", F.explode(F.concat(F.array("u"), "v")).alias("v"))
    exact = (pairs.join(nodes.select(F.col("nid").alias("u"), F.col("vector").alias("x")), "u")
             .join(nodes.select(F.col("nid").alias("v"), F.col("vector").alias("y")), "v")
             .select("u", "v", F.aggregate(F.zip_with("x", "y", lambda a, b: a * b), F.lit(0.0),
                                           lambda a, b: a + b).alias("score")))
    ids = (exact.join(same.select(F.col("nid").alias("v"), "vec_id"), "v")
           .join(asked.select("query_id", F.col("nid").alias("u")), "u")
           .where(F.col("vec_id") != F.col("query_id")))
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return ids.withColumn("rank", rank).where(F.col("rank") <= top).select("query_id", "rank", "vec_id", "score")
