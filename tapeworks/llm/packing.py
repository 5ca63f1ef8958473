"""Packing of tokenized documents into sequences by a grouping genetic algorithm on islands."""

from __future__ import annotations

import zlib
from bisect import bisect_left, insort

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tapeworks.llm.bpe_ids import encoder
from tapeworks.llm.common import field, slices, stored


def cut_pieces(docs: DataFrame, tokenizer: str, capacity: int = 1024, end_id: int = 2,
               doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Pieces of at most ``capacity`` ids: uid, doc_id, piece, start, length, ids_crc32.

    The ids of a text and ``end_id`` are one piece if they fit; else all pieces but the first are full.
    ``uid`` numbers the pieces of this run; keep the result stored.
    """
    schema = T.StructType([T.StructField("uid", T.LongType()), field(docs, doc_id, "doc_id"),
                           T.StructField("piece", T.IntegerType()),
                           *[T.StructField(n, T.LongType()) for n in ("start", "length", "ids_crc32")]])
    end = int(end_id).to_bytes(4, "little")

    def cut(batches):
        encode = encoder(tokenizer)
        uid = TaskContext.get().partitionId() << 40
        for batch in slices(batches):
            rows: list[tuple[int, int, int, int, int]] = []
            for at, ids in enumerate(encode(batch.column(1).to_pylist())):
                ids += end
                n = len(ids) // 4
                stops = range((n - 1) % capacity + 1, n + 1, capacity)
                start = 0
                for piece, stop in enumerate(stops):
                    rows.append((at, piece, start, stop - start, zlib.crc32(ids[4 * start:4 * stop])))
                    start = stop
            at, piece, start, length, crc = map(np.array, zip(*rows))
            yield pa.record_batch(
                [pa.array(np.arange(uid, uid + len(rows))), batch.column(0).take(pa.array(at)),
                 pa.array(piece.astype(np.int32)), *[pa.array(x.astype(np.int64)) for x in (start, length, crc)]],
                schema.names)
            uid += len(rows)

    return (docs.select(docs[doc_id].alias("doc_id"), F.coalesce(docs[text], F.lit("")).alias("text"))
            .mapInArrow(cut, schema))


class Bins:
    """One individual: bins of items, their free places kept in order for best fit."""

    def __init__(self, sizes: list[int], capacity: int) -> None:
        self.sizes, self.capacity = sizes, capacity
        self.items: dict[int, list[int]] = {}
        self.room: dict[int, int] = {}
        self.order: list[tuple[int, int]] = []
        self.next = 0

    def best_fit(self, items) -> None:
        """Put each item where the least room remains, or into a new bin."""
        for item in items:
            size = self.sizes[item]
            at = bisect_left(self.order, (size, -1))
            if at < len(self.order):
                room, name = self.order.pop(at)
            else:
                room, name = self.capacity, self.next
                self.next += 1
                self.items[name] = []
            self.items[name].append(item)
            self.room[name] = room - size
            if room > size:
                insort(self.order, (room - size, name))

    def inject(self, items: list[int]) -> None:
        """Take over a whole bin."""
        name, room = self.next, self.capacity - sum(self.sizes[i] for i in items)
        self.next += 1
        self.items[name], self.room[name] = list(items), room
        if room:
            insort(self.order, (room, name))

    def fitness(self) -> tuple[int, float]:
        """Fewer bins first; then the mean square of their fill, which rewards full bins."""
        fill = (self.capacity - np.fromiter(self.room.values(), float, len(self.room))) / self.capacity
        return -len(self.items), float(np.mean(fill * fill)) if len(fill) else 0.0

    def assignment(self) -> list[int]:
        out = [0] * len(self.sizes)
        for number, items in enumerate(self.items.values()):
            for item in items:
                out[item] = number
        return out


def of_assignment(sizes: list[int], capacity: int, assignment) -> Bins:
    bins = Bins(sizes, capacity)
    groups: dict[int, list[int]] = {}
    for item, name in enumerate(assignment):
        groups.setdefault(name, []).append(item)
    for items in groups.values():
        bins.inject(items)
    return bins


def crossover(first: Bins, second: Bins, random: np.random.Generator) -> Bins:
    """Child of two groupings: well-filled bins of one go whole into the other.

    Bins of the receiver that hold an injected document go, so no document is there twice; what else
    they held is displaced and put back by best fit, the longest first.
    """
    sizes, capacity = first.sizes, first.capacity
    names = [n for n, room in second.room.items() if room * 50 <= capacity]
    chosen = [names[k] for k in random.permutation(len(names))[:max(1, len(names) // 2)]] if names else []
    injected = {i for n in chosen for i in second.items[n]}
    child = Bins(sizes, capacity)
    displaced: list[int] = []
    for items in first.items.values():
        if injected.isdisjoint(items):
            child.inject(items)
        else:
            displaced += [i for i in items if i not in injected]
    for n in chosen:
        child.inject(second.items[n])
    child.best_fit(sorted(displaced, key=lambda i: (-sizes[i], i)))
    return child


def mutate(bins: Bins, random: np.random.Generator, share: float = 0.05) -> Bins:
    """Empty the worst-filled bins and some others, and put their documents back by best fit."""
    by_room = sorted(bins.room, key=lambda n: (-bins.room[n], n))
    count = max(1, int(len(by_room) * share))
    gone = set(by_room[:count]) | {by_room[k] for k in random.integers(0, len(by_room), count)}
    out = Bins(bins.sizes, bins.capacity)
    loose: list[int] = []
    for name, items in bins.items.items():
        if name in gone:
            loose += items
        else:
            out.inject(items)
    out.best_fit(sorted(loose, key=lambda i: (-bins.sizes[i], i)))
    return out


def evolve(sizes: list[int], capacity: int, elites: list, seed: int, population: int,
           generations: int) -> list[int]:
    """One epoch of an island: its own elite and the migrant live among new individuals."""
    random = np.random.default_rng(seed)
    people = [of_assignment(sizes, capacity, e) for e in elites]
    longest = sorted(range(len(sizes)), key=lambda i: (-sizes[i], i))
    while len(people) < population:
        bins = Bins(sizes, capacity)
        if len(people) == 0:
            bins.best_fit(longest)
        else:  # nearly by length: neighbours change places
            noise = np.array(sizes) * (1 + 0.1 * random.standard_normal(len(sizes)))
            bins.best_fit(np.argsort(-noise, kind="stable").tolist())
        people.append(bins)
    people.sort(key=Bins.fitness, reverse=True)
    least = -(-sum(sizes) // capacity)
    for _ in range(generations):
        if len(people[0].items) == least:
            break
        a, b = sorted(random.choice(len(people), 2, replace=False)) if len(people) > 1 else (0, 0)
        for child in (crossover(people[a], people[b], random), crossover(people[b], people[a], random),
                      mutate(people[a], random)):
            people.append(child)
        people.sort(key=Bins.fitness, reverse=True)
        del people[population:]
    return people[0].assignment()


def genetic_packing(pieces: DataFrame, capacity: int = 1024, shard_items: int = 4096, islands: int = 2,
                    epochs: int = 2, population: int = 4, generations: int = 4, seed: int = 7) -> DataFrame:
    """Sequence and offset of every piece: uid, sequence_id, offset. ``pieces`` has uid and length.

    Full pieces are sequences by themselves. The others are dealt by a hash over shards of about
    ``shard_items``; on each shard some islands evolve groupings, and after each epoch the best
    grouping of an island moves on to the next island of its shard.
    """
    rest = pieces.where(F.col("length") < capacity).select("uid", "length")
    shards = max(1, -(-rest.count() // shard_items))
    items = stored(
        rest.groupBy(F.pmod(F.xxhash64("uid", F.lit(seed)), F.lit(shards)).alias("shard"))
        .agg(F.array_sort(F.collect_list(F.struct("uid", F.col("length").cast("int").alias("length")))).alias("x"))
        .select("shard", F.col("x.uid").alias("uids"), F.col("x.length").alias("sizes")), "packing-items")
    state = items.select("shard", "sizes", F.explode(F.sequence(F.lit(0), F.lit(islands - 1))).alias("island"),
                         F.array().cast("array<array<int>>").alias("elites"))
    for epoch in range(epochs):
        def run(frames, epoch=epoch):
            for frame in frames:
                best = [evolve([int(x) for x in r.sizes], capacity, [list(e) for e in r.elites],
                               hash((seed, epoch, int(r.shard), int(r.island))) & 0x7FFFFFFF,
                               population, generations) for r in frame.itertuples()]
                yield pd.DataFrame({"shard": frame.shard, "island": frame.island, "elite": best,
                                    "bins": [max(b) + 1 for b in best]})

        # One row is the work of seconds, so rows are spread over tasks by their number.
        tasks = min(shards * islands, 4 * state.sparkSession.sparkContext.defaultParallelism)
        elites = stored(state.repartition(max(1, tasks), "shard", "island")
                        .mapInPandas(run, "shard long, island int, elite array<int>, bins int"),
                        f"packing-epoch-{epoch}")
        moved = elites.select("shard", ((F.col("island") + 1) % islands).alias("island"),
                              F.col("elite").alias("migrant"))
        state = (elites.join(moved, ["shard", "island"]).join(items.drop("uids"), "shard")
                 .select("shard", "sizes", "island", F.array("elite", "migrant").alias("elites")))
    best = elites.groupBy("shard").agg(F.min_by("elite", F.struct("bins", "island")).alias("bin"))
    placed = (best.join(items, "shard")
              .select("shard", F.explode(F.arrays_zip("uids", "sizes", "bin")).alias("x"))
              .groupBy("shard", "x.bin").agg(F.array_sort(F.collect_list(
                  F.struct("x.uids", "x.sizes"))).alias("x")))
    # Offsets inside a sequence: running sums over its few pieces.
    starts = F.transform(F.sequence(F.lit(0), F.size("x") - 1),
                         lambda k: F.aggregate(F.slice("x", 1, k), F.lit(0).cast("long"),
                                               lambda a, p: a + p["sizes"]))
    sequence = (F.col("shard") * F.lit(shard_items * 64) + F.col("bin")) * 2 + 1
    short = (placed.select(sequence.alias("sequence_id"), F.explode(F.arrays_zip(
        F.col("x.uids").alias("uid"), starts.alias("offset"))).alias("y"))
        .select(F.col("y.uid").alias("uid"), "sequence_id", F.col("y.offset").alias("offset")))
    full = pieces.where(F.col("length") == capacity).select(
        "uid", (F.col("uid") * 2).alias("sequence_id"), F.lit(0).cast("long").alias("offset"))
    return short.unionByName(full)


def pack_documents(docs: DataFrame, tokenizer: str, capacity: int = 1024, end_id: int = 2,
                   doc_id: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """Pack all documents: doc_id, piece, start, length, ids_crc32, sequence_id, offset.

    One row per piece; NULL and empty texts are ``end_id`` alone, repeated rows and NULL ids are packed
    each, an empty table gives no rows, other columns are ignored. ``options`` go to
    ``genetic_packing``; its shards hold so many lengths only, never texts.
    """
    pieces = stored(cut_pieces(docs, tokenizer, capacity, end_id, doc_id, text), "packing-pieces")
    placed = genetic_packing(pieces, capacity, **options)
    return (pieces.join(placed, "uid")
            .select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"))
