"""Token counts by rank-synchronous merging of batches of pre-tokens."""

from __future__ import annotations

import functools
import heapq
from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tapeworks.llm.common import field, slices
from tapeworks.llm.pieces import PieceCache, byte_letters, is_plain_byte_bpe, read_settings

NEVER = np.iinfo(np.int64).max


class Merges:
    """Merge ranks of a byte-level BPE file, and the counting of merged symbols."""

    def __init__(self, settings: dict, long_piece: int = 1000) -> None:
        model = settings["model"]
        vocab = model["vocab"]
        self.long_piece = long_piece
        self.byte_id = np.array([vocab[letter] for letter in byte_letters()], np.int64)
        pairs = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
        left = np.array([vocab[a] for a, _ in pairs], np.int64)
        right = np.array([vocab[b] for _, b in pairs], np.int64)
        key = left << 32 | right
        order = np.argsort(key, kind="stable")
        self.key, self.rank = key[order], order
        self.made = np.array([vocab[a + b] for a, b in pairs], np.int64)

    def ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        key = left << 32 | right
        at = np.minimum(np.searchsorted(self.key, key), len(self.key) - 1)
        return np.where(self.key[at] == key, self.rank[at], NEVER)

    def count(self, pieces: list[bytes]) -> np.ndarray:
        """Number of tokens of each piece.

        Pieces lie one after the other in flat arrays. In each round, every piece merges all
        occurrences of its own lowest-ranked pair, from the left; pieces without a pair are done.
        """
        sizes = np.fromiter(map(len, pieces), np.int64, len(pieces))
        counts = sizes.copy()
        for k in np.flatnonzero(sizes > self.long_piece):
            counts[k] = self._count_long(pieces[k])
        seq = np.repeat(np.arange(len(pieces)), np.where(sizes > self.long_piece, 0, sizes))
        sym = self.byte_id[np.frombuffer(
            b"".join(p for p in pieces if len(p) <= self.long_piece), np.uint8)]
        rank = self._all_ranks(sym, seq)
        while len(sym):
            starts = np.flatnonzero(np.r_[True, seq[1:] != seq[:-1]])
            lowest = np.minimum.reduceat(rank, starts)
            lengths = np.diff(np.r_[starts, len(seq)])
            counts[seq[starts]] = lengths
            going = np.repeat(lowest < NEVER, lengths)
            sym, seq, rank = sym[going], seq[going], rank[going]
            if not len(sym):
                break
            keep = lowest < NEVER
            hit = rank == np.repeat(lowest[keep], lengths[keep])
            # Only a pair of equal symbols can overlap itself; of a row of hits every other one counts.
            index = np.arange(len(hit))
            begins = hit & ~np.r_[False, hit[:-1]]
            run = np.maximum.accumulate(np.where(begins, index, 0))
            hit &= (index - run) % 2 == 0
            at = np.flatnonzero(hit)
            sym[at] = self.made[rank[at]]
            stay = np.ones(len(sym), bool)
            stay[at + 1] = False
            moved = np.cumsum(stay) - 1
            sym, seq, rank = sym[stay], seq[stay], rank[stay]
            at = moved[at]
            changed = np.unique(np.r_[at, at[at > 0] - 1])
            after = np.minimum(changed + 1, len(sym) - 1)
            inside = (changed < len(sym) - 1) & (seq[changed] == seq[after])
            rank[changed] = np.where(inside, self.ranks(sym[changed], sym[after]), NEVER)
        return counts

    def _all_ranks(self, sym: np.ndarray, seq: np.ndarray) -> np.ndarray:
        rank = np.full(len(sym), NEVER)
        if len(sym) > 1:
            rank[:-1] = np.where(seq[1:] == seq[:-1], self.ranks(sym[:-1], sym[1:]), NEVER)
        return rank

    def _count_long(self, piece: bytes) -> int:
        """One long piece: rounds would each pass over all of it, so a heap gives the next pair."""
        sym = self.byte_id[np.frombuffer(piece, np.uint8)].tolist()
        table = self._table()
        before, after = list(range(-1, len(sym) - 1)), [*range(1, len(sym)), -1]
        heap = [(table[p], i) for i, p in enumerate(zip(sym, sym[1:])) if p in table]
        heapq.heapify(heap)
        left = len(sym)
        while heap:
            rank, i = heapq.heappop(heap)
            j = after[i]
            if sym[i] is None or j < 0 or table.get((sym[i], sym[j])) != rank:
                continue
            sym[i], sym[j] = int(self.made[rank]), None
            left -= 1
            after[i] = after[j]
            if after[i] >= 0:
                before[after[i]] = i
                if (pair := (sym[i], sym[after[i]])) in table:
                    heapq.heappush(heap, (table[pair], i))
            if before[i] >= 0 and (pair := (sym[before[i]], sym[i])) in table:
                heapq.heappush(heap, (table[pair], before[i]))
        return left

    @functools.cache
    def _table(self) -> dict[tuple[int, int], int]:
        return {(k >> 32, k & 0xFFFFFFFF): r for k, r in zip(self.key.tolist(), self.rank.tolist())}


@functools.cache
def counter(path: str) -> Callable[[list[str]], list[int]]:
    """Function from texts to their numbers of tokens; one per worker and file."""
    settings = read_settings(path)
    if not is_plain_byte_bpe(settings):
        raise ValueError(f"{path} is not a byte-level BPE file")
    merges = Merges(settings)
    special = {t["content"]: 1 for t in settings.get("added_tokens", ())}
    return PieceCache(lambda pieces: merges.count([p.encode() for p in pieces]).tolist(), sum, special)


def token_counts(docs: DataFrame, tokenizer: str, limit: int = 512, doc_id: str = "doc_id",
                 text: str = "text") -> DataFrame:
    """Bytes and tokens of every text: doc_id, n_bytes, n_tokens, over_limit.

    ``tokenizer`` is the path of a byte-level BPE file that every executor can open. Rows keep their
    number: NULL and empty texts have no bytes and no tokens, NULL ids stay, repeated rows are counted
    each, other columns are ignored. Work is row by row without a shuffle.
    """
    schema = T.StructType([field(docs, doc_id, "doc_id"), T.StructField("n_bytes", T.LongType()),
                           T.StructField("n_tokens", T.LongType())])

    def count(batches):
        tokens = counter(tokenizer)
        for batch in slices(batches):
            yield pa.record_batch([batch.column(0), batch.column(1),
                                   pa.array(tokens(batch.column(2).to_pylist()), pa.int64())],
                                  ["doc_id", "n_bytes", "n_tokens"])

    whole = F.coalesce(docs[text], F.lit(""))
    return (docs.select(docs[doc_id].alias("doc_id"), F.octet_length(whole).cast("long").alias("n_bytes"),
                        whole.alias("text"))
            .mapInArrow(count, schema)
            .withColumn("over_limit", F.col("n_tokens") > limit))
