"""Quality of documents from overlapping heuristic labellers, without labelled rows.

Each labeller votes good, bad or nothing. Expectation-maximisation over the counts of vote patterns of
all documents estimates how often each labeller is right, and the posterior of a pattern labels its
documents. A linear scorer over hashed features of words is trained on some of them and scores all.
"""

from __future__ import annotations

import math
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tapeworks.llm.common import field, slices, stored

GOOD, BAD, NONE = 1, 0, -1
# Least and most of a share: up to the first the vote is good, from the second on it is bad.
LIMITS = {
    "symbols": (0.01, 0.1),     # words with a sign that prose does not use
    "shouting": (0.05, 0.3),    # words of two letters or more in capitals only
    "repeats": (0.02, 0.2),     # words equal to the word before
    "same_lines": (0.05, 0.3),  # lines equal to an earlier line
    "signs": (0.02, 0.15),      # words without letter and digit
    "marks": (0.02, 0.2),       # words with two exclamation marks or more
    "tails": (0.01, 0.1),       # words with the same sign twice in a row
}
LABELLERS = (*LIMITS, "short_words", "variety")
# Signs that the first labeller looks for.
SIGNS = frozenset("#*$%&|<>{}\\^~")
FLAGS = np.arange(64)
TWICE = re.compile(r"([^\w\s.!?-])\1")


class Words:
    """What a word shows, looked up once per distinct word and worker."""

    def __init__(self, bits: int, limit: int = 300_000, most_chars: int = 1 << 25) -> None:
        self.bits, self.limit, self.known = bits, limit, {}
        self.chars, self.most_chars = 0, most_chars
        self.table = np.zeros((1024, 3), np.int64)

    def _look(self, word: str) -> tuple[int, int, int]:
        """Flags, hashed shape, hashed word."""
        mask, code = (1 << self.bits) - 1, zlib.crc32(word.lower().encode())
        # Most new words are letters and perhaps a full stop or comma.
        body, end = (word[:-1], word[-1]) if word[-1] in ".," else (word, "")
        if body.isalpha() and (body[1:].islower() or len(body) == 1) and len(body) <= 63:
            shape = ("A" if body[0].isupper() else "a") + ("a" if len(body) > 1 and body[0].isupper() else "") + end
            return (len(body) <= 3) << 4, zlib.crc32(shape.encode()) & mask, code & mask
        letters = sum(map(str.isalpha, word))
        flags = (bool(SIGNS & set(word)) | (letters >= 2 and word.upper() == word and word.lower() != word) << 1
                 | (not letters and not any(map(str.isdigit, word))) << 2 | ("!!" in word) << 3
                 | (1 <= letters <= 3) << 4 | (TWICE.search(word) is not None) << 5)
        shape, last = [], ""
        for c in word:
            kind = "a" if c.islower() else "A" if c.isupper() else "0" if c.isdigit() else c
            if kind != last:
                shape.append(kind)
            last = kind
        return flags, zlib.crc32("".join(shape).encode()) & mask, code & mask

    def __call__(self, words: list[str]) -> np.ndarray:
        if len(self.known) > self.limit or self.chars > self.most_chars:
            self.known, self.chars = {}, 0
        known = self.known
        new = set(words).difference(known)
        if len(known) + len(new) > len(self.table):
            self.table = np.resize(self.table, (2 * (len(known) + len(new)), 3))
        for word in new:
            self.table[len(known)] = self._look(word)
            known[word] = len(known)
            self.chars += len(word)
        return self.table[np.fromiter(map(known.__getitem__, words), np.int64, len(words))]


def votes(text: str, words: list[str], seen: np.ndarray) -> list[int]:
    """One vote per labeller."""
    n = len(words)
    if n < 5:
        return [NONE] * len(LABELLERS)
    by_flags = np.bincount(seen[:, 0], minlength=64)
    share = lambda bit: float(by_flags[FLAGS & bit > 0].sum()) / n
    lines = [x for x in text.split("\n") if x.strip()]
    shares = [share(1), share(2), np.count_nonzero(seen[1:, 2] == seen[:-1, 2]) / n,
              1 - len(set(lines)) / max(1, len(lines)), share(4), share(8), share(32)]
    out = [GOOD if s <= low else BAD if s >= high else NONE for s, (low, high) in zip(shares, LIMITS.values())]
    short = share(16)
    out.append(GOOD if short >= 0.25 else BAD if short <= 0.05 and n >= 30 else NONE)
    # Distinct words fall with length, so the share is held against the square root of the length.
    variety = len(set(words)) / math.sqrt(n)
    out.append(NONE if n < 50 else GOOD if variety >= 4 else BAD if variety <= 2 else NONE)
    return out


def features(seen: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashed features of a document with unit length: shapes, pairs of shapes, words, repeats."""
    if not len(seen):
        return np.zeros(0, np.int64), np.zeros(0)
    mask, shape = (1 << bits) - 1, seen[:, 1]
    pair = (shape[1:] * 31 + shape[:-1] * 17 + 7) & mask
    again = np.full(int(np.sum(seen[1:, 2] == seen[:-1, 2])), 1, np.int64)
    index, counts = np.unique(np.concatenate([shape, pair, again]), return_counts=True)
    values = np.sqrt(counts / len(seen))
    word, word_counts = np.unique(seen[:, 2], return_counts=True)
    values = np.concatenate([values, 0.3 * np.sqrt(word_counts / len(seen))])
    index = np.concatenate([index, word ^ mask])
    return index, values / np.linalg.norm(values)


def estimate(patterns: np.ndarray, counts: np.ndarray, rounds: int = 100) -> tuple[np.ndarray, np.ndarray, float]:
    """EM over vote patterns: posterior of good per pattern, accuracy (bad, good) per labeller, prior.

    Given the class, labellers are independent, and each votes bad, good or nothing with probabilities of
    its own; its accuracy in a class is the probability of that class's vote. So a labeller of one defect,
    which calls documents with other defects good, weighs little where it says good. The first posterior
    trusts every bad vote; a labeller whose bad votes stand alone too often loses its weight.
    """
    values = np.array([BAD, GOOD, NONE])
    cast = patterns[:, :, None] == values
    posterior = np.where(np.any(patterns == BAD, axis=1), 0.001, 0.999)
    accuracy, prior = np.zeros((patterns.shape[1], 2)), 0.5
    for _ in range(rounds):
        prior = float(np.clip(np.sum(counts * posterior) / max(1, np.sum(counts)), 0.01, 0.99))
        log = np.zeros((len(patterns), 2))
        for c, weight in ((BAD, counts * (1 - posterior)), (GOOD, counts * posterior)):
            votes_of = np.einsum("plv,p->lv", cast, weight) + np.where(values == c, 1.0, 0.05)
            chance = votes_of / votes_of.sum(axis=1, keepdims=True)
            accuracy[:, c] = chance[:, c]
            log[:, c] = np.einsum("plv,lv->p", cast, np.log(chance))
        log += np.log([1 - prior, prior])
        before, posterior = posterior, 1 / (1 + np.exp(np.clip(log[:, BAD] - log[:, GOOD], -500, 500)))
        if np.max(np.abs(posterior - before), initial=0) < 1e-9:
            break
    return posterior, accuracy, prior


def fit_linear(rows: list[tuple[np.ndarray, np.ndarray]], target: np.ndarray, weight: np.ndarray, bits: int,
               rounds: int = 8, rate: float = 0.5, decay: float = 1e-5) -> tuple[np.ndarray, float]:
    """Logistic regression on soft labels by steps over documents, with averaged weights."""
    w, total, bias, bias_total, steps = np.zeros(1 << bits), np.zeros(1 << bits), 0.0, 0.0, 0
    for epoch in range(rounds):
        for k in np.random.default_rng(epoch).permutation(len(rows)):
            index, value = rows[k]
            error = (target[k] - 1 / (1 + math.exp(-max(-30, min(30, bias + w[index] @ value))))) * weight[k]
            w[index] += rate * (error * value - decay * w[index])
            bias += 0.1 * rate * error
        total += w
        bias_total += bias
        steps += 1
    return total / max(1, steps), bias_total / max(1, steps)


def _read(batches: Iterator[pa.RecordBatch], look: Words):
    for batch in slices(batches):
        for row in batch.to_pylist():
            words = (row["text"] or "").split()
            yield row, words, look(words)


def weak_quality(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", limit: float = 0.5,
                 sample: int = 6000, bits: int = 16, seed: int = 11) -> DataFrame:
    """Score and verdict of every row: all columns of ``docs``, then quality_score, quality_kept.

    ``sample`` bounds the rows that the scorer is trained on (those with the smallest hashes, so a rerun
    takes the same); the accuracies come from the patterns of all rows. Texts of less than five words
    give no votes but are scored; the less they show, in words or, where these are few, in characters, the
    more good they count, so a text of one very long word is judged by its signs. NULL and empty texts
    are kept, for nothing speaks against them. Very long texts and words are taken whole. Repeated rows
    and NULL ids are scored each; given columns of the result's names are replaced. If no pattern is more likely bad, or the table is empty, all is kept.
    """
    spark = docs.sparkSession
    given = docs.select(F.xxhash64(F.lit(seed), docs[doc_id], docs[text]).alias("h"), docs[text].alias("text"))

    def vote(batches):
        look = Words(bits)
        for batch in slices(batches):
            held = []
            for row in batch.to_pylist():
                words = (row["text"] or "").split()
                held.append(votes(row["text"] or "", words, look(words)))
            yield pa.record_batch([batch.column(0), pa.array(held, pa.list_(pa.int32()))], ["h", "votes"])

    voted = stored(given.mapInArrow(vote, "h long, votes array<int>"), "quality-votes")
    # At most 3 to the number of labellers rows.
    table = voted.groupBy("votes").agg(F.count("*").alias("n")).orderBy("votes").collect()
    model = None
    if table:
        patterns = np.array([r.votes for r in table])
        posterior, accuracy, _ = estimate(patterns, np.array([r.n for r in table], float))
        spoken = np.any(patterns != NONE, axis=1)
        if np.any((posterior < 0.5) & spoken):
            model = _train(spark, docs, given, voted, dict(zip(map(tuple, patterns.tolist()), posterior)),
                           sample, bits)
    return _score(docs, text, model, limit, bits)


def _train(spark, docs, given, voted, posterior, sample, bits):
    """Weights from the sample's features, which alone come to the driver."""
    # A hash's leading part: as many rows as asked for, in the order of hashes, in both classes.
    bad = [list(v) for v, p in posterior.items() if p < 0.5]
    side = F.col("votes").isin(*[F.array(*map(F.lit, v)) for v in bad])
    chosen = (voted.where(side).orderBy("h").limit(sample // 2)
              .unionByName(voted.where(~side).orderBy("h").limit(sample // 2))).dropDuplicates(["h"])
    rows = stored(chosen, "quality-sample")
    texts = given.join(rows, "h").dropDuplicates(["h"])

    def describe(batches):
        look = Words(bits)
        for batch in slices(batches):
            held = [features(look((t or "").split()), bits) for t in batch.column(1).to_pylist()]
            yield pa.record_batch([batch.column(0), batch.column(2),
                                   pa.array([i.tolist() for i, _ in held], pa.list_(pa.int32())),
                                   pa.array([v.tolist() for _, v in held], pa.list_(pa.float32()))],
                                  ["h", "votes", "index", "value"])

    got = texts.select("h", "text", "votes").mapInArrow(
        describe, "h long, votes array<int>, index array<int>, value array<float>").orderBy("h").toArrow()
    target = np.array([posterior[tuple(v)] for v in got.column("votes").to_pylist()])
    spoken = np.array([any(x != NONE for x in v) for v in got.column("votes").to_pylist()])
    vectors = [(np.array(i, np.int64), np.array(v, float))
               for i, v in zip(got.column("index").to_pylist(), got.column("value").to_pylist())]
    return fit_linear(vectors, target, spoken.astype(float), bits)


def _score(docs: DataFrame, text: str, model, limit: float, bits: int) -> DataFrame:
    weights = None if model is None else docs.sparkSession.sparkContext.broadcast(
        (model[0].astype(np.float32), model[1]))  # 2 ** bits numbers

    def score(batches):
        look = Words(bits)
        for batch in batches:
            scores: list[float] = []
            for part in slices([batch.select([text])]):
                for t in part.column(0).to_pylist():
                    words = (t or "").split()
                    if weights is None or not words:
                        scores.append(1.0)
                        continue
                    index, value = features(look(words), bits)
                    w, bias = weights.value
                    # A short text shows little; its score is pulled towards good.
                    shown = len(words) if len(words) >= 5 else max(len(words), sum(map(len, words)) / 6)
                    trust = shown / (shown + 8)
                    raw = trust * (bias + float(w[index] @ value)) + (1 - trust) * 2
                    scores.append(1 / (1 + math.exp(-max(-30.0, min(30.0, raw)))))
            kept = [s >= limit for s in scores]
            yield pa.record_batch([*batch.columns, pa.array(scores, pa.float64()), pa.array(kept, pa.bool_())],
                                  [*batch.schema.names, "quality_score", "quality_kept"])

    given = docs.drop("quality_score", "quality_kept")
    schema = T.StructType([*[field(given, c) for c in given.columns],
                           T.StructField("quality_score", T.DoubleType()),
                           T.StructField("quality_kept", T.BooleanType())])
    return given.mapInArrow(score, schema)
