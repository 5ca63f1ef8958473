"""Periodic runs of words, found by multi-scale minimizers and lag scans.

Some hundred texts at a time are one array of word numbers with a mark of its own after each text. A run
of period q and at least 4q words is found at the scale g, the power of two with g/2 < q <= g: grams of g
words have hashes, and of every g/2 grams in a row the least is selected. Windows one period apart hold
the same grams, so selected grams repeat at the distance q; since no two equal grams of q words or more
lie closer in a run of smallest period q, neighbours among equal selected grams name the period. Such
a pair is a seed and is extended both ways on the words themselves. Periods up to ``SHORT`` are scanned
lag by lag.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tapeworks.llm.common import id_crc, slices

SHORT = 4  # the greatest period that is scanned directly
BATCH_BYTES = 1 << 21  # texts are put together up to this size; a longer one stands alone
_MIX = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9)


def _join(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Hash of two hashes in this order."""
    mixed = (left * _MIX[0]) ^ (right + (left >> np.uint64(29)))
    mixed *= _MIX[1]
    return mixed ^ (mixed >> np.uint64(32))


def _slide(values: np.ndarray, width: int, pick: np.ufunc) -> np.ndarray:
    """``pick`` (minimum or maximum) of every ``width`` values in a row; ``width`` is a power of two."""
    step = 1
    while step < width:
        values = pick(values[:-step], values[step:])
        step *= 2
    return values


def _selected(hashes: np.ndarray, width: int) -> np.ndarray:
    """Places that hold the minimum of some window of ``width`` hashes; of equal ones all."""
    if len(hashes) < width:
        return np.zeros(0, np.int64)
    least = _slide(hashes, width, np.minimum)
    edge = np.zeros(width - 1, hashes.dtype)  # below all minima, so no window there counts
    greatest = _slide(np.concatenate([edge, least, edge]), width, np.maximum)
    return np.flatnonzero(greatest == hashes)


def _stretches(same: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and lengths of the stretches where ``same`` holds."""
    edges = np.flatnonzero(np.diff(np.concatenate([[False], same, [False]]).astype(np.int8)))
    return edges[::2], edges[1::2] - edges[::2]


def _reach(words: np.ndarray, at: int, lag: int, step: int) -> int:
    """Places from ``at`` in the direction ``step`` where words ``lag`` apart are equal, in growing chunks."""
    n, size, done = len(words) - lag, 64, 0
    while True:
        if step > 0:
            low, high = at + done, min(at + done + size, n)
            same = words[low:high] == words[low + lag:high + lag]
        else:
            low, high = max(at - done - size + 1, 0), at - done + 1
            same = (words[low:high] == words[low + lag:high + lag])[::-1]
        wrong = np.flatnonzero(~same)
        if len(wrong) or high - low < size:
            return done + (int(wrong[0]) if len(wrong) else max(high - low, 0))
        done, size = done + size, 2 * size


def long_runs(words: np.ndarray, lengths: np.ndarray, times: int) -> Iterator[tuple[int, int, int]]:
    """Start, length and period of the runs with a period above ``SHORT``; ``words`` holds the texts with marks.

    A run may come more than once, and its stretch may be too short or have a smaller period.
    """
    gram = 2 * SHORT
    while True:
        # A text is too short for this scale when its least period does not fit ``times`` times.
        enough = lengths >= times * (gram // 2 + 1)
        if not enough.any():
            return
        places = np.flatnonzero(np.repeat(enough, lengths + 1))
        part = words[places]
        hashes = part.view(np.uint64)
        hashes = _join(hashes, hashes)
        step = 1
        while step < gram:
            hashes = _join(hashes[:-step], hashes[step:])
            step *= 2
        chosen = _selected(hashes, gram // 2)
        chosen = chosen[np.argsort(hashes[chosen], kind="stable")]
        lag = np.diff(chosen)
        pair = (hashes[chosen[1:]] == hashes[chosen[:-1]]) & (lag > gram // 2) & (lag <= gram)
        seeds = np.stack([lag[pair], chosen[:-1][pair]])
        seeds = seeds[:, np.lexsort(seeds[::-1])]
        known, until = 0, -1
        for period, at in seeds.T.tolist():
            if period == known and at < until:
                continue
            if part[at] != part[at + period]:
                continue
            start = at - _reach(part, at, period, -1) + 1
            known, until = period, at + _reach(part, at, period, 1)
            yield int(places[start]), until - start + period, period
        gram *= 2


def find_runs(words: np.ndarray, lengths: np.ndarray, least: int, times: int) -> np.ndarray:
    """Runs of all texts as rows (start in ``words``, length, period), by start, then period."""
    found = []
    for lag in range(1, SHORT + 1):
        start, length = _stretches(words[:-lag] == words[lag:]) if len(words) > lag else (np.zeros(0, int),) * 2
        length = length + lag
        fit = length >= max(least, times * lag)
        found.append(np.stack([start[fit], length[fit], np.full(fit.sum(), lag)], 1))
    rows = [r for r in set(long_runs(words, lengths, times)) if r[1] >= max(least, times * r[2])]
    found.append(np.array(rows, np.int64).reshape(-1, 3))
    runs = np.concatenate(found).astype(np.int64)
    runs = runs[np.lexsort((runs[:, 2], runs[:, 1], runs[:, 0]))]
    # The same stretch under a multiple of its smallest period is no run of its own.
    fresh = np.ones(len(runs), bool)
    fresh[1:] = (runs[1:, :2] != runs[:-1, :2]).any(1)
    runs = runs[fresh]
    return runs[np.lexsort((runs[:, 2], runs[:, 0]))]


def _chunks(texts: Iterator[bytes]) -> Iterator[list[bytes]]:
    held, size = [], 0
    for text in texts:
        if held and size + len(text) > BATCH_BYTES:
            yield held
            held, size = [], 0
        held.append(text)
        size += len(text)
    if held:
        yield held


def runs_of_texts(texts: list[bytes], least: int, times: int) -> list[tuple[int, np.ndarray, bytes]]:
    """Per text its number of words, its runs and its words without repeated periods."""
    split = [t.split() for t in texts]  # of bytes: at blanks and the signs 9 to 13, as words are defined
    numbers: dict[bytes, int] = {}
    lengths = np.array([len(w) for w in split], np.int64)
    words = np.empty(int(lengths.sum()) + len(split), np.int64)
    starts = np.concatenate([[0], np.cumsum(lengths + 1)])
    for k, own in enumerate(split):
        words[starts[k]:starts[k + 1] - 1] = [numbers.setdefault(w, len(numbers)) for w in own]
    words[starts[1:] - 1] = -1 - np.arange(len(split))
    runs = find_runs(words, lengths, least, times)
    cuts = np.searchsorted(runs[:, 0], starts)
    out = []
    for k, own in enumerate(split):
        mine = runs[cuts[k]:cuts[k + 1]] - [starts[k], 0, 0]
        if len(mine):
            edges = np.zeros(len(own) + 1, np.int64)
            np.add.at(edges, mine[:, 0] + mine[:, 2], 1)
            np.add.at(edges, mine[:, 0] + mine[:, 1], -1)
            own = [own[i] for i in np.flatnonzero(np.cumsum(edges[:-1]) == 0).tolist()]
        out.append((int(lengths[k]), mine, b" ".join(own)))
    return out


def periodic_runs(docs: DataFrame, least: int = 6, times: int = 4, doc_id: str = "doc_id",
                  text: str = "text") -> DataFrame:
    """Per row of ``docs``: doc_id, n_words, runs (start, length, period) and collapsed.

    A run is a stretch of words with smallest period q, at least ``least`` words and ``times`` q long
    (``times`` is 4 or more), that no neighbouring word extends. ``collapsed`` has the words that no run
    holds after its first period, with single blanks between them. Runs come by start, then period.

    NULL and empty texts have no words, no runs and an empty ``collapsed``; very long texts are taken
    whole, one at a time; equal rows get equal results, one row each; an empty table gives no row;
    other columns are ignored.
    """
    if times < 4:
        raise ValueError("runs of fewer than four periods may be missed")
    run = T.StructType([T.StructField(n, T.LongType()) for n in ("start", "length", "period")])
    schema = T.StructType([
        T.StructField("doc_id", docs.schema[doc_id].dataType), T.StructField("n_words", T.LongType()),
        T.StructField("runs", T.ArrayType(run)), T.StructField("collapsed", T.StringType())])

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            ids, at = batch.column(0), 0
            for chunk in _chunks(b or b"" for b in batch.column(1).to_pylist()):
                found = runs_of_texts(chunk, least, times)
                rows = np.concatenate([r for _, r, _ in found])
                fields = [pa.array(rows[:, k]) for k in range(3)]
                ends = np.concatenate([[0], np.cumsum([len(r) for _, r, _ in found])])
                yield pa.RecordBatch.from_arrays(
                    [ids.slice(at, len(chunk)), pa.array([n for n, _, _ in found], pa.int64()),
                     pa.ListArray.from_arrays(pa.array(ends, pa.int32()),
                                              pa.StructArray.from_arrays(fields, ["start", "length", "period"])),
                     pa.array([c for _, _, c in found], pa.binary()).cast(pa.string())],
                    schema.names)
                at += len(chunk)

    return docs.select(docs[doc_id], F.coalesce(docs[text], F.lit("")).cast("binary")).mapInArrow(find, schema)


def planted(docs: DataFrame) -> DataFrame:
    """Texts with a period planted in a tenth of the documents: doc_id, text.

    With h the CRC of the decimal id and g = h // 10, documents with h % 10 = 0 and n > 0 words repeat the
    p = 1 + (n - a) // (3 + g % 8) words from a = g % n on to their end. For NULL ids h is 0.
    """
    h = id_crc(docs["doc_id"])
    words = F.regexp_extract_all(docs["text"], F.lit(r"[^\x20\x09-\x0D]+"), F.lit(0))

    def repeated(w):
        n = F.size(w).cast("long")
        g = F.floor(h / 10).cast("long")
        sizes = F.array(F.struct((g % n).alias("a"), n.alias("n"), g.alias("g")))
        period = F.transform(sizes, lambda s: F.struct(
            s["a"].alias("a"), (F.floor((s["n"] - s["a"]) / (3 + s["g"] % 8)) + 1).cast("long").alias("p")))
        return F.flatten(F.transform(period, lambda s: F.transform(
            F.sequence(F.lit(0), F.size(w) - 1),
            lambda i: F.get(w, F.when(i < s["a"], i).otherwise(s["a"] + (i - s["a"]) % s["p"]).cast("int")))))

    # The words are bound once: an expression inside a lambda would be computed for each of them again.
    whole = F.element_at(F.transform(F.array(words), lambda w: F.when(F.size(w) > 0, F.array_join(repeated(w), " "))), 1)
    return docs.select("doc_id", F.coalesce(F.when(h % 10 == 0, whole), docs["text"]).alias("text"))
