"""Line dedup against the comparison of all lines at all shifts, on texts of few different lines."""

from __future__ import annotations

import collections
import random
import time

import pytest
from pyspark.sql import functions as F

from tapeworks.llm.line_dedup import _key, line_dedup

SCHEMA = "doc_id long, text string"


def _expected(docs: list[tuple], min_words: int) -> dict:
    """Per document the lines that stay: every pair of a window and its first one, extended line by line."""
    docs = sorted(docs, key=lambda d: d[:2])
    lines = [[(k, x.strip(), len(x.split())) for k, x in enumerate(text.split("\n")) if x.split()] for _, _, text in docs]
    first, pairs = {}, collections.defaultdict(set)
    for d, own in enumerate(lines):
        for p in range(len(own)):
            words, q = 0, p
            while q < len(own) and words < min_words:
                words += own[q][2]
                q += 1
            if words >= min_words:
                d0, p0 = first.setdefault(tuple(x for _, x, _ in own[p:q]), (d, p))
                if (d0, p0) != (d, p):
                    pairs[d].add((d0, p - p0))
    out = {}
    for d, own in enumerate(lines):
        gone = set()
        for d0, shift in pairs[d]:
            run = []
            for p in range(len(own) + 1):
                q = p - shift
                if p < len(own) and 0 <= q < len(lines[d0]) and lines[d0][q][1] == own[p][1]:
                    run.append(own[p])
                    continue
                if sum(n for _, _, n in run) >= min_words:
                    gone |= {k for k, _, _ in run}
                run = []
        out[docs[d][0]] = "\n".join(x for k, x in enumerate(docs[d][2].split("\n")) if k not in gone)
    return out


@pytest.mark.parametrize("seed", [1, 2])
def test_equals_all_shifts(spark, seed):
    rng = random.Random(seed)
    pool = [" ".join(f"w{k}x{i}" for i in range(rng.choice([1, 2, 3, 5, 9]))) for k in range(6)] + ["", "  "]
    passages = [[rng.choice(pool) for _ in range(rng.randint(4, 12))] for _ in range(4)]
    rows = []
    for i in range(70):
        text = []
        for _ in range(rng.randint(1, 6)):
            text += rng.choice(passages) if rng.random() < 0.6 else [rng.choice(pool) for _ in range(rng.randint(1, 8))]
            if rng.random() < 0.2:
                text += [rng.choice(pool)] * rng.randint(2, 12)
        rows.append((i, "\n".join(text)))
    df = spark.createDataFrame(rows, SCHEMA).repartition(3)
    keys = {r.doc_id: bytes(r.k) for r in df.select("doc_id", _key(F.col("doc_id"), F.col("text")).alias("k")).collect()}
    for min_words in (1, 20):
        got = {r.doc_id: r.text for r in line_dedup(df, min_words).collect()}
        assert got == _expected([(i, keys[i], t) for i, t in rows], min_words)


def test_very_long_text_of_one_line(spark):
    """50,000 equal lines are linear work; columns of any name come along."""
    line = "ten words of a log that says the same again"
    rows = [(1, "\n".join([line] * 50_000) + "\nend"), (2, "\n".join([line] * 7)), (3, None), (4, "other")]
    df = spark.createDataFrame(rows, SCHEMA)
    names = ["_gone", "_doc", "gone", "doc", "row", "at", "n_lines"]
    started = time.monotonic()
    out = line_dedup(df.withColumns({c: F.lit("kept") for c in names}))
    got = {r.doc_id: r for r in out.collect()}
    assert time.monotonic() - started < 90
    assert got[1].text == line + "\nend" and (got[1].n_lines, got[1].n_removed) == (50_001, 49_999)
    assert got[2].text == "" and got[2].n_removed == 7 and got[3].text is None and got[4].text == "other"
    assert all(got[4][c] == "kept" for c in names[:-1]) and got[4].n_lines == 1
