"""Operators next to their SQL on documents with nulls, ties, repeated rows and hot groups."""

from __future__ import annotations

import random

import duckdb
import pytest

from tapeworks.llm import queries

WORDS = [f"w{i}" for i in range(300)] + ["é", "naïve", "日本", "a#b", "$", "||"]


def _documents():
    rng = random.Random(11)
    text = lambda n: " ".join(rng.choices(WORDS, k=n))
    passage = "\n".join(text(12) for _ in range(6))
    long = text(120).split(" ")
    rows = [(0, None, None), (1, "", "a"), (2, "", "a"), (3, " \t\n", "b"), (4, "one", None), (5, "one", "b"),
            (5, "one", "b"), (None, "one", "a"), (None, None, None), (6, "x\n" * 40, "c"),
            (7, "the same five words again " * 30, "c"), (8, " ".join(long), "a"), (9, " ".join(long), "b"),
            (10, "\n" + passage + "\n\n", "a"), (11, passage, "hot"), (12, passage + "\n" + passage, "hot"),
            (13, text(30) + "\n" + passage.replace("\n", "  \r\n") + "\n" + text(5), None)]
    for i in range(30):  # near copies in a chain: each is like the next, the ends differ
        long[4 * i] = f"n{i}"
        rows.append((20 + i, " ".join(long), "hot"))
    rows += [(100 + i, text(rng.randrange(0, 90)) + "\n" * (i % 3) + text(20), f"s{i % 4}") for i in range(60)]
    return [(i, t, "en", s, None if t is None else len(t)) for i, t, s in rows]


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    out = str(tmp_path_factory.mktemp("documents"))
    (spark.createDataFrame(_documents(), "doc_id LONG, text STRING, lang STRING, source STRING, n_chars INT")
     .coalesce(1).write.parquet(f"{out}/documents.parquet"))
    pages = [(None if i is None else i % 90, None if i is None else f"http://x/{i}", t) for i, t, *_ in _documents()]
    (spark.createDataFrame(pages, "page_id LONG, url STRING, html STRING")
     .coalesce(1).write.parquet(f"{out}/pages.parquet"))
    return out


@pytest.mark.parametrize("name", sorted(queries.ORACLE))
def test_equals_sql(spark, folder, name):
    con = duckdb.connect()
    for table in ("documents", "pages"):
        con.execute(f"create view {table} as select * from '{folder}/{table}.parquet/*.parquet'")
    theirs = con.sql(queries.ORACLE[name])
    ours = queries.QUERIES[name](spark, folder)
    assert sorted(ours.columns) == sorted(theirs.columns)
    got = sorted((tuple(r[c] for c in theirs.columns) for r in ours.collect()), key=repr)
    assert got == sorted(theirs.fetchall(), key=repr)
    assert got


@pytest.mark.parametrize("name", ["op11_merkle_manifest", "op13_periodic_runs"])
def test_null_ids_equal_sql(spark, tmp_path, name):
    """A NULL id has the CRC 0: its row is tampered with, its text gets a period."""
    text = " ".join(f"w{i}" for i in range(40))
    rows = [(None, text, "en", "s", 1), (None, "a b c", "de", None, None), (None, None, None, "s", 0), (1, text, "en", "s", 1)]
    (spark.createDataFrame(rows, "doc_id LONG, text STRING, lang STRING, source STRING, n_chars INT")
     .coalesce(1).write.parquet(str(tmp_path / "documents.parquet")))
    con = duckdb.connect()
    con.execute(f"create view documents as select * from '{tmp_path}/documents.parquet/*.parquet'")
    theirs = con.sql(queries.ORACLE[name])
    got = [tuple(r[c] for c in theirs.columns) for r in queries.QUERIES[name](spark, str(tmp_path)).collect()]
    assert sorted(got, key=repr) == sorted(theirs.fetchall(), key=repr)
