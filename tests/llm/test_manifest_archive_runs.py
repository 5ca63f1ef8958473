"""Merkle manifest, archives and periodic runs against plain Python on small fixtures with awkward rows."""

from __future__ import annotations

import collections
import datetime as dt
import hashlib
import io
import random
import struct

import numpy as np
import pyarrow.fs
import pytest
import zstandard
from pyspark.sql import functions as F

from tapeworks.llm import merkle, periodic, warc
from tapeworks.session import shared_dir

DOCS = "doc_id long, text string, lang string, source string, n_chars long, tree string, i int, log string, block int"


def _sha(*parts: str) -> str:
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def _leaf(row, n_chars) -> str:
    values = (row.doc_id, row.source, row.lang, n_chars, row.text)
    return _sha(*["-" if v is None else f"{len(str(v).encode())}:{v}" for v in values])


def _levels(nodes: list[str]) -> list[list[str]]:
    levels = [nodes]
    while len(levels[-1]) > 1:
        below = levels[-1]
        levels.append([_sha(*below[k:k + 2]) for k in range(0, len(below), 2)])
    return levels


def _way(levels: list[list[str]], i: int) -> list[str]:
    return [level[i >> h ^ 1] for h, level in enumerate(levels[:-1]) if i >> h ^ 1 < len(level)]


# --- manifest ------------------------------------------------------------------------------------

@pytest.mark.parametrize("n", [1, 2, 3, 4, 5, 7, 8, 11, 16, 21, 100])
def test_log_is_addressed_in_closed_form(n):
    leaves = [hashlib.sha256(str(k).encode()).digest() for k in range(n)]
    top = (n - 1).bit_length()
    log = merkle.append_log(leaves, top)
    levels = _levels([x.hex() for x in leaves])
    places = {}
    for h, level in enumerate(levels):
        for k, node in enumerate(level):
            places[merkle.position(n, h, k)] = node
    assert [x.hex() for x in log] == [places[k] for k in range(len(log))] and len(places) == len(log)
    for i in range(n):
        way = merkle.siblings(log, n, top, i)
        assert [d.hex() for s, d in way if s != "-"] == _way(levels, i)
        assert merkle.fold(leaves[i], way).hex() == levels[-1][0]
        assert n == 1 or merkle.fold(leaves[i - 1], way) != log[-1]


@pytest.fixture(scope="module")
def rows(spark):
    rng = random.Random(4)
    langs = ["en"] * 30 + ["de", "fr", None, "", "日本", "é"]
    data = [(k, rng.choice(["", "a|b", "é\n", "x" * 50_000]) + str(k), rng.choice(langs), rng.choice(["s", None]), k)
            for k in rng.sample(range(10_000), 150)]
    data += [data[3], data[3], (data[3][0], "other", data[3][2], None, None), (None, None, None, None, None),
             (None, "no id", "en", "s", 2**63 - 1), (7, None, "xx", "s", None)]
    return spark.createDataFrame([(*r, "other", 1, "x", 2) for r in data], DOCS).repartition(5)


def test_manifest(spark, rows):
    wrong = F.col("doc_id") % 3 == 0
    claims = {"n_chars": F.when(wrong, F.col("n_chars").cast("decimal(20, 0)") + 1).otherwise(F.col("n_chars"))}
    given = rows.collect()
    trees = collections.defaultdict(list)
    for r in given:
        trees[r.lang].append(((r.doc_id is not None, r.doc_id or 0), _leaf(r, r.n_chars), r))
    order = sorted(trees, key=lambda t: (t is not None, (t or "").encode()))
    grown = {t: _levels([leaf for _, leaf, _ in sorted(trees[t], key=lambda x: x[:2])]) for t in order}
    crown = _levels([grown[t][-1][0] for t in order])
    want = []
    for k, t in enumerate(order):
        for i, (_, leaf, r) in enumerate(sorted(trees[t], key=lambda x: x[:2])):
            changed = r.doc_id is not None and r.doc_id % 3 == 0 and r.n_chars is not None
            want.append((r.doc_id, leaf, grown[t][-1][0], crown[-1][0], _way(grown[t], i) + _way(crown, k), not changed))
    for bits in (2, 10):
        got = merkle.merkle_manifest(rows, claims, bits=bits).collect()
        assert sorted(map(repr, want)) == sorted(
            repr((r.doc_id, r.leaf, r.subroot, r.root, list(r.siblings), r.verified)) for r in got)
        assert all((r.folded_root == r.root) == r.verified for r in got)


def test_manifest_log_over_builders(spark):
    """The parts of all builders, put in place, are the log that one builder would write."""
    n = 300
    leaves = [hashlib.sha256(str(k).encode()).digest() for k in range(n)]
    df = spark.createDataFrame([("t", k, n, bytearray(x), str(k)) for k, x in enumerate(leaves)],
                               "tree string, i long, n long, node binary, item string").repartition(3)
    forest = merkle.build(df, shared_dir(spark, "forest"), bits=3)
    assert len(forest.levels) == 3
    got = sorted((r.position, bytes(r.node)) for r in merkle.logged_nodes(forest).collect())
    assert got == list(enumerate(merkle.append_log(leaves, 9)))


def test_manifest_of_few_rows(rows):
    assert merkle.merkle_manifest(rows.limit(0)).count() == 0
    one = merkle.merkle_manifest(rows.where("doc_id = 7")).first()
    assert one.leaf == one.subroot == one.root == one.folded_root and one.verified and one.siblings == []


# --- archives ------------------------------------------------------------------------------------

@pytest.fixture(scope="module")
def pages(spark):
    rng = random.Random(8)
    body = lambda n: "".join(rng.choices("<p>abcdefgh é日</p>\r\n", k=n))
    popular, long = "<html>" + body(500), body(400_000)
    data = [(k, f"http://a/{k}", body(rng.randint(0, 4000))) for k in range(120)]
    data += [(200 + k, "http://b", popular) for k in range(40)]
    data += [(190, None, popular), (300, "u", long), (301, "bad url\r\nX: y ", long), (302, "", ""), (303, "u", None),
             (304, "u", ""), (305, "u", "short"), (306, "u", "short"), (307, "u", "é" * 50), (308, "u", "é" * 50),
             (309, "u", "é" * 49), (310, "u", "é" * 49), (None, "u", popular), (None, None, None), (190, "again", popular),
             (311, "u", "\r\n\r\nHTTP/1.1 200 OK\r\n\r\n" * 9), (311, "u", "\r\n\r\nHTTP/1.1 200 OK\r\n\r\n" * 9)]
    return spark.createDataFrame([(*r, "other", 5, "x") for r in data],
                                 "page_id long, url string, html string, digest string, row int, key string").repartition(4)


def _expected(given) -> list:
    by_payload = collections.defaultdict(list)
    for r in given:
        by_payload[r.html or ""].append((r.page_id is None, r.page_id or 0))
    out = []
    for payload, ids in by_payload.items():
        data = payload.encode()
        for k, (none, page) in enumerate(sorted(ids)):
            later = k > 0 and len(data) >= 100
            first = None if min(ids)[0] else min(ids)[1]
            out.append((None if none else page, len(data), hashlib.sha256(data).hexdigest(),
                        "revisit" if later else "response", first if later else None,
                        None if later else data))
    return sorted(map(repr, out))


@pytest.mark.parametrize("size", [1, 20_000, 1 << 28])
def test_archives_round_trip(spark, pages, size):
    folder = shared_dir(spark, "warc")
    warc.write_warc(pages, folder, archive_bytes=size, date=dt.datetime(2020, 2, 3, 4, 5, 6))
    got = warc.read_warc(spark, folder).where("record_type <> 'warcinfo' or problem is not null")
    got = got.withColumn("page_id", warc.page_of("record_id")).withColumn("first", warc.page_of("refers_to")).collect()
    assert all(r.problem is None and r.date == "2020-02-03T04:05:06Z" for r in got)
    assert sorted(repr((r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.first,
                        None if r.payload is None else bytes(r.payload))) for r in got) == _expected(pages.collect())
    known = {r.record_id: r.payload_digest for r in got if r.record_type == "response"}
    assert all(known[r.refers_to] == r.payload_digest for r in got if r.record_type == "revisit")
    assert {r.target_uri for r in got if r.page_id == 301} == {"bad%20url%0D%0AX:%20y "}
    archives = spark.read.parquet(f"{folder}/archives").collect()
    assert sum(r.records for r in archives) == pages.count() and (len(archives) > 100) == (size == 1)
    fs, base = pyarrow.fs.FileSystem.from_uri(folder)
    assert {r.name: r.bytes for r in archives} == {
        f.base_name: f.size for f in fs.get_file_info(pyarrow.fs.FileSelector(base)) if f.base_name.endswith(".zst")}


def test_no_pages(spark, pages):
    folder = shared_dir(spark, "warc")
    warc.write_warc(pages.limit(0), folder)
    assert warc.read_warc(spark, folder).count() == 0


def _archive(records: list[bytes], squeeze: bool = False) -> bytes:
    rng = random.Random(1)
    samples = ["".join(rng.choices("abc <p>", k=5000)).encode() for _ in range(60)]
    dictionary = warc.train_dictionary(samples)
    frame = warc.dictionary_frame(dictionary)
    if squeeze:
        data = zstandard.compress(dictionary.as_bytes())
        frame = struct.pack("<II", 0x184D2A5D, len(data)) + data
    coder = zstandard.ZstdCompressor(dict_data=dictionary)
    return frame + b"".join(coder.compress(r) for r in records)


def _response(payload: bytes = b"<p>abc</p>", **changed: str) -> bytes:
    headers = {"WARC-Type": "response", "WARC-Record-ID": "<urn:page:1:0>", "WARC-Date": "2020-01-01T00:00:00Z",
               "WARC-Payload-Digest": f"sha256:{hashlib.sha256(payload).hexdigest()}"} | changed
    http = f"HTTP/1.1 200 OK\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    return warc.record({k: v for k, v in headers.items() if v}, http + payload)


@pytest.mark.parametrize("squeeze", [False, True])
def test_frames_load_the_dictionary_and_skip(squeeze):
    records = [_response(b"a" * n) for n in (0, 10, 3_000_000)]
    raw = _archive(records, squeeze)
    found = list(warc.frames(io.BytesIO(raw)))
    assert [x for _, x in found] == records
    assert all(raw[at:at + 4] == warc.FRAME_MAGIC for at, _ in found)
    with pytest.raises(warc.BadRecord):  # without its dictionary
        list(warc.frames(io.BytesIO(raw[found[0][0]:])))
    other = struct.pack("<II", 0x184D2A51, 3) + b"xyz"
    plain = zstandard.compress(records[0])
    assert [x for _, x in warc.frames(io.BytesIO(other + plain + other + plain))] == records[:1] * 2
    for cut in (2, 6, 11 + len(plain) - 3, 11 + len(plain) + 5):
        with pytest.raises(warc.BadRecord):
            list(warc.frames(io.BytesIO((other + plain + other)[:cut])))


@pytest.mark.parametrize("spoil", [
    lambda r: r.replace(b"WARC/1.1", b"WARC/3.0"), lambda r: r[:-1], lambda r: r + b"x",
    lambda r: r.replace(b"<p>abc", b"<p>abd"), lambda r: r.replace(b"WARC-Date", b"WARC-Dote"),
    lambda r: r.replace(b"WARC-Type: response", b"WARC-Type response"), lambda r: r.replace(b"\r\nContent-Length: ", b"\r\nContent-Length: +", 1),
    lambda r: b"", lambda r: _response(**{"WARC-Type": "revisit"}),
    lambda r: _response(**{"WARC-Payload-Digest": "sha256:00"}), lambda r: _response(**{"WARC-Record-ID": ""}),
    lambda r: r.replace(b"WARC-Date:", b"WARC-Type: x\r\nWARC-Date:"),
    lambda r: warc.record({"WARC-Type": "response", "WARC-Record-ID": "<a>", "WARC-Date": "x"}, b"no http")])
def test_bad_records_are_told(spoil):
    good = _response()
    assert warc.parse_record(good)["payload"] == b"<p>abc</p>"
    with pytest.raises(warc.BadRecord):
        warc.parse_record(spoil(good))


def test_bad_archives_are_told(spark):
    folder = shared_dir(spark, "warc")
    fs, base = pyarrow.fs.FileSystem.from_uri(folder)
    fs.create_dir(base)
    good = _response()
    raw = {"a.warc.zst": _archive([good, good[:-1], good]), "b.warc.zst": _archive([good, good])[:-4]}
    for name, data in raw.items():
        with fs.open_output_stream(f"{base}/{name}", compression=None) as out:
            out.write(data)
    spark.createDataFrame([(n, len(d), 1) for n, d in raw.items()], "name string, bytes long, records long") \
        .write.parquet(f"{folder}/archives")
    got = sorted((r.archive, r.offset, r.problem is None) for r in warc.read_warc(spark, folder).collect())
    assert [(a, ok) for a, _, ok in got] == [("a.warc.zst", True), ("a.warc.zst", False), ("a.warc.zst", True),
                                            ("b.warc.zst", True), ("b.warc.zst", False)]


# --- periodic runs -------------------------------------------------------------------------------

def _runs(words: list) -> list[tuple[int, int, int]]:
    """All runs by comparing words at every distance."""
    n, found = len(words), {}
    for q in range(1, n // 4 + 1):
        i = 0
        while i + q < n:
            if words[i] != words[i + q]:
                i += 1
                continue
            start = i
            while i + q < n and words[i] == words[i + q]:
                i += 1
            if i - start + q >= max(6, 4 * q):
                found.setdefault((start, i - start + q), q)
    return sorted((s, length, q) for (s, length), q in found.items())


def _collapsed(words: list[str], runs: list) -> str:
    gone = {k for s, n, q in runs for k in range(s + q, s + n)}
    return " ".join(w for k, w in enumerate(words) if k not in gone)


def _awkward_words() -> list[list[str]]:
    rng = random.Random(12)
    texts = [[], ["one"], ["a"] * 5, ["a"] * 6, ["a"] * 300, ["a", "b"] * 4, ["a", "b"] * 4 + ["a"], ["a", "b"] * 3 + ["a"]]
    for _ in range(250):
        letters = "ab" if rng.random() < 0.3 else "abcdefghijklmnop"
        parts = [rng.choices(letters, k=rng.randint(0, 30))]
        for _ in range(rng.randint(0, 4)):
            period = rng.choices(letters, k=rng.choice([1, 2, 3, 4, 5, 6, 7, 8, 9, 15, 16, 17, 31, 32, 33, 40, 64, 65]))
            length = rng.randint(3 * len(period), 6 * len(period)) + rng.randint(-1, 1)
            parts.append((period * 7)[:length])
            parts.append(rng.choices(letters, k=rng.randint(0, 5)))
        texts.append([w for p in parts for w in p])
    inner = (["x"] * 7 + ["y"]) * 3 + ["z"]
    texts += [inner * 5, inner * 4, (inner * 4)[:-1], texts[-1], texts[-1]]
    return texts


def test_runs_equal_all_distances():
    texts = _awkward_words()
    for step in (1, 7, len(texts)):  # alone and together
        for k in range(0, len(texts), step):
            some = texts[k:k + step]
            found = periodic.runs_of_texts([" ".join(t).encode() for t in some], 6, 4)
            for words, (n, runs, collapsed) in zip(some, found):
                want = _runs(words)
                assert n == len(words) and [tuple(r) for r in runs.tolist()] == want
                assert collapsed.decode() == _collapsed(words, want)


def test_long_texts_of_runs():
    rng = random.Random(5)
    period = [f"w{rng.randrange(10**6)}" for _ in range(1000)]
    for words, want in (
            (["same"] * 200_000, [(0, 200_000, 1)]), (period * 100 + ["end"], [(0, 100_000, 1000)]),
            (["pre"] + (["a", "b", "c", "d", "e"] * 30_000), [(1, 150_000, 5)]),
            ([str(k) for k in range(100_000)], [])):
        (n, runs, _), = periodic.runs_of_texts([" ".join(words).encode()], 6, 4)
        assert [tuple(r) for r in runs.tolist()] == want and n == len(words)


def test_periodic_runs(spark):
    texts = [" ".join(t) for t in _awkward_words()] + [None, "", " \t\n", "é\xa0é x y\x0bz\x1c\n" * 5]
    rows = [(k, t, "other", 1) for k, t in enumerate(texts)] + [(3, texts[3], "o", 2), (None, texts[20], "o", 3)]
    df = spark.createDataFrame(rows, "doc_id long, text string, runs string, start int").repartition(3)
    want = []
    for k, t, *_ in rows:
        words = [w for w in warc.re.split(r"[\x20\x09-\x0D]+", t or "") if w]
        want.append(repr((k, len(words), _runs(words), _collapsed(words, _runs(words)))))
    got = periodic.periodic_runs(df).collect()
    assert sorted(repr((r.doc_id, r.n_words, [tuple(x) for x in r.runs], r.collapsed)) for r in got) == sorted(want)
    assert periodic.periodic_runs(df.limit(0)).count() == 0
    with pytest.raises(ValueError):
        periodic.periodic_runs(df, times=3)


def test_selected_grams_are_window_minima():
    rng = np.random.default_rng(3)
    for width in (1, 2, 8):
        values = rng.integers(0, 20, 100).astype(np.uint64)
        want = {p for i in range(100 - width + 1) for p in range(i, i + width) if values[p] == values[i:i + width].min()}
        assert set(periodic._selected(values, width).tolist()) == want
