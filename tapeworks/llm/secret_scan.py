"""Secrets in texts: fixed patterns, and windows of high entropy in candidate strings."""

from __future__ import annotations

import hashlib
import math
import re
from collections.abc import Iterable

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tapeworks.llm.common import field, slices

# The base patterns, the least lengths, the kinds in order.
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
                    re.IGNORECASE | re.ASCII)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]+")
LEAST = {"assign": 6, "access": 20, "hex": 24}
KINDS = ("assign", "access", "hex", "entropy")

# A run of 24 or more is what a hex match needs; the shorter runs of the same text drop out anyway.
LONG_HEX = re.compile(r"(?<![0-9a-f])[0-9a-f]{24,}")
CANDIDATE = re.compile(r"[A-Za-z0-9+/_-]{20,}={0,2}")
# What looks random but is public: identifiers, digests named as such, ordinary words joined by signs.
ALLOWED = tuple(re.compile(p) for p in (
    r"[0-9a-fA-F]{8}(-[0-9a-fA-F]{4}){3}-[0-9a-fA-F]{12}",
    r"(?i)(sha(1|224|256|384|512)|md5)[-_=][0-9A-Za-z+/]+={0,2}",
    r"([A-Z]?[a-z]+|[A-Z]+)([-_/]+([A-Z]?[a-z]+|[A-Z]+))+",
    r"[A-Z]?[a-z]{2,}([A-Z][a-z]{2,})+",
    r"(?i)abcdefghijklmnopqrstuvwxyz[0-9]*|0123456789[0-9a-f]*",
))
# Character classes, the first that holds all characters counts: class, window, least bits per character.
CLASSES = (
    ("digits", re.compile(r"[0-9]+"), 24, 3.0),
    ("hex", re.compile(r"[0-9a-f]+|[0-9A-F]+"), 20, 3.0),
    # Words and names have no digit either, so such strings must be more random.
    ("letters", re.compile(r"[A-Za-z+/_=-]+"), 20, 3.8),
    ("base64", re.compile(r"[A-Za-z0-9+/_=-]+"), 20, 3.8),
)


def entropy_windows(text: str, width: int, least: float) -> tuple[int, int] | None:
    """From the first to the last window of ``width`` characters with ``least`` bits per character.

    The sum of n log2 n over character counts n changes by two terms when the window moves by one.
    """
    terms = [0.0] + [n * math.log2(n) for n in range(1, width + 2)]
    counts: dict[str, int] = {}
    total, limit, first, last = 0.0, width * (math.log2(width) - least), -1, -1
    for at, char in enumerate(text):
        n = counts.get(char, 0)
        counts[char] = n + 1
        total += terms[n + 1] - terms[n]
        if at >= width:
            old = text[at - width]
            n = counts[old]
            counts[old] = n - 1
            total += terms[n - 1] - terms[n]
        if at >= width - 1 and total <= limit + 1e-9:
            first, last = (at - width + 1 if first < 0 else first), at + 1
    return None if first < 0 else (first, last)


def entropy_spans(text: str) -> list[tuple[int, int]]:
    spans = []
    for match in CANDIDATE.finditer(text):
        value = match.group()
        if any(p.fullmatch(value) for p in ALLOWED):
            continue
        for _, chars, width, least in CLASSES:
            if chars.fullmatch(value):
                if found := entropy_windows(value, width, least):
                    spans.append((match.start() + found[0], match.start() + found[1]))
                break
    return spans


def base_spans(text: str) -> list[tuple[int, int, str]]:
    spans = []
    if ":" in text or "=" in text:
        spans = [(m.start(), m.end(), "assign") for m in ASSIGN.finditer(text)
                 if m.end(2) - m.start(2) >= LEAST["assign"]]
    spans += [(m.start(), m.end(), "access") for m in ACCESS.finditer(text)
              if m.end() - m.start() >= LEAST["access"]]
    spans += [(m.start(), m.end(), "hex") for m in LONG_HEX.finditer(text)]
    return spans


def find_secrets(text: str) -> tuple[list[tuple[int, int, str]], list[tuple[int, int, str]]]:
    """Base spans and all spans (start, end, kind), by start and kind.

    The method adds the windows of high entropy that no base span overlaps.
    """
    order = lambda s: (s[0], KINDS.index(s[2]))
    base = sorted(base_spans(text), key=order)
    added, reached, k = [], 0, 0  # both lists go by start, so one sweep tells what overlaps
    for a, b in entropy_spans(text):
        while k < len(base) and base[k][0] < b:
            reached, k = max(reached, base[k][1]), k + 1
        if reached <= a:
            added.append((a, b, "entropy"))
    return base, sorted(base + added, key=order)


def spell(spans: Iterable[tuple[int, int, str]]) -> str:
    return ",".join(f"{kind}:{start}:{end}" for start, end, kind in spans)


def secret_scan(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Secrets of every text: doc_id, n_assign, n_access, n_hex, base_sha256, spans, n_entropy.

    Rows keep their number: NULL and empty texts have no spans, repeated rows are scanned each, other
    columns are ignored, an empty table gives no row. Very long texts are scanned whole, in time that grows
    with their length. Row by row, without a shuffle.
    """
    schema = T.StructType([field(docs, doc_id, "doc_id"),
                           *[T.StructField(f"n_{k}", T.LongType()) for k in KINDS[:3]],
                           T.StructField("base_sha256", T.StringType()),
                           T.StructField("spans", T.StringType()), T.StructField("n_entropy", T.LongType())])

    def scan(batches):
        for batch in slices(batches):
            found = [find_secrets(x) for x in batch.column(1).to_pylist()]
            count = lambda kind: pa.array([sum(s[2] == kind for s in a) for _, a in found], pa.int64())
            yield pa.record_batch(
                [batch.column(0), *[count(k) for k in KINDS[:3]],
                 pa.array([hashlib.sha256(spell(b).encode()).hexdigest() for b, _ in found]),
                 pa.array([spell(a) for _, a in found]), count("entropy")],
                [f.name for f in schema])

    return docs.select(docs[doc_id].alias("doc_id"), F.coalesce(docs[text], F.lit("")).alias("text")) \
        .mapInArrow(scan, schema)
