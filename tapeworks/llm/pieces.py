"""Pre-tokens of byte-level BPE, each distinct one encoded once per worker.

A text is cut at its single spaces and line ends, where a pre-token always begins, and every distinct
chunk between them is encoded once and looked up afterwards. White space that stands beside other
white space decides together where pre-tokens begin, so a text with such a place is split by the
pattern as a whole. Caches are emptied when they reach a fixed number of entries.
"""

from __future__ import annotations

import itertools
import json
from collections.abc import Callable, Iterable
from typing import Any

import regex

# Fixed value: the pre-token pattern that the vocabulary was made with.
PRETOKEN = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+")


def byte_letters() -> list[str]:
    """The printable letter that stands for each byte in a byte-level vocabulary."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    spare = iter(range(256, 512))
    return [chr(b) if b in shown else chr(next(spare)) for b in range(256)]


def is_plain_byte_bpe(settings: dict) -> bool:
    """Whether a tokenizers file is byte-level BPE without anything that looks beyond a pre-token."""
    first, model = settings.get("pre_tokenizer") or {}, settings["model"]
    return (model["type"] == "BPE" and first.get("type") == "ByteLevel" and first.get("use_regex", True)
            and not first.get("add_prefix_space") and not settings.get("normalizer")
            and not any(model.get(k) for k in ("dropout", "continuing_subword_prefix",
                                               "end_of_word_suffix", "ignore_merges", "unk_token"))
            and not any(t[k] for t in settings.get("added_tokens", ())
                        for k in ("single_word", "lstrip", "rstrip", "normalized")))


def read_settings(path: str) -> dict:
    with open(path, encoding="utf-8") as file:
        return json.load(file)


class PieceCache:
    """Encodes texts through ``encode`` (distinct pre-tokens to values) and ``join`` (values to one).

    ``special`` holds the values of strings that are tokens of their own wherever they stand.
    """

    def __init__(self, encode: Callable[[list[str]], list], join: Callable[[Iterable], Any],
                 special: dict[str, Any], limit: int = 400_000) -> None:
        self.encode, self.join, self.special, self.limit = encode, join, special, limit
        self.cut = regex.compile("(" + "|".join(map(regex.escape, sorted(special, key=len, reverse=True)))
                                 + ")") if special else None
        self.pieces: dict[str, Any] = {}
        self.chunks: dict[str, Any] = {}

    def pretokens(self, text: str) -> list[str]:
        if not any(mark in text for mark in self.special):
            return PRETOKEN.findall(text)
        out: list[str] = []
        for part in self.cut.split(text):
            out += [part] if part in self.special else PRETOKEN.findall(part)
        return out

    def learn(self, pieces: Iterable[str]) -> None:
        if len(self.pieces) > self.limit:
            self.pieces = {}
        self.pieces.update(self.special)
        new = list(set(pieces).difference(self.pieces))
        self.pieces.update(zip(new, self.encode(new)))

    def _split(self, chunk: str) -> Iterable[str] | None:
        """Pre-tokens of a chunk, with the space before it; None where its white space is not alone."""
        if chunk.isalpha():
            return (" " + chunk,)
        if chunk[:-1].isalpha() and chunk[-1] in ".,":
            return " " + chunk[:-1], chunk[-1]
        line = chunk[:1] == "\n"
        body = chunk[1:] if line else chunk
        if not body or body.split() != [body]:
            return None
        return self.pretokens(chunk if line else " " + chunk)

    def _learn_chunks(self, rows: list[list[str]]) -> dict[str, Any]:
        """Fill the caches for some texts' chunks; returns the values of their first chunks."""
        if len(self.chunks) > self.limit:
            self.chunks = {}
        seen: set[str] = set()
        for row in rows:
            seen.update(row)
        new = list(seen.difference(self.chunks))
        split = list(map(self._split, new))
        firsts = {row[0]: self.pretokens(row[0]) for row in rows}
        self.learn(itertools.chain(itertools.chain.from_iterable(filter(None, split)), *firsts.values()))
        look, join, chunks = self.pieces.__getitem__, self.join, self.chunks
        for chunk, parts in zip(new, split):
            if parts is None:
                chunks[chunk] = None
            else:
                chunks[chunk] = look(parts[0]) if len(parts) == 1 else join(map(look, parts))
        return {text: join(map(look, parts)) for text, parts in firsts.items()}

    def __call__(self, texts: list[str]) -> list:
        rows = [text.replace("\n", " \n").split(" ") for text in texts]
        firsts = self._learn_chunks(rows)
        out, chunk, join = [], self.chunks.__getitem__, self.join
        for text, row in zip(texts, rows):
            first = firsts[row[0]]
            row[0] = ""
            try:
                out.append(join((first, join(map(chunk, itertools.islice(row, 1, None))))))
            except TypeError:  # a chunk that is None
                parts = self.pretokens(text)
                self.learn(parts)
                out.append(join(map(self.pieces.__getitem__, parts)))
        return out
