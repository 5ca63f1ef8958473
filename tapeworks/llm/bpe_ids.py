"""Ids of the tokenizers library as bytes, whole texts at a time."""

from __future__ import annotations

import functools
import sys
from array import array
from collections.abc import Callable

from tokenizers import Tokenizer

from tapeworks.llm.pieces import PieceCache, byte_letters, is_plain_byte_bpe, read_settings


@functools.cache
def encoder(path: str) -> Callable[[list[str]], list[bytes]]:
    """Function from texts to their ids as little-endian unsigned 32-bit integers.

    No begin, end or padding ids; special strings inside texts become their tokens, as is the
    library's default. One encoder per worker and file. Byte-level BPE files go through the library's
    model once per distinct pre-token; any other file is encoded text by text.
    """
    tokenizer = Tokenizer.from_file(path)
    tokenizer.no_padding()
    tokenizer.no_truncation()
    settings = read_settings(path)

    def as_bytes(ids: list[int]) -> bytes:
        out = array("I", ids)
        if sys.byteorder == "big":
            out.byteswap()
        return out.tobytes()

    if not is_plain_byte_bpe(settings):
        return lambda texts: [as_bytes(e.ids) for e in
                              tokenizer.encode_batch_fast(texts, add_special_tokens=False)]
    model, letters = tokenizer.model, byte_letters()
    shown = dict(enumerate(letters))

    def spelled(piece: str) -> str:
        if piece.isascii() and piece.isprintable():
            return piece.replace(" ", letters[32])
        return piece.encode().decode("latin-1").translate(shown)

    def encode(pieces: list[str]) -> list[bytes]:
        return [as_bytes([t.id for t in model.tokenize(spelled(p))]) for p in pieces]

    special = {t["content"]: as_bytes([t["id"]]) for t in settings.get("added_tokens", ())}
    return PieceCache(encode, b"".join, special)
