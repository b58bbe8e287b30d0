"""Exact ids of the public word BPE, with each distinct word encoded once per Python worker.

White space is a hard border for this tokenizer (its pattern never matches it and its
normaliser maps single characters), so a text's ids are the ids of its chunks between
spaces and newlines, one after another.  Chunks of ASCII and Latin-1 letters go to the
model piece by piece; every other chunk, and every text that may hold a special token,
goes to the full tokenizer.
"""

from __future__ import annotations

import re

from ._shared import CACHE_ENTRIES, CACHE_KEY, Memory, process_cache

#: Same alternatives as in the tokenizer file, for chunks of plain characters.
PIECES = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[a-zß-öø-ÿ]+|[0-9]|[^\sa-zß-öø-ÿ0-9]+")
PLAIN = re.compile(r"[!-~À-ÖØ-öø-ÿ]*")


def byte_letters() -> dict[int, str]:
    """The printable stand-in of each byte in byte-level vocabularies: printable Latin-1 stands for itself, the rest from 256 on."""
    own = [*range(ord("!"), ord("~") + 1), *range(ord("¡"), ord("¬") + 1), *range(ord("®"), ord("ÿ") + 1)]
    rest = [b for b in range(256) if b not in own]
    return {b: chr(b) for b in own} | {b: chr(256 + i) for i, b in enumerate(rest)}


class WordEncoder:
    """``ids(text)``: the ids as little-endian unsigned 32-bit bytes."""

    def __init__(self, path: str):
        import os

        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        cache = process_cache(f"bpe:{path}")
        self.chunks, self.pieces = Memory(self.chunk, cache.setdefault("chunks", {})), cache.setdefault("pieces", {})
        self.letters = byte_letters()
        self.model = self.tokenizer.model.tokenize
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]

    def whole(self, text: str) -> bytes:
        return b"".join(i.to_bytes(4, "little") for i in self.tokenizer.encode(text, add_special_tokens=False).ids)

    def chunk(self, chunk: str) -> bytes:
        if not PLAIN.fullmatch(chunk):
            return self.whole(chunk)
        out = []
        for piece in PIECES.findall(chunk.lower()):
            ids = self.pieces.get(piece)
            if ids is None:
                word = piece if piece.isascii() else "".join(self.letters[b] for b in piece.encode())
                ids = b"".join(t.id.to_bytes(4, "little") for t in self.model(word))
                if len(piece) <= CACHE_KEY:
                    if len(self.pieces) >= CACHE_ENTRIES // 4:
                        self.pieces.clear()
                    self.pieces[piece] = ids
            out.append(ids)
        return b"".join(out)

    def ids(self, text: str) -> bytes:
        if any(s in text for s in self.special):
            return self.whole(text)
        chunks = text.replace("\n", " ").split(" ")
        n = Memory.SLICE
        return b"".join(self.chunks.values(chunks[at : at + n], b"".join) for at in range(0, len(chunks), n))
