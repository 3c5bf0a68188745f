"""Token ids of whole texts from a public byte-level BPE vocabulary.

A byte-level BPE splits a text by a fixed pattern and merges inside each part, so equal parts have
equal ids: they are encoded once per worker and kept in a bounded table. Texts whose characters are
all of known class are split by a compiled pattern of explicit classes; any other text goes through
the encoder's own splitter, so ids never depend on the path taken.
"""

from __future__ import annotations

import base64
import re
import struct

# Characters whose class the fast pattern states: letters of the Latin and Cyrillic blocks, digits,
# ASCII white space, ASCII punctuation and the common typographic signs.
_LETTERS = "A-Za-zªµºÀ-ÖØ-öø-ɏЀ-ҁҊ-ӿ"
_SAFE = re.compile(f"[^\\t\\n\\x0b\\x0c\\r -~{_LETTERS}¡¿«»‘’“”–—…€£·©®°§×÷]")
_PARTS = re.compile(f"'(?:[stmd]|re|ve|ll)| ?[{_LETTERS}]+| ?[0-9]+| ?[^\\s{_LETTERS}0-9]+|\\s+(?!\\S)|\\s+")

#: Entries of a worker's table of parts; beyond it the table starts anew. About 60 MB.
CACHE_PARTS = 400_000


class _Parts(dict):
    """Part of a text -> its ids as little-endian unsigned 32-bit integers."""

    def __init__(self, encode):
        super().__init__()
        self.encode = encode

    def __missing__(self, part: str) -> bytes:
        ids = self.encode(part)
        if len(self) >= CACHE_PARTS:
            self.clear()
        packed = self[part] = struct.pack(f"<{len(ids)}I", *ids)
        return packed


class ByteBPE:
    """Encoder of one vocabulary file; ``packed(text)`` has four bytes an id."""

    def __init__(self, ranks_path: str, pattern: str):
        import tiktoken

        with open(ranks_path, "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in (line.split() for line in f if line.strip())}
        bpe = tiktoken.Encoding(ranks_path, pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
        self.plain = bpe.encode_ordinary
        self.parts = _Parts(getattr(bpe, "_encode_single_piece", bpe.encode_ordinary))

    def packed(self, text: str | None) -> bytes:
        """Null has the ids of the empty text: none."""
        if not text:
            return b""
        if _SAFE.search(text):
            ids = self.plain(text)
            return struct.pack(f"<{len(ids)}I", *ids)
        return b"".join(map(self.parts.__getitem__, _PARTS.findall(text)))


def counts(text: str | None, encoders: list[ByteBPE]) -> list[int]:
    """How many ids a text has in each vocabulary; it is split once for all."""
    if not text:
        return [0] * len(encoders)
    if _SAFE.search(text):
        return [len(e.plain(text)) for e in encoders]
    parts = _PARTS.findall(text)
    return [len(b"".join(map(e.parts.__getitem__, parts))) // 4 for e in encoders]


_LOADED: dict[tuple[str, str], ByteBPE] = {}


def encoder(ranks_path: str, pattern: str) -> ByteBPE:
    """One encoder a worker process and vocabulary."""
    if (ranks_path, pattern) not in _LOADED:
        _LOADED[ranks_path, pattern] = ByteBPE(ranks_path, pattern)
    return _LOADED[ranks_path, pattern]


def public_vocabulary(name: str = "byte_bpe_50k") -> tuple[str, str]:
    """(file of ranks, pattern) of a public byte-level vocabulary, the one its ``.json`` file describes too."""
    import public_tokenizers

    return public_tokenizers.path(f"{name}.tiktoken"), public_tokenizers.PATTERN
