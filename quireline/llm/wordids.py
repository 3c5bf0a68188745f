"""Token ids of whole texts from a public vocabulary of lower-case words with word ends, by the tokenizers library.

The vocabulary's splitter never joins what white space or its pattern parts, so equal parts have equal ids: the library
encodes each part once per worker, a bounded table keeps it, and Arrow deals its ids to all places of the words that hold it.
That is for texts of characters of known class; any other one goes through the library as a whole, so ids never depend on the
path taken.
"""

from __future__ import annotations

import re
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

# Letters, digits, white space and signs that no normalisation but lower case changes, and whose lower case is here too: Latin
# (but for I with a dot, whose lower case is two characters) and Cyrillic letters, ASCII, the common typographic signs.
_LETTERS = "A-Za-zªµºÀ-ÖØ-öø-įı-ſЀ-ҁҊ-ӿ"
OTHER = f"[^\\t\\n\\x0b\\x0c\\r -~{_LETTERS}¡¿«»‘’“”–—…€£·©®°§×÷]"
_PARTS = re.compile(f"'s|'t|'re|'ve|'m|'ll|'d|[{_LETTERS}]+|[0-9]|[^\\s{_LETTERS}0-9]+")

#: Parts in a generation of a worker's table; beyond so many a new one begins and the one before it stays, so that what is common
#: is kept. About 100 MB.
CACHE_PARTS = 300_000
#: Longer parts are encoded anew in each batch of texts; the library is given so many parts at a time.
CACHE_LENGTH, TOGETHER = 64, 500


class WordIds:
    """Ids of texts as bytes, two for each id, little-endian."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        self.library.encode_special_tokens = True  # their names in a text are ordinary text
        names = self.library.get_vocab()
        if max(names.values()) >= 1 << 16:
            raise ValueError(f"{path} has ids of more than two bytes")
        self.last = np.zeros(1 << 16, bool)  # ids that end a part
        self.last[[i for name, i in names.items() if name.endswith("</w>")]] = True
        self.parts: dict[str, bytes] = {}
        self.before: dict[str, bytes] = {}

    def whole(self, text: str) -> bytes:
        return np.array(self.library.encode(text, add_special_tokens=False).ids, "<u2").tobytes()

    def _learn(self, parts: set[str]) -> None:
        """Puts parts that the table lacks into it; new ones go to the library between spaces, many at a time."""
        new = parts.difference(self.parts)
        known = new.intersection(self.before)
        self.parts.update(zip(known, map(self.before.__getitem__, known), strict=True))
        new = list(new - known)
        for k in range(0, len(new), TOGETHER):
            own = new[k : k + TOGETHER]
            ids = np.array(self.library.encode(" ".join(own), add_special_tokens=False).ids, "<u2")
            ends = (2 * (1 + np.flatnonzero(self.last[ids]))).tolist()
            raw = ids.tobytes()
            if len(ends) != len(own):
                raise ValueError("the vocabulary has parts without an end")
            self.parts.update(zip(own, (raw[i:j] for i, j in zip([0, *ends], ends, strict=False)), strict=True))

    def _of(self, words: list[str]) -> list[bytes]:
        """Ids of lower-case words; a word is one part or more, or none."""
        split = {w: _PARTS.findall(w) for w in words if not w.isalpha()}
        if len(self.parts) > CACHE_PARTS:
            self.parts, self.before = {}, self.parts
        needed = set(words).difference(split).union(chain.from_iterable(split.values()))
        self._learn(needed)
        get = self.parts.__getitem__
        out = [b"".join(map(get, split[w])) if w in split else get(w) for w in words]
        for p in needed:
            if len(p) > CACHE_LENGTH:
                del self.parts[p]
        return out

    def packed(self, texts: pa.Array) -> list[bytes]:
        """Null has the ids of the empty text: none. Each different word of a batch is looked up once."""
        texts = texts.fill_null("")
        other = pc.match_substring_regex(texts, OTHER)
        words = pc.ascii_split_whitespace(pc.utf8_lower(pc.if_else(other, "", texts)))
        coded = words.flatten().dictionary_encode()
        taken = pa.array(self._of(coded.dictionary.to_pylist()), pa.large_binary()).take(coded.indices)
        ends = np.frombuffer(taken.buffers()[1], np.int64)[: len(taken) + 1][words.offsets.to_numpy() - words.offsets[0].as_py()].tolist() if len(taken) else [0] * (len(texts) + 1)
        raw = memoryview(taken.buffers()[2]) if len(taken) and taken.buffers()[2] else b""
        out = [bytes(raw[a:b]) for a, b in zip(ends, ends[1:], strict=False)]
        for k in np.flatnonzero(other.to_numpy(zero_copy_only=False)).tolist():
            out[k] = self.whole(texts[k].as_py())
        return out


_LOADED: dict[str, WordIds] = {}


def word_ids(path: str) -> WordIds:
    """One encoder a worker process and vocabulary."""
    if path not in _LOADED:
        _LOADED[path] = WordIds(path)
    return _LOADED[path]


def public_vocabulary(name: str = "word_bpe_49k") -> str:
    import public_tokenizers

    return public_tokenizers.path(f"{name}.json")
