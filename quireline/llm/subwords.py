"""Hashed features of whole texts, a block of texts at a time in numpy: words and character n-grams within words.

Texts are lower-cased and laid out as one array of code points, each between spaces, so a text begins at a known
place, no n-gram runs from one word or text into the next, and pooling over a text is one ``reduceat``.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quireline.llm.common import held_out

#: Characters of texts that are laid out together, about; a longer text stands alone.
BLOCK = 400_000
#: Stands for the whole word among the orders of n-grams.
WORD = 0

_PRIME, _MIX = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD6E8FEB86659FD93)
_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))


def blocks(texts: list[str | None], size: int = BLOCK) -> Iterator[tuple[int, int]]:
    """(begin, end) of runs of texts of about ``size`` characters."""
    begin = held = 0
    for k, text in enumerate(texts):
        held += len(text or "")
        if held >= size:
            yield begin, k + 1
            begin, held = k + 1, 0
    if begin < len(texts):
        yield begin, len(texts)


def layout(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """Code points of all texts in lower case, white space as 32, and where each text begins. Null is as empty."""
    padded = [f" {(t or '').lower()} " for t in texts]
    codes = np.frombuffer("".join(padded).encode("utf-32-le", "surrogatepass"), "<u4").copy()
    codes[(codes < 32) | (codes == 0xA0)] = 32
    return codes, np.concatenate(([0], np.cumsum([len(t) for t in padded])[:-1])).astype(np.int64)


def grams(codes: np.ndarray, orders: tuple[int, ...], bits: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """For each order (places, buckets) of its features: words by ``WORD``, else n-grams of that many characters, of which the first or last may be the space beside a word."""
    space = codes == 32
    seen = np.cumsum(space, dtype=np.int32)
    x = (codes.astype(np.uint64) + np.uint64(1)) * _MIX
    shift = np.uint64(64 - bits)
    rolling, n = x, 1
    with np.errstate(over="ignore"):
        for order in sorted(orders):
            if order == WORD:
                begin = np.flatnonzero(~space[1:] & space[:-1]) + 1
                end = np.flatnonzero(space[1:] & ~space[:-1]) + 1
                power = np.full(len(codes), _PRIME)
                power[0] = 1
                total = np.cumsum(x * np.multiply.accumulate(power), dtype=np.uint64)
                power[1:] = _INVERSE
                back = np.multiply.accumulate(power)
                h = (total[end - 1] - total[begin - 1]) * back[begin]
                yield begin, _bucket(h + np.uint64(7), shift)
                continue
            while n < order:
                rolling = rolling[:-1] * _PRIME + x[n:]
                n += 1
            if len(rolling) < 1:
                continue
            last = len(rolling)
            clear = seen[n - 2 : n - 2 + last] == seen[:last] if n > 1 else ~space
            if n == 2:
                clear = ~(space[:last] & space[1:])
            at = np.flatnonzero(clear)
            yield at, _bucket(rolling[at] + np.uint64(n), shift)


def repeats(codes: np.ndarray, starts: np.ndarray, bits: int, times: int = 4) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Features that say of each word whether it and the next one stood together earlier in the text, given ``times`` fold.

    An average of vectors can't see repetition otherwise. The buckets are the first ``2 * times``.
    """
    at, words = next(grams(codes, (WORD,), 31))
    if not len(at):
        return
    text = np.searchsorted(starts, at, "right")
    with np.errstate(over="ignore"):
        pair = (words.astype(np.uint64) * _PRIME + np.append(words[1:], 0).astype(np.uint64)) * _MIX ^ text.astype(np.uint64) * _PRIME
    order = np.argsort(pair, kind="stable")
    again = np.zeros(len(at), bool)
    again[order[1:]] = pair[order[1:]] == pair[order[:-1]]
    for k in range(times):
        yield at, (2 * k + again).astype(np.int32)


def _bucket(h: np.ndarray, shift: np.uint64) -> np.ndarray:
    h = h ^ (h >> np.uint64(29))
    return ((h * _MIX) >> shift).astype(np.int32)


def labelled_sample(labels: DataFrame, column: str, per_class: int) -> DataFrame:
    """(doc_id, y) of at most ``per_class`` rows of each class to learn from, the first by a hash of their id.

    Rows whose id is held out, null ids and null labels are never taken; an id that has several labels has the largest.
    """
    own = labels.where(~held_out(F.col("doc_id")) & F.col("doc_id").isNotNull() & F.col(column).isNotNull())
    own = own.groupBy("doc_id").agg(F.max(F.col(column).cast("int")).alias("y"))
    return own.where("y = 0").orderBy(F.xxhash64("doc_id"), "doc_id").limit(per_class).unionByName(own.where("y = 1").orderBy(F.xxhash64("doc_id"), "doc_id").limit(per_class))


def class_counts(labels: DataFrame, column: str) -> tuple[int, int]:
    """How many rows to learn from are of class 0 and of class 1, in all."""
    own = labels.where(~held_out(F.col("doc_id")) & F.col("doc_id").isNotNull())
    row = own.agg(F.count_if(F.col(column) == 0).alias("no"), F.count_if(F.col(column) == 1).alias("yes")).first()
    return row["no"], row["yes"]


def sigmoid(x):
    return 1.0 / (1.0 + np.exp(-np.clip(x, -40, 40)))
